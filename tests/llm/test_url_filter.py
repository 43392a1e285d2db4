import fnmatch
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from bidscope.llm import url_filter as U


def test_automaton_equals_regular_expressions():
    rng = random.Random(5)
    globs = ["".join(rng.choices("ab*?é", k=rng.randint(0, 9))) for _ in range(60)]  # several words of bits
    texts = ["".join(rng.choices("abé", k=rng.randint(0, 12))) for _ in range(300)] + ["", "a" * 5000]

    def first(text):
        for k, glob in enumerate(globs):
            parts = [".*" if c == 42 else "." if c == 63 else re.escape(chr(c)) for c in glob.encode()]
            if re.fullmatch("".join(parts), text.encode().decode("latin-1"), re.S):
                return k
        return -1

    automaton = U.GlobAutomaton(globs)
    assert automaton.width > 1
    assert automaton.first_match(pa.array(texts)).tolist() == [first(t) for t in texts]
    assert U.GlobAutomaton([]).first_match(pa.array(["a", ""])).tolist() == [-1, -1]
    assert fnmatch.fnmatch("ab", "a*")


def judged(spark, urls, **kw):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return [(r.host, r.path, r.rule, r.verdict) for r in U.judge(df, **kw).orderBy("page_id").collect()]


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://Shop.EXAMPLE.net/en/1?q#t": ("shop.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net": ("example.net", "", None, "allow"),
        "https://x.net/": ("x.net", "/", "net/", "block"),
        "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "https://example.com/de/?x": ("example.com", "/de/", "example.com/de/", "block"),
        "https://example.com/de": ("example.com", "/de", None, "allow"),
        "//no.scheme/net/": ("", "", None, "allow"),
        "a://ÄÖ.org/fr/Ü?": ("ÄÖ.org", "/fr/Ü", "org/fr/", "allow"),
        "a://b.org?://c.net/": ("b.org", "", None, "allow"),
        "http://h#x/net/": ("h", "", None, "allow"),
        "http://a.com/x.net/": ("a.com", "/x.net/", None, "allow"),
        "http://spam-farm.example.org/a": ("spam-farm.example.org", "/a", None, "block"),
        "http://a.com/wp-login.php": ("a.com", "/wp-login.php", None, "block"),
        "http://a.com/" + "x" * 30000 + ".exe": ("a.com", "/" + "x" * 30000 + ".exe", None, "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    assert judged(spark, list(cases)) == list(cases.values())


def test_longest_rule_wins_then_the_first(spark):
    rules = (("allow", "b.c", "/x"), ("block", "c", "/x/longer"), ("block", "b.c", "/y"), ("allow", "b.c", "/y"))
    got = judged(spark, ["t://a.b.c/x/longer", "t://b.c/x/l", "t://b.c/yy"], rules=rules, globs=())
    assert [g[2:] for g in got] == [("c/x/longer", "block"), ("b.c/x", "allow"), ("b.c/y", "block")]


def test_rows_stay_and_clashing_columns_are_replaced(spark):
    df = spark.createDataFrame([(1, "t://a.net/"), (1, "t://a.net/"), (2, None)], "page_id long, url string")
    df = df.withColumn("verdict", F.lit(1)).withColumn("host", F.lit(2))
    got = U.judge(df)
    assert got.columns.count("verdict") == 1 and got.count() == 3
    assert [r.verdict for r in got.filter("page_id = 1").collect()] == ["block", "block"]
    assert U.judge(df.limit(0)).count() == 0
