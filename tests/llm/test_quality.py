from collections import Counter

from pyspark.sql import functions as F

from bidscope.llm import quality


def base(text, words):
    w = words(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    # Words keep their case here, so count on the text's own words.
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_base_measures(documents, words):
    texts = [
        None,
        "",
        " \n\t ",
        "one two three four five " * 3,
        "a b c d e f g. a b c d e x. b c d e x\nsame line\nsame line\n same line",
        "a " * 40,
        "###$% é ü |<>&* z",
        "x" * 20000 + " y",
        "p q r s t u v w\x0bx\x0cy z.\r\np q r s t u v w x",
    ]
    df = documents([(i, t, "s") for i, t in enumerate(texts)])
    for r in quality.judge(df).collect():
        expected = base(texts[r.doc_id], words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected, texts[r.doc_id][:50]
        assert r.base_failed == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])
        assert not (r.kept and r.base_failed)


def test_lines_fail_and_documents_lose_too_much(documents):
    good = "The committee met again on Tuesday and went through the open items one by one."
    junk = {
        "nav": " | ".join(["home", "about", "news", "contact", "help", "login", "terms", "imprint"] * 3),
        "symbols": " ".join(f"word{i}%%%" for i in range(40)),
        "shouts": " ".join(f"BUY{i}!!" for i in range(40)),
        "open end": " ".join(f"word{i}" for i in range(40)),
    }
    rows = [(0, good, "s"), (1, good + "\nLicensed under some licence, see below.", "s")]
    rows += [(2 + i, text, "s") for i, text in enumerate(junk.values())]
    rows += [(9, good + "\n" + junk["nav"] + "\n" + junk["symbols"], "s"), (10, good + "\n\n" + good + " Twice.", "s")]
    got = {r.doc_id: r for r in quality.judge(documents(rows)).collect()}
    assert got[0].kept and got[0].cleaned == good and got[0].n_lines_dropped == 0
    assert got[1].kept and got[1].cleaned == good and got[1].n_lines_dropped == 1
    assert not any(got[i].kept for i in (2, 3, 4, 5, 9))
    assert got[9].cleaned == good and got[9].lost > quality.MAX_LOST
    assert "\n\n" in got[10].cleaned  # empty lines stay


def test_rows_and_columns_pass(spark, documents):
    good = "The committee met again on Tuesday and went through the open items one by one."
    df = documents([(1, good, "s"), (1, good, "s"), (None, good, None), (2, None, "s")], kept=F.lit("x"), lost=F.lit(1))
    judged = quality.judge(df)
    assert judged.columns.count("kept") == judged.columns.count("lost") == 1
    assert judged.schema["kept"].dataType.typeName() == "boolean"
    assert judged.filter("kept").count() == 3
    cleaned = quality.clean(df)
    assert cleaned.columns == df.columns and cleaned.count() == 3
    assert quality.clean(df.limit(0)).collect() == quality.judge(df.limit(0)).collect() == []


def test_no_python_and_no_shuffle(documents):
    plan = quality.judge(documents([(1, "a", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
