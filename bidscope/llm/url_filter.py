"""URL rules as glob patterns, all of them run at once over every canonical URL.

The patterns are packed one after the other into words of 64 bits, a bit for the start of each
pattern and one for each of its characters. A URL is read byte by byte; shift, mask and keep are
three operations on the words, whatever the number of patterns, and a whole batch of URLs takes
each step together.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.llm.registry import query, table
from bidscope.llm.words import raw

#: The rules every caller of the query relies on, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Further globs over canonical URLs, weaker than the rules above; the first that fits decides.
GLOBS = (
    ("block", "*.spam-farm.*#*"),
    ("block", "*#*/wp-login.php*"),
    ("block", "*#/tag/*"),
    ("block", "*#*.exe"),
    ("allow", "*#*"),
)

#: Words of state that are held at once: the more globs there are, the fewer URLs a step takes.
_STATE = 1 << 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A to Z lowered, and path. Both are empty for null and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def canonical(url: Column) -> Column:
    """``.host#path``: neither part can hold a ``#``, so a glob can tell them apart."""
    host, path = host_and_path(url)
    return F.concat(F.lit("."), host, F.lit("#"), path)


def rule_glob(host: str, path: str) -> str:
    """Fits the host and all its subdomains, and paths that begin with ``path``."""
    return f"*.{host}#{path}*"


class GlobAutomaton:
    """Shift-And over many globs: ``*`` is any run of bytes, ``?`` any one byte."""

    def __init__(self, globs):
        self.globs = tuple(globs)
        chars: list[tuple[int, int | None]] = []  # (bit, byte or None for any)
        start, loop, accept, bit = [], [], [], 0
        for glob in self.globs:
            start.append(bit)
            for byte in glob.encode():
                if byte == ord("*"):
                    loop.append(bit)
                else:
                    bit += 1
                    chars.append((bit, None if byte == ord("?") else byte))
            accept.append(bit)
            bit += 1
        self.width = -(-bit // 64) if bit else 1
        self.start, self.loop = self._mask(start), self._mask(loop)
        self.accept = np.array(accept, dtype=np.int64)
        self.masks = np.zeros((256, self.width), dtype=np.uint64)
        for place, byte in chars:
            rows = slice(None) if byte is None else byte
            self.masks[rows, place // 64] |= np.uint64(1) << np.uint64(place % 64)

    def _mask(self, bits) -> np.ndarray:
        mask = np.zeros(self.width, dtype=np.uint64)
        for bit in bits:
            mask[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        return mask

    def first_match(self, texts: pa.Array) -> np.ndarray:
        """Number of the first glob that fits each whole text, -1 where none does."""
        data, offsets = raw(texts)
        lengths = np.diff(offsets)
        found = np.full(len(lengths), -1, dtype=np.int32)
        order = np.argsort(-lengths, kind="stable")
        step = max(1, _STATE // self.width)
        for lo in range(0, len(order), step):
            rows = order[lo : lo + step]
            found[rows] = self._run(data, offsets[:-1][rows], lengths[rows])
        return found

    def _run(self, data, begins, lengths) -> np.ndarray:
        """Lengths fall, so the texts that still have a byte are always the first ones."""
        state = np.tile(self.start, (len(begins), 1))
        falling = -lengths
        for step in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(falling, -step, side="left"))
            now = state[:live]
            moved = now << np.uint64(1)
            if self.width > 1:
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.masks[data[begins[:live] + step]]
            now &= self.loop
            now |= moved
        hit = (state[:, self.accept // 64] >> (self.accept % 64).astype(np.uint64)) & np.uint64(1)
        if not len(self.globs):
            return np.full(len(begins), -1, dtype=np.int32)
        return np.where(hit.any(axis=1), hit.argmax(axis=1), -1).astype(np.int32)


def first_match(key: Column, globs) -> Column:
    """Number of the first of ``globs`` that fits, -1 for none or null."""
    automaton = GlobAutomaton(globs)

    @F.arrow_udf("int")
    def match(texts: pa.Array) -> pa.Array:
        return pa.array(automaton.first_match(texts), type=pa.int32())

    return F.when(key.isNull(), F.lit(-1)).otherwise(match(key))


def judge(pages: DataFrame, rules=RULES, globs=GLOBS, url: str = "url") -> DataFrame:
    """Add host, path, rule, glob and verdict to every row.

    Of the rules that fit, the one with the longest host and path wins, the earlier one at a tie;
    without any, the first fitting glob decides, and without that the URL is allowed. Every row
    stays, repeated ones too; a null, empty or odd URL has an empty host and path. Columns of the
    input named like an added one are replaced.
    """
    ranked = sorted(rules, key=lambda rule: -len(rule[1] + rule[2]))
    verdicts = [rule[0] for rule in ranked] + [verdict for verdict, _ in globs]
    names = [host + path for _, host, path in ranked]
    patterns = [rule_glob(host, path) for _, host, path in ranked] + [glob for _, glob in globs]
    host, path = host_and_path(F.col(url))
    spare = f"_{len(pages.columns)}_match"
    found = pages.withColumn(spare, first_match(canonical(F.coalesce(F.col(url), F.lit(""))), patterns))

    def pick(values: list[str]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]).cast("array<string>"), F.col(spare))

    at, ruled = F.col(spare), len(names)
    return found.withColumns(
        {
            "host": host,
            "path": path,
            "rule": F.when((at >= 0) & (at < ruled), pick(names)),
            "glob": F.when(at >= 0, pick(patterns)),
            "verdict": F.when(at >= 0, pick(verdicts)).otherwise(F.lit("allow")),
        }
    ).drop(spare)


_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM split
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IS NOT NULL THEN CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END
    WHEN ('.' || host) LIKE '%.spam-farm.%' OR contains(path, '/wp-login.php')
      OR starts_with(path, '/tag/') OR ends_with(path, '.exe') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op3_url_filter", _SQL)
def url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")
