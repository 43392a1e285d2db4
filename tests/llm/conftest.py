import re

import pytest

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = str.maketrans(UPPER, UPPER.lower())


@pytest.fixture(scope="session")
def words():
    """The words of a text as the operators define them, by another way than theirs."""
    return lambda text: re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWERED))


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text, lang, source, n_chars) to a table, optionally with more columns."""

    def build(rows, **extra):
        df = spark.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows],
            "doc_id long, text string, lang string, source string, n_chars long",
        )
        for name, value in extra.items():
            df = df.withColumn(name, value)
        return df

    return build


@pytest.fixture(scope="session")
def prose():
    """Invented words in a fixed pseudo-random order."""

    def build(n, seed=0):
        state, out = seed * 7919 + 17, []
        for _ in range(n):
            state = (state * 1103515245 + 12345) % 2**31
            out.append("w" + format(state >> 8, "x"))
        return out

    return build
