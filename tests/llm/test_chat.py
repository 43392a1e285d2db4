import hashlib

from bidscope.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def expected(rows):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return len(rows), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def digests(df, **kw):
    windowed = chat.windows(df, **kw)
    return {r.conv_id: tuple(r)[1:5] for r in chat.digest(windowed).collect()}


NASTY = [
    ("system", "be <turn kind>\n</turn>\n<turn user>\n"),
    ("user", r"\### Assistant: </turn> ok"),
    ("assistant", "\\l \\b \\\\l <|im_end|> \n</turn>\n"),
    ("user", ""),
    ("assistant", None),
    (None, "no role"),
    ("odd\nrole>\n<x \\n", "é ü 😀   end\n"),
    ("assistant", "😀" * 700),
    ("assistant", "\n"),
]


def test_round_trip_of_any_text(spark):
    rows = [(1, k, r, t) for k, (r, t) in enumerate(NASTY)] + [(2, 0, "assistant", "alone")]
    for kw in ({}, {"budget": 20, "history_turns": 1}, {"budget": 40, "group": 2}, {"history_turns": 0}):
        assert digests(frame(spark, rows), **kw) == {1: expected(NASTY), 2: expected([("assistant", "alone")])}


def test_windows_keep_the_system_turn_and_mask_repeats(spark):
    turns = [("system", "rules")] + [(("user", "assistant")[k % 2], f"turn {k} " + "x" * 40) for k in range(12)]
    rows = [(5, k, r, t) for k, (r, t) in enumerate(turns)]
    got = chat.windows(frame(spark, rows), budget=60, history_turns=2, history_tokens=30).orderBy("window").collect()
    assert len(got) > 2
    targets = []
    for w in got:
        assert w.formatted.startswith("<turn system>\nrules\n</turn>\n")
        parts = w.formatted.split("</turn>\n")[:-1]
        assert sum(-(-len(p.split(">\n", 1)[1].rstrip("\n")) // 4) + 1 for p in parts) <= 60 + 2
        spans = [w.formatted[s.start - 1 : s.start - 1 + s.length] for s in w.loss_spans]
        targets += spans
        new = parts[w.n_repeated :]
        assert spans == [p.split(">\n", 1)[1][:-1] for p in new if p.startswith("<turn assistant>")]
    assert [w.n_repeated > 1 for w in got] == [False] + [True] * (len(got) - 1)
    assert targets == [t for r, t in turns if r == "assistant"]


def test_order_nulls_ties_and_empty_tables(spark):
    rows = [
        (1, 2, "user", "b"),
        (1, None, "assistant", "first"),
        (1, 2, "user", "a"),
        (1, 2, "user", "a"),
        (None, 0, "assistant", "x"),
        (None, 1, "system", "late"),
    ]
    got = digests(frame(spark, rows))
    assert got[1] == expected([("assistant", "first"), ("user", "a"), ("user", "a"), ("user", "b")])
    assert got[None] == expected([("assistant", "x"), ("system", "late")])
    assert digests(frame(spark, rows[:0])) == {}


def test_a_long_conversation_is_many_groups(spark):
    rows = [(9, k, ("user", "assistant")[k % 2], f"t{k}") for k in range(1000)]
    assert digests(frame(spark, rows), group=64)[9] == expected([(r, t) for _, _, r, t in rows])
    assert chat.windows(frame(spark, rows), group=64).count() == chat.windows(frame(spark, rows)).count()


def test_extra_columns_do_not_matter(spark):
    df = frame(spark, [(1, 0, "assistant", "a")]).selectExpr("*", "1 as run", "2 as window", "3 as starts")
    assert digests(df)[1] == expected([("assistant", "a")])


def uncut(rows, budget, history_turns, history_tokens):
    """Windows of one conversation, packed turn by turn: (first place, n_repeated, formatted)."""
    rows = sorted(((r[1], r[2] or "", r[3] or "") for r in rows), key=lambda t: (t[0] is not None, t))
    size = [-(-len(t[2].encode()) // 4) + 1 for t in rows]
    system = min((t for t in rows if t[1] == "system"), default=None)
    room = max(budget - history_tokens - (-(-len(system[2].encode()) // 4) + 1 if system else 0), 1)
    starts, used = [], room + 1
    for k, n in enumerate(size):
        used += n
        if used > room:
            starts, used = [*starts, k], n
    out = []
    for start, end in zip(starts, [*starts[1:], len(rows)]):
        h = 0
        while h < min(history_turns, start) and sum(size[start - h - 1 : start]) <= history_tokens:
            h += 1
        shown = rows[start - h : end]
        lead = system is not None and system not in shown
        shown = [system, *shown] if lead else shown
        out.append((start, h + lead, "".join(f"<turn {r}>\n{t}\n</turn>\n" for _, r, t in shown)))
    return out


def test_windows_are_those_of_the_uncut_conversation(spark):
    """Neither the size of a group nor the distance of turn numbers shows in a window."""
    rows = [(1, k * 1000, ("user", "assistant")[k % 2], f"t{k} " + "x" * (k * k % 61)) for k in range(700)]
    rows += [(2, k, "assistant", "ok") for k in range(300)] + [(3, 5, "system", "rules"), (3, None, "user", "a")]
    rows += [(3, 10**12 + k // 3, "user", "y" * (k % 7) * 9) for k in range(120)] + [(None, 0, "user", "z" * 900)] * 9
    for kw in ((512, 2, 128), (40, 3, 20), (9, 0, 0)):
        names = dict(zip(("budget", "history_turns", "history_tokens"), kw))
        want = sorted(
            (str(c), *w) for c in (1, 2, 3, None) for w in uncut([r for r in rows if r[0] == c], *kw)
        )
        for group in (2, 64, 10**9):
            got = chat.windows(frame(spark, rows), group=group, **names)
            assert sorted((str(r.conv_id), r.window, r.n_repeated, r.formatted) for r in got.collect()) == want
