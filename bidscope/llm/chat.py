"""Chat conversations as training windows of a token budget, with a loss mask.

Turns are packed into spans by running sums of their tokens; a span never splits a turn. Each
window shows the system turn, a limited history of the turns before its span, and the span. Only
the assistant turns of the span carry loss, so each of them is a target once, in one window.

Turns are put into order by ranges and dealt into groups of ``GROUP`` places, so a conversation that
holds a third of all rows is spread over many tasks. What a group does to the open span is a short
step function; these are chained, so windows are those of the uncut conversation.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.llm.registry import query, table
from bidscope.operators.numbering import totals_before

BUDGET = 512
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
#: Places of the overall order that one group holds; windows do not depend on it.
GROUP = 256

#: Fixed values of the template: ``<turn role>`` line, text, ``</turn>`` line.
OPEN, HEAD_END, CLOSE = "<turn ", ">\n", "\n</turn>\n"

CONVERSATIONS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def escape(text: Column) -> Column:
    """No ``<`` or ``>`` is left, so no text can look like a mark of the template."""
    for char, code in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Undo ``escape``: a backslash only ever begins a code, and codes do not overlap."""
    for char, code in ((">", "\\g"), ("<", "\\l"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def token_count(text: Column) -> Column:
    """Tokens by size: four UTF-8 bytes a token, rounded up, and one for the turn's marks."""
    return (F.ceil(F.octet_length(text) / 4) + 1).cast("int")


#: What some turns do to the open span, by its tokens: the first step whose ``above`` they exceed
#: gives the tokens and first place of the span then open; below all steps, ``total`` is added.
STEPS = "array<struct<above:bigint,used:bigint,start:bigint>>"


def _span(used: Column, start: Column) -> Column:
    return F.struct(used.cast("long").alias("used"), start.cast("long").alias("start"))


def _after(change: Column, span: Column) -> Column:
    """The open span after a change."""
    step = F.get(F.filter(change["steps"], lambda e: span["used"] > e["above"]), F.lit(0))
    return F.when(step.isNotNull(), _span(step["used"], step["start"])).otherwise(
        _span(span["used"] + change["total"], span["start"])
    )


def _chained(first: Column, second: Column) -> Column:
    """One change that does two, one after the other. A span has a token at least."""

    def moved(e: Column) -> Column:
        span = _after(second, e)
        return F.struct(e["above"].alias("above"), span["used"].alias("used"), span["start"].alias("start"))

    shifted = F.transform(
        second["steps"],
        lambda e: F.struct((e["above"] - first["total"]).alias("above"), e["used"].alias("used"), e["start"].alias("start")),
    )
    closed = (F.size(first["steps"]) > 0) & (F.try_element_at(first["steps"], F.lit(-1))["above"] <= 0)
    steps = F.transform(first["steps"], moved)
    return F.struct(
        (first["total"] + second["total"]).alias("total"),
        F.when(closed, steps).otherwise(F.concat(steps, shifted)).alias("steps"),
    )


def _no_change() -> Column:
    return F.struct(F.lit(0).cast("long").alias("total"), F.array().cast(STEPS).alias("steps"))


def _open_spans(groups: DataFrame, group: int) -> DataFrame:
    """For each group that its predecessor may continue into: the open span, and whose it is.

    Only one sequence reaches the end of a group's places, so there is one row per ``cell``. Changes
    are chained in blocks of ``group`` groups, and blocks along the sequence.
    """
    keys = ["conv_id"]
    turn = lambda t: F.struct(
        t["size"].alias("total"),
        F.array(
            F.struct((F.col("room") - t["size"]).alias("above"), t["size"].alias("used"), t["place"].alias("start"))
        ).alias("steps"),
    )
    changes = groups.filter(F.col("last") == (F.col("cell") + 1) * group - 1).select(
        *keys,
        "room",
        "first",
        F.floor(F.col("cell") / group).alias("block"),
        "cell",
        F.aggregate("own", _no_change(), lambda c, t: _chained(c, turn(t))).alias("change"),
    )
    blocks = changes.groupBy(*keys, "block").agg(
        F.min("first").alias("first"),
        F.min("room").alias("room"),
        F.sort_array(F.collect_list(F.struct("cell", "change"))).alias("changes"),
    )
    blocks = blocks.withColumn("change", F.aggregate("changes", _no_change(), lambda c, x: _chained(c, x["change"])))
    # A sequence starts as if a span without room were open.
    scan = "array<struct<at:bigint,used:bigint,start:bigint>>"

    def scanned(items: Column, used: Column, start: Column, at: str, before: bool) -> Column:
        def step(s: Column, x: Column) -> Column:
            span = _after(x["change"], s["span"])
            out = s["span"] if before else span
            place = F.struct(x[at].cast("long").alias("at"), out["used"].alias("used"), out["start"].alias("start"))
            return F.struct(span.alias("span"), F.concat(s["out"], F.array(place)).alias("out"))

        state = F.struct(_span(used, start).alias("span"), F.array().cast(scan).alias("out"))
        return F.aggregate(items, state, step, lambda s: s["out"])

    tops = blocks.groupBy(*keys).agg(
        F.min("first").alias("origin"),
        F.min("room").alias("room"),
        F.sort_array(F.collect_list(F.struct("block", "change"))).alias("blocks"),
    )
    tops = tops.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        "origin",
        F.explode(scanned(F.col("blocks"), F.col("room") + 1, F.lit(-1), "block", True)).alias("begin"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    inside = blocks.join(tops, [*same, F.col("block") == F.col("begin.at")])
    inside = inside.select(
        *keys,
        "origin",
        F.explode(scanned(F.col("changes"), F.col("begin.used"), F.col("begin.start"), "cell", False)).alias("end"),
    )
    return inside.select(
        (F.col("end.at") + 1).alias("cell"),
        F.struct(*keys, "origin", F.col("end.used").alias("used"), F.col("end.start").alias("start")).alias("open"),
    )


def windows(
    turns: DataFrame,
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
    group: int = GROUP,
) -> DataFrame:
    """One row per window: conv_id, window, n_repeated, formatted and loss_spans.

    ``window`` is the place, from 0, of the window's first new turn. ``loss_spans`` are
    (start, length) in characters of ``formatted``, from 1. ``n_repeated`` is the number of turns
    at its start that other windows already hold: history, and the system turn in all but the
    window it belongs to. A window holds at most ``budget`` tokens, unless a single turn with what
    is retained is longer. The system turn is the conversation's first one of role ``system``.

    Turns are ordered by turn number (null first), then role and text; equal rows are all kept.
    Null roles and texts count as empty. A null conv_id is a conversation of its own. No rows
    give no windows. Other columns of the input are ignored.

    ``group`` bounds what one task gathers and changes no window.
    """
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        # Equal rows are told apart, so many of them do not share a range.
        F.monotonically_increasing_id().alias("_row_id"),
    )
    placed = totals_before(rows, ["conv_id", "turn", "role", "text", "_row_id"])
    systems = (
        placed.filter(F.col("role") == "system")
        .groupBy("conv_id")
        .agg(F.min(F.struct("turn", "role", "text")).alias("system"))
        .withColumnRenamed("conv_id", "_sys_conv")
    )
    # The last turns of a group are history in the next ones too.
    place = F.col("rows_before")
    cells = F.sequence(F.floor(place / group), F.floor((place + history_turns) / group))
    item = F.struct(
        place.alias("place"),
        token_count(F.col("text")).cast("long").alias("size"),
        F.struct("turn", "role", "text").alias("t"),
    )
    groups = (
        placed.select("conv_id", F.explode(cells).alias("cell"), item.alias("item"))
        .groupBy("conv_id", "cell")
        .agg(F.sort_array(F.collect_list("item")).alias("items"), F.max("item.place").alias("last"))
        .filter(F.col("last") >= F.col("cell") * group)
    )
    groups = groups.join(systems, F.col("conv_id").eqNullSafe(F.col("_sys_conv")), "left").drop("_sys_conv")
    kept_tokens = F.coalesce(token_count(F.col("system.text")), F.lit(0))
    groups = groups.withColumns(
        {
            "room": F.greatest(F.lit(budget - history_tokens) - kept_tokens, F.lit(1)).cast("long"),
            "own": F.filter("items", lambda i: i["place"] >= F.col("cell") * group),
        }
    ).withColumn("first", F.get("own", F.lit(0))["place"])
    groups = groups.join(_open_spans(groups, group), "cell", "left")
    continues = (
        F.col("open").isNotNull()
        & (F.col("first") == F.col("cell") * group)
        & F.col("conv_id").eqNullSafe(F.col("open.conv_id"))
    )
    groups = groups.withColumns(
        {
            "origin": F.when(continues, F.col("open.origin")).otherwise(F.col("first")),
            "used": F.when(continues, F.col("open.used")).otherwise(F.col("room") + 1),
            "sizes": F.transform("items", lambda i: i["size"]),
            "before": F.size("items") - F.size("own"),
        }
    )
    state = F.struct(
        F.col("used").alias("used"), F.array().cast("array<int>").alias("starts"), F.col("before").alias("at")
    )

    def step(s: Column, t: Column) -> Column:
        fits = s["used"] + t["size"] <= F.col("room")
        return F.struct(
            F.when(fits, s["used"] + t["size"]).otherwise(t["size"]).alias("used"),
            F.when(fits, s["starts"]).otherwise(F.concat(s["starts"], F.array(s["at"]))).alias("starts"),
            (s["at"] + 1).alias("at"),
        )

    groups = groups.withColumn("starts", F.aggregate("own", state, step, lambda s: s["starts"]))
    # What comes before a group's first start belongs to the open span.
    headless = F.coalesce(F.get("starts", F.lit(0)) > F.col("before"), F.lit(True))
    groups = groups.withColumn("headless", headless).withColumn(
        "starts", F.when(F.col("headless"), F.concat(F.array("before"), F.col("starts"))).otherwise(F.col("starts"))
    )
    spans = groups.select("*", F.posexplode("starts").alias("piece", "start")).withColumns(
        {
            "end": F.coalesce(F.get(F.col("starts"), F.col("piece") + 1), F.size("items")),
            "goes_on": F.col("headless") & (F.col("piece") == 0),
        }
    )
    # History: as many of the turns before as fit, nearest first.
    back = F.least(F.lit(history_turns), F.col("start"))
    reach = F.aggregate(
        F.sequence(F.lit(1), F.lit(max(history_turns, 1))),
        F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("tokens"), F.lit(True).alias("open")),
        lambda s, k: F.when(
            s["open"] & (k <= back) & (s["tokens"] + F.get(F.col("sizes"), F.col("start") - k) <= history_tokens),
            F.struct(
                (s["n"] + 1).alias("n"),
                (s["tokens"] + F.get(F.col("sizes"), F.col("start") - k)).alias("tokens"),
                F.lit(True).alias("open"),
            ),
        ).otherwise(F.struct(s["n"].alias("n"), s["tokens"].alias("tokens"), F.lit(False).alias("open"))),
        lambda s: s["n"],
    )
    spans = spans.withColumn(
        "history", F.when(F.lit(history_turns > 0) & ~F.col("goes_on"), reach).otherwise(F.lit(0))
    )
    first = F.col("start") - F.col("history")
    begun = F.get(F.col("items"), F.col("start"))["place"]
    pieces = spans.select(
        "conv_id",
        "origin",
        "system",
        "history",
        F.when(F.col("goes_on"), F.col("open.start")).otherwise(begun).alias("start"),
        F.struct(
            "cell", F.transform(F.slice("items", first + 1, F.col("end") - first), lambda i: i["t"]).alias("ts")
        ).alias("part"),
    )
    # A span's pieces lie in one group, or in several that follow each other.
    spans = pieces.groupBy("conv_id", "start").agg(
        F.min("origin").alias("origin"),
        F.min("system").alias("system"),
        F.max("history").alias("history"),
        F.flatten(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["ts"])).alias("shown"),
    )
    # The system turn leads the window unless it is among the turns shown anyway.
    shown = F.col("shown")
    lead = F.col("system").isNotNull() & ~F.coalesce(F.array_contains(shown, F.col("system")), F.lit(False))
    spans = spans.select(
        "conv_id",
        (F.col("start") - F.col("origin")).alias("window"),
        (F.col("history") + lead.cast("int")).alias("n_repeated"),
        F.when(lead, F.concat(F.array("system"), shown)).otherwise(shown).alias("shown"),
    )
    # A turn is its mark, its text and its end; the places of texts follow from the running length.
    spans = spans.withColumn(
        "pieces",
        F.transform(
            "shown",
            lambda t: F.struct(
                F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(HEAD_END)).alias("head"),
                escape(t["text"]).alias("body"),
                (t["role"] == "assistant").alias("target"),
            ),
        ),
    )
    places = F.aggregate(
        F.col("pieces"),
        F.struct(F.lit(1).alias("at"), F.lit(0).alias("k"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p["head"]) + F.length(p["body"]) + len(CLOSE)).alias("at"),
            (s["k"] + 1).alias("k"),
            F.when(
                p["target"] & (s["k"] >= F.col("n_repeated")),
                F.concat(
                    s["spans"],
                    F.array(
                        F.struct(
                            (s["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("length")
                        )
                    ),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return spans.select(
        "conv_id",
        "window",
        "n_repeated",
        F.array_join(
            F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), ""
        ).alias("formatted"),
        places.alias("loss_spans"),
    )


def read_turns(formatted: Column, n_repeated: Column) -> Column:
    """The turns (role, text) that a window adds, parsed from its text alone."""
    parts = F.filter(F.split(formatted, CLOSE), lambda p: p.startswith(OPEN))
    return F.transform(
        F.slice(parts, n_repeated + 1, F.lit(2**30)),
        lambda p: F.struct(
            unescape_role(F.substring_index(F.substring(p, len(OPEN) + 1, 2**30), HEAD_END, 1)).alias("role"),
            unescape(p.substr(F.instr(p, HEAD_END) + len(HEAD_END), F.length(p))).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, one target after the other."""
    texts = F.transform(spans, lambda s: unescape(formatted.substr(s["start"], s["length"])))
    return F.array_join(texts, "")


def digest(windowed: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: turns, their digest, and the loss digest."""
    read = windowed.select(
        "conv_id",
        F.struct(
                "window",
            read_turns(F.col("formatted"), F.col("n_repeated")).alias("turns"),
            loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
            F.length("formatted").alias("chars"),
        ).alias("w"),
    )
    whole = read.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    turns = F.flatten(F.transform("ws", lambda w: w["turns"]))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("ws", lambda w: w["loss"]), "")
    chars = F.aggregate("ws", F.lit(0).cast("long"), lambda total, w: total + w["chars"])
    return whole.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        chars.alias("formatted_chars"),
    )


@query("op7_chat_format")
def chat_format(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], CONVERSATIONS)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest(windows(turns.unionByName(extra)))
