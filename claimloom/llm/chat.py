"""Chat formatting in budgeted, turn-aligned windows, in DataFrame functions alone.

A conversation is cut into windows between turns. Prefix sums of turn tokens choose
the spans: a turn longer than ``stride`` is a span of its own; the others go to the
span ``floor(tokens before the turn / stride)`` of their stretch between long turns,
which therefore holds at most two strides. A window shows the system turn, the last
turns of the span before (within ``history_turns`` and ``history_tokens``) and its own
fresh turns. Only fresh assistant turns are under the loss mask, so each target is
there once and what is repeated is masked.

Prefix sums are made in two levels, over blocks of turns and within them, and spans
are bounded by their tokens, so a conversation with a third of all rows is spread
over many tasks; no row but the digest of ``read_back`` holds a whole conversation.

The template of a turn is ``### role ###``, a line feed, the text, ``</turn>`` and a
line feed. Inside roles and texts a backslash is put before each backslash, into each
``##`` and into each ``</turn>``, so that neither ``###`` nor ``</turn>`` is left there;
taking away each backslash that precedes another character gives the text back.

Defined results: null roles and texts are empty ones; turns are ordered by turn (null
first), then role and text, and repeated rows are turns of their own; a null conv_id
is a conversation like any other; an empty turn is kept and counts its overhead; an
empty table gives no windows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import cut

STRIDE = 768
HISTORY_TOKENS = 256
HISTORY_TURNS = 4
BUDGET = 2048
#: Tokens of a turn's markers; as none is free, a span holds at most 2 * STRIDE / OVERHEAD turns.
OVERHEAD = 4
BLOCK_TURNS = 64
TOKEN = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
END = "</turn>\n"


def escaped(text: Column) -> Column:
    """No ``###`` and no ``</turn>`` is left; ``unescaped`` gives the text back."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("##"), F.lit("#\\#"))
    return F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#/])", "$1")


def counted_tokens(text: Column) -> Column:
    """Runs of letters, single digits and runs of other signs."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("bigint")


def _turns(conversations: DataFrame, stride: int) -> DataFrame:
    """Each turn with its place in the conversation, the tokens before it and the long turns up to it."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
    ).withColumns(
        {
            "tokens": counted_tokens(F.col("text")) + OVERHEAD,
            "block": F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62))),
        }
    )
    turns = turns.withColumn("long", (F.col("tokens") > stride).cast("bigint"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    blocks = (
        turns.groupBy("conv_id", "block")
        .agg(F.count("*").alias("n"), F.sum("tokens").alias("t"), F.sum("long").alias("l"))
        .select(F.col("conv_id").alias("c"), F.col("block").alias("k"), before("n").alias("n0"), before("t").alias("t0"), before("l").alias("l0"))
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    placed = turns.withColumns({"n": F.count("*").over(inside), "t": F.sum("tokens").over(inside), "l": F.sum("long").over(inside)})
    return placed.join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("k"))).select(
        "conv_id",
        "role",
        "text",
        "tokens",
        (F.col("n0") + F.col("n")).alias("place"),
        (F.col("t0") + F.col("t") - F.col("tokens")).alias("before"),
        (F.col("l0") + F.col("l")).alias("stretch"),
        (F.col("long") == 1).alias("long"),
    )


def _tail(turns: str, history_turns: int, history_tokens: int) -> Column:
    """The last turns of a span that fit the history."""
    last = F.slice(F.col(turns), F.greatest(F.size(turns) - (history_turns - 1), F.lit(1)), F.lit(history_turns))
    later = lambda x: F.aggregate(F.filter(last, lambda y: y.place >= x.place), F.lit(0).cast("bigint"), lambda a, y: a + y.tokens)
    return F.filter(last, lambda x: later(x) <= history_tokens)


def windows(
    conversations: DataFrame,
    stride: int = STRIDE,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
    budget: int = BUDGET,
) -> DataFrame:
    """conv_id, window (from 0), formatted, kinds (system, history or fresh, by turn), loss_spans, tokens, over_budget.

    ``loss_spans`` are starts (from 1) and lengths in code points of ``formatted``.
    A window is over its budget only through a turn that alone is too long, or a long system turn.
    """
    # Placed turns and spans are read by several branches; each is written once to the shared folder.
    turns = cut(_turns(conversations, stride), "turns")
    key = ["conv_id", "stretch", "long", "part"]
    turns = turns.withColumn("part", F.when(F.col("long"), 0).otherwise(F.floor(F.col("before") / stride)).cast("bigint"))
    one = F.struct("place", escaped(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"), "tokens", (F.col("role") == "assistant").alias("target"))
    spans = turns.groupBy(*key).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    # The system turn travels with the spans' numbers, which are few and short beside the texts.
    numbers = turns.groupBy(*key).agg(F.min("place").alias("first"), F.min(F.when(F.col("role") == "system", one)).alias("own"))
    whole = Window.partitionBy("conv_id")
    numbers = numbers.withColumns({"window": F.row_number().over(whole.orderBy("first")) - 1, "system": F.min("own").over(whole)})
    numbers = numbers.select(*(F.col(c).alias(f"{c}_") for c in key), "first", F.col("window").cast("bigint").alias("window"), "system")
    same = F.col("conv_id").eqNullSafe(F.col("conv_id_")) & (F.col("stretch") == F.col("stretch_")) & (F.col("long") == F.col("long_")) & (F.col("part") == F.col("part_"))
    spans = cut(spans.join(numbers, same).select("conv_id", "window", "first", "turns", "system"), "spans")

    tails = spans.select(F.col("conv_id").alias("tail_conv"), (F.col("window") + 1).alias("tail_window"), _tail("turns", history_turns, history_tokens).alias("history"))
    joined = spans.join(tails, F.col("conv_id").eqNullSafe(F.col("tail_conv")) & (F.col("window") == F.col("tail_window")), "left")

    as_kind = lambda turns, kind: F.transform(turns, lambda x: F.struct(F.lit(kind).alias("kind"), x.role.alias("role"), x.text.alias("text"), x.tokens.alias("tokens"), (x.target & F.lit(kind == "fresh")).alias("target")))
    none = F.filter(F.col("turns"), lambda x: F.lit(False))
    kept_system = F.when(F.col("system.place") < F.col("first"), F.array("system")).otherwise(none)
    not_system = F.filter(F.coalesce("history", none), lambda x: F.coalesce(x.place != F.col("system.place"), F.lit(True)))
    shown = F.concat(as_kind(kept_system, "system"), as_kind(not_system, "history"), as_kind(F.col("turns"), "fresh"))
    joined = joined.select("conv_id", "window", shown.alias("shown"))

    head = lambda x: F.concat(F.lit("### "), x.role, F.lit(" ###\n"))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(a: Column, x: Column) -> Column:
        own = F.array(F.struct((a.at + F.length(head(x))).alias("start"), F.length(x.text).alias("length")))
        return F.struct((a.at + F.length(head(x)) + F.length(x.text) + len(END)).alias("at"), F.when(x.target, F.concat(a.spans, own)).otherwise(a.spans).alias("spans"))

    tokens = F.aggregate("shown", F.lit(0).cast("bigint"), lambda a, x: a + x.tokens)
    return joined.select(
        "conv_id",
        "window",
        F.array_join(F.transform("shown", lambda x: F.concat(head(x), x.text, F.lit(END))), "").alias("formatted"),
        F.transform("shown", lambda x: x.kind).alias("kinds"),
        F.aggregate("shown", start, step, lambda a: a.spans).alias("loss_spans"),
        tokens.alias("tokens"),
        (tokens > budget).alias("over_budget"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from the windows' text, kinds and loss spans."""
    parts = F.slice(F.split("formatted", END, -1), F.lit(1), F.size("kinds"))
    fresh = F.filter(F.arrays_zip(parts.alias("part"), F.col("kinds")), lambda x: x.kinds == "fresh")

    def turn(x: Column) -> Column:
        halves = F.split(x.part, " ###\n", 2)
        return F.concat(unescaped(F.substr(halves[0], F.lit(5))), F.lit("\n"), unescaped(halves[1]), F.lit("\n"))

    loss = F.transform("loss_spans", lambda x: unescaped(F.substr(F.col("formatted"), x.start, x.length)))
    read = formatted.select(
        "conv_id",
        "window",
        F.size(fresh).cast("bigint").alias("turns"),
        F.array_join(F.transform(fresh, turn), "").alias("text"),
        F.array_join(loss, "").alias("loss"),
        F.length("formatted").cast("bigint").alias("chars"),
    )
    # A digest needs its conversation in one row; nothing else here does.
    whole = read.groupBy("conv_id").agg(
        F.sum("turns").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("window", "text", "loss"))).alias("w"),
        F.sum("chars").alias("formatted_chars"),
    )
    joined = lambda field: F.array_join(F.transform("w", lambda x: x[field]), "")
    whole = whole.select("conv_id", "n_turns", joined("text").alias("text"), joined("loss").alias("loss"), "formatted_chars")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2("text", 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def oracle_sql(rows: str) -> str:
    """DuckDB SQL for ``read_back(windows(rows))``: digests from the turns themselves, and the windows' sizes by prefix sums over whole conversations."""
    white = r" \t\n\x0B\f\r"
    escaped_length = lambda c: f"length(replace(replace(replace({c}, '\\', '\\\\'), '##', '#\\#'), '</turn>', '<\\/turn>'))"
    return rf"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM ({rows})),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, len(regexp_extract_all(text, '\p{{L}}+|\p{{N}}|[^{white}\p{{L}}\p{{N}}]+')) + {OVERHEAD} AS tokens,
  {4 + 5 + len(END)} + {escaped_length("role")} + {escaped_length("text")} AS chars FROM c),
p AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY place) - tokens AS before, count_if(tokens > {STRIDE}) OVER (PARTITION BY conv_id ORDER BY place) AS stretch, tokens > {STRIDE} AS long FROM t),
k AS (SELECT *, CASE WHEN long THEN 0 ELSE before // {STRIDE} END AS part FROM p),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY first) - 1 AS "window" FROM (SELECT conv_id, stretch, long, part, min(place) AS first FROM k GROUP BY conv_id, stretch, long, part)),
w AS MATERIALIZED (SELECT k.*, n.first, n."window" FROM k JOIN n USING (conv_id, stretch, long, part)),
y AS (SELECT conv_id, min(place) AS place, arg_min(chars, place) AS chars FROM w WHERE role = 'system' GROUP BY conv_id),
h AS (SELECT w.conv_id, w."window" + 1 AS "window", w.place, w.chars FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, "window" ORDER BY place DESC) AS back, sum(tokens) OVER (PARTITION BY conv_id, "window" ORDER BY place DESC) AS later FROM w) w
  LEFT JOIN y USING (conv_id) WHERE back <= {HISTORY_TURNS} AND later <= {HISTORY_TOKENS} AND coalesce(w.place <> y.place, true)),
s AS (SELECT n.conv_id, y.chars FROM n JOIN y ON y.conv_id = n.conv_id AND y.place < n.first UNION ALL SELECT h.conv_id, h.chars FROM h JOIN n ON n.conv_id = h.conv_id AND n."window" = h."window" UNION ALL SELECT conv_id, chars FROM w)
SELECT a.*, z.formatted_chars FROM (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256 FROM w GROUP BY conv_id) a
JOIN (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM s GROUP BY conv_id) z ON z.conv_id = a.conv_id"""
