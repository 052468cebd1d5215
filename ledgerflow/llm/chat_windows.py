"""Conversations as training texts: windows of whole turns under a budget of tokens.

A turn is written as ``<|im_start|>role``, a line break, its text and ``<|im_end|>``.  Inside
texts and roles a ``<``, any number of backslashes and a ``|`` get one backslash more, so no
text holds a control string, and one backslash less gives it back.  ``%`` and line breaks of
roles are written as ``%25`` and ``%0A``.

The prefix sums of the turns' tokens place each turn.  A conversation's room is the budget
without its system turn and the history, a quarter of the budget at least.  Blocks of three
quarters of the room take the turns that start in them; the last one, where it ends beyond
the room, is a window of its own.  So a window keeps within the budget unless one turn, or
the system turn, is too long for that; turns are never cut.  Every window but the first
repeats the system turn and the last turns before it, as far as they fit into the history.

The loss mask covers the texts of assistant turns where they stand for the first time;
repeated ones are context only.

Only DataFrame operations run.  Turns are summed per run of ``SPAN`` turn numbers, then over
the runs, so that a long conversation is no single task; a turn meets the windows around it
by conversation and block.  Only ``read_back`` brings a conversation together, for its hash.

Defined results: a null text or role is empty; turns are ordered by number (null first), then
role and text, so repeated rows and ties have a place each; rows of one conversation and
turn number are ordered in one task; rows without a conv_id are one conversation; a system
turn counts as one where it is first; very long texts are one window each; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged, table

BUDGET = 2048
HISTORY = 256
SPAN = 64
# fixed values: the marks of the template
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# a run of letters, digits and characters beyond ASCII, or one ASCII sign
TOKEN = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]"
BEFORE_ALL = -(1 << 60)
CONV = ["conv", "unnamed"]


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def turns(conversations: DataFrame) -> DataFrame:
    """Every turn as it is written: its head, its text and the number of its tokens."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select(
        F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv"), F.col("conv_id").isNull().alias("unnamed"),
        F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("said"),
        F.concat(F.lit(OPEN), escaped_role(role), F.lit("\n")).alias("head"), escaped(text).alias("body"))
    whole = F.concat("head", "body", F.lit(CLOSE))
    return rows.withColumn("tokens", F.regexp_count(whole, F.lit(TOKEN)).cast("long"))


def placed(rows: DataFrame, budget: int, history: int) -> DataFrame:
    """Turns with ``start`` and ``end`` in their conversation's tokens, ``block`` and ``window``."""
    span = F.coalesce(F.floor(F.col("turn") / SPAN).cast("long"), F.lit(BEFORE_ALL))
    rows = rows.withColumn("span", span)
    run = Window.partitionBy(*CONV, "span").orderBy(F.asc_nulls_first("turn"), "role", "said").rowsBetween(
        Window.unboundedPreceding, 0)
    rows = rows.withColumn("within", F.sum("tokens").over(run))
    # runs of turns: what lies before each, and the system turn of the conversation
    before = Window.partitionBy(*CONV).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*CONV).orderBy("span").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    # the first turn of a run is the one whose sum is its own
    first = F.max(F.when((F.col("within") == F.col("tokens")) & (F.col("role") == "system"), F.col("tokens")))
    spans = rows.groupBy(*CONV, "span").agg(F.sum("tokens").alias("sum"), first.alias("first")).select(
        *CONV, "span", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"),
        F.coalesce(F.first("first").over(whole), F.lit(0)).alias("system"))
    room = F.greatest(budget - history - F.col("system"), F.lit(budget // 4))
    rows = rows.join(spans, [*CONV, "span"]).drop("span").withColumns({
        "start": F.col("offset") + F.col("within") - F.col("tokens"),
        "end": F.col("offset") + F.col("within"),
        "room": room,
        "step": F.floor(room * 3 / 4).cast("long"),
    })
    block = F.floor(F.col("start") / F.col("step")).cast("long")
    rows = rows.withColumn("block", block)
    crossing = (F.col("end") - F.col("block") * F.col("step") > F.col("room")).cast("long")
    return rows.withColumn("window", F.col("block") * 2 + crossing).drop("offset", "within", "room", "step")


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, repeated, text, loss, tokens), one row per window.

    ``repeated`` turns stand at the head of ``text`` without counting; ``loss`` holds the
    spans (start, end) of ``text``, in code points, that are trained on.
    """
    if 16 * history > 3 * budget:
        raise ValueError("the history may take three sixteenths of the budget")
    # three steps refer to the turns, which are written once
    rows = staged(placed(turns(conversations), budget, history), "chat-turns")
    windows = rows.groupBy(*CONV, "window").agg(F.min("start").alias("at"))

    # a turn may be history of the windows that start within its block or in the next one
    block = F.floor(F.col("window") / 2).cast("long")
    near = windows.select(
        *CONV, F.explode(F.array(block, block - 1)).alias("block"), F.struct("window", "at").alias("w")
    ).groupBy(*CONV, "block").agg(F.collect_list("w").alias("near"))  # at most four
    is_system = (F.col("start") == 0) & (F.col("role") == "system")
    own = F.struct(F.col("window").alias("window"), F.lit(True).alias("fresh"))
    again = F.transform(
        F.filter("near", lambda w: (w["at"] >= F.col("end")) & (F.col("start") >= w["at"] - history) & ~is_system),
        lambda w: F.struct(w["window"].alias("window"), F.lit(False).alias("fresh")))
    turn = F.struct("start", "fresh", "head", "body", F.col("role").alias("role"), "tokens")
    shown = rows.join(near, [*CONV, "block"]).withColumn(
        "use", F.explode(F.concat(F.array(own), again))).select(
        *CONV, "use.window", F.col("use.fresh").alias("fresh"), "start", "head", "body", "role", "tokens")
    system = rows.filter(is_system).select(
        *CONV, F.lit(-1).cast("long").alias("start"), "head", "body", "role", "tokens")
    shown = shown.unionByName(windows.filter("at > 0").select(*CONV, "window").join(system, CONV).withColumn(
        "fresh", F.lit(False)))

    told = shown.groupBy(*CONV, "window").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    sizes = F.transform("turns", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(CLOSE))
    trained = lambda t: t["fresh"] & (t["role"] == "assistant")
    no_spans = F.array().cast("array<struct<start:long,end:long>>")

    def with_turn(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(t["head"])
        end = begin + F.length(t["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            (end + len(CLOSE)).alias("at"),
            F.when(trained(t), F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    loss = F.aggregate(
        "turns", F.struct(F.lit(0).cast("long").alias("at"), no_spans.alias("spans")), with_turn)["spans"]
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    return told.select(
        F.when(~F.col("unnamed"), F.col("conv")).alias("conv_id"), "window",
        F.size(F.filter("turns", lambda t: ~t["fresh"])).alias("repeated"), text.alias("text"), loss.alias("loss"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation say, from their texts and loss spans alone."""
    parts = F.split("text", r"<\|im_start\|>")
    inner = F.transform(
        F.slice(parts, F.col("repeated") + 2, F.size(parts)),
        lambda t: F.substring(t, F.lit(1), F.length(t) - len(CLOSE)))
    said = F.transform(inner, lambda t: F.concat(
        unescaped_role(F.substring_index(t, "\n", 1)), F.lit("\n"),
        unescaped(F.substring(t, F.length(F.substring_index(t, "\n", 1)) + 2, F.length(t))), F.lit("\n")))
    trained = F.transform("loss", lambda s: unescaped(F.substring(
        F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    told = formatted.select(
        "conv_id", F.length("text").cast("long").alias("chars"), F.size(inner).cast("long").alias("n"),
        F.struct("window", F.array_join(said, "").alias("said"), F.array_join(trained, "").alias("trained")).alias("part"))
    whole = told.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("part")).alias("parts"))
    loss = F.array_join("parts.trained", "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join("parts.said", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


# fixed values: a conversation of nothing but control strings
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def with_control_conversation(conversations: DataFrame) -> DataFrame:
    extra = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def op11_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted, written and read back."""
    rows = with_control_conversation(table(spark, sf_dir, "conversations"))
    return read_back(staged(chat_windows(rows), "op11-windows"))


OP11_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')),
e AS (SELECT *, '{OPEN}' || regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\\\1|', 'g') || chr(10)
  || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '{CLOSE[:-1]}' || chr(10) AS w FROM t),
n AS (SELECT *, row_number() OVER o AS place, len(regexp_extract_all(w, '{TOKEN}')) AS tokens, sum(len(regexp_extract_all(w, '{TOKEN}'))) OVER o AS e
  FROM e WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
r AS (SELECT *, e - tokens AS s, greatest({BUDGET - HISTORY} - coalesce(first(CASE WHEN role = 'system' THEN tokens END) OVER c, 0), {BUDGET // 4}) AS room,
  first(CASE WHEN role = 'system' THEN w ELSE '' END) OVER c AS system FROM n WINDOW c AS (PARTITION BY conv_id ORDER BY place)),
b AS (SELECT *, s // (room * 3 // 4) AS block FROM r),
x AS (SELECT *, block * 2 + (e - block * (room * 3 // 4) > room)::INT AS win FROM b),
g AS (SELECT conv_id, win, min(s) AS s, sum(length(w)) AS chars, first(system) AS system FROM x GROUP BY 1, 2),
h AS (SELECT g.conv_id, g.win, g.chars + CASE WHEN g.s > 0 THEN length(g.system) ELSE 0 END + coalesce(sum(length(x.w)), 0) AS chars
  FROM g LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM g.conv_id AND x.e <= g.s AND x.s >= g.s - {HISTORY}
    AND NOT (x.place = 1 AND x.role = 'system') GROUP BY g.conv_id, g.win, g.chars, g.s, g.system),
f AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM h GROUP BY 1),
q AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256 FROM x GROUP BY 1)
SELECT q.*, formatted_chars FROM q JOIN f ON q.conv_id IS NOT DISTINCT FROM f.conv_id"""
