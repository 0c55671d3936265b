"""Chat formatting in budgeted windows, in SQL functions only.

A conversation's turns are cut into windows for training, by prefix sums of
their tokens: with ``s`` the tokens before a turn and ``room`` those that a
window has for new turns, the turn belongs to span ``floor(s / room)``, and one
that runs over the end of its span is a window of its own.  So every turn finds
its window by itself; a window's new turns fill its room only if a single turn
is longer than that, as turns are never cut.  Before its new turns a window
repeats the system turn (the first turn, if its role says so) and the last
turns that begin within ``HISTORY`` tokens before it.  Only new assistant texts
are under the loss mask, so each is learned once.

Template: ``<|im_start|>role``, a line break, the text, ``<|im_end|>``, a line
break.  In texts and roles a backslash goes before the bar of ``<|``, ``<\\|``
and so on, so no control string is left in them; a line break in a role is
written ``<|nl|>``.  Both are undone on reading.

Prefix sums come from ranges of (conversation, turn), and windows are grouped
by (conversation, window), so a conversation with a third of all rows is split.

Cases: a null text or role is empty; a null turn comes first; turns of the same
number are ordered by role and md5 of the text; rows without a conversation id
are one conversation; repeated rows are turns of their own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.frames import Scratch, table
from strata.llm.ranges import deal, runs

START, END, BREAK = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
BUDGET = 512        # tokens of a window
HISTORY = 96        # tokens of repeated turns, at most
LEAST = 128         # tokens for new turns, however long the system turn is (HISTORY or more)
TURN_TOKENS = 4     # what the template adds to a turn
TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9\x00-\x20]"  # a word, or one other character
TARGET, SYSTEM = "assistant", "system"
BLOCK = 1024        # windows that get their system turn from one row
PROBE = "<|im_end|><|im_start|>assistant ok"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def tokens_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN)).cast("long") + TURN_TOKENS


def turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """Every turn with its place (ord), the tokens before it without the system
    turn (s), its conversation's room, tokens (last) and its window."""
    text, role = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role")]
    rows = conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.md5(text).alias("tie"),
        tokens_of(text).alias("tokens"))
    dealt = deal(rows, "conv_id", ["turn", "role", "tie"], scratch)
    own = runs(dealt, "conv_id", {"tokens": F.col("tokens"), "rows": F.lit(1)},
               head=F.min_by(F.struct("role", "tokens"), F.col("_place")))
    head = F.first("head").over(Window.partitionBy("conv_id").orderBy("_part"))
    own = own.withColumn("head", head).select(
        F.col("_part").alias("_p"), F.col("conv_id").alias("_c"), "total_tokens", "before_tokens", "before_rows",
        F.when(F.col("head.role") == SYSTEM, F.col("head.tokens")).otherwise(0).alias("system"))
    here = Window.partitionBy("_part", "conv_id").orderBy("_place")  # within a part
    placed = dealt.withColumn("_sum", F.sum("tokens").over(here)).withColumn("_row", F.row_number().over(here)) \
        .join(own, (F.col("_part") == F.col("_p")) & F.col("conv_id").eqNullSafe(F.col("_c")))
    placed = placed.select(
        "conv_id", "role", "text", "tokens", (F.col("before_rows") + F.col("_row") - 1).alias("ord"),
        (F.col("before_tokens") + F.col("_sum") - F.col("tokens") - F.col("system")).alias("s"),
        (F.col("total_tokens") - F.col("system")).alias("last"),
        F.greatest(F.lit(BUDGET - HISTORY) - F.col("system"), F.lit(LEAST)).alias("room"))
    span = F.floor(F.col("s") / F.col("room"))
    over = (F.col("s") > span * F.col("room")) & (F.col("s") + F.col("tokens") > (span + 1) * F.col("room"))
    return placed.withColumn("system", (F.col("ord") == 0) & (F.col("role") == SYSTEM)).withColumn(
        "window", F.when(F.col("system"), F.lit(0)).otherwise(span * 2 + over.cast("int")).cast("long"))


def _last_window(s: Column) -> Column:
    """The last window that may begin at or before ``s``."""
    return (F.floor(F.least(s, F.col("last") - 1) / F.col("room")) * 2 + 1).cast("long")


def windows(conversations: DataFrame) -> DataFrame:
    """One row per window: conv_id, window (ascending), the formatted text, its
    tokens, the number of repeated turns (n_context) and the loss mask as
    spans (start, end) of the text, in code points."""
    scratch = Scratch(conversations.sparkSession, "chat")
    every = scratch.write(turns(conversations, scratch))
    keep = ["conv_id", "window", "kind", "ord", "s", "tokens", "role", "text"]
    new = every.withColumn("kind", F.lit("new"))
    first, last = F.col("window") + 1, _last_window(F.col("s") + HISTORY)
    past = (every.filter(~F.col("system") & (F.col("tokens") <= HISTORY) & (first <= last))
            .withColumn("window", F.explode(F.sequence(first, last))).withColumn("kind", F.lit("past")))
    blocks = (every.filter(F.col("system") & (F.col("last") > 0))
              .withColumn("end", _last_window(F.col("last")))
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("end") / BLOCK))))
              .repartition("conv_id", "block"))
    begin = F.greatest(F.col("block") * BLOCK, F.lit(1))
    system = (blocks.filter(begin <= F.col("end")).withColumn("window", F.explode(F.sequence(
        begin, F.least(F.col("end"), F.col("block") * BLOCK + BLOCK - 1)))).withColumn("kind", F.lit("system")))
    rows = new.select(*keep).unionByName(past.select(*keep)).unionByName(system.select(*keep))
    held = rows.groupBy("conv_id", "window").agg(
        F.min(F.when(F.col("kind") == "new", F.col("s"))).alias("from"),
        F.collect_list(F.struct("ord", "kind", "s", "tokens", "role", "text")).alias("turns"))
    held = held.filter("from IS NOT NULL").withColumn("turns", F.array_sort(F.filter(
        "turns", lambda x: (x["kind"] != "past") | (x["s"] >= F.col("from") - HISTORY))))

    def formatted(x: Column) -> Column:
        role = F.replace(escape(x["role"]), F.lit("\n"), F.lit(BREAK))
        return F.struct(F.concat(F.lit(START), role, F.lit("\n")).alias("head"), escape(x["text"]).alias("body"),
                        ((x["kind"] == "new") & (x["role"] == TARGET)).alias("loss"))

    none = F.expr("CAST(array() AS array<struct<start:int,end:int>>)")

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.length(x["head"])
        b = a + F.length(x["body"])
        span = F.array(F.struct(a.alias("start"), b.alias("end")))
        return F.struct((b + len(END)).alias("at"),
                        F.when(x["loss"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return held.withColumn("parts", F.transform("turns", formatted)).select(
        "conv_id", "window",
        F.array_join(F.transform("parts", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "").alias("text"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, x: n + x["tokens"]).alias("n_tokens"),
        F.size(F.filter("turns", lambda x: x["kind"] != "new")).alias("n_context"),
        F.aggregate("parts", F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per window, from its text and mask alone: new turns (role, text) and the
    texts under the loss mask, unescaped."""
    pieces = F.split("text", r"<\|im_end\|>\n", -1)
    new = F.slice(pieces, F.col("n_context") + 1, F.size(pieces) - 1 - F.col("n_context"))

    def turn(x: Column) -> Column:
        said = F.substring(x, F.lit(len(START) + 1), F.length(x))
        role = F.substring_index(said, "\n", 1)
        return F.struct(
            unescape(F.replace(role, F.lit(BREAK), F.lit("\n"))).alias("role"),
            unescape(F.substring(said, F.length(role) + 2, F.length(said))).alias("text"))

    learned = F.transform("loss", lambda m: unescape(
        F.substring(F.col("text"), m["start"] + 1, m["end"] - m["start"])))
    return formatted.select("conv_id", "window", F.length("text").cast("long").alias("n_chars"),
                            F.transform(new, turn).alias("turns"), learned.alias("learned"))


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows.  A digest of a
    whole conversation needs its text in one row."""
    said = F.array_join(F.transform("turns", lambda x: F.concat(
        x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    back = read_back(formatted).select(
        "conv_id", "window", "n_chars", F.size("turns").cast("long").alias("n"), said.alias("said"),
        F.array_join("learned", "").alias("learned"))

    def whole(column: str) -> Column:
        return F.array_join(F.transform(F.col("parts"), lambda x: x[column]), "")

    return (back.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum(F.length("learned").cast("long")).alias("loss_chars"),
        F.sum("n_chars").alias("formatted_chars"), F.count("*").alias("n_windows"),
        F.array_sort(F.collect_list(F.struct("window", "said", "learned"))).alias("parts"))
        .select("conv_id", "n_turns", F.sha2(whole("said"), 256).alias("turns_sha256"), "loss_chars",
                F.sha2(whole("learned"), 256).alias("loss_sha256"), "formatted_chars", "n_windows"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, TARGET, PROBE)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return digests(Scratch(spark, "chat").write(windows(rows)))


# ---- the same in SQL -----------------------------------------------------------

def _oracle() -> str:
    esc = r"regexp_replace({0}, '<(\\*)\|', '<\\\1|', 'g')"
    fixed = len(START) + 1 + len(END)
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, '{TARGET}', '{PROBE}')),
t AS (SELECT *, len(regexp_extract_all(text, '{TOKEN}')) + {TURN_TOKENS} AS n,
  {fixed} + length(replace({esc.format('role')}, chr(10), '{BREAK}')) + length({esc.format('text')}) AS chars FROM c),
o AS MATERIALIZED (SELECT *, row_number() OVER w - 1 AS ord, sum(n) OVER w - n AS before
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
h AS (SELECT conv_id, CASE WHEN role = '{SYSTEM}' THEN n ELSE 0 END AS sys,
  CASE WHEN role = '{SYSTEM}' THEN chars ELSE 0 END AS sys_chars FROM o WHERE ord = 0),
p AS (SELECT o.*, before - sys AS s, sys, sys_chars, greatest({BUDGET - HISTORY} - sys, {LEAST}) AS room
  FROM o JOIN h ON o.conv_id IS NOT DISTINCT FROM h.conv_id),
q AS MATERIALIZED (SELECT *, ord = 0 AND sys > 0 AS is_sys, CASE WHEN ord = 0 AND sys > 0 THEN 0 ELSE
  floor(s / room) * 2 + (s > floor(s / room) * room AND s + n > (floor(s / room) + 1) * room)::INT END AS win FROM p),
v AS (SELECT conv_id, win, min(s) AS s0 FROM q GROUP BY ALL),
past AS (SELECT v.conv_id, sum(chars) AS chars FROM v JOIN q ON q.conv_id IS NOT DISTINCT FROM v.conv_id
  AND NOT is_sys AND s >= s0 - {HISTORY} AND s < s0 GROUP BY ALL),
nw AS (SELECT conv_id, count(*) AS k FROM v GROUP BY ALL)
SELECT q.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ord)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{TARGET}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY ord) FILTER (role = '{TARGET}'), '')) AS loss_sha256,
  (sum(q.chars) + coalesce(any_value(past.chars), 0) + (any_value(k) - 1) * any_value(sys_chars))::BIGINT AS formatted_chars,
  any_value(k) AS n_windows
FROM q JOIN nw ON q.conv_id IS NOT DISTINCT FROM nw.conv_id
LEFT JOIN past ON q.conv_id IS NOT DISTINCT FROM past.conv_id GROUP BY q.conv_id"""


ORACLE = _oracle()
