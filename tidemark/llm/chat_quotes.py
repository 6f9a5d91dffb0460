"""Conversations without quotations, ordered by replies; DataFrame functions only.

Lines that begin with quote marks are cut into passages of one nesting level. A passage, and each
of its lines, is normalised and hashed; the hashes are joined with those of the texts, paragraphs
and lines that earlier messages of the conversation wrote themselves. The passage of the lowest
level that is found names the message replied to; a message without one replies to the one before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

#: Marks before a quoted line, and lines that introduce a quotation.
MARKS = r"^[ \t]{0,3}(>(?:[ \t]?>)*)"
INTRODUCTION = r"^\s*(?:On|Am|Le|El)\b.*\b(?:wrote|schrieb|a écrit|escribió)\s*:\s*$"
SPAN = 1024  # turns of a conversation that one window partition holds


def normalised(text: Column) -> Column:
    """Lower case, one space for each run of white space, none at the ends."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _hash(text: Column) -> Column:
    return F.md5(normalised(text))


def _lines(text: Column) -> Column:
    return F.split(text, r"\r?\n")


def parsed(messages: DataFrame) -> DataFrame:
    """(row, conv, turn, own, passages): messages that quote, with what they wrote themselves.

    A passage is (run, level, body): neighbouring lines of one level without their marks.
    """
    quoting = messages.where(F.col("text").rlike("(?m)" + MARKS))
    line = quoting.select("row", "conv", "turn", F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    marks = F.regexp_extract("line", MARKS, 1)
    line = line.withColumn("level", F.length(F.regexp_replace(marks, "[^>]", "")))
    line = line.withColumn("line", F.when(F.col("level") > 0, F.regexp_replace("line", MARKS + r"[ \t]?", "")).otherwise(F.col("line")))
    order = Window.partitionBy("row").orderBy("at")
    line = line.withColumn("new", (F.col("level") != F.lag("level", 1, -1).over(order)).cast("int"))
    leads_in = (F.col("level") == 0) & (F.lead("level", 1, 0).over(order) > 0) & F.col("line").rlike(INTRODUCTION)
    line = line.withColumn("run", F.sum("new").over(order)).withColumn("leads_in", leads_in).where(~F.col("leads_in"))

    def joined(lines: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(lines), lambda x: x["line"]), "\n")

    runs = line.groupBy("row", "conv", "turn", "run", "level").agg(joined(F.collect_list(F.struct("at", "line"))).alias("body"))
    own = F.array_sort(F.collect_list(F.when(F.col("level") == 0, F.struct("run", "body"))))
    quoted = F.array_sort(F.collect_list(F.when(F.col("level") > 0, F.struct("run", "level", "body"))))
    return runs.groupBy("row", "conv", "turn").agg(
        F.trim(F.array_join(F.transform(own, lambda x: x["body"]), "\n")).alias("own"), quoted.alias("passages")
    )


def originals(messages: DataFrame) -> DataFrame:
    """(conv, hash, origin): the first turn of a conversation that wrote a text, paragraph or line."""
    own = F.col("own")
    units = F.concat(F.array(own), F.split(own, r"\n[ \t]*\n"), _lines(own))
    unit = messages.select("conv", "turn", F.explode(F.array_distinct(F.transform(units, normalised))).alias("unit"))
    return unit.where("unit <> ''").groupBy("conv", F.md5("unit").alias("hash")).agg(F.min("turn").alias("origin"))


def linked(quotes: DataFrame, index: DataFrame) -> DataFrame:
    """(row, run, level, origin): the earlier turn that each passage quotes, null if none is known.

    A passage that is found whole is linked to that text; else the turn that has most of its lines
    counts, if these are more than half.
    """
    passage = quotes.select("row", "conv", "turn", F.explode("passages").alias("p")).select("row", "conv", "turn", "p.*")
    parts = F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), _hash(F.col("body")).alias("hash"))),
        F.transform(F.filter(_lines(F.col("body")), lambda x: normalised(x) != ""), lambda x: F.struct(F.lit(False).alias("whole"), _hash(x).alias("hash"))),
    )
    part = passage.select("row", "conv", "turn", "run", "level", F.explode(parts).alias("part")).select("*", "part.whole", "part.hash")
    same = part.conv.eqNullSafe(index.conv) & (part.hash == index.hash) & (index.origin < part.turn)
    found = part.join(index, same, "left").select("row", "run", "level", "whole", "origin")
    lines = F.sum(F.when(~F.col("whole"), 1).otherwise(0))
    counted = found.groupBy("row", "run", "level", "origin").agg(F.max("whole").alias("whole"), lines.alias("n"))
    per = counted.groupBy("row", "run", "level").agg(
        F.max(F.when(F.col("whole"), F.col("origin"))).alias("whole"),
        F.max(F.when(F.col("origin").isNotNull(), F.struct("n", "origin"))).alias("most"),
        F.sum("n").alias("n"),
    )
    by_lines = F.when(F.col("most.n") * 2 > F.col("n"), F.col("most.origin"))
    return per.select("row", "run", "level", F.coalesce("whole", by_lines).alias("origin"))


def _ordered(messages: DataFrame) -> DataFrame:
    """(conv, turn, before, branch): the turn before each turn, and the start of its branch.

    A branch starts at a turn that replies to another one than the turn before, and at the first
    turn. Turns are ordered within spans of ``SPAN``, then the spans of a conversation, so that a
    long conversation is not in one task.
    """
    turn = messages.groupBy("conv", "turn").agg(F.max("parent").alias("parent")).where("turn is not null")
    span = turn.withColumn("span", F.floor(F.col("turn") / SPAN))
    within = Window.partitionBy("conv", "span").orderBy("turn")
    ends = span.groupBy("conv", "span").agg(F.max("turn").alias("end"))
    spans = Window.partitionBy("conv").orderBy("span")
    ends = ends.select(F.col("conv").alias("_conv"), F.col("span").alias("_span"), F.lag("end").over(spans).alias("end"))
    met = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("span") == F.col("_span"))
    known = span.withColumn("near", F.lag("turn").over(within)).join(ends, met).drop("_conv", "_span")
    known = known.withColumn("before", F.coalesce("near", "end"))
    starts = F.col("before").isNull() | (F.col("parent").isNotNull() & (F.col("parent") != F.col("before")))
    known = known.select("conv", "turn", "span", "before", F.when(starts, F.col("turn")).alias("start"))
    last = known.groupBy("conv", "span").agg(F.max("start").alias("start"))
    upto = spans.rowsBetween(Window.unboundedPreceding, -1)
    last = last.select(F.col("conv").alias("_conv"), F.col("span").alias("_span"), F.max("start").over(upto).alias("earlier"))
    running = known.withColumn("own", F.max("start").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    return running.join(last, met).select("conv", "turn", "before", F.coalesce("own", "earlier").alias("branch"))


def conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, parent_turn, branch, n_quotes, n_linked) for every message, ordered by replies.

    ``text`` is without quotations and their introductions; ``parent_turn`` is the turn replied
    to, null for the first; ``branch`` is the turn at which the message's branch starts. Rows are
    sorted by conversation, branch and turn, so that a reply comes after what it replies to.

    Null texts count as empty, null conversations form one, null turns come last without parent
    and branch. Repeated turns stay; they share the turn before. Quotations of later or unknown
    messages are cut out and link nothing. No rows give no rows. Other columns are not read.
    """
    known = messages.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    known = known.withColumn("row", F.xxhash64("conv", "turn", "role", "text"))
    quotes = cut_lineage(parsed(known.distinct()))
    written = known.join(quotes.select("row", F.col("own").alias("_own"), "passages"), "row", "left")
    written = written.withColumn("own", F.coalesce("_own", "text")).drop("_own")
    met = linked(quotes, originals(written.select("conv", "turn", "own")))
    link = met.groupBy("row").agg(
        F.count("*").alias("n_quotes"), F.count("origin").alias("n_linked"),
        F.min(F.when(F.col("origin").isNotNull(), F.struct("level", (-F.col("origin")).alias("later")))).alias("first"),
    )
    link = cut_lineage(link.select("row", "n_quotes", "n_linked", (-F.col("first.later")).alias("parent")))
    full = written.select("row", "conv", "turn", "role", F.col("own").alias("text")).join(link, "row", "left")
    order = _ordered(full.select("conv", "turn", "parent")).select(
        F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), "before", "branch"
    )
    placed = full.join(order, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("turn") == F.col("_turn")), "left")
    none = F.lit(0).cast("long")
    return placed.orderBy(F.col("conv").asc_nulls_last(), F.col("branch").asc_nulls_last(), F.col("turn").asc_nulls_last()).select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), F.col("text").alias(text),
        F.coalesce("parent", "before").alias("parent_turn"), "branch",
        F.coalesce("n_quotes", none).alias("n_quotes"), F.coalesce("n_linked", none).alias("n_linked"),
    )
