"""Quotation linking: which message a message quotes, and conversations without quotes.

All of it are DataFrame operations. A line's quote level is the number of ``>`` it begins with;
a quoted line is a passage, normalised (lower case, runs of white space as one space, trimmed)
and hashed. Within a conversation a passage comes from the last earlier turn that has the same
line as its own text. Of the passages a message quotes at its lowest level that have a source,
the turn that most come from is the message's parent, the latest of several.

Replies are ordered by their path: the turns from the first message of the thread down to the
message. Paths are built by joining each message with the path so far of its ancestor, doubling
the length each time.

Last earlier turns are found by a window over the lines with the same hash in one conversation,
so a line that many messages repeat is never paired with itself.

Defined results: null text is empty; a message of quotes only has empty text; null conversation,
turn or role are values like others, but a message without a turn is linked with nothing.
Repeated messages keep a row each, alike. Other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.session import stored

#: Longest prefix of a line that can be quote marks: ``>`` with blanks and tabs around.
MARKS = "^(?:[ \\t]*>)+[ \\t]?"


def quoted_lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, at, level, line): every line with its quote level, without the marks."""
    lines = messages.select(
        "conv_id", "turn", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n"))
        .alias("at", "raw"))
    marks = F.regexp_extract("raw", MARKS, 0)
    return lines.select(
        "conv_id", "turn", "at",
        (F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))).alias("level"),
        F.regexp_replace("raw", MARKS, "").alias("line"))


def _normal(line: str) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), "[\\x20\\x09-\\x0D]+", " "))


def sources(lines: DataFrame) -> DataFrame:
    """(conv_id, turn, level, passage, source): quoted passages and the turn they come from.

    ``source`` is null where no earlier message of the conversation has the line as its own.
    """
    hashed = (lines.select("conv_id", "turn", "level", _normal("line").alias("normal"))
              .where("normal <> '' and turn is not null")
              .select("conv_id", "turn", "level",
                      F.sha2("normal", 256).alias("passage")).distinct())
    earlier = (Window.partitionBy("conv_id", "passage").orderBy("turn")
               .rangeBetween(Window.unboundedPreceding, -1))
    return (hashed.withColumn("source", F.max(F.when(F.col("level") == 0, F.col("turn")))
                              .over(earlier))
            .where("level > 0"))


def parents(found: DataFrame) -> DataFrame:
    """(conv_id, turn, parent) for messages that quote an earlier one."""
    votes = (found.where("source is not null").groupBy("conv_id", "turn", "level", "source")
             .agg(F.count("*").alias("n")))
    return (votes.groupBy("conv_id", "turn")
            .agg(F.max(F.struct((-F.col("level")).alias("l"), "n", "source")).alias("best"))
            .select("conv_id", "turn", F.col("best.source").alias("parent")))


def paths(links: DataFrame) -> DataFrame:
    """(conv_id, turn, path): turns from the thread's first message to this, for linked ones.

    ``top`` is the ancestor the path starts from; each round puts the path of the ancestor
    before it, so a thread of n messages takes log2(n) rounds.
    """
    known = stored(links.select("conv_id", "turn", F.col("parent").alias("top"),
                                F.array("parent", "turn").alias("path")), "paths")
    while True:
        above = known.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"),
                             F.col("top").alias("_top"), F.col("path").alias("_path"))
        joined = known.join(above, F.expr("conv_id <=> _c and top = _t"), "left")
        if not joined.where("_t is not null").head(1):
            return known.select("conv_id", "turn", "path")
        known = stored(joined.select(
            "conv_id", "turn", F.coalesce("_top", "top").alias("top"),
            F.when(F.col("_t").isNull(), F.col("path"))
            .otherwise(F.concat("_path", F.slice("path", 2, F.size("path")))).alias("path")),
            "paths")


def linked_messages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, reply_to, depth, path, n_quoted, n_linked) per message.

    ``text`` has no quoted lines and no white space at its ends. ``path`` orders the replies of
    a conversation; ``reply_to`` is the parent's turn.
    """
    given = messages.select("conv_id", "turn", "role", "text")
    lines = quoted_lines(given.select("conv_id", "turn", "text").distinct())
    found = stored(sources(lines), "quotes")
    links = parents(found)
    quotes = found.groupBy("conv_id", "turn").agg(F.count("*").alias("n_quoted"),
                                                  F.count("source").alias("n_linked"))
    threads = paths(links)
    info = (quotes.alias("q").join(threads.alias("p"), F.expr(
        "q.conv_id <=> p.conv_id and q.turn = p.turn"), "left")
        .selectExpr("q.conv_id as _c", "q.turn as _t", "n_quoted", "n_linked", "path as _path"))
    own = F.array_join(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"),
                                lambda x: ~x.rlike(MARKS)), "\n")
    path = F.coalesce("_path", F.array("turn"))
    return (given.join(info, F.expr("conv_id <=> _c and turn = _t"), "left")
            .select("conv_id", "turn", "role",
                    F.regexp_replace(own, "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+\\z", "")
                    .alias("text"),
                    F.when(F.size(path) > 1, F.element_at(path, F.greatest(
                        F.size(path) - 1, F.lit(1)))).alias("reply_to"),
                    (F.size(path) - 1).alias("depth"), path.alias("path"),
                    F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
                    F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked")))
