"""Chat threads from quoted messages (built-in functions only).

Quote levels are parsed line by line: a line's level is the number of ``>``
marks it opens with (blanks between marks are allowed). Consecutive lines of
one level form a passage. Level 0 is what the author wrote; every deeper
passage is normalised (lower case, runs of other characters than letters and
digits become one blank) and hashed, and so are the whole own text and each own
passage, paragraph and line of every message. A quoted passage is linked to the
latest message of its conversation that holds that hash and comes earlier. A
message replies to the latest message among its links at the shallowest linked
level; without a link it opens a thread. Depth and thread are found by pointer
doubling over the reply links.

Skew: the latest holder is a running maximum over blocks of 2**BLOCK_BITS turns
of one (conversation, hash), then over blocks of blocks; no conversation is ever
collected into one row or window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import materialise

# Marks at the start of a line, each followed by blanks; the rest of the line is its content.
MARKS = r"^((?:[ \t]*>)*)[ \t]?(.*)$"
#: Turns (then blocks of them) that one window holds; four levels span every 64-bit turn.
BLOCK_BITS, LEVELS = 16, 4


def _normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parse(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, copy, role, level, line_no, content): one row a line.
    ``copy`` tells repeated (conv_id, turn) rows apart by their text."""
    m = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lines = m.select("conv_id", "turn", "role", "text", F.split("text", "\r?\n").alias("lines"))
    marks = lambda x: F.regexp_extract(x, MARKS, 1)
    return lines.withColumn("lines", F.transform("lines", lambda x: F.struct(
        F.length(F.regexp_replace(marks(x), "[^>]", "")).alias("level"), F.regexp_extract(x, MARKS, 2).alias("content"))))


def _passages(parsed: DataFrame) -> DataFrame:
    """Adds ``passages``: array of (level, content) over consecutive lines of one level. Each passage is cut out of the lines
    once, from where it starts to where the next one does, so the work grows with the number of lines."""
    n = F.size("lines")
    level = lambda i: F.get("lines", i)["level"]
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (level(i) != level(i - 1)))
    content = lambda i, end: F.array_join(F.transform(F.slice("lines", i + 1, end - i), lambda x: x["content"]), "\n")
    # ``starts`` is a column of its own: it is read twice below, so it is not computed again for each passage.
    return parsed.withColumn("starts", starts).withColumn("passages", F.transform("starts", lambda i, k: F.struct(
        level(i).alias("level"), content(i, F.coalesce(F.get("starts", k + 1), n)).alias("content")))).drop("starts")


def thread(messages: DataFrame) -> DataFrame:
    """One row per message: ``conv_id, turn, role, reply_to, root_turn,
    reply_depth, n_quotes, n_linked, content`` (the author's own lines). Sorted
    by (conv_id, root_turn, reply_depth, turn) the rows of a conversation are in
    reply order.

    A null text is an empty message. Repeated (conv_id, turn) rows are kept as
    they are; links name the turn. Rows with a null conversation or turn have no
    links. Passages that normalise to nothing are never linked. An empty table
    gives an empty result; further columns are ignored.
    """
    parsed = _passages(parse(messages))
    own = F.filter("passages", lambda p: p["level"] == 0)
    body = F.trim(F.regexp_replace(F.array_join(F.transform(own, lambda p: p["content"]), "\n"), r"(?s)^\s+|\s+$", ""))
    paragraphs = F.flatten(F.transform(own, lambda p: F.split(p["content"], "\n[ \t]*\n")))
    single = F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["content"])
    quoted = F.filter("passages", lambda p: (p["level"] > 0) & (_normalised(p["content"]) != ""))
    rows = cut_lineage(parsed.select(
        "conv_id", "turn", "role", body.alias("content"),
        F.array_distinct(F.transform(F.concat(F.array(body), F.transform(own, lambda p: p["content"]), paragraphs, single),
                                     _normalised)).alias("own"),
        F.transform(quoted, lambda p: F.struct(p["level"].alias("level"),
                                               F.sha2(_normalised(p["content"]), 256).alias("hash"))).alias("quotes")))
    holders = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL") \
        .select("conv_id", "turn", F.explode("own").alias("passage")).where("passage != ''") \
        .select("conv_id", "turn", F.sha2("passage", 256).alias("hash")).distinct()
    quotes = rows.select("conv_id", "turn", F.explode("quotes").alias("q")) \
        .select("conv_id", "turn", "q.level", "q.hash").distinct()
    links = _latest_holders(quotes, holders).where("origin IS NOT NULL")
    # The shallowest linked level decides; of its originals the latest.
    parent = cut_lineage(links.groupBy("conv_id", "turn").agg(
        F.max(F.struct(-F.col("level"), "origin")).alias("best"), F.count(F.lit(1)).alias("n_linked"))
        .select("conv_id", "turn", F.col("best.origin").alias("reply_to"), "n_linked"))
    placed = rows.join(parent, ["conv_id", "turn"], "left").join(_depths(parent), ["conv_id", "turn"], "left")
    return placed.select("conv_id", "turn", "role", "reply_to", F.coalesce("root", "turn").alias("root_turn"),
                         F.coalesce("depth", F.lit(0).cast("long")).alias("reply_depth"),
                         F.size("quotes").cast("long").alias("n_quotes"),
                         F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"), "content")


def _latest_holders(quotes: DataFrame, holders: DataFrame) -> DataFrame:
    """``quotes`` with ``origin``: the latest turn before the quoting one that
    holds the hash. A quote looks into its own block of turns; without a holder
    there, into the earlier blocks of its block of blocks, and so on."""
    events = quotes.select("conv_id", "hash", "turn", "level", F.lit(None).cast("long").alias("held")) \
        .unionByName(holders.select("conv_id", "hash", "turn", F.lit(None).cast("int").alias("level"), F.col("turn").alias("held")))
    # Quotes sort before holders of the same turn, so a turn does not see itself.
    before = Window.partitionBy("conv_id", "hash", "block").orderBy("turn", F.col("held").isNotNull())
    events = cut_lineage(events.withColumn("block", F.shiftright("turn", BLOCK_BITS)).withColumn(
        "origin", F.max("held").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    found = events.where("level IS NOT NULL").drop("held")
    blocks = events.groupBy("conv_id", "hash", "block").agg(F.max("held").alias("last"))
    # Most hashes live in one block; only those of several have earlier blocks to look into.
    several = blocks.groupBy("conv_id", "hash").agg(F.min("block").alias("b0"), F.max("block").alias("b1")) \
        .where("b0 < b1").select("conv_id", "hash")
    blocks = cut_lineage(blocks.join(several, ["conv_id", "hash"]))
    if blocks.isEmpty():
        return found
    for level in range(1, LEVELS):
        above = F.shiftright("block", BLOCK_BITS) if level < LEVELS - 1 else F.lit(0).cast("long")  # both signs meet at the top
        earlier = Window.partitionBy("conv_id", "hash", "above").orderBy("block")
        blocks = cut_lineage(blocks.withColumn("above", above).withColumn(
            "earlier", F.max("last").over(earlier.rowsBetween(Window.unboundedPreceding, -1))))
        found = found.join(blocks.select("conv_id", "hash", "block", "above", "earlier"), ["conv_id", "hash", "block"], "left") \
            .withColumn("origin", F.coalesce("origin", "earlier")).drop("block", "earlier").withColumnRenamed("above", "block")
        blocks = blocks.groupBy("conv_id", "hash", F.col("above").alias("block")).agg(F.max("last").alias("last"))
    return found


def _depths(parent: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) of every replying message. Each round doubles
    the distance a pointer has gone; a pointer ends at a turn that replies to
    none, and only pointers that have not ended go on."""
    every = active = parent.select("conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).cast("long").alias("depth"))
    ended = None
    while True:
        step = every.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        now = materialise(active.join(step, ["conv_id", "root"], "left").select(
            "conv_id", "turn", F.coalesce("next", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("on")))
        stop = now.where("NOT on").drop("on")
        ended = stop if ended is None else ended.unionByName(stop)
        active = now.where("on").drop("on")
        if active.isEmpty():
            return ended
        every = ended.unionByName(active)


def mail_replies(conversations: DataFrame) -> DataFrame:
    """Conversations as quoted mail: from turn 1 on, each message opens with the
    previous turn as a ``> `` quote, and (on even turns) above it with the turn
    before that as a ``> > `` quote. Turns meet by two equi-joins on
    (conv_id, turn); a turn without predecessor is unchanged."""
    c = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    one = c.groupBy("conv_id", (F.col("turn") + 1).alias("turn")).agg(F.max("text").alias("p1"))
    two = c.groupBy("conv_id", (F.col("turn") + 2).alias("turn")).agg(F.max("text").alias("p2"))
    quote = lambda t, mark: F.concat(F.lit(mark), F.replace(t, F.lit("\n"), F.lit("\n" + mark)))
    j = c.join(one, ["conv_id", "turn"], "left").join(two, ["conv_id", "turn"], "left")
    deep = F.when((F.col("turn") % 2 == 0) & F.col("p2").isNotNull(), F.concat(quote(F.col("p2"), "> > "), F.lit("\n")))
    return j.select("conv_id", "turn", "role", F.concat(
        F.coalesce(deep, F.lit("")), F.coalesce(F.concat(quote(F.col("p1"), "> "), F.lit("\n")), F.lit("")),
        F.col("text")).alias("text"))


def chat_format(threads: DataFrame) -> DataFrame:
    """Messages as one JSON object each, ready to be written in reply order."""
    return threads.repartitionByRange("conv_id", "root_turn", "reply_depth", "turn") \
        .sortWithinPartitions("conv_id", "root_turn", "reply_depth", "turn") \
        .select("conv_id", F.to_json(F.struct("turn", "reply_to", "role", "content")).alias("message"))
