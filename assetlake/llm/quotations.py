"""Conversations without quotations, ordered by reply.

Lines that begin with ``>`` are quoted, once per sign; lines of one level that follow each other
are a passage.  A passage is normalised (signs and blanks at the ends gone, blanks one space, lower
case) and hashed as a whole, by its lines, its sentences and its runs of SHORT and LONG words; so
are the own words of the messages of its conversation.  The first message to say each of these is a
candidate; the passage is linked to the candidate that shares the most of them, to the earliest of
equals, and to none that shares less than half.  A message answers the latest message that it quotes
at level one, or else at the lowest level that is found; without any, the message before it.
Messages that answer another one than the message before them open a new thread.

``position`` is the place by turn, ``reply_place`` the place in the order of replies: each message
is followed by its answers, the earliest first, each with all that answers it.  That order is a
list through the tree of replies, ranked by pointer doubling: log2 of the longest conversation
rounds of joins, only over conversations in which an answer leaves the order of turns.

Everything is built-in expressions.  A frequent passage meets one row, its first message, so no
key is multiplied out; the order within conversations comes from ranges of the whole table, so
a conversation with a third of all messages is not collected in one task.

Edge cases: a null text is empty; a quoted single word links only to a line, sentence or message
that is this word; a message of quotations only has an empty text and stays; an
attribution line (ending in ``wrote:`` or its like) directly above a quotation goes with it; a
passage that only later messages say links to nothing; messages repeated under one turn are ordered
by role and text; a null conv_id is one conversation, a null turn comes first; an empty table gives
an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlake.sources.scratch import stored

from .ordering import ranked

QUOTED = r"^[ \t]*>"
SIGNS = r"^[ \t]*((?:>[ \t]*)+)"
# How mail programs end the line above a quotation.
ATTRIBUTION = r"(wrote|writes|said|schrieb|a écrit|escribió):[ \t]*$"
BLOCK = 100_000
SHORT, LONG = 2, 8  # words


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, SIGNS, 1), "[^>]", ""))


def split_quotes(messages: DataFrame) -> DataFrame:
    """``messages`` with ``own`` (the lines that are not quoted) and ``quotes`` (level, lines of each passage)."""
    lines = messages.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\r?\n"))
    lines = lines.withColumn("_levels", F.transform("_lines", _level))
    n = F.size("_lines")
    at = lambda i: F.try_element_at("_levels", i.cast("int"))
    line = lambda i: F.try_element_at("_lines", i.cast("int"))
    places = F.sequence(F.lit(1), n)
    starts = F.filter(places, lambda i: (at(i) > 0) & ((i == 1) | (at(F.greatest(i - 1, F.lit(1))) != at(i))))
    ends = F.filter(places, lambda i: (at(i) > 0) & ((i == n) | (at(F.least(i + 1, n)) != at(i))))
    above = lambda i: line(i).rlike(ATTRIBUTION) & (i < n) & (at(F.least(i + 1, n)) > 0)
    own = F.filter(places, lambda i: (at(i) == 0) & ~above(i))
    bare = lambda i: F.regexp_replace(line(i), SIGNS, "")
    passage = lambda s, e: F.struct(
        at(s).alias("level"), F.filter(F.transform(F.sequence(s, e), lambda i: _normal(bare(i))), lambda t: t != "").alias("lines")
    )
    lines = lines.withColumns({"own": F.transform(own, line), "_starts": starts, "_ends": ends})
    quotes = F.filter(F.zip_with("_starts", "_ends", passage), lambda q: F.size(q["lines"]) > 0)
    return lines.withColumn("quotes", quotes).drop("_lines", "_levels", "_starts", "_ends")


def _keys(lines: Column) -> Column:
    """Hashes of the whole text, its lines, its sentences and its runs of words."""

    def of_text(said: Column) -> Column:
        def runs(length: int) -> Column:
            words = F.array(F.split(said, " "))  # bound once, not per place
            return F.flatten(F.transform(words, lambda w: F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(w) - (length - 1), F.lit(1))), lambda i: F.array_join(F.slice(w, i, length), " ")
            )))

        return F.concat(F.array(said), F.split(said, r"(?<=[.!?])\s+"), runs(SHORT), runs(LONG))

    whole = F.array(_normal(F.array_join(lines, " ")))
    pieces = F.concat(F.flatten(F.transform(whole, of_text)), F.transform(lines, _normal))
    return F.array_distinct(F.transform(F.filter(pieces, lambda t: t != ""), lambda t: F.xxhash64(t)))


def _links(rows: DataFrame) -> DataFrame:
    """_rank and source (rank) of the messages whose quotations are found."""
    conv = F.xxhash64(F.struct("conv_id")).alias("conv")
    asked = rows.where(F.size("quotes") > 0).select("_rank", conv, F.posexplode("quotes").alias("place", "q"))
    asked = stored(asked.select("_rank", "conv", "place", "q.level", _keys(F.col("q.lines")).alias("keys")), "asked")
    sayings = rows.select(F.col("_rank").alias("of"), conv, "text").join(asked.select("conv").distinct(), "conv", "left_semi")
    sayings = stored(sayings.select("of", "conv", _keys(F.split("text", "\n")).alias("said")), "sayings")
    wanted = asked.select("_rank", "place", "conv", F.explode("keys").alias("key")).select("_rank", "place", F.xxhash64("conv", "key").alias("key"))
    first = sayings.select("of", "conv", F.explode("said").alias("key")).select("of", F.xxhash64("conv", "key").alias("key"))
    first = first.join(wanted.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.min("of").alias("of"))
    candidates = wanted.join(first, "key").where("of < _rank").select("_rank", "place", "of").distinct()
    shared = F.size(F.array_intersect("keys", "said"))
    met = candidates.join(asked, ["_rank", "place"]).join(sayings.select("of", "said"), "of")
    met = met.select("_rank", "place", "level", "of", shared.alias("shared"), F.size("keys").alias("all")).where("2 * shared >= all")
    best = met.groupBy("_rank", "place", "level").agg(F.max(F.struct("shared", (-F.col("of")).alias("back"))).alias("best"))
    best = best.groupBy("_rank").agg(F.min(F.struct("level", F.col("best.back").alias("back"))).alias("best"))
    return best.select("_rank", (-F.col("best.back")).alias("source"))


def _by_replies(tree: DataFrame) -> DataFrame:
    """_rank and reply_place of the messages of ``tree`` (_rank, parent, size of the conversation)."""
    born = tree.where("parent is not null").select(F.col("_rank").alias("child"), "parent")
    born = stored(ranked(born, ["parent", "child"], name="siblings"), "births")
    later = born.select((F.col("_rank") - 1).alias("_rank"), F.col("child").alias("next"), F.col("parent").alias("_of"))
    after = born.join(later, "_rank").where("parent = _of").select(F.col("child").alias("_rank"), "next")
    eldest = born.groupBy(F.col("parent").alias("_rank")).agg(F.min("child").alias("eldest"))
    nodes = tree.join(after, "_rank", "left").join(eldest, "_rank", "left")
    # a message is entered at 2 * rank and left at 2 * rank + 1
    rank = F.col("_rank")
    enter = F.struct((2 * rank).alias("at"), F.coalesce(2 * F.col("eldest"), 2 * rank + 1).alias("next"), F.lit(1).cast("long").alias("left"))
    leave = F.struct((2 * rank + 1).alias("at"), F.coalesce(2 * F.col("next"), 2 * F.col("parent") + 1).alias("next"), F.lit(0).cast("long").alias("left"))
    tour = stored(nodes.select(F.inline(F.array(enter, leave))), "tour")
    while not tour.where("next is not null").isEmpty():
        ahead = tour.select(F.col("at").alias("next"), F.col("next").alias("_next"), F.col("left").alias("_left"))
        moved = tour.where("next is not null").join(ahead, "next").select("at", F.col("_next").alias("next"), (F.col("left") + F.col("_left")).alias("left"))
        tour = stored(tour.where("next is null").union(moved), "tour")
    entered = tour.where("at % 2 = 0").select((F.col("at") / 2).cast("long").alias("_rank"), "left")
    return tree.join(entered, "_rank").select("_rank", (F.col("size") - F.col("left")).alias("reply_place"))


def reply_order(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (without quotations), position, reply_place, reply_to, linked, quotes and thread of every message.

    ``reply_to`` is the turn of the message that is answered, ``linked`` whether a quotation says so,
    ``thread`` the turn of the first message of the thread.
    """
    rows = messages.select("conv_id", "turn", "role", "text").withColumn("text_key", F.xxhash64("role", "text"))
    rows = split_quotes(ranked(rows, ["conv_id", "turn", "text_key"], name="messages"))
    rows = rows.withColumn("text", F.trim(F.array_join("own", "\n")))
    rows = stored(rows.select("_rank", "conv_id", "turn", "role", "text", "quotes"), "split")
    links = _links(rows)
    starts = rows.groupBy(F.struct("conv_id").alias("conv")).agg(F.min("_rank").alias("start"), F.count(F.lit(1)).alias("size"))
    named = rows.select("_rank", F.struct("conv_id").alias("conv"))
    places = named.join(starts, "conv").join(links, "_rank", "left").select(
        "_rank",
        (F.col("_rank") - F.col("start")).alias("position"),
        F.when(F.col("_rank") > F.col("start"), F.coalesce("source", F.col("_rank") - 1)).alias("parent"),
        F.col("source").isNotNull().alias("linked"),
        "start",
        "size",
    )
    # a thread is headed by the latest message up to here that doesn't answer the one before it
    head = F.when(F.col("parent").isNull() | (F.col("parent") != F.col("_rank") - 1), F.col("_rank"))
    places = stored(places.withColumns({"head": head, "block": F.floor(F.col("_rank") / BLOCK)}), "places")
    branched = places.where("parent <> _rank - 1").select("start").distinct()
    by_replies = _by_replies(stored(places.join(branched, "start", "left_semi").select("_rank", "parent", "size"), "branched"))
    carried = places.groupBy("block").agg(F.max("head").alias("head"))  # a row per BLOCK messages
    carried = carried.select("block", F.max("head").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    inside = Window.partitionBy("block").orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    places = places.join(carried, "block").withColumn("thread", F.coalesce(F.max("head").over(inside), "carried"))
    turns = rows.select(F.col("_rank").alias("at"), "turn")
    parents = turns.select(F.col("at").alias("parent"), F.col("turn").alias("reply_to"))
    heads = turns.select(F.col("at").alias("thread"), F.col("turn").alias("thread_turn"))
    whole = rows.select("_rank", "conv_id", "turn", "role", "text", F.size("quotes").alias("quotes")).join(places, "_rank")
    whole = whole.join(by_replies, "_rank", "left").withColumn("reply_place", F.coalesce("reply_place", "position"))
    return whole.join(parents, "parent", "left").join(heads, "thread").select(
        "conv_id", "turn", "role", "text", "position", "reply_place", "reply_to", "linked", "quotes", F.col("thread_turn").alias("thread")
    )
