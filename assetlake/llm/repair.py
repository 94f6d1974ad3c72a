"""Repair of the order of roles in conversations by Knuth's lightest derivation.

A repaired conversation is empty or an optional system message and then pairs of user and assistant.
Its messages are kept (cost 0), given another role (2), deleted (3) or inserted without text (2); a
truncated message that stays costs 1 more, a blank or repeated one must go.  The cheapest edits are
wanted and, among equally cheap ones, those whose letters (K, R, D, I in order) come first.

The four states of the role pattern are START, SYSTEM, USER and REPLY.  An item (lo, hi, p, q) says
that the messages from lo to hi lead from state p to q.  Single edits are axioms, and two items that
meet make a longer one: (0, k, p, q), (k, l, q, r) -> (0, l, p, r).  A weight is (cost, messages read,
letters) and two weights are joined part by part.  All derivations of one item read the same
messages, so equal costs mean that neither's letters begin the other's (what is left would
be insertions, which cost), joining keeps the order of weights on both sides, and every joint is greater than
its parts as an insertion costs and any other edit reads a message: the functions are monotone and
superior.  So an item popped from the agenda is final, and the search ends when its goal is.

Long conversations are cut into pieces of PIECE messages along one global order.  A piece that is not
a whole conversation derives its items for every pair of states; FAN such pieces at a time are
joined by the same agenda until the conversation is one, and the chosen states go back down the same
way.  So no task holds a conversation's messages.  The letters of a conversation are one value of the
result, which bounds its length (tens of millions of messages).  SHA-256 can only be computed in
order: each conversation's lines pass through one task, one batch at a time.

Edge cases: a null role or text is one space; a role other than system, user or assistant by its
initial can't be kept; messages are ordered by turn, null turns first, equal turns by role and text;
a null conv_id is a conversation of its own; very long texts are only compared by their digests and
hashed as they pass; empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.sources.scratch import stored

from .ordering import ranked

PIECE, FAN = 512, 64
START, SYSTEM, USER, REPLY = range(4)
BLANKS = " \t\n\x0b\x0c\r"
# State after a message with an initial; in each state one of user and assistant can follow.
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): REPLY, (REPLY, "u"): USER}
WANTED = "uuau"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ENDS = (START, REPLY)
KINDS = "suax"  # initials; x: any other
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
KNOWN_PIECES = 1 << 16

Weight = tuple[int, int, str, str]  # cost, messages read, letters, states between the parts
Segment = tuple[int, int, int, int]  # lo, hi, state before, state after


def lightest(axioms: dict[Segment, Weight], end: int, starts: Iterable[int], goal: bool) -> dict[tuple[int, int], Weight]:
    """The least weights of (state before, state after) over the segments 0 to ``end``.

    With ``goal``, only the least one from START to an end of the pattern.
    """
    agenda = [(weight, segment) for segment, weight in axioms.items()]
    agenda += [((0, 0, "", str(p)), (0, 0, p, p)) for p in starts]
    heapq.heapify(agenda)
    final: set[tuple[Segment, bool]] = set()
    left: dict[tuple[int, int], list[tuple[int, Weight]]] = {}  # by end and state: prefixes
    right: dict[tuple[int, int], list[tuple[Segment, Weight]]] = {}  # by begin and state: axioms
    found: dict[tuple[int, int], Weight] = {}
    while agenda:
        weight, segment = heapq.heappop(agenda)
        lo, hi, p, q = segment
        prefix = weight[3] != ""  # prefixes name the states they passed
        if (segment, prefix) in final:
            continue
        final.add((segment, prefix))
        if prefix:
            left.setdefault((hi, q), []).append((p, weight))
            if hi == end and (not goal or q in ENDS):
                found[p, q] = weight
                if goal:
                    break
            for (_, far, _, r), other in right.get((hi, q), ()):
                heapq.heappush(agenda, (_joined(weight, other, r), (0, far, p, r)))
        else:
            right.setdefault((lo, p), []).append((segment, weight))
            for first, other in left.get((lo, p), ()):
                heapq.heappush(agenda, (_joined(other, weight, q), (0, hi, first, q)))
    return found


def _joined(a: Weight, b: Weight, state: int) -> Weight:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] + str(state)


def edit_axioms(codes: str) -> dict[Segment, Weight]:
    """Every single edit of the messages of a piece; the lighter one where two have the same effect."""
    axioms: dict[Segment, Weight] = {}

    def offer(segment: Segment, cost: int, letter: str) -> None:
        weight = (cost, segment[1] - segment[0], letter, "")
        if segment not in axioms or weight < axioms[segment]:
            axioms[segment] = weight

    for place in range(len(codes) + 1):
        for p in range(4):
            offer((place, place, p, STEPS[p, WANTED[p]]), INSERT, "I")
    for place, code in enumerate(codes):
        kind, fault = KINDS[(ord(code) - 97) // 3], (ord(code) - 97) % 3
        for p in range(4):
            offer((place, place + 1, p, p), DELETE, "D")
            if fault < 2:
                offer((place, place + 1, p, STEPS[p, WANTED[p]]), REROLE + TRUNCATED * fault, "R")
                if (p, kind) in STEPS:
                    offer((place, place + 1, p, STEPS[p, kind]), KEEP + TRUNCATED * fault, "K")
    return axioms


def illegal_pairs(kinds: Iterable[str]) -> int:
    kinds = list(kinds)
    return sum(pair not in LEGAL for pair in zip(kinds, kinds[1:], strict=False))


def edits(codes: str, state: int, letters: str) -> list[tuple[str, str, str, str]]:
    """For each message: the initials inserted before it, its letter, its new initial (if R), those inserted behind the last."""
    rows, lead = [], ""
    for letter in letters:
        if letter == "I":
            lead += WANTED[state]
            state = STEPS[state, WANTED[state]]
            continue
        new = WANTED[state] if letter == "R" else ""
        if letter != "D":
            state = STEPS[state, new or KINDS[(ord(codes[len(rows)]) - 97) // 3]]
        rows.append((lead, letter, new, ""))
        lead = ""
    if lead:
        rows[-1] = (*rows[-1][:3], lead)
    return rows


_ITEMS = "array<struct<p: int, q: int, cost: long, letters: string, states: string>>"


def diagnosed(rows: DataFrame) -> DataFrame:
    """The messages with ``place`` along one order of all conversations, ``fault`` (null, blank, duplicate, truncated) and ``code``."""
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    # the texts wait for the lines; what decides is short
    placed = ranked(rows, ["conv_id", "turn", "role", "text"], name="messages").withColumnRenamed("_rank", "place")
    placed = placed.withColumn("same", F.md5(F.concat_ws("\u0000", F.length("role").cast("string"), "role", "text")))
    placed = stored(
        placed.withColumns({"blank": body == "", "open": ~F.right(body, F.lit(1)).isin(".", "!", "?")}), "placed"
    )
    again = placed.groupBy("conv_id", "same").agg(F.min("place").alias("first"), F.count("place").alias("times"))
    again = stored(again.where("times > 1").drop("times"), "repeated").toDF("_conv", "_same", "first")
    same = placed["conv_id"].eqNullSafe(again["_conv"]) & (placed["same"] == again["_same"])
    found = placed.join(again, same, "left").drop("_conv", "_same")
    fault = F.when(F.col("blank"), "blank").when(F.col("place") > F.col("first"), "duplicate").when(F.col("open"), "truncated")
    initial = F.instr(F.lit(KINDS[:3]), F.left("role", F.lit(1)))  # 0: none of them
    kind = F.when((initial > 0) & (F.length("role") > 0), initial - 1).otherwise(3)
    found = found.withColumn("fault", fault)
    level = F.when(F.col("fault") == "truncated", 1).when(F.col("fault").isNotNull(), 2).otherwise(0)
    found = found.withColumn("code", F.char(F.lit(97) + kind * 3 + level))
    return stored(found.select("conv_id", "turn", "place", "role", "text", "fault", "code"), "diagnosed")


def summary(messages: DataFrame) -> DataFrame:
    """Faults, gaps in the turns and the first and last place of each conversation."""
    span = F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count_distinct("turn")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    gaps = F.when(span > most, most).otherwise(span).cast("long")  # null without a turn
    counts = [F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")]
    bounds = [F.min("place").alias("first"), F.max("place").alias("last")]
    return messages.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"), *counts, *bounds)


def _pieces(messages: DataFrame, bounds: DataFrame) -> DataFrame:
    """The items of each piece; ``lo`` and ``hi`` are the first and last piece of its conversation."""
    piece = F.floor(F.col("place") / PIECE)
    codes = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "code"))), lambda x: x["code"]), "")
    held = messages.groupBy("conv_id", piece.alias("piece")).agg(codes.alias("codes"), F.min("place").alias("place"))
    bounds = bounds.select(F.col("conv_id").alias("_conv"), *[F.floor(F.col(c) / PIECE).alias(n) for c, n in (("first", "lo"), ("last", "hi"))])
    held = held.join(bounds, held["conv_id"].eqNullSafe(bounds["_conv"])).drop("_conv")

    def derive(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, bool], tuple[list, int]] = {}
        for batch in batches:
            items, illegal = [], []
            for codes, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("codes", "lo", "hi")), strict=True):
                key = codes, lo == hi
                if key not in known:
                    if len(known) >= KNOWN_PIECES:
                        known.clear()
                    found = lightest(edit_axioms(codes), len(codes), (START,) if lo == hi else range(4), lo == hi)
                    kinds = [KINDS[(ord(c) - 97) // 3] for c in codes]
                    known[key] = [_item(k, w, "") for k, w in sorted(found.items())], illegal_pairs(kinds)
                items.append(known[key][0]), illegal.append(known[key][1])
            ends = [[KINDS[(ord(c[at]) - 97) // 3] for c in batch.column("codes").to_pylist()] for at in (0, -1)]
            columns = [*batch.columns, pa.array(items, _ARROW_ITEMS), pa.array(illegal, pa.int64()), *map(pa.array, ends)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "items", "illegal", "head", "tail"])

    schema = f"{_fields(held)}, items {_ITEMS}, illegal long, head string, tail string"
    return stored(held.mapInArrow(derive, schema), "pieces")


def _item(states: tuple[int, int], weight: Weight, passed: str) -> dict:
    return {"p": states[0], "q": states[1], "cost": weight[0], "letters": weight[2], "states": passed}


_ARROW_ITEMS = pa.list_(
    pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("letters", pa.string()), ("states", pa.string())])
)


def _fields(frame: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields)


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """FAN neighbouring pieces of a conversation each made one; ``children`` are their numbers."""
    up = [F.floor(F.col(c) / FAN).alias(c) for c in ("piece", "lo", "hi")]
    child = F.struct("piece", "items", "illegal", "head", "tail")
    held = pieces.where("lo < hi").groupBy("conv_id", *up).agg(F.sort_array(F.collect_list(child)).alias("parts"))

    def derive(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for parts, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("parts", "lo", "hi")), strict=True):
                axioms = {
                    (k, k + 1, x["p"], x["q"]): (x["cost"], 1, x["letters"], "") for k, part in enumerate(parts) for x in part["items"]
                }
                found = lightest(axioms, len(parts), (START,) if lo == hi else range(4), lo == hi)
                between = sum((a["tail"], b["head"]) not in LEGAL for a, b in zip(parts, parts[1:], strict=False))
                rows.append(
                    {
                        "children": [part["piece"] for part in parts],
                        "items": [_item(k, w, w[3]) for k, w in sorted(found.items())],
                        "illegal": between + sum(part["illegal"] for part in parts),
                        "head": parts[0]["head"],
                        "tail": parts[-1]["tail"],
                    }
                )
            kept = batch.drop_columns(["parts"])
            made = [
                pa.array([r["children"] for r in rows], pa.list_(pa.int64())),
                pa.array([r["items"] for r in rows], _ARROW_ITEMS),
                pa.array([r["illegal"] for r in rows], pa.int64()),
                pa.array([r["head"] for r in rows], pa.string()),
                pa.array([r["tail"] for r in rows], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *made], [*kept.schema.names, "children", "items", "illegal", "head", "tail"]
            )

    schema = f"{_fields(held.drop('parts'))}, children array<long>, items {_ITEMS}, illegal long, head string, tail string"
    return stored(held.mapInArrow(derive, schema), "pieces")


def derivations(messages: DataFrame, bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, illegal, cost, audit) of each conversation, and (place, lead, letter, initial, trail) of each message.

    ``messages`` from ``diagnosed``, ``bounds`` from ``summary``.
    """
    levels = [_pieces(messages, bounds)]
    while not levels[-1].where("lo < hi").isEmpty():
        levels.append(_joined_pieces(levels[-1]))
    ends = F.filter("items", lambda x: (x["p"] == START) & x["q"].isin(*ENDS))
    best = F.array_min(F.transform(ends, lambda x: F.struct(x["cost"], x["letters"], x["p"], x["q"])))
    tops, chosen = None, None
    for level, pieces in reversed([*enumerate(levels)]):
        mine = pieces.where("lo = hi").select("conv_id", "piece", "illegal", best.alias("best"))
        top = mine.select("conv_id", "illegal", F.col("best.cost").alias("cost"), F.col("best.letters").alias("audit"))
        tops = top if tops is None else tops.union(top)
        choice = mine.select("conv_id", "piece", F.col("best.p").alias("p"), F.col("best.q").alias("q"))
        choice = choice if chosen is None else choice.union(chosen)
        choice = choice.select(*[F.col(c).alias(f"_{c}") for c in choice.columns])
        same = pieces["conv_id"].eqNullSafe(choice["_conv_id"]) & (pieces["piece"] == choice["_piece"])
        taken = pieces.join(choice, same)
        taken = taken.withColumn("item", F.filter("items", lambda x: (x["p"] == F.col("_p")) & (x["q"] == F.col("_q")))[0])
        if level:
            down = taken.select("conv_id", F.posexplode("children").alias("at", "piece"), F.col("item.states").alias("states"))
            states = [F.substring("states", F.col("at") + n, F.lit(1)).cast("int").alias(c) for n, c in ((1, "p"), (2, "q"))]
            chosen = down.select("conv_id", "piece", *states)

    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for codes, place, state, letters in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                rows += [(place + k, *edit) for k, edit in enumerate(edits(codes, state, letters))]
            kinds = [pa.int64(), *[pa.string()] * 4]
            columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["place", "lead", "letter", "initial", "trail"])

    taken = taken.select("codes", "place", F.col("_p").alias("state"), F.col("item.letters").alias("letters"))
    spelt = taken.mapInArrow(spell, "place long, lead string, letter string, initial string, trail string")
    return stored(tops, "derived"), stored(spelt, "edits")


def repaired(messages: DataFrame, spelt: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, part (order within a place), role, text, letter."""

    def inserted(column: str) -> Column:
        role = lambda x: F.when(x == "u", "user").otherwise("assistant")
        letters = F.filter(F.split(column, ""), lambda x: x != "")
        return F.transform(letters, lambda x: F.struct(role(x).alias("role"), F.lit("").alias("text"), F.lit("I").alias("letter")))

    role = F.when(F.col("initial") == "u", "user").when(F.col("initial") == "a", "assistant").otherwise(F.col("role"))
    own = F.array(F.struct(role.alias("role"), "text", "letter"))
    own = F.when(F.col("letter") == "D", F.slice(own, 1, 0)).otherwise(own)
    lines = messages.join(spelt, "place").select(
        "conv_id", "place", F.posexplode(F.concat(inserted("lead"), own, inserted("trail"))).alias("part", "line")
    )
    return lines.select("conv_id", "place", "part", "line.*")


def digests(lines: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, read in order."""

    def hash_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, value, open_ = None, None, False
        for batch in batches:
            done: list[tuple] = []
            for conv_id, role, text in zip(batch.column("conv_id").to_pylist(), batch.column("role"), batch.column("text"), strict=True):
                if not open_ or conv_id != now:
                    if open_:
                        done.append((now, value.hexdigest()))
                    now, value, open_ = conv_id, hashlib.sha256(), True
                else:
                    value.update(b"\n")
                value.update(role.as_py().encode("utf-8", "surrogatepass") + b":")
                value.update(text.as_buffer() or b"")
            yield _digest_batch(done)
        if open_:
            yield _digest_batch([(now, value.hexdigest())])

    kind = lines.schema["conv_id"].dataType.simpleString()
    sorted_lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place", "part")
    return sorted_lines.select("conv_id", "role", "text").mapInArrow(hash_lines, f"conv_id {kind}, sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["conv_id", "sha256"]
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by a hash of conversation and turn: dropped, emptied, cut short, repeated or renamed."""
    known = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id",
        "turn",
        *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.crc32(known.cast("binary")) % 20).alias("_kind"),
    ).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: faults, cost, audit and digest of the repair of ``rows``."""
    messages = diagnosed(rows)
    found = stored(summary(messages), "summary")
    derived, spelt = derivations(messages, found)
    hashed = digests(repaired(messages, spelt))
    report = conversations.select("conv_id").distinct()
    for part, name in ((found.drop("first", "last"), "_a"), (derived, "_b"), (hashed, "_c")):
        part = part.withColumnRenamed("conv_id", name)
        report = report.join(part, report["conv_id"].eqNullSafe(part[name]), "left").drop(name)
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return report.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256")
    )
