"""Repair of conversations against exhaustive search, and the report's columns against a plain version."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from assetlake.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?\Z")


def exhaustive(rows):
    """The least (cost, letters, lines) over all edits of a few messages; ``rows``: (role, text, fault)."""
    best = None
    roles = {"u": "user", "a": "assistant"}
    gaps = ["", "u", "a", "ua", "au"]
    choices = []
    for role, text, fault in rows:
        mine = [(3, "D", None)]
        if fault not in ("blank", "duplicate"):
            late = int(fault == "truncated")
            mine += [(late, "K", (role, text))] + [(2 + late, "R", (r, text)) for r in roles.values()]
        choices.append(mine)
    for chosen in itertools.product(*choices):
        for leads in itertools.product(gaps, repeat=len(rows) + 1):
            cost = sum(c for c, _, _ in chosen) + 2 * sum(map(len, leads))
            letters, lines = "", []
            for lead, edit in itertools.zip_longest(leads, chosen):
                letters += "I" * len(lead)
                lines += [(roles[x], "") for x in lead]
                if edit:
                    letters += edit[1]
                    lines += [edit[2]] if edit[2] else []
            if PATTERN.match("".join(r[:1] if r[:1] in "sua" and r else "x" for r, _ in lines)):
                found = cost, letters, "\n".join(f"{r}:{t}" for r, t in lines)
                best = min(best or found, found)
    return best


def plain_faults(rows):
    seen, found = set(), []
    for role, text in rows:
        body = text.rstrip(repair.BLANKS)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def plain_damage(rows):
    found = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        die = zlib.crc32(key.encode()) % 20
        if die:
            row = (conv, turn, "user" if die == 4 else role, "" if die == 1 else re.sub("[.!?]", "", text) if die == 2 else text)
            found += [row] * (2 if die == 3 else 1)
    return found


def expected(conversations, rows):
    report = {}
    for conv in {r[0] for r in conversations}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults = plain_faults([r[2:] for r in mine])
        turns = [r[1] for r in mine if r[1] is not None]
        kinds = [r[2][:1] for r in mine]
        cost, letters, text = exhaustive(faults) if len(mine) <= 4 else (None, None, None)
        report[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: sum(x[2] == f for x in faults) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(kinds)),
            "cost": cost,
            "audit": letters,
            "repaired_sha256": None if text is None else hashlib.sha256(text.encode()).hexdigest(),
        }
    return report


def table(n=60, seed=3):
    rng = random.Random(seed)
    texts = ["Yes.", "No", " ", "", "Why?\n", "é ü!", None, "a.b", "Yes."]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "assistant", "user"]
    rows = []
    for conv in [*range(n), None]:
        turns = rng.choice([range(rng.randrange(1, 4)), [None, 2, 2], [7, -3], [5, 5]])
        rows += [(conv, t, rng.choice(roles), rng.choice(texts)) for t in turns]
    return rows


def test_report_equals_exhaustive_search(spark):
    rows = table()
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as place", "'x' as fault", "2 as piece", "'y' as code")
    got = {r["conv_id"]: r.asDict() for r in repair.repair_report(frame, repair.damaged(frame)).collect()}
    want = expected(rows, plain_damage(rows))
    assert set(got) == set(want)
    for conv, values in want.items():
        values = {k: v for k, v in values.items() if v is not None}
        assert {k: got[conv][k] for k in values} == values, conv


@pytest.mark.parametrize("seed", range(30))
def test_agenda_equals_exhaustive_search(seed):
    rng = random.Random(seed)
    rows = plain_faults([(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", "c!"])) for _ in range(rng.randrange(1, 5))])
    level = {None: 0, "truncated": 1, "blank": 2, "duplicate": 2}
    codes = "".join(chr(97 + 3 * ("suax".find(r[0]) if r[0] in "sua" else 3) + level[f]) for r, _, f in rows)
    (weight,) = repair.lightest(repair.edit_axioms(codes), len(codes), (repair.START,), True).values()
    cost, letters, _ = exhaustive(rows)
    assert (weight[0], weight[2]) == (cost, letters)


def test_long_conversations_in_pieces(spark, monkeypatch):
    """Pieces joined over several levels give what one agenda gives."""
    rng = random.Random(5)
    rows = [
        (conv, t, rng.choice(["user", "assistant", "assistant", "system", "x"]), rng.choice([f"{t}.", f"{t}", "", "again."]))
        for conv, n in ((1, 90), (2, 1), (3, 37))
        for t in range(n)
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    whole = repair.repair_report(frame, frame).select(columns).orderBy("conv_id").collect()
    monkeypatch.setattr(repair, "PIECE", 4)
    monkeypatch.setattr(repair, "FAN", 3)
    assert repair.repair_report(frame, frame).select(columns).orderBy("conv_id").collect() == whole
    for row in whole:
        mine = [(r, t) for c, _, r, t in rows if c == row["conv_id"]]
        kept = [x for x in row["audit"] if x != "I"]
        assert len(kept) == len(mine)
        roles = {"u": "user", "a": "assistant"}
        state, lines, source = repair.START, [], iter(mine)
        for letter in row["audit"]:
            role, text = next(source) if letter != "I" else ("", "")
            if letter in "RI":
                role = roles[repair.WANTED[state]]
            if letter != "D":
                state = repair.STEPS[state, role[0]]
                lines.append(f"{role}:{text}")
        assert PATTERN.match("".join(line[0] for line in lines))
        assert row["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_empty_table_long_texts_and_wide_turns(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert repair.repair_report(frame, repair.damaged(frame)).count() == 0
    long = "word " * 300_000
    rows = [(1, -(1 << 63), "user", long + "."), (1, (1 << 63) - 1, "assistant", long)]
    (got,) = repair.repair_report(*[spark.createDataFrame(rows, SCHEMA)] * 2).collect()
    assert (got["cost"], got["audit"], got["truncated"], got["gaps"]) == (1, "KK", 1, (1 << 63) - 1)
    assert got["repaired_sha256"] == hashlib.sha256(f"user:{long}.\nassistant:{long}".encode()).hexdigest()
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(9, dropped, "user", "Gone.")], SCHEMA)
    (got,) = repair.repair_report(frame, repair.damaged(frame)).collect()
    assert (got["cost"], got["audit"], got["repaired_sha256"]) == (0, "", hashlib.sha256().hexdigest())
