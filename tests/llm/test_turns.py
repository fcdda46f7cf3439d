"""Repair of conversations against a plain dynamic programme over whole strings."""

import hashlib
import random
import re
import zlib

import pytest

from catalog_star.llm import turns
from catalog_star.llm.queries import damaged, op13_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string, block string"
BLANK = re.compile(r"^[\x20\x09-\x0D]*$")


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def plain(rows):
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, lines."""
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {conv: _one(group) for conv, group in groups.items()}


def _one(rows):
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(f"{len(r[1].encode())}:{r[1]}:{r[2]}".encode()).digest()))
    found = sorted({t for t, _, _ in rows if t is not None})
    gaps = found[-1] - found[0] + 1 - len(found) if found else 0
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        faults.append("blank" if BLANK.match(text) else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    best = {(len(rows), q): x for q, x in {"": (0, ""), "s": (6, "II"), "u": (3, "I"), "a": (0, "")}.items()}
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    for i in range(len(rows) - 1, -1, -1):
        extra = 3 if faults[i] == "truncated" else 0
        direct = {}
        for q in follow:
            ways = [(4 + best[i + 1, q][0], "D" + best[i + 1, q][1])]
            if faults[i] not in ("blank", "duplicate"):
                if initials[i] == follow[q] or (initials[i], q) == ("s", ""):
                    ways.append((extra + best[i + 1, initials[i]][0], "K" + best[i + 1, initials[i]][1]))
                ways.append((3 + extra + best[i + 1, follow[q]][0], "R" + best[i + 1, follow[q]][1]))
            direct[q] = min(ways)
        for q in follow:
            a = follow[q]
            b = follow[a]
            best[i, q] = min(direct[q], (3 + direct[a][0], "I" + direct[a][1]), (6 + direct[b][0], "II" + direct[b][1]))
    cost, audit = best[0, ""]
    lines, q, i = [], "", 0
    names = {"u": "user", "a": "assistant"}
    for letter in audit:
        if letter == "I":
            q = follow[q]
            lines.append(f"{names[q]}:")
            continue
        if letter == "K":
            q = initials[i]
            lines.append(f"{rows[i][1]}:{rows[i][2]}")
        if letter == "R":
            q = follow[q]
            lines.append(f"{names[q]}:{rows[i][2]}")
        i += 1
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines)) and i == len(rows)
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, lines)


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u"])
            text = rng.choice(["Yes.", "No", " ", "", None, f"{t} done! \n", f"{t} and", "Ça va?"])
            rows.append((c if c else None, rng.choice([t, t, t * 2, None]), role, text))
    rng.shuffle(rows)
    return rows


def repaired(spark, rows):
    fixed = turns.repair(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3))
    report = {r[0]: tuple(r)[1:] for r in fixed.report.collect()}
    lines = {}
    for conv, place, role, text in fixed.lines.collect():
        lines.setdefault(conv, []).append((place, f"{role}:{text}"))
    digests = {r[0]: r[1] for r in turns.line_digests(fixed.lines).collect()}
    for conv, found in lines.items():
        assert [p for p, _ in found] == list(range(len(found)))
        assert digests[conv] == hashlib.sha256("\n".join(x for _, x in found).encode()).hexdigest()
    return {c: (*r, [x for _, x in lines.get(c, [])]) for c, r in report.items()}


@pytest.mark.parametrize("block", [4, 7, 2048])
def test_repairs_equal_a_plain_programme(spark, monkeypatch, block):
    monkeypatch.setattr(turns, "BLOCK", block)
    rows = random_rows(block, 60, 9) + [(1000, t, ["user", "assistant", "assistant"][t % 3], f"t{t % 40}{'.' * (t % 2)}") for t in range(150)]
    found, expected = repaired(spark, rows), plain(rows)
    assert found == expected


def test_long_and_repeated_conversations(spark, monkeypatch):
    monkeypatch.setattr(turns, "BLOCK", 16)
    rows = [(1, 0, "user", "Same.")] * 100 + [(2, t, "user", f"{t}.") for t in range(200)] + [(3, t, "system", "x" * 200_000) for t in range(3)] + [(4, None, None, None)] * 3
    rows += [(5, t, "assistant" if t % 2 else "user", f"{t}?") for t in range(256)]
    assert repaired(spark, rows) == plain(rows)


def test_damage_and_query(spark, tmp_path):
    rows = random_rows(5, 80, 8)
    spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    broken = list(damage(rows))
    assert sorted(map(tuple, damaged(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)).collect()), key=str) == sorted(broken, key=str)
    expected = plain(broken)
    found = {r[0]: tuple(r)[1:] for r in op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(found) == {r[0] for r in rows} >= set(expected)
    for conv, got in found.items():
        *numbers, lines = expected.get(conv, (0, 0, 0, 0, 0, 0, "", []))
        assert got == (*numbers, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_whole_test_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = plain(list(damage(rows)))
    found = {r[0]: tuple(r)[1:] for r in op13_conversation_repair(spark, folder).collect()}
    for conv, got in found.items():
        *numbers, lines = expected.get(conv, (0, 0, 0, 0, 0, 0, "", []))
        assert got == (*numbers, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    assert len(found) == len({r[0] for r in rows})


def test_no_rows(spark):
    fixed = turns.repair(spark.createDataFrame([], SCHEMA))
    assert fixed.report.collect() == [] and fixed.lines.collect() == [] and turns.line_digests(fixed.lines).collect() == []
