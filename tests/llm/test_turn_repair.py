"""Repair of conversations against a plain forward search."""

import hashlib
import random
from collections import Counter

import pytest

from tests.llm import helpers as h
from vitrine.llm.catalog import op13_turn_repair
from vitrine.llm.turn_repair import digests, repair

FAR = (10**9, "", ())


def added(found, cost, letter, line=None):
    return found[0] + cost, found[1] + letter, found[2] + ((line,) if line is not None else ())


def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        inner = text.strip(" \t\n\x0b\f\r")
        if not inner:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if inner[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Least (cost, edits, lines) of each state, row by row from the front."""
    nothing, system, user, assistant = (0, "", ()), FAR, FAR, FAR

    def opened(nothing, system, user, assistant):
        user = min(user, *(added(s, 3, "I", "user:") for s in (nothing, system, assistant)))
        return nothing, system, user, min(assistant, added(user, 3, "I", "assistant:"))

    for (_, role, text), fault in zip(rows, plain_faults(rows), strict=True):
        states = opened(nothing, system, user, assistant)
        nothing, system, user, assistant = (added(s, 4, "D") for s in states)
        if fault in ("blank", "duplicate"):
            continue
        more = 3 * (fault == "truncated")
        keep = lambda s: added(s, more, "K", f"{role}:{text}")  # noqa: B023, E731
        into_user = [states[0], states[1], states[3]]
        if role[:1] == "s":
            system = min(system, keep(states[0]))
        if role[:1] == "u":
            user = min([user, *map(keep, into_user)])
        if role[:1] == "a":
            assistant = min(assistant, keep(states[2]))
        user = min([user, *(added(s, 3 + more, "R", f"user:{text}") for s in into_user)])
        assistant = min(assistant, added(states[2], 3 + more, "R", f"assistant:{text}"))
    states = opened(nothing, system, user, assistant)
    return min(states[0], states[3])


def plain(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in own if t is not None}
        count = Counter(plain_faults(own))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:], strict=False)]
        cost, audit, lines = plain_repair(own)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, lines, digest))
    return out


def found(spark, rows, bits, clash=""):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", *clash)
    result = repair(turns, chunk_bits=bits)
    assert result.conversations.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    lines = {}
    for r in sorted(result.turns.collect(), key=lambda r: (r.place, r.step)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    digest = {r.conv_id: r.repaired_sha256 for r in digests(result.turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return [(*r, tuple(lines.get(r.conv_id, ())), digest.get(r.conv_id, empty)) for r in result.conversations.collect()]


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "unknown", "", None]
TEXTS = ["Yes.", "No!", "What?", "cut off", "", " \t\n", None, "é…", "Yes.  \n", "end. ", "x." * 5000]


def random_rows(seed):
    rnd = random.Random(seed)
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rnd.choice([1, 2, 3, 5, 8, 13, 40])):
            text = rnd.choice(TEXTS) if rnd.random() < 0.6 else f"text {rnd.random()}{rnd.choice('.!,')}"
            role = rnd.choice(ROLES) if rnd.random() < 0.5 else ROLES[turn % 2]
            rows.append((conv, rnd.choice([turn, turn, 3 * turn, None, turn // 2]), role, text))
    rows += [rows[7]] * 9 + [rows[-1]] * 3
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits", [0, 2, 12])
def test_repair_equals_a_plain_search(spark, bits):
    rows = random_rows(bits)
    clash = ["7 as place", "'x' as chunk", "'y' as audit", "1 as cost", "2 as step", "3 as fault"]
    assert h.ordered(found(spark, rows, bits, clash)) == h.ordered(plain(rows))


def test_one_long_conversation_over_many_chunks(spark):
    rnd = random.Random(9)
    rows = [(1, n, rnd.choice(ROLES), rnd.choice(TEXTS[:5]) or f"{n}") for n in range(700)]
    rows += [(1, n, "user", "same.") for n in range(300)] + [(2, 0, "user", "Hi.")]
    assert h.ordered(found(spark, rows, 4)) == h.ordered(plain(rows))


def test_nothing_to_repair(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hi."), (2, None, "user", "")]
    got = {r[0]: r for r in found(spark, rows, 12)}
    assert got[1][6:8] == (0, "KKK") and got[2][1:9] == (0, 1, 0, 0, 0, 4, "D", ())
    assert found(spark, [], 12) == []


def test_every_conversation_has_a_row(spark, folder):
    rows = [(conv, turn, "user", "x.") for conv in [None, *range(150)] for turn in [conv and conv % 3 or None]] + [(99, n, None, None) for n in range(3)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns.coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    got = op13_turn_repair(spark, folder).collect()
    assert sorted(map(str, (r.conv_id for r in got))) == sorted(map(str, {r[0] for r in rows}))
    assert any(r.audit == "" and r.cost == 0 for r in got) and all(None not in tuple(r)[1:] for r in got)
