"""Conversation repair against a search over all edits, without grammar, blocks or places."""

import random

import numpy as np
import pytest

from millrace.llm import repair
from millrace.llm.queries import damaged, digests

SPACE = " \t\n\x0b\x0c\r"


def cheapest(turns):
    """(cost, audit) of turns (initial, must go, truncated): the best of each state, edit by edit."""

    def inserted(best):
        for _ in range(2):
            for i, (cost, audit) in list(best.items()):
                j = "a" if i == "u" else "u"
                best[j] = min(best.get(j, (10**9, "")), (cost + 3, audit + "I"))
        return best

    best = {"": (0, "")}
    for initial, must_go, truncated in turns:
        new = {}

        def offer(state, value, new=new):
            new[state] = min(new.get(state, (10**9, "")), value)

        for state, (cost, audit) in inserted(best).items():
            offer(state, (cost + 4, audit + "D"))
            if must_go:
                continue
            more = 3 * truncated
            turn = "a" if state == "u" else "u"
            offer(turn, (cost + 3 + more, audit + "R"))
            if initial == turn or (initial == "s" and state == ""):
                offer(initial, (cost + more, audit + "K"))
        best = new
    best = inserted(best)
    return min(best[state] for state in ("", "a") if state in best)


def every(turns):
    """All edit strings that give a legal conversation, at most two insertions in a row."""
    found = []

    def go(n, state, cost, audit, run):
        if n == len(turns) and state in ("", "a"):
            found.append((cost, audit))
        turn = "a" if state == "u" else "u"
        if run < 2:
            go(n, turn, cost + 3, audit + "I", run + 1)
        if n < len(turns):
            initial, must_go, truncated = turns[n]
            go(n + 1, state, cost + 4, audit + "D", 0)
            if not must_go:
                go(n + 1, turn, cost + 3 + 3 * truncated, audit + "R", 0)
                if initial == turn or (initial == "s" and state == ""):
                    go(n + 1, initial, cost + 3 * truncated, audit + "K", 0)

    go(0, "", 0, "", 0)
    return min(found)


def drawn(rng, length):
    return [(rng.choice("suuaaot"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(length)]


def symbols(turns):
    return [8 if must_go else ("sua".find(i) if i in "sua" else 3) + 4 * cut for i, must_go, cut in turns]


def local_grammar(sequences, rounds, width):
    grammar = repair.Grammar()
    for _ in range(rounds):
        x = grammar.shorten(repair.joined([bytes(s) for s in sequences]))
        pairs = [(a, b) for a, b in zip(x[:-1].tolist(), x[1:].tolist(), strict=True) if a >= 0 and b >= 0]
        grammar.add(sorted(set(pairs), key=lambda p: (-pairs.count(p), p))[:width])
    return grammar


def solved(grammar, sequence):
    short = repair.split(grammar.shorten(repair.joined([bytes(sequence)])))
    cost, audits = repair.repair(short, grammar)
    return cost, "".join(audits)


def test_dynamic_program_equals_enumeration():
    rng = random.Random(1)
    for _ in range(300):
        turns = drawn(rng, rng.randint(1, 4))
        assert cheapest(turns) == every(turns), turns


@pytest.mark.parametrize("rounds,width", [(0, 1), (3, 2), (6, 40)])
def test_grammar_gives_the_cheapest_least_audit(rounds, width):
    rng = random.Random(rounds)
    drawn_turns = [drawn(rng, rng.randint(1, 40)) for _ in range(200)] + [[("u", False, False)] * 33, [("a", True, False)] * 17]
    grammar = local_grammar([symbols(t) for t in drawn_turns], rounds, width)
    for turns in drawn_turns:
        assert solved(grammar, symbols(turns)) == cheapest(turns)


def test_rules_spell_what_they_stand_for():
    rng = random.Random(4)
    sequences = [[rng.randint(0, 8) for _ in range(rng.randint(1, 60))] for _ in range(40)]
    grammar = local_grammar(sequences, 5, 10)

    def spelt(x):
        return [x] if x < repair.TERMINALS else [y for part in grammar.pairs[x - repair.TERMINALS] for y in spelt(part)]

    short = repair.split(grammar.shorten(repair.joined([bytes(s) for s in sequences])))
    assert [[y for x in own for y in spelt(x)] for own in short] == sequences
    assert sum(map(len, short)) < 0.7 * sum(map(len, sequences))


def expected(rows):
    """(faults and cost, edits) of one conversation's rows, by plain loops."""
    seen, turns, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        turns.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = cheapest(turns)
    initials = [t[0] for t in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    known = sorted({t for t, _, _ in rows if t is not None})
    gaps = known[-1] - known[0] + 1 - len(known) if known else 0
    return {"gaps": gaps, **faults, "illegal": illegal, "cost": cost}, audit


SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, symbols int"


def test_rows_of_every_kind(spark):
    rng = random.Random(7)
    texts = ["Yes.", "No", " ", "", "Why?\n", "x" * 200_000 + ".", "Yes. "]
    rows = {}
    for c in [*range(30), None]:
        for n in range(rng.randint(1, 14)):
            turn = None if n == 0 and c == 3 else n // (1 if c != 5 else 2) + (n > 4) * 3
            rows.setdefault(c, []).append((turn, rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice([*texts, None])))
    rows[40] = [(n, "user" if n % 3 else "assistant", f"t{n % 9000}" + "."[: n % 5]) for n in range(9500)]
    rows[41] = [(None, "user", "a."), (None, "user", "a.")]
    flat = [(c, t, r, x, "clash", 1) for c, own in rows.items() for t, r, x in own]
    rng.shuffle(flat)
    edits, faults = repair.repaired(spark.createDataFrame(flat, SCHEMA))
    got = {row["conv"]: row.asDict() for row in faults.collect()}
    audits = {row["conv"]: row["audit"] for row in digests(edits).collect()}
    assert set(got) == set(audits) == set(rows)
    made = {}
    for row in edits.where("edit <> 'D'").collect():
        made.setdefault(row["conv"], []).append(row["role"][:1])
    keys = {(r["role"], r["text"]): bytes(r["key"]) for r in repair.marked(spark.createDataFrame(flat, SCHEMA), "conv_id", "turn", "role", "text").collect()}
    for c, own in rows.items():
        plain = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in own]
        plain.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), keys[v[1], v[2]]))
        faults_of, audit = expected(plain)
        assert {k: got[c][k] for k in faults_of} == faults_of, c
        assert audits[c] == audit, c
        pattern = "".join(made.get(c, []))
        assert pattern.removeprefix("s") == "ua" * (len(pattern) // 2) and pattern != "s"


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "A. b! c?") for c in range(40) for t in range(5)] + [(7, None, None, None), (None, 1, None, "x")]
    got = sorted(map(tuple, damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=repr)
    wanted = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        row = (c, t, "user" if fault == 4 else role, "" if fault == 1 else text.translate(str.maketrans("", "", ".!?")) if fault == 2 else text)
        wanted += [row] * (0 if fault == 0 else 2 if fault == 3 else 1)
    assert got == sorted(wanted, key=repr)


def test_empty_table_and_text_keys(spark):
    edits, faults = repair.repaired(spark.createDataFrame([], SCHEMA))
    assert edits.count() == 0 and faults.count() == 0
    frame = spark.createDataFrame([("é", 1, "assistant", "Hi.")], "id string, turn int, role string, text string")
    edits, faults = repair.repaired(frame, conversation="id")
    assert [tuple(r) for r in edits.collect()] == [("é", "I", "user", ""), ("é", "K", "assistant", "Hi.")]
    assert faults.collect()[0]["cost"] == 3


def test_pairs_are_counted_over_all_blocks(spark):
    blocks = spark.createDataFrame([(bytearray([1, 2] * 6),), (bytearray([1, 2, 5]),), (bytearray([]),), (bytearray([1]),)], "symbols binary")
    grammar = repair.learnt(blocks, width=1, rounds=2)
    assert grammar.pairs == [(1, 2), (9, 9)]
    assert grammar.shorten(np.array([1, 2] * 6)).tolist() == [10, 10, 10]
