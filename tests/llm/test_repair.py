"""Conversation repair: pieces of any size, brute force over all edits, awkward rows."""

from __future__ import annotations

import heapq
import random

import numpy as np
import pytest

from shelfcast.llm import repair, viterbi

SCHEMA = "conv_id long, turn long, role string, text string"
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
WANTED = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, letters) by searching all edits of (initial, fault) rows, cheapest and then least letters first."""
    queue = [(0, "", 0, "")]
    done = set()
    while queue:
        cost, letters, at, state = heapq.heappop(queue)
        if at == len(rows) and state in ("", "a"):
            return cost, letters
        if (at, state) in done:
            continue
        done.add((at, state))
        heapq.heappush(queue, (cost + 2, letters + "I", at, WANTED[state]))
        if at < len(rows):
            initial, fault = rows[at]
            heapq.heappush(queue, (cost + 3, letters + "D", at + 1, state))
            if fault not in (1, 2):
                extra = fault == 3
                heapq.heappush(queue, (cost + 2 + extra, letters + "R", at + 1, WANTED[state]))
                if (state, initial) in AFTER:
                    heapq.heappush(queue, (cost + extra, letters + "K", at + 1, AFTER[state, initial]))
    raise AssertionError


def _codes(rows: list[tuple[str, int]]) -> str:
    return "".join(chr(ord("A") + "suao".index(i) + viterbi.ROLES * f) for i, f in rows)


def _letters(edits: str) -> str:
    out = ""
    for c in edits[:-1]:
        inserted, choice = divmod(ord(c) - ord("A"), 4)
        out += "I" * inserted + viterbi.EDITS[choice]
    return out + "I" * (ord(edits[-1]) - ord("A"))


def _random_rows(rng: random.Random, n: int) -> list[tuple[str, int]]:
    return [(rng.choice("suaao"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]


def test_letters_are_the_least_of_the_cheapest():
    rng = random.Random(3)
    rows = [_random_rows(rng, n) for n in [0, 1, 1, 1, 2, 2, 3, 5, 8, 13, 21] * 20]
    n = len(rows)
    edits, _ = viterbi.trace([_codes(r) for r in rows], np.tile(viterbi.END, (n, 1)), np.zeros(n, dtype=int), np.ones(n, dtype=bool))
    assert [_letters(e) for e in edits] == [cheapest(r)[1] for r in rows]


def test_fix_up_equals_a_fresh_run():
    """Whether old and new costs fall into step or not."""
    rng = random.Random(4)
    pieces = [_codes(_random_rows(rng, rng.randint(1, 12))) for _ in range(300)]
    old = np.array([[rng.randint(0, 6) for _ in range(4)] for _ in pieces])
    new = np.array([[rng.randint(0, 6) for _ in range(4)] for _ in pieces])
    fixed = viterbi.fixed_up(pieces, old, new, viterbi.entry_costs(pieces, old))
    assert (fixed == viterbi.entry_costs(pieces, new)).all()


@pytest.mark.parametrize("chunk", [1, 3, 7, 4096])
def test_pieces_of_any_size_give_the_same(spark, chunk):
    """Long conversations cut into pieces, down to single rows, against a search of the whole."""
    rng = random.Random(chunk)
    initials = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    rows, expected = [], {}
    for conv, n in enumerate([1, 2, 3, 9, 40, 150]):
        own = [(rng.choice("suaua"), rng.choice([0, 0, 0, 0, 1, 3])) for _ in range(n)]
        for i, (initial, fault) in enumerate(own):
            rows.append((conv, i, initials[initial], "" if fault == 1 else f"text {i}" + ("" if fault == 3 else ".")))
        expected[conv] = cheapest(own)
    got = repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(5), chunk=chunk).collect()
    assert {r.conv_id: (r.cost, r.audit) for r in got} == expected


def test_speculation_that_fails_is_run_again(spark):
    """Deletions only, which keep the costs assumed behind a piece as they are through all pieces before it."""
    rows = [(1, i, "user", "" if i else "hello.") for i in range(40)]
    got = repair.repair(spark.createDataFrame(rows, SCHEMA), chunk=4).collect()
    assert [(r.cost, r.audit, r.blank) for r in got] == [(*cheapest([("u", 0)] + [("u", 1)] * 39), 39)]


def test_faults_gaps_and_names(spark):
    rows = [
        (1, None, "user", "a."), (1, 2, "user", "a."), (1, 5, "assistant", " \t\n"), (1, 5, "assistant", "b"), (1, 5, "assistant", "c!\n"),
        (None, 3, None, None), (2, None, "system", "x?"),
    ]
    names = [(1,), (2,), (None,), (7,)]
    got = {r.conv_id: r for r in repair.repair(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(names, "conv_id long")).collect()}
    assert {k: (r.gaps, r.blank, r.duplicate, r.truncated) for k, r in got.items()} == {1: (2, 1, 1, 1), None: (0, 1, 0, 0), 2: (0, 0, 0, 0), 7: (0, 0, 0, 0)}
    assert got[7].audit == "" and got[7].repaired_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert got[None].audit == "D" and got[2].audit == "D"


def test_many_equal_rows_of_one_conversation(spark):
    rows = [(1, 0, "user", "again.")] * 500 + [(1, 1, "assistant", "yes.")]
    got = repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(7), chunk=16).collect()[0]
    assert (got.duplicate, got.audit, got.cost) == (499, "K" + "D" * 499 + "K", 3 * 499)
