"""Cheapest edits of role sequences in numpy: backward costs of many pieces at once, and their tracing.

A piece is a text with one letter a row (:func:`code_of`). Costs to the end are kept per state of the wanted
sequence ``(s?(ua)+)?``: nothing yet, after a system row, after a user row, after an assistant row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Costs of the edits, and what a kept or reassigned truncated row adds.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4

#: Letters of the edits, in the order of ties.
EDITS = "DIKR"

_NEVER = 1 << 28
#: The state after the next wanted role, which is also what an inserted or reassigned row has.
_NEXT = np.array([USER, USER, ASSISTANT, USER])

# Roles in a code: system, user, assistant, any other. Faults: none, blank, duplicate, truncated.
ROLES, FAULTS = 4, 4
_PAD = ROLES * FAULTS
_FIRST_LETTER = ord("A")

#: State after keeping a row of the role, or -1.
_KEPT = np.full((ROLES, STATES), -1)
_KEPT[0, START] = SYSTEM
_KEPT[1, [START, SYSTEM, ASSISTANT]] = USER
_KEPT[2, USER] = ASSISTANT

#: Cells (rows times pieces, padding included) that are worked on together.
_CELLS = 1 << 20


def _with_inserts(costs: np.ndarray) -> np.ndarray:
    """Two inserted rows at most lead to a better state; more would come back to where they began."""
    once = costs[..., _NEXT] + INSERT
    twice = costs[..., _NEXT[_NEXT]] + 2 * INSERT
    return np.minimum(costs, np.minimum(once, twice))


def _shape(vectors: np.ndarray) -> np.ndarray:
    return vectors - vectors.min(axis=-1, keepdims=True)


#: Costs behind the last row of a conversation, and those assumed behind a piece whose successor is not known.
END = _with_inserts(np.array([0, _NEVER, _NEVER, 0]))
SPECULATIVE = END


def _tables() -> tuple[np.ndarray, ...]:
    """Per code: cost of keeping and the state after it, cost of reassigning; never where not allowed."""
    codes = np.arange(_PAD)
    role, fault = codes % ROLES, codes // ROLES
    must_go, extra = (fault == 1) | (fault == 2), (fault == 3) * TRUNCATED
    after = _KEPT[role]
    keep = np.where((after < 0) | must_go[:, None], _NEVER, extra[:, None])
    rerole = np.where(must_go, _NEVER, REROLE + extra)
    return keep, np.maximum(after, 0), rerole


_KEEP, _AFTER, _REROLE = _tables()


def _moves(code: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs of deleting, keeping and reassigning a row in every state, with ``costs`` behind it."""
    keep = _KEEP[code] + np.take_along_axis(costs, _AFTER[code], axis=1)
    return costs + DELETE, keep, costs[:, _NEXT] + _REROLE[code][:, None]


def _before(code: np.ndarray, costs: np.ndarray) -> np.ndarray:
    """Costs before a row from those behind it; padding changes nothing."""
    row = code < _PAD
    delete, keep, rerole = _moves(np.where(row, code, 0), costs)
    found = _with_inserts(np.minimum(delete, np.minimum(keep, rerole)))
    return np.where(row[:, None], found, costs)


def _blocks(pieces: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of the pieces, their codes as rows of a matrix padded at the end), pieces of like lengths."""
    lengths = np.array([len(p) for p in pieces])
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        shortest = max(1, lengths[order[at]])
        end = at
        while end < len(order) and lengths[order[end]] <= 2 * shortest and (end - at + 1) * lengths[order[end]] <= max(_CELLS, lengths[order[end]]):
            end += 1
        own = order[at:end]
        codes = np.full((len(own), lengths[own].max()), _PAD, dtype=np.int64)
        for i, place in enumerate(own):
            codes[i, : lengths[place]] = np.frombuffer(pieces[place].encode(), dtype=np.uint8) - _FIRST_LETTER
        yield own, codes
        at = end


def entry_costs(pieces: Sequence[str], ends: np.ndarray) -> np.ndarray:
    """Shape (least cost zero) of the costs before every piece, given the costs behind it."""
    out = np.empty((len(pieces), STATES), dtype=np.int64)
    for own, codes in _blocks(pieces):
        costs = ends[own]
        for i in reversed(range(codes.shape[1])):
            costs = _before(codes[:, i], costs)
        out[own] = _shape(costs)
    return out


def fixed_up(pieces: Sequence[str], before: np.ndarray, ends: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """:func:`entry_costs` for new ``ends``, where ``before`` gave ``entries``.

    Old and new costs go backward together. Once they differ by a constant they always will, and the old
    entry holds; only pieces that never get there take a new one.
    """
    out = entries.copy()
    for own, codes in _blocks(pieces):
        old, new = before[own], ends[own]
        open_ = np.arange(len(own))
        for i in reversed(range(codes.shape[1])):
            old, new = _before(codes[open_, i], old), _before(codes[open_, i], new)
            apart = (_shape(old) != _shape(new)).any(axis=1)
            open_, old, new = open_[apart], old[apart], new[apart]
            if not len(open_):
                break
        out[own[open_]] = _shape(new)
    return out


def _all_costs(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Costs before every row and behind the last, (rows + 1, pieces, states)."""
    costs = np.empty((codes.shape[1] + 1, len(codes), STATES), dtype=np.int64)
    costs[-1] = ends
    for i in reversed(range(codes.shape[1])):
        costs[i] = _before(codes[:, i], costs[i + 1])
    return costs


def trace(pieces: Sequence[str], ends: np.ndarray, entries: np.ndarray, last: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Per piece the least of its cheapest edits from state ``entries`` on, and the state behind it.

    An edit is a letter a row: A to D for D, I, K, R without, E to H with one and I to L with two rows
    inserted before it. A piece that is ``last`` in its conversation has one more letter, A to C, for the
    rows inserted at its end.
    """
    texts: list[str] = [""] * len(pieces)
    exits = np.empty(len(pieces), dtype=np.int64)
    for own, codes in _blocks(pieces):
        costs, state = _all_costs(codes, ends[own]), entries[own].copy()
        n, rows = len(own), np.arange(len(own))
        edits = np.zeros((n, codes.shape[1] + 1), dtype=np.uint8)
        for i in range(codes.shape[1]):
            is_row = codes[:, i] < _PAD
            delete, keep, rerole = _moves(np.where(is_row, codes[:, i], 0), costs[i + 1])
            inserted = np.zeros(n, dtype=np.int64)
            for _ in range(2):
                # Deleting comes before inserting in ASCII, inserting before all others.
                best = costs[i][rows, state]
                insert = is_row & (delete[rows, state] != best) & (costs[i][rows, _NEXT[state]] + INSERT == best)
                inserted += insert
                state = np.where(insert, _NEXT[state], state)
            best = costs[i][rows, state]
            choice = np.where(delete[rows, state] == best, 0, np.where(keep[rows, state] == best, 2, 3))
            after = np.where(choice == 0, state, np.where(choice == 2, _AFTER[np.where(is_row, codes[:, i], 0), state], _NEXT[state]))
            state = np.where(is_row, after, state)
            edits[:, i] = _FIRST_LETTER + 4 * inserted + choice
        ending = last[own]
        missing = np.where(state == USER, 1, np.where(state == SYSTEM, 2, 0)) * ending
        lengths = (codes < _PAD).sum(axis=1)
        edits[rows, lengths] = _FIRST_LETTER + missing
        exits[own] = state
        for i, place in enumerate(own):
            texts[place] = edits[i, : lengths[i] + ending[i]].tobytes().decode()
    return texts, exits


def exit_states(pieces: Sequence[str], ends: np.ndarray) -> np.ndarray:
    """State behind every piece for each state before it, (pieces, states)."""
    n = len(pieces)
    never = np.zeros(n, dtype=bool)
    return np.stack([trace(pieces, ends, np.full(n, state), never)[1] for state in range(STATES)], axis=1)
