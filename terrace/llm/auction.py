"""Cheapest repair of a row of turns: an auction over the lattice of (turn, state).

A state says which role was last put out: none, system, user or assistant. A turn takes one
*step*: any number of inserted turns, then the turn itself kept, given another role or
deleted. The audit letters of a step (``I...`` and one of ``K R D``) are a prefix code, so two
different audits of the same turns differ first inside one step, and the smaller letters of
that step decide. Costs are whole numbers, and inserted turns cost, so no cycle is free.

``prices`` runs the auction: every node has a price, at first what its cheapest arc and the
least price of the next turn cost; a path grows from the origin. If its last node's price is below the cheapest arc and price behind it, the price
rises to that and the path is cut back by the node; otherwise the path is extended over
that arc, until it reaches the end. Prices never exceed distances, so arcs of a cheapest
path, and of all that are as cheap, are *tight*: price = cost + next price. ``trace`` follows
the tight arcs that still lead to the end, always the one of the least letters.

Long rows of turns are cut into blocks. ``transfer`` sums up a block: for every state before
and after it the cost of the cheapest way, and the order of the ways' letters; the sums are
steps again.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import product

# Costs and letters of the edits.
KEEP, REROLE, DELETE, INSERT, OPEN = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
BIG = 1 << 60

#: Codes of the first letter of a role, and of the first fault of a turn.
ROLES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
OTHER = 0
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

#: The role that may follow each state by insertion or a new role (a system turn only ever stands first).
FOLLOWS = (USER, USER, ASSISTANT, USER)
#: Letters and cost of what is inserted behind the last turn.
TAIL = ("", "II", "I", "")

Steps = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]  # costs and ranks by (state before, state after)


def inserted(state: int, n: int) -> int:
    """The state after ``n`` inserted turns."""
    for _ in range(n):
        state = FOLLOWS[state]
    return state


@lru_cache(maxsize=None)
def letters(role: int, fault: int) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and letters of the cheapest step (the least letters of those) by state before and after a turn."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before, n in product(STATES, range(4)):
        here = inserted(before, n)
        ways = [(here, DELETE, "D")]
        if fault not in (BLANK, DUPLICATE):
            more = OPEN if fault == TRUNCATED else 0
            ways.append((FOLLOWS[here], REROLE + more, "R"))
            if role == FOLLOWS[here] or (role == SYSTEM and here == START):
                ways.append((role, KEEP + more, "K"))
        for after, cost, letter in ways:
            way = (INSERT * n + cost, "I" * n + letter)
            best[before, after] = min(way, best.get((before, after), way))
    return best


def ordered(ways: dict[tuple[int, int], tuple]) -> Steps:
    """``ways`` (cost, what orders them) as costs and as ranks among the ways from the same state."""
    costs, ranks = [[BIG] * 4 for _ in STATES], [[0] * 4 for _ in STATES]
    for before in STATES:
        mine = sorted((what, after) for (b, after), (_, what) in ways.items() if b == before)
        for rank, (_, after) in enumerate(mine):
            costs[before][after], ranks[before][after] = ways[before, after][0], rank
    return tuple(map(tuple, costs)), tuple(map(tuple, ranks))


@lru_cache(maxsize=None)
def turn(role: int, fault: int) -> Steps:
    return ordered(letters(role, fault))


def prices(steps: list[Steps], ends: list[int], origins: list[int]) -> list[list[int]]:
    """Node prices after an auction for the cheapest way from each origin to the end (``ends``: cost behind each last state)."""
    n = len(steps)
    price = [list(ends)]
    for costs, _ in reversed(steps):
        least = min(price[-1])
        price.append([min(min(row) + least, BIG) for row in costs])
    price.reverse()
    for origin in origins:
        path = [origin]
        while True:
            i, state = len(path) - 1, path[-1]
            if i == n:
                best, after = ends[state], -1
            else:
                row, ahead = steps[i][0][state], price[i + 1]
                best, after = min((row[q] + ahead[q], q) for q in STATES)
            if price[i][state] < best:
                price[i][state] = best
                if best >= BIG and i == 0:
                    break
                if i:
                    path.pop()
            elif i == n:
                break
            else:
                path.append(after)
    return price


def trace(steps: list[Steps], ends: list[int], price: list[list[int]], origin: int) -> list[int] | None:
    """The states of the cheapest way of least letters from ``origin`` (None if there is none)."""
    n = len(steps)
    if price[0][origin] >= BIG:
        return None
    leads = [[False] * 4 for _ in range(n)] + [[price[n][q] == ends[q] < BIG for q in STATES]]
    for i in range(n - 1, -1, -1):
        costs, ahead, on = steps[i][0], price[i + 1], leads[i + 1]
        leads[i] = [any(on[q] and costs[s][q] + ahead[q] == price[i][s] for q in STATES) for s in STATES]
    states = [origin]
    for i in range(n):
        s = states[-1]
        costs, ranks = steps[i][0][s], steps[i][1][s]
        tight = [(ranks[q], q) for q in STATES if leads[i + 1][q] and costs[q] + price[i + 1][q] == price[i][s]]
        states.append(min(tight)[1])
    return states


def solve(steps: list[Steps], entry: int = START, leave: int | None = None) -> list[int]:
    """The states along the best way from ``entry`` to ``leave`` (None: to a legal end, insertions behind the last turn counted)."""
    ends = [INSERT * len(t) for t in TAIL] if leave is None else [0 if q == leave else BIG for q in STATES]
    return trace(steps, ends, prices(steps, ends, [entry]), entry)


def transfer(steps: list[Steps]) -> Steps:
    """A block of steps as one step."""
    ways = {}
    for leave in STATES:
        ends = [0 if q == leave else BIG for q in STATES]
        price = prices(steps, ends, list(STATES))
        for entry in STATES:
            states = trace(steps, ends, price, entry)
            if states:
                order = tuple(steps[i][1][a][b] for i, (a, b) in enumerate(zip(states, states[1:])))
                ways[entry, leave] = (price[0][entry], order)
    return ordered(ways)


@lru_cache(maxsize=1 << 16)
def audit(kinds: bytes, entry: int = START, leave: int | None = None) -> str:
    """Letters of the best repair of turns given by ``4 * role + fault``, without what is inserted behind the last."""
    turns = [divmod(k, 4) for k in kinds]
    states = solve([turn(*t) for t in turns], entry, leave)
    return "".join(letters(*t)[a, b][1] for t, a, b in zip(turns, states, states[1:]))
