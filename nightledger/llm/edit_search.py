"""Cheapest edits that give a run of conversation turns its form, by iterative-deepening A*.

Turns are symbols: the role's initial, s, u, a or x for any other; a capital if the
text is truncated; - if the turn has to go. Roles have to read (s?(ua)+)? afterwards. Depth-first
search tries edits in ASCII order under a bound on cost, so the first path to the end
under the least bound is the cheapest and, of those, the ASCII-least.
"""

from __future__ import annotations

from functools import cache

DELETE, INSERT, KEEP, REROLE = "DIKR"
#: What edits cost; a truncated turn that stays costs one more.
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED = 1
GONE, OTHER = "-", "x"

#: States: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FOLLOWS = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
#: The state after a user or assistant turn that may come next, whatever the turn was.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
ENDS = frozenset({START, ASSISTANT})

Move = tuple[str, int, int]
NEVER = 1 << 60


@cache
def moves(symbol: str, state: int) -> list[Move]:
    """(edit, cost, state after it) of the edits before or of a turn, in ASCII order."""
    found = [(DELETE, COST[DELETE], state), (INSERT, COST[INSERT], NEXT[state])]
    if symbol != GONE:
        more = TRUNCATED if symbol.isupper() else 0
        kept = FOLLOWS.get((state, symbol.lower()))
        if kept is not None:
            found.append((KEEP, COST[KEEP] + more, kept))
        if kept != NEXT[state]:
            found.append((REROLE, COST[REROLE] + more, NEXT[state]))
    return found


def least_costs(symbols: str, closing: bool) -> list[int]:
    """Per position a cost that the turns from there on have at least.

    Turns that must go and truncated ones count by themselves. Where two turns that may stay cannot
    follow each other, an edit must touch one or come between them; it settles two such places at most.
    """
    out, fixed, unfit, after = [0], 0, 0, "end" if closing else None
    for symbol in reversed(symbols):
        if symbol == GONE:
            fixed += COST[DELETE]
        else:
            fixed += TRUNCATED if symbol.isupper() else 0
            role = symbol.lower()
            fits = role == "a" if after == "end" else after is None or (role + after) in ("su", "ua", "au")
            unfit, after = unfit + (not fits), role
        out.append(fixed + 2 * ((unfit + 1) // 2))
    return out[::-1]


def reachable(symbols: str, start: int, end: int) -> bool:
    """Whether any edits of these turns lead from one state to the other."""
    if end == START:
        return start == START
    if end == SYSTEM:
        return start == SYSTEM or (start == START and "s" in symbols.lower())
    return True


def cheapest(symbols: str, start: int = START, ends: frozenset[int] = ENDS, closing: bool = True) -> tuple[int, str]:
    """Cost and edits of the cheapest path from `start` to one of `ends`, which must be reachable.

    Inserts after the last turn are made only if `closing`. The transposition table holds, for each
    place and state that has failed under a bound, the cost that is needed from there at least.
    """
    n, least = len(symbols), least_costs(symbols, closing)
    needed: dict[tuple[int, int], int] = {}

    def search(at: int, state: int, left: int) -> str | None:
        if at == n and state in ends:
            return ""
        need = NEVER
        for edit, cost, after in moves(symbols[at] if at < n else GONE, state):
            if at == n and (edit != INSERT or not closing):
                continue
            to = at if edit == INSERT else at + 1
            low = cost + needed.get((to, after), least[to])
            if low <= left:
                found = search(to, after, left - cost)
                if found is not None:
                    return edit + found
                low = cost + needed[to, after]
            need = min(need, low)
        needed[at, state] = need
        return None

    bound = least[0]
    while (found := search(0, start, bound)) is None:
        bound = needed[0, start]
    return bound, found


def summaries(symbols: str, first: bool, last: bool) -> list[tuple[int, int, int, int, str]]:
    """(start, end, cost, rank, edits) of a stretch of a conversation, for each pair of states around it.

    rank orders the edits of a start; the last stretch has one end for all. Two different edits of the
    same turns, not ending in inserts, are never one the beginning of the other, so that ranks decide between whole conversations.
    """
    out = []
    for start in [START] if first else STATES:
        if last:
            found = [(ASSISTANT, *cheapest(symbols, start))]
        else:
            ends = [end for end in STATES if reachable(symbols, start, end)]
            found = [(end, *cheapest(symbols, start, frozenset({end}), closing=False)) for end in ends]
        ranks = {edits: rank for rank, edits in enumerate(sorted(edits for _, _, edits in found))}
        out += [(start, end, cost, ranks[edits], edits) for end, cost, edits in found]
    return out


def composed(stretches: list[list[tuple[int, int, int, int]]]) -> list[tuple[int, int]]:
    """The (start, end) of each stretch on the cheapest way through all, ties by the edits of the earlier stretch.

    `stretches` holds (start, end, cost, rank) of each, in order.
    """
    ahead, ways = {ASSISTANT: 0}, []
    for stretch in reversed(stretches):
        best: dict[int, tuple[int, int, int]] = {}
        for start, end, cost, rank in stretch:
            if end in ahead:
                way = (cost + ahead[end], rank, end)
                best[start] = min(best.get(start, way), way)
        ways.append({start: end for start, (_, _, end) in best.items()})
        ahead = {start: cost for start, (cost, _, _) in best.items()}
    out, state = [], START
    for way in reversed(ways):
        out.append((state, way[state]))
        state = way[state]
    return out
