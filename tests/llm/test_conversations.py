import hashlib
import itertools
import random
import re
import zlib

import pytest

from nightledger.llm.conversations import STRETCH, damaged, repair_conversations, repaired_after_damage
from nightledger.llm.edit_search import ENDS, START, cheapest, composed, summaries

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def cheapest_by_table(symbols):
    """Least (cost, edits) by states, turn for turn."""
    follow = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    onto = {0: 2, 1: 2, 2: 3, 3: 2}

    def inserts(best):
        for _ in range(2):
            for state, (cost, edits) in list(best.items()):
                way = (cost + 2, edits + "I")
                best[onto[state]] = min(best.get(onto[state], way), way)
        return best

    best = {0: (0, "")}
    for symbol in symbols:
        now, role, more = {}, symbol.lower(), int(symbol.isupper())
        for state, (cost, edits) in inserts(dict(best)).items():
            ways = [(state, 3, "D")]
            if symbol != "-":
                ways += [(follow[state, role], more, "K")] if (state, role) in follow else []
                ways += [(onto[state], 2 + more, "R")]
            for to, add, edit in ways:
                now[to] = min(now.get(to, (1 << 40, "")), (cost + add, edits + edit))
        best = now
    final = inserts(dict(best))
    return min(final[state] for state in (0, 3) if state in final)


@pytest.mark.parametrize("length", range(5))
def test_all_short_conversations(length):
    for symbols in itertools.product("suaxSA-", repeat=length):
        symbols = "".join(symbols)
        assert cheapest(symbols) == cheapest_by_table(symbols), symbols


def test_long_conversations_and_stretches():
    rng = random.Random(3)
    for n in (20, 60, 128):
        for _ in range(15):
            symbols = "".join(rng.choice("uauauauasxUA-") for _ in range(n))
            expected = cheapest_by_table(symbols)
            assert cheapest(symbols) == expected
            cuts = sorted(rng.sample(range(1, n), 3))
            parts = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, n])]
            ways = [summaries(part, i == 0, i == len(parts) - 1) for i, part in enumerate(parts)]
            path = composed([[way[:4] for way in part] for part in ways])
            chosen = [next(way for way in part if way[:2] == pair) for part, pair in zip(ways, path)]
            assert (sum(way[2] for way in chosen), "".join(way[4] for way in chosen)) == expected


def test_ends():
    assert cheapest("") == (0, "")
    assert cheapest("s") == (3, "D")
    assert cheapest("u") == (2, "KI")
    assert cheapest("-" * 200) == (600, "D" * 200)
    assert START in ENDS


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm:
            row = (conv, turn, "user" if harm == 4 else role, "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text)
            out += [row] * (2 if harm == 3 else 1)
    return out


def brute(rows, harmed=True):
    turns, out = damage(rows) if harmed else rows, []
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in turns if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults, symbols = set(), [], ""
        for _, role, text in mine:
            bare = text.strip(BLANKS)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            symbols += "-" if faults[-1] in ("blank", "duplicate") else initial.upper() if faults[-1] else initial
        ids = [t for t, _, _ in mine if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = cheapest_by_table(symbols)
        lines, left, state = [], list(mine), 0
        for edit in audit:
            if edit == "I":
                role, text = ("assistant" if state == 2 else "user"), ""
            else:
                _, role, text = left.pop(0)
            if edit == "D":
                continue
            if edit == "R":
                role = "assistant" if state == 2 else "user"
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            lines.append(f"{role}:{text}")
        out.append((
            conv, max(ids) - min(ids) + 1 - len(set(ids)) if ids else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "Why?", "and so", " \t", "", None, "Ends. \n", "Ende. ", "Long " * 3000 + "text."]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            kind = rng.random()
            role = ["user", "assistant"][turn % 2] if kind < 0.7 else rng.choice(["system", "user", "assistant", "tool", "", None, "User"])
            rows.append((conv, None if rng.random() < 0.05 else turn + (turn > 4), role, rng.choice(texts) if rng.random() < 0.4 else f"T {rng.random()}."))
    rows += [rows[5], rows[5], rows[9]]
    # Longer than a stretch, the last with one turn again and again.
    rows += [(100, t, ["user", "assistant"][(t + t // 50) % 2], f"Turn {t}{'.' if t % 7 else ''}") for t in range(3 * STRETCH)]
    rows += [(101, 5, "user", "Again.")] * (STRETCH + 20)
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = conversations()
    found = repaired_after_damage(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def test_damage(spark):
    rows = conversations()
    assert sorted(map(tuple, damaged(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == sorted(damage(rows), key=str)


def test_repaired_turns_and_odd_tables(spark):
    from pyspark.sql import functions as F

    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hello."), (2, 0, "tool", "x")]
    table = spark.createDataFrame(rows, SCHEMA)
    more = table.withColumns({name: F.lit("x") for name in ("key", "seq", "mark", "edits", "stretch", "initial", "cost", "harm", "copy")})
    for df in (table, more):
        found, turns = repair_conversations(df)
        assert {(r.conv_id, r.cost, r.audit) for r in found.collect()} == {(1, 2, "KR"), (2, 3, "D")}
        assert [tuple(r)[1:] for r in turns.orderBy("position").collect()] == [(0, "K", "user", "Hi."), (1, "R", "assistant", "Hello.")]
    assert repaired_after_damage(table.limit(0)).collect() == []
    # All turns of a conversation dropped.
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    only = repaired_after_damage(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)).collect()
    assert [tuple(r) for r in only] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
