import hashlib
import os
import random
import re
import zlib
from functools import lru_cache

import pytest

from ledgerstar.llm import turns

SHORT = {"s": "s", "u": "u", "a": "ua"}
SAID = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying every edit at every row."""
    seen, kinds = set(), []
    for _, _, role, text in rows:
        said = [c for c in text if SAID.match(c)]
        kinds.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))

    def after(now, initial):
        text = now + initial
        return text if re.fullmatch("(s|s?(ua)*u|s?(ua)+)?", text) else None

    @lru_cache(None)
    def best(at, state, added):
        """state: initials so far, shortened to what decides the next."""
        options = []
        if at == len(rows):
            if re.fullmatch("(s?(ua)+)?", state):
                options.append((0, "", ()))
        else:
            _, _, role, text = rows[at]
            late = 3 * (kinds[at] == "truncated")
            c, a, r = best(at + 1, state, 0)
            options.append((c + 4, "D" + a, r))
            if kinds[at] not in ("blank", "duplicate"):
                for initial, name, cost, edit in [(role[:1], role, 0, "K"), ("u", "user", 3, "R"), ("a", "assistant", 3, "R")]:
                    to = after(state, initial) if initial else None
                    if to is not None:
                        c, a, r = best(at + 1, SHORT[to[-1]], 0)
                        options.append((c + cost + late, edit + a, ((name, text), *r)))
        for initial, name in (("u", "user"), ("a", "assistant")) if added < 3 else ():
            to = after(state, initial)
            if to is not None:
                c, a, r = best(at, SHORT[to[-1]], added + 1)
                options.append((c + 3, "I" + a, ((name, ""), *r)))
        return min(options, default=(1 << 40, "", ()))

    return *best(0, "", 0), kinds


def expected(rows, damage=True):
    out = []
    after = damaged(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        cost, audit, left, kinds = cheapest(own)
        at = {r[1] for r in own} - {None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:], strict=False)]
        out.append((conv, max(at) - min(at) + 1 - len(at) if at else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(7, t, x, "k", c, r, 3) for c, t, r, x in rows], "n int, turn long, text string, ck string, conv_id long, role string, piece int")


def some(r, convs, longest):
    texts = ["Hi.", "Go on!", "Why?", "cut off", "", " \t\n", None, "Tail.  \n", "é漢.", "a:b.", "x ", "many words here."]
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", None, "User", "s"]
    return [(conv, r.choice([None, *range(6)]) if r.random() < 0.3 else k, r.choice(roles[:3]) if r.random() < 0.7 else r.choice(roles), f"Part {k}." if r.random() < 0.4 else r.choice(texts))
            for conv in convs for k in range(r.randint(1, longest))]


def check(spark, rows, **more):
    d = frame(spark, rows)
    got = turns.report(turns.repair(turns.damage(d), d.select("conv_id"), **more))
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


@pytest.mark.parametrize("more", [{}, {"piece_rows": 1}, {"piece_rows": 3}, {"piece_bytes": 200}])
def test_equals_brute_force(spark, more):
    r = random.Random(4)
    rows = some(r, [*range(60), None], 9) + some(r, [100, 101], 60)
    rows += [rows[3], rows[3], (None, None, "user", "Hi."), (None, None, None, None)]
    check(spark, rows, **more)


def test_repair_alone_and_its_turns(spark):
    r = random.Random(9)
    rows = some(r, range(40), 12)
    pieces = turns.repair(frame(spark, rows), piece_rows=4)
    assert sorted(map(tuple, turns.report(pieces).collect()), key=str) == expected(rows, damage=False)
    said = {}
    for t in turns.turns(pieces).orderBy("conv_id", "piece", "position").collect():
        said.setdefault(t["conv_id"], []).append(t["role"][0])
    assert said and all(re.fullmatch("s?(ua)+", "".join(x)) for x in said.values())


def test_long_conversation_and_long_text(spark):
    r = random.Random(2)
    rows = [(1, k, r.choice(["user", "assistant"]), f"t{k}" + r.choice([".", "", "!"])) for k in range(3000)]
    rows += [(2, 0, "user", "w " * 300_000 + "."), (2, 1, "assistant", "Same."), *[(2, 2 + k, "assistant", "Same.") for k in range(50)]]
    d = frame(spark, rows)
    whole, cut = (sorted(map(tuple, turns.report(turns.repair(d, piece_rows=n)).collect()), key=str) for n in (1 << 14, 37))
    assert whole == cut
    cost = {row[0]: row[6] for row in whole}
    steps = [turns.examine(t, role, text, 1, True)[0] for _, t, role, text in rows[:3000]]
    forward = {0: 0}  # cheapest way to each state, row by row from the front
    for s in [*steps, None]:
        for _ in range(3):
            forward = {k: min(v for v in [forward.get(k, 1 << 40), *(c + 3 for q, c in forward.items() if turns.NEXT[q] == k)]) for k in range(4)}
        if s:
            to = {}
            for q, c in forward.items():
                kept = turns.KEPT[s.initial][q]
                for k, x in [(q, c + 4), (turns.NEXT[q], c + 3 + s.cut), *([(kept, c + s.cut)] if kept is not None else [])]:
                    to[k] = min(to.get(k, 1 << 40), x)
            forward = to
    assert cost[1] == min(forward[0], forward[3])


def test_no_rows_and_empty_table(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(lost, 0, "user", "Hi.")])
    d = frame(spark, [])
    assert turns.report(turns.repair(turns.damage(d), d.select("conv_id"))).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data")
def test_query_equals_brute_force(spark):
    from ledgerstar.llm.queries import QUERIES
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_checkpointed_repair"](spark, folder)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)
