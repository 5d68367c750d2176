import hashlib
import random
import re
import zlib

import pytest

from parcelkit.llm import conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost int, rows string, mark int"
GOOD = re.compile(r"(s?(ua)+)?")
WHITE = " \t\n\v\f\r"


def brute(codes, entry=cr.START):
    """Least (cost, audit) per exit state, row by row over every edit (no bounds, no search order)."""
    def inserted(best):
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                to, new = cr._NEXT[s], (c + 3, a + "I")
                best[to] = min(best.get(to, new), new)
        return best
    best = inserted({entry: (0, "")})
    for code in codes:
        step = {}
        for s, (c, a) in best.items():
            moves = [("D", 4, s)]
            if code != "x":
                t, to = 3 * code.isupper(), cr._NEXT[s]
                moves.append(("R", 3 + t, to))
                if code.lower() == "s" and s == cr.START:
                    moves.append(("K", t, cr.SYSTEM))
                if code.lower() == {cr.USER: "u", cr.ASSISTANT: "a"}[to]:
                    moves.append(("K", t, to))
            for e, k, to in moves:
                new = (c + k, a + e)
                step[to] = min(step.get(to, new), new)
        best = inserted(step)
    return best


def expected(rows):
    """The contract in plain Python."""
    convs = {}
    for conv, turn, role, text, *_ in rows:
        out = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = role if role is not None else " ", text if text is not None else " "
        hit = zlib.crc32(key.encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    result = {}
    for conv, out in convs.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        faults, seen, codes = [], set(), ""
        for _, role, text in out:
            fault = "blank" if not text.strip(WHITE) else "duplicate" if (role, text) in seen else (
                "truncated" if text.rstrip(WHITE)[-1] not in ".!?" else "")
            seen.add((role, text))
            faults.append(fault)
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        best = brute(codes)
        cost, audit = min(best[s] for s in (cr.START, cr.ASSISTANT) if s in best)
        turns = [r[0] for r in out if r[0] is not None]
        kept, at = [], 0
        length = len(audit) - audit.count("D")
        for e in audit:
            place = len(kept) - length % 2
            new = "assistant" if place % 2 else "user"
            if e != "D":
                text = "" if e == "I" else out[at][2]
                kept.append((out[at][1] if e == "K" else new, text))
            at += e != "I"
        assert GOOD.fullmatch("".join(r[0][:1] for r in kept))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(out, out[1:])]
        result[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                        faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return result


def got(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


def test_search_finds_the_least_cost_and_audit():
    rng = random.Random(3)
    for _ in range(800):
        codes = "".join(rng.choice("uuaausUAxoOS") for _ in range(rng.randint(0, 16)))
        best = brute(codes)
        assert list(cr.solve(codes).values()) == [min(best[s] for s in (cr.START, cr.ASSISTANT) if s in best)]
        for entry in range(4):
            assert cr.solve(codes, entry, False) == brute(codes, entry)


def test_bounds_never_exceed_the_rest():
    rng = random.Random(4)
    for _ in range(200):
        codes = "".join(rng.choice("uaasUAxoOS") for _ in range(rng.randint(0, 9)))
        for i, bounds in enumerate(cr.suffix_bounds(codes, True)):
            for state in range(4):
                best = brute(codes[i:], state)
                assert bounds[state] <= min(best[s][0] for s in (cr.START, cr.ASSISTANT) if s in best)


def test_joined_stretches_equal_the_whole():
    rng = random.Random(5)
    for _ in range(100):
        codes = "".join(rng.choice("uaasUAxoOS") for _ in range(12))
        parts = [[{"entry": e, "exit": x, "cost": c, "audit": a} for e in range(4) for x, (c, a) in cr.solve(p, e, False).items()]
                 for p in (codes[:5], codes[5:7], codes[7:])]
        joined = {r["exit"]: (r["cost"], r["audit"]) for r in cr.join_solutions(cr.join_solutions(parts[0], parts[1]), parts[2])
                  if r["entry"] == cr.START}
        assert joined == brute(codes)


def _random_rows(n, seed, conv=None):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "assistant", "user", "system", "tool", "", None], ["Yes.", "No!", "cut", "", " \t", None, "a.b", "ü?"]
    return [(conv if conv is not None else rng.randint(0, n // 5), rng.choice([None, *range(12)]) if conv is None else i,
             rng.choice(roles), rng.choice(texts) if rng.random() < .3 else f"Text {rng.random()}.", 1, "x", 2) for i in range(n)]


def test_odd_rows_equal_plain_python(spark):
    rows = _random_rows(400, 1) + [(None, 1, "user", "null id.", 1, "x", 2), (None, None, None, None, 1, "x", 2),
                                   (-7, 3, "user", "long " * 40_000 + ".", None, None, None), (900, None, "user", "Hi.", 1, "x", 2)]
    rows += rows[:20]                                           # repeated rows
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(cr.repair_report(df)) == expected(rows)


@pytest.mark.parametrize("block", [4, 16])
def test_long_conversations_span_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(cr, "BLOCK", block)
    monkeypatch.setattr(cr, "FAN", 2)
    rows = _random_rows(150, 2, conv=5) + _random_rows(90, 3, conv=6) + _random_rows(60, 4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(cr.repair_report(df)) == expected(rows)


def test_empty_table(spark):
    assert cr.repair_report(spark.createDataFrame([], SCHEMA)).collect() == []
