import hashlib
import random
import re
import zlib

import pytest

from sparkroute.llm import structure_repair as sr

DDL = "conv_id long, turn long, role string, text string, block string, last int"


def plain(initials, marks):
    """Least (cost, audit) by all edits in order, state by state, without heaps."""
    tables = [{sr.START: (0, "")}]
    for i in range(len(initials) + 1):
        here = tables[-1]
        for _ in range(4):
            for s, (c, a) in list(here.items()):
                to = sr.MADE[s]
                here[to] = min(here.get(to, (10**9, "")), (c + 3, a + "I"))
        if i == len(initials):
            break
        after = {}

        def put(state, label):
            after[state] = min(after.get(state, (10**9, "")), label)

        for s, (c, a) in here.items():
            put(s, (c + 4, a + "D"))
            if marks[i] in "st":
                more = 3 * (marks[i] == "t")
                put(sr.MADE[s], (c + 3 + more, a + "R"))
                if initials[i] in sr.NEXT[s]:
                    put(sr.NEXT[s][initials[i]], (c + more, a + "K"))
        tables.append(after)
    return min(v for s, v in tables[-1].items() if s in sr.LEGAL_ENDS)


def expected(rows):
    """{conv: fields} written from the contract; rows are (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            turns += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, marks = set(), ""
        for _, role, text in turns:
            found = re.findall(r"[^\x20\x09-\x0D]", text)
            marks += "b" if not found else "d" if (role, text) in seen else "s" if found[-1] in ".!?" else "t"
            seen.add((role, text))
        initials = [t[1][:1] for t in turns]
        cost, audit = plain(initials, marks)
        state, i, lines = sr.START, 0, []
        for letter in audit:
            if letter == "D":
                i += 1
                continue
            role = turns[i][1] if letter == "K" else "assistant" if state == sr.USER else "user"
            lines.append(role + ":" + ("" if letter == "I" else turns[i][2]))
            state = sr.NEXT[state][role[0]]
            i += letter != "I"
        numbers = {t[0] for t in turns if t[0] is not None}
        out[conv] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, marks.count("b"), marks.count("d"), marks.count("t"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
        assert re.fullmatch(r"(s?(ua)+)?", "".join(line[0] for line in lines))
    return out


def reported(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL)
    got = sr.damage_report(df).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in got}


ROLES = ["user", "assistant", "system", "tool", "uncle", "", None]
TEXTS = ["Yes.", "No", "Why?", "", " \n", None, "Fine!", "So. And"]


def conversation(rng, conv, n):
    """Sound turns in order, half of them replaced by odd ones."""
    rows = [(conv, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(n)]
    for i in range(n):
        if rng.random() < 0.5:
            turn = None if rng.random() < 0.05 else rng.randrange(n * 2)
            rows[i] = conv, turn, rng.choices(ROLES, [9, 9, 3, 1, 1, 1, 1])[0], rng.choice(TEXTS)
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_search_finds_the_least_of_the_cheapest(seed):
    rng = random.Random(seed)
    for _ in range(300):
        n = rng.randrange(14)
        initials = rng.choices("uasx ", [5, 5, 2, 1, 1], k=n)
        marks = "".join(rng.choices("sbdt", [5, 1, 1, 2], k=n))
        assert sr.cheapest(initials, marks) == plain(initials, marks)
    assert sr.cheapest([], "") == (0, "")
    assert sr.cheapest(["s"], "s") == (4, "D")


@pytest.mark.parametrize("seed", range(3))
def test_blocks_give_the_same_as_one_search(seed):
    rng = random.Random(seed)
    for _ in range(40):
        n, wide = rng.randrange(2, 24), rng.randrange(1, 6)
        initials, marks = rng.choices("uasx", [5, 5, 2, 1], k=n), "".join(rng.choices("sbdt", [5, 1, 1, 2], k=n))
        cuts = list(range(0, n, wide))
        steps = []
        for k in cuts:
            costs, ranks = sr.block_matrix(initials[k : k + wide], marks[k : k + wide])
            steps.append({"block": k, "costs": costs, "ranks": ranks})
        costs, ranks = sr.product(steps)
        if len(steps) > 3:
            halves = [dict(zip(("costs", "ranks"), sr.product(part), strict=True)) for part in (steps[:2], steps[2:])]
            assert sr.product(halves) == (costs, ranks)
        states = sr.between(steps, sr.START, sr._end(costs[:4], ranks[:4]))
        audit, total = "", 0
        for k, step, s, t in zip(cuts, steps, states, states[1:]):
            last = step is steps[-1]
            c, a = sr.cheapest(initials[k : k + wide], marks[k : k + wide], s, sr.LEGAL_ENDS if last else [t], last)
            audit, total = audit + a, total + c
        assert (total, audit) == plain(initials, marks)


def test_like_the_contract(spark):
    rng = random.Random(4)
    rows = [r for conv in [*range(60), None, -3] for r in conversation(rng, conv, rng.randrange(1, 12))]
    assert reported(spark, rows) == expected(rows)
    assert reported(spark, []) == {}


def test_long_conversations_and_a_hot_null_id(spark):
    rng = random.Random(9)
    rows = conversation(rng, None, 900) + conversation(rng, 5, 400) + conversation(rng, 6, 5) + [(7, i, "user", "Same.") for i in range(600)]
    rows += [(8, 1, "user", "Equal turns.")] * 700 + [(9, 1, "user", "x" * 300_000 + ".")]
    assert reported(spark, rows) == expected(rows)


def test_turns_of_a_repair(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi"), (1, 2, "user", "Hi"), (1, 3, "user", "More?"), (2, 0, "assistant", "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL)
    got = {r["conv"]: r for r in sr.repair(df).collect()}
    assert got[1]["audit"] == "KKDR" and got[1]["cost"] == 10
    assert [tuple(t) for t in got[1]["turns"]][2:] == [("D", "user", "Hi"), ("R", "assistant", "More?")]
    assert got[2]["audit"] == "D" and got[2]["turns"][0]["role"] == "assistant"
