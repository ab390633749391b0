import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest

from quiver.llm.repair import all_stacks, damage, parse, inserts, repair, ACCEPT, START

SCHEMA = "conv_id long, turn long, role string, text string, key string, seg string, pos string, audit string, lines string"


def cheapest(rows):
    """(cost, audit, roles) over all edits with at most two inserts between rows, by trying each; (role, fault) rows."""
    found = []
    gaps = [""] + ["u", "a", "ua", "au"]
    for edits in product("KDua", repeat=len(rows)):
        if any(e != "D" and f in ("blank", "duplicate") for e, (_, f) in zip(edits, rows)):
            continue
        for ins in product(gaps, repeat=len(rows) + 1):
            roles, audit, cost = ins[0], "I" * len(ins[0]), 3 * len(ins[0])
            for e, (role, fault), more in zip(edits, rows, ins[1:]):
                roles += "" if e == "D" else role if e == "K" else e
                audit += e if e in "KD" else "R"
                cost += {"K": 0, "D": 4}.get(e, 3) + 3 * (e != "D" and fault == "truncated")
                roles, audit, cost = roles + more, audit + "I" * len(more), cost + 3 * len(more)
            if re.fullmatch("(s?(ua)+)?", roles):
                found.append((cost, audit, roles))
    return min(found)


def whole(rows, start=START):
    return min((c + d, a + e) for s, c, a in parse(rows, start) for t, d, e in inserts(s) if t[-1] in ACCEPT)


@pytest.mark.parametrize("seed", range(40))
def test_parse_against_all_edits(seed):
    r = random.Random(seed)
    rows = [(r.choice("suat "), r.choice(["", "", "truncated", "blank", "duplicate"])) for _ in range(r.randint(0, 3))]
    assert whole(rows) == cheapest(rows)[:2]


def table(n, seed=1):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", "Été 日本.", "a\x85.", "Ends.\n", None, "x" * 5000 + "."]
    rows = [(i, t, r.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), r.choice(texts)) for i in range(n) for t in range(r.randint(1, 9))]
    rows += [(None, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(5)] + [(7, None, "user", "No turn.")] * 2
    rows += [(900, t, ["user", "assistant"][t % 2] if t % 11 else "system", r.choice(["Fine.", "cut", f"Row {t}."])) for t in range(300)] + [(901, None, "user", "Only.")]
    return rows + [rows[3], rows[3], (4, 2, "user", "Second row of a turn.")]


def brute(rows):
    groups = {r[0]: [] for r in rows}
    for c, t, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        groups[c] += [(t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    out = {}
    for c, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, told, n = set(), [], defaultdict(int)
        for t, role, text in own:
            last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
            seen.add((role, text))
            n[fault] += 1
            told.append((role[:1], fault))
        turns = {r[0] for r in own if r[0] is not None}
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(told, told[1:]))
        cost, audit = whole(told)
        lines, it = [], iter(own)
        for e in audit:
            _, role, text = (None, None, "") if e == "I" else next(it)
            if e != "D":
                lines.append((role if e == "K" else None, text))
        system = bool(lines) and (lines[0][0] or "")[:1] == "s"
        lines = [f"{role if role is not None else ['user', 'assistant'][(i - system) % 2]}:{text}" for i, (role, text) in enumerate(lines)]
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.mark.parametrize("segment", [3, 256])
def test_repair_against_brute_force(spark, segment):
    rows = table(60)
    df = spark.createDataFrame([(*r, "k", "s", "p", "a", "l") for r in rows], SCHEMA).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in repair(damage(df), df, segment).collect()}
    assert got == brute(rows)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair(damage(none), none).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(dropped, 0, "user", "Hi.", *"ksapl")], SCHEMA)
    assert [tuple(r) for r in repair(damage(one), one).collect()] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_stacks_are_few():
    assert len(all_stacks()) == 8
