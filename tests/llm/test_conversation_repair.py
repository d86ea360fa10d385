import hashlib
import itertools
import random
import re
import zlib

import pytest
from tests_llm_prose import SF_SMALL

from lading.llm import conversation_repair as R
from lading.llm.queries import op12_conversation_repair

COLUMNS = "conv_id long, turn long, role string, text string, audit string, cost string, kind string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip("\t\n\x0b\x0c\r ")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """Plain dynamic programme over (rows consumed, roles' automaton)."""
    best = {(0, 0): (0, "")}

    def insert():
        for _ in range(3):
            for (i, g), (c, a) in list(best.items()):
                for r in "ua":
                    if (g, r) in R.STEPS:
                        to = (i, R.STEPS[g, r])
                        best[to] = min(best.get(to, (c + 3, a + "I")), (c + 3, a + "I"))

    insert()
    for (_, _, role, _), mark in zip(rows, marks, strict=True):
        old, best = best, {}
        for (i, g), (c, a) in old.items():
            steps = [((i + 1, g), c + 4, a + "D")]
            if mark not in ("blank", "duplicate"):
                extra = 3 if mark == "truncated" else 0
                steps += [((i + 1, R.STEPS[g, r]), c + extra + w, a + e) for r, w, e in ((role[:1], 0, "K"), ("u", 3, "R"), ("a", 3, "R")) if (g, r) in R.STEPS]
            for to, cost, audit in steps:
                best[to] = min(best.get(to, (cost, audit)), (cost, audit))
        insert()
    return min(v for (_, g), v in best.items() if g in R.ACCEPT)


def repaired(rows, audit):
    turns, it = [], iter(rows)
    for e in audit:
        if e == "I":
            turns.append(None)
        else:
            row = next(it)
            if e != "D":
                turns.append((e, row))
    assert next(it, None) is None
    odd = len(turns) % 2
    out = []
    for k, t in enumerate(turns):
        role = ("user", "assistant")[(k - odd) % 2]
        out.append((role, "") if t is None else (t[1][2] if t[0] == "K" else role, t[1][3]))
    assert GRAMMAR.match("".join(r[:1] for r, _ in out))
    return out


def expected(rows, ids):
    want = {}
    for conv in ids:
        mine = in_order([r for r in rows if r[0] == conv])
        marks = faults(mine)
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:], strict=False)]
        cost, audit = cheapest(mine, marks)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired(mine, audit)).encode()).hexdigest()
        want[conv] = (gaps, *[marks.count(m) for m in ("blank", "duplicate", "truncated")], sum(p not in R.LEGAL for p in pairs), cost, audit, sha)
    return want


def got(frame):
    cols = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[c] for c in cols) for r in frame.collect()}


def test_search_finds_the_least_of_all_edits():
    for n in range(5):
        for codes in itertools.product(["s.", "u.", "a.", "ut", "ax", "o."], repeat=n):
            rows = [(0, k, c[0], "") for k, c in enumerate(codes)]
            marks = [{".": "", "t": "truncated", "x": "blank"}[c[1]] for c in codes]
            assert R.solve(list(codes)) == cheapest(rows, marks)


@pytest.mark.parametrize("size", [1, 2, 7])
def test_segments_compose_to_the_whole(size):
    rng = random.Random(size)
    for _ in range(30):
        codes = [rng.choice("suao") + rng.choice("...tx") for _ in range(rng.randrange(1, 40))]
        parts = [R.between(codes[k: k + size]) for k in range(0, len(codes), size)]
        assert R.compose(parts) == R.solve(codes)


def test_whole_table_against_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(op12_conversation_repair(spark, SF_SMALL)) == expected(damaged(rows), {r[0] for r in rows})


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    texts = ["Fine.", "cut off", "", " \t\n", None, "Really?", "x!  ", "é…", "The end.\x0b"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "", "User"]
    return [(conv, rng.choice([None, *range(8)]), rng.choice(roles), rng.choice(texts), "x", "x", "x")
            for conv in convs for _ in range(rng.randrange(most))]


@pytest.mark.parametrize("segment", [3, R.SEGMENT])
def test_nulls_ties_repeats_and_clashing_columns(spark, segment):
    rows = random_rows(5, [None, *range(40)], 12)
    chats = spark.createDataFrame(rows, COLUMNS).repartition(5)
    fixed = R.damage(chats)
    report = R.audit_conversations(fixed, ids=chats, segment=segment)
    assert got(R.digest(fixed, report)) == expected(damaged(rows), {r[0] for r in rows})


def test_a_long_conversation_among_short_ones(spark):
    rng = random.Random(3)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"turn {t % 1500}" + rng.choice([".", "!", ""])) for t in range(3000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", "Well.") for c in range(200) for t in range(2) if c != 7]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    report = R.audit_conversations(chats, segment=100)
    assert got(R.digest(chats, report)) == expected(rows, {r[0] for r in rows})


def test_repaired_turns_and_empty_table(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Hi."), (1, 2, "assistant", ""), (2, 0, "assistant", "Yes.")]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    report = R.written(R.audit_conversations(chats), "report")
    turns = {(r.conv_id, r.place): (r.edit, r.role, r.text) for r in R.repaired_turns(chats, report).collect()}
    for conv in (1, 2):
        mine = in_order([r for r in rows if r[0] == conv])
        want = repaired(mine, cheapest(mine, faults(mine))[1])
        assert [turns[conv, k][1:] for k in range(len(want))] == want
    none = R.audit_conversations(chats.limit(0))
    assert R.digest(chats.limit(0), none).collect() == []
    only = R.digest(chats.limit(0), R.audit_conversations(chats.limit(0), ids=chats)).collect()
    assert {(r.conv_id, r.cost, r.audit, r.repaired_sha256) for r in only} == {(c, 0, "", hashlib.sha256(b"").hexdigest()) for c in (1, 2)}
