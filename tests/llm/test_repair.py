import hashlib
import itertools
import random
import re
import zlib

import pytest

from trestle.llm import repair as R
from trestle.llm.common import table

NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(rows):
    """(cost, audit, rows) by trying state by state; ``rows`` are (role, text, fault)."""
    best = {"": (0, "", ())}                    # by initial of the last repaired row

    def insert(ways):
        for _ in range(2):
            for state, (cost, audit, out) in list(ways.items()):
                role = "assistant" if state == "u" else "user"
                new = (cost + 5, audit + "I", (*out, (role, "")))
                if role[0] not in ways or new < ways[role[0]]:
                    ways[role[0]] = new
        return ways

    for role, text, fault in rows:
        ways = {}

        def offer(state, way):
            if state not in ways or way < ways[state]:
                ways[state] = way

        for state, (cost, audit, out) in insert(best).items():
            offer(state, (cost + 2, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                cost += 5 * (fault == "truncated")
                if role[:1] in NEXT[state]:
                    offer(role[0], (cost, audit + "K", (*out, (role, text))))
                new = "assistant" if state == "u" else "user"
                offer(new[0], (cost + 1, audit + "R", (*out, (new, text))))
        best = ways
    return min(insert(best)[s] for s in ("", "a") if s in best)


def expected(conversations):
    out = {}
    for conv in {r[0] for r in conversations}:
        rows, turns = [], []
        for _, turn, role, text in [r for r in conversations if r[0] == conv]:
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            role, text, draw = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
            if draw:
                text = {1: "", 2: re.sub("[.!?]", "", text)}.get(draw, text)
                rows += [((turn is not None, turn or 0), "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
                turns += [turn] * (turn is not None)
        rows.sort(key=lambda r: r[0])
        seen, judged = set(), []
        for _, role, text in rows:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else (
                "truncated" if words[-1] not in ".!?" else None)
            seen.add((role, text))
            judged.append((role, text, fault))
        cost, audit, repaired = cheapest(judged)
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{k: sum(f == k for *_, f in judged) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged)),
            "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()}
    return out


def by_id(df):
    got = {r["conv_id"]: r.asDict() for r in df.collect()}
    for r in got.values():
        del r["conv_id"]
    return got


def tuples(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def test_query_against_brute_force(code):
    from trestle.llm.queries import QUERIES

    rows = tuples(table(code, "/root/testdata/sf0.01", "conversations"))
    got = QUERIES["op13_conversation_repair"](code, "/root/testdata/sf0.01")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    assert by_id(got) == expected(rows)


SCHEMA = "conv_id long, turn long, role string, text string, fault string, audit string"


def made(code, n, seed, convs):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "and then", "", " \t", "Why? ", "x" * 3000, "ends (so).", None]
    roles = ["user", "assistant", "system", "", "bot", "User", "umpire", None]
    # Every turn of a conversation once, so that the order of its rows is given.
    return [(rng.choice(convs), t if rng.random() < 0.97 or t != 3 else None, rng.choices(roles, [5, 5, 1, .3, .3, .3, .3, .3])[0],
             rng.choice(texts), "f", "z") for t in range(n)]


@pytest.mark.parametrize("length", [1, 3, 512])
def test_one_long_conversation_in_many_stretches(code, length):
    rows = made(code, 240, length, [7, 7, 7, 8, None, 9])
    df = code.createDataFrame(rows, SCHEMA).repartition(5)
    assert by_id(R.report(df, length=length)) == expected([r[:4] for r in rows])


def test_odd_conversations(code):
    rows = [(1, None, None, None), (2, None, "user", "a."), (2, None, "user", "a."), (2, None, "user", "a."),
            (3, 1 << 40, "assistant", "b?"), (4, 5, "system", "only."), (None, 1, "user", "hi."),
            (None, 2, "assistant", "ho."), (5, 0, "user", "long text " * 100_000 + ".")]
    df = code.createDataFrame([(*r, "f", "z") for r in rows], SCHEMA)
    assert by_id(R.report(df)) == expected(rows)
    assert R.report(df.filter("false")).count() == 0


def test_conversation_without_rows_left(code):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = by_id(R.report(code.createDataFrame([(gone, 0, "user", "x.", "", "")], SCHEMA)))
    assert got == {gone: {**dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0), "audit": "",
                          "repaired_sha256": hashlib.sha256().hexdigest()}}


def test_spans_are_lightest_and_join():
    rng = random.Random(4)
    for _ in range(300):
        rows = [(rng.choice("sua") + "x", "t", rng.choice([None, None, "truncated", "blank", "duplicate"]))
                for _ in range(rng.randrange(8))]
        cost, audit, _ = cheapest(rows)
        pairs = [(r[:1], f) for r, _, f in rows]
        assert min((c, a) for _, q, c, a in R.spans(pairs, [R.START]) if q in R.ACCEPTED) == (cost, audit)
        for k in range(len(rows) + 1):
            heads = {R.START: (0, "")}
            for part in (pairs[:k], pairs[k:]):
                heads = {q: v for q, (v, _) in R.joined(heads, R.spans(part, range(4))).items()}
            assert min(heads[q] for q in R.ACCEPTED if q in heads) == (cost, audit)


def test_repaired_rows_follow_the_pattern(code):
    rows = made(code, 120, 11, [1, 2, 3])
    _, repaired = R.repair(code.createDataFrame(rows, SCHEMA), length=7)
    initials = {}
    for r in repaired.orderBy("conv_id", "stretch").collect():
        initials[r["conv_id"]] = initials.get(r["conv_id"], "") + "".join(x["role"][0] for x in r["rows"])
    assert initials and all(re.fullmatch("(s?(ua)+)?", x) for x in initials.values())
