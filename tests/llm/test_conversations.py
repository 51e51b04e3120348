"""Conversation repair against a plain version that keeps whole strings."""

import hashlib
import random
import re
import zlib

import pytest

from pagewell.llm import conversations as C

FOLDER = "/root/testdata/sf0.001"
GIVEN = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
KEEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(rows):
    """`(cost, audit, repaired)` of `(role, text, fault)` rows; whole strings at each position."""
    def with_inserts(best):
        for _ in range(3):
            for s, (cost, audit, out) in list(best.items()):
                role, to = GIVEN[s]
                one = (cost + 5, audit + "I", out + ((role, ""),))
                if to not in best or one < best[to]:
                    best[to] = one
        return best

    best = with_inserts({0: (0, "", ())})
    for role, text, fault in rows:
        found = {}
        for s, (cost, audit, out) in best.items():
            options = [(s, (cost + 2, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                given, to = GIVEN[s]
                options.append((to, (cost + more + 1, audit + "R", out + ((given, text),))))
                if role[:1] in KEEPS[s]:
                    options.append((KEEPS[s][role[:1]], (cost + more, audit + "K", out + ((role, text),))))
            for to, one in options:
                if to not in found or one < found[to]:
                    found[to] = one
        best = with_inserts(found)
    return min(best[s] for s in (0, 3) if s in best)


def plain(rows):
    """The result row of `(turn, role, text)` rows, nulls already spaces but for the turn."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        shown = re.sub("[\x20\x09-\x0D]", "", text)
        fault = ("blank" if not shown else "duplicate" if (role, text) in seen
                 else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
        marked.append((role, text, fault))
        if fault:
            counts[fault] += 1
    turns = {t for t, _, _ in rows if t is not None}
    initials = [role[:1] for role, _, _ in marked]
    cost, audit, out = cheapest(marked)
    return {**counts, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost,
            "audit": audit, "out": out,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()}


def damage(conv, turn, role, text):
    role, text = (" " if v is None else v for v in (role, text))
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    if kind == 0:
        return []
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def test_steps_of_random_conversations():
    rng, fronts = random.Random(3), C.Fronts()
    for _ in range(3000):
        roles = ["system", "user", "assistant", "tool"] if rng.random() < 0.5 else ["user", "assistant"]
        rows = [(rng.choice(roles), f"t{rng.randrange(9)}", rng.choice([None, None, "blank", "truncated"]))
                for _ in range(rng.randrange(0, 14))]
        one = C._Conversation("x", fronts)
        for n, (role, text, fault) in enumerate(rows):
            one.add(True, n, role.encode(), text.encode(), role[0] if role[0] in "sua" else "?",
                    fault == "blank", False, fault == "truncated")
        got, (cost, audit, out) = one.result(), cheapest(rows)
        assert got[6:] == (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())
    assert len(fronts.fronts) < 100 and len(fronts.steps) < 1000  # what a task holds of them is bounded


def test_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()
    by = {}
    for r in rows:
        by.setdefault(r["conv_id"], []).extend(damage(r["conv_id"], r["turn"], r["role"], r["text"]))
    got = {r["conv_id"]: r.asDict() for r in C.op11_conversations(spark, FOLDER).collect()}
    assert set(got) == set(by)
    for key, found in got.items():
        want = plain(by[key])
        assert {c: found[c] for c in found if c != "conv_id"} == {c: want[c] for c in found if c != "conv_id"}


@pytest.fixture
def odd(spark):
    rng = random.Random(5)
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 0, "assistant", "Hi."), (1, None, "system", "S!"),
            (1, None, None, None), (2, 5, "user", None), (3, None, None, "x."), (None, 1, "user", "Q?"),
            (None, 2, "assistant", "A. \t"), (4, 1, "", "."), (4, 9, "umpire", "yes."), (4, 10, "a", "no! "),
            (5, -3, "user", "word " * 60_000 + "."), (5, 7, "assistant", ""), (6, 1, "user", "cut off"),
            (6, 2, "assistant", "fine."), (6, 3, "user", "é \U0001F600?"), (6, 3, "user", "a.\nassistant:b.")]
    rows += [(7, rng.randrange(900), rng.choice(["user", "assistant", "tool"]), rng.choice(["a.", "b", " ", "c!"]))
             for _ in range(1500)]
    return spark.createDataFrame([(*r, "x", "y", True) for r in rows],
                                 "conv_id long, turn long, role string, text string, key string, letter string, again boolean")


def by_conversation(odd):
    by = {}
    for r in odd.collect():
        by.setdefault(r["conv_id"], []).append((r["turn"], *(" " if r[c] is None else r[c] for c in ("role", "text"))))
    return by


@pytest.mark.parametrize("held,batch", [(1 << 20, "10000"), (7, "3")])
def test_odd_rows(spark, odd, monkeypatch, held, batch):
    """Also across Arrow batches, and with steps in the task's file."""
    monkeypatch.setattr(C, "HELD_STEPS", held)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = C.repairs(odd)
        got = {r["conv_id"]: r.asDict() for r in found.collect()}
        lines = C.repaired(odd, found).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = {k: plain(v) for k, v in by_conversation(odd).items()}
    assert set(got) == set(want)
    for key, w in want.items():
        assert {c: v for c, v in got[key].items() if c != "conv_id"} == {
            c: w[c] for c in got[key] if c != "conv_id"}
        out = sorted((r["position"], r["role"], r["text"]) for r in lines if r["conv_id"] == key)
        assert out == [(n, *o) for n, o in enumerate(w["out"])]


def test_rows_across_batches(odd):
    """A conversation that spans frames and files of steps, without Spark."""
    rows = sorted((r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()) for r in by_conversation(odd)[7])
    whole, small = C._Conversation("7", C.Fronts()), C._Conversation("7", C.Fronts())
    held = C.HELD_STEPS
    for one, steps in ((whole, held), (small, 64)):
        C.HELD_STEPS = steps
        for row in rows:
            letter = row[2][:1].decode()
            one.add(*row, letter if letter in "sua" else "?", not row[3].strip(), False, row[3][-1:] not in b".!?")
    C.HELD_STEPS = 64
    assert small.file is not None and small.result() == whole.result()
    C.HELD_STEPS = held


def test_all_dropped_and_empty(spark, odd):
    none = C.repairs(odd.selectExpr("*", "true as gone"), gone="gone").collect()
    assert len(none) == len(by_conversation(odd))
    for r in none:
        assert r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() and r["audit"] == ""
        assert not any(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    assert C.repairs(odd.where("false")).count() == 0
    assert C.damaged(odd.where("false")).count() == 0
