"""Near-duplicates among many texts of one template, whose similarity is just too small."""

import numpy as np

from pagewell.llm import simhash
from tests.llm.test_against_brute_force import joined


def linked(texts):
    """The groups by brute force over the distinct shingles."""
    sets = {k: set(simhash.shingle_hashes(t, 5).tolist()) for k, t in texts.items()}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return near, joined(sorted(sets), near)


def found(spark, texts):
    rows = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    got = simhash.groups_by_similarity(rows).collect()
    assert len({r["key"] for r in got}) == len(got)
    return {k: k for k in texts} | {r["key"]: r["component"] for r in got}


def variants(rng, count, own, words=200):
    """Texts that share a template but for the last `own` words."""
    base = [f"t{k}" for k in range(words - own)]
    return [base + [f"v{n}x{k}" for k in rng.integers(0, 1 << 40, own)] for n in range(count)]


def test_links_between_rejected_candidates(spark):
    rng = np.random.default_rng(11)
    made = variants(rng, 300, 25)  # similarity 0.77 to each other
    for k in range(0, 60, 2):  # pairs at 0.9 or so
        made[k + 1] = made[k][:190] + [f"p{k}x{j}" for j in range(10)]
    texts = {int(n): " ".join(w) for n, w in zip(rng.permutation(len(made)), made)}
    near, groups = linked(texts)
    assert len(near) == 30
    assert found(spark, texts) == groups


def test_chunks_of_rejected_candidates(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK_SHINGLES", 4_000)
    rng = np.random.default_rng(12)
    made = variants(rng, 120, 24)
    for k in range(0, 30, 3):
        made[k + 1] = made[k][:192] + [f"p{k}x{j}" for j in range(8)]
        made[k + 2] = made[k][:188] + [f"q{k}x{j}" for j in range(12)]
    texts = {int(n): " ".join(w) for n, w in zip(rng.permutation(len(made)), made)}
    assert found(spark, texts) == linked(texts)[1]


def test_repeated_passages_do_not_count(spark):
    rng = np.random.default_rng(13)
    texts = {}
    for k in range(40):
        words = [f"w{k}x{j}" for j in range(204)]
        changed = int(rng.integers(0, 8))
        other = words[:200 - changed] + [f"c{k}x{j}" for j in range(4 + changed)]
        at = int(rng.integers(0, 150))
        texts[2 * k], texts[2 * k + 1] = " ".join(words), " ".join(other + other[at:at + 24] * (3 + k % 8))
    near, groups = linked(texts)
    assert len(near) == 40
    assert found(spark, texts) == groups


def test_candidates_at_the_asked_similarity():
    rng = np.random.default_rng(14)
    for shared, left, right in ((4, 0, 1), (8, 1, 1), (40, 5, 5), (160, 20, 20), (160, 0, 40)):
        apart = []
        for _ in range(400):
            h = rng.integers(0, 1 << 63, shared + left + right).astype(np.uint64)
            a, b = simhash.fingerprint(h[:shared + left], simhash.WORDS), simhash.fingerprint(
                np.r_[h[:shared], h[shared + left:]], simhash.WORDS)
            apart.append(int(np.bitwise_count(a ^ b).sum()))
        assert max(apart) <= simhash.POSSIBLE
