"""Queries without SQL, on a small table, against plain versions of what they compute."""

import base64
import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from pagewell.llm import bitslice, embeddings, langid, lm, packing, simhash, token_counts, token_files, warc
from pagewell.llm.components import components
from pagewell.llm.tokens import Encoder, default_path

FOLDER = "/root/testdata/sf0.001"


def joined(ids, links):
    """The smallest id reachable from each."""
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids_of(texts):
    library = Encoder(default_path())
    return {k: library._whole([t or ""])[0] for k, t in texts.items()}


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (180, 2))] + [(k, k + 1) for k in range(1000, 1060)]
    links += [(2000, k) for k in range(2001, 2100)]
    want = joined({x for e in links for x in e if e[0] != e[1]}, links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want


@pytest.mark.parametrize("words,radius", [(1, 3), (1, 0), (4, 38)])
def test_bit_sliced_links(words, radius):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, (6, words)).astype(np.uint64)
    prints = np.concatenate([base] * 40)
    for row in prints:
        for _ in range(rng.integers(0, radius + 3)):
            bit = int(rng.integers(0, 64 * words))
            row[bit >> 6] ^= np.uint64(1 << (bit & 63))
    node = np.arange(len(prints)) * 3
    group = np.sort(rng.integers(0, 3, len(prints)))
    links = bitslice.group_links(node, prints, group, np.zeros(len(prints), int), (radius,))
    near = [(int(node[a]), int(node[b])) for a in range(len(prints)) for b in range(a) if group[a] == group[b]
            and int(np.bitwise_count(prints[a] ^ prints[b]).sum()) <= radius]
    assert joined(node.tolist(), links) == joined(node.tolist(), near)
    assert set(map(tuple, map(sorted, links))) <= set(map(tuple, map(sorted, near))) and len(links) < len(prints)


def test_simhash(spark, texts):
    rows = simhash.op3_simhash(spark, FOLDER).collect()
    want = {}
    for key, text in texts.items():
        h = simhash.shingle_hashes(text, 3)
        bits = [2 * sum(int(x) >> b & 1 for x in h) > len(h) for b in range(64)]
        want[key] = sum(1 << b for b, on in enumerate(bits) if on)
    keys = sorted(want)
    near = [(a, b) for a in keys for b in keys if a < b and (want[a] ^ want[b]).bit_count() <= 3]
    groups = joined(keys, near)
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows) == [
        (k, f"{want[k]:016x}", groups[k]) for k in keys]


def test_chunks_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rng = np.random.default_rng(9)
    prints = [int(x) for x in np.unique(np.uint64(0xABC0000000000000) ^ (np.uint64(1) << rng.integers(0, 24, 300).astype(np.uint64))
              ^ (np.uint64(1) << rng.integers(0, 40, 300).astype(np.uint64)))]
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    rows = spark.createDataFrame(list(enumerate(signed)), "key long, fp long")
    got = {r["key"]: r["component"] for r in simhash.groups_by_radius(rows).collect()}
    near = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert got == joined(range(len(prints)), near)


def test_similarity(spark, texts):
    sets = {k: set(simhash.shingle_hashes(t, 5).tolist()) for k, t in texts.items()}
    keys = sorted(sets)
    near = [(a, b) for a in keys for b in keys if a < b
            and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    groups = joined(keys, near)
    got = simhash.groups_by_similarity(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()
    assert sorted((r["key"], r["component"]) for r in got) == [(k, c) for k, c in groups.items() if k != c]


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CHUNK", 50)
    monkeypatch.setattr(embeddings, "TILE", 16)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(30, 24))
    made = np.concatenate([centre[rng.integers(0, 30, 400)] + rng.normal(size=(400, 24)) * rng.uniform(0, 0.4, (400, 1)),
                           np.repeat(centre[:3], 20, axis=0)]).astype(np.float32)
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(made)], "vec_id long, embedding array<float>")
    unit = made.astype(float) / np.linalg.norm(made.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    groups = joined(range(len(made)), np.argwhere(near).tolist())
    got = sorted((r["key"], r["n_links"], r["component"], r["kept"]) for r in embeddings.near_duplicates(rows).collect())
    assert near.sum() > 500
    assert got == [(k, int(near[k].sum()), groups[k], groups[k] == k) for k in range(len(made))]


def test_lm(spark, texts):
    words = {k: (t or "").encode().lower().split() for k, t in texts.items()}
    one, two = Counter(), Counter()
    for w in words.values():
        one.update(w)
        two.update(zip(w, w[1:]))
    everything = sum(one.values())
    rows = {r["doc_id"]: r for r in lm.op2_lm_scores(spark, FOLDER).collect()}
    assert set(rows) == set(words)
    for key, w in words.items():
        own_one, own_two, total = Counter(w), Counter(zip(w, w[1:])), 0.0
        rest = max(1, everything - len(w))
        for k, x in enumerate(w):
            pair = (w[k - 1], x) if k else None
            if pair and two[pair] > own_two[pair]:
                total += math.log((two[pair] - own_two[pair]) / (one[pair[0]] - own_one[pair[0]]))
                continue
            total += math.log(0.4) if k else 0.0
            alone = one[x] - own_one[x]
            total += math.log(alone / rest) if alone else math.log(0.4 / rest)
        assert rows[key]["log_score"] == pytest.approx(total) and rows[key]["n_words"] == len(w)


def test_lm_is_the_same_in_small_blocks_and_partitions(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    whole = sorted(map(tuple, lm.score(docs, order=3).collect()))
    monkeypatch.setattr(lm, "PARTITION_GRAMS", 5_000)
    parts = sorted(map(tuple, lm.score(docs.repartition(5), order=3).collect()))
    assert [(a, b, pytest.approx(c)) for a, b, c, _ in whole] == [(a, b, c) for a, b, c, _ in parts]


def test_language_held_out(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = langid.op5_language(spark, folder).collect()
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in out) >= 0.98 * len(out)


def test_warc(spark):
    html = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    last = {}
    for key, data in html.items():
        last[data] = max(key, last.get(data, key))
    want = [(k, len(d), base64.b32encode(hashlib.sha1(d).digest()).decode(), "response" if last[d] == k else "revisit",
             None if last[d] == k else last[d]) for k, d in sorted(html.items())]
    assert sorted(map(tuple, warc.op6_warc(spark, FOLDER).collect())) == want


def test_broken_records_and_archives():
    import io

    import zstandard

    good = warc.page_record("7", "http://a", b"<p>", None)
    assert warc.parse_record(good)["error"] is None
    assert "length" in warc.parse_record(good[:-5] + b"\r\n\r\n")["error"]
    assert "digest" in warc.parse_record(good.replace(b"<p>", b"<q>"))["error"]
    assert "version" in warc.parse_record(b"nothing")["error"]
    assert "missing" in warc.parse_record(good.replace(b"WARC-Date", b"X-Date"))["error"]
    dictionary = zstandard.train_dictionary(2048, [warc.page_record(str(k), f"http://a/{k}", b"<p>%d" % k, None) for k in range(500)]).as_bytes()
    press = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    data = warc.dictionary_frame(dictionary) + press.compress(good) * 3
    assert list(warc.frames(io.BytesIO(data))) == [good] * 3
    with pytest.raises(ValueError):
        list(warc.frames(io.BytesIO(data[:-3])))


def test_token_queries(spark, texts, ids_of):
    rows = sorted(token_files.op7_token_files(spark, FOLDER).collect())
    at = 0
    for r in rows:
        ids = np.array([*ids_of[r["doc_id"]], 0], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert [r["doc_id"] for r in rows] == sorted(texts)
    counts = {r["doc_id"]: r for r in token_counts.op10_token_counts(spark, FOLDER).collect()}
    assert {k: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for k, r in counts.items()} == {
        k: (len((t or "").encode()), len(ids_of[k]), len(ids_of[k]) > 1024) for k, t in texts.items()}


def test_packing(spark, ids_of):
    rows = packing.op9_packing(spark, FOLDER).collect()
    at, filled = Counter(), Counter()
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        ids = np.array([*ids_of[r["doc_id"]], 1], "<u4")
        assert r["start"] == at[r["doc_id"]] and r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
        at[r["doc_id"]] += r["length"]
    assert at == {k: len(v) + 1 for k, v in ids_of.items()}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled[r["sequence_id"]]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048
    assert sum(2048 - n for n in filled.values()) < 0.03 * 2048 * len(filled)


def test_least_rows_of_each_language(spark):
    rows = [("a" if k % 3 else "b", (k * 7919) % 501 - 250) for k in range(1500)]
    frame = spark.createDataFrame(rows, "lang string, _h long").distinct()
    for count in (1, 40, 10_000):
        found = langid._least(frame, [F.shiftright("_h", 4), F.col("_h").bitwiseAND(F.lit(15))], count)
        for lang in "ab":
            least = sorted({h for name, h in rows if name == lang})[:count]
            assert sorted(r["_h"] for r in found.where(F.col("lang") == lang).collect()) == least
