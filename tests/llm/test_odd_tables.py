"""Each operator on odd and on empty tables: nothing crashes and every case has its result."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewell.llm import (
    embeddings, langid, lm, mixing, packing, quality, simhash, token_counts, token_files, warc)
from pagewell.llm.shared import shared_folder
from pagewell.llm.tokens import Encoder, default_path


@pytest.fixture(scope="module")
def plain():
    """Ids by whole texts."""
    library = Encoder(default_path())
    return lambda text: library._whole([text or ""])[0]


def test_mixing(odd_docs, no_docs):
    mixed = mixing.mix(odd_docs)
    rows = mixed.collect()
    assert len(rows) == odd_docs.count()
    assert {c for c in odd_docs.columns} <= set(mixed.columns)
    by = {}
    for r in rows:
        assert r["size"] == len((r["text"] or "").encode().split()) and 0 <= r["copies"] <= 2
        by.setdefault(r["source"], []).append(r)
    for part in by.values():
        taken = sum(r["copies"] * r["size"] for r in part)
        assert abs(taken - part[0]["target"]) <= max(r["size"] for r in part)
    assert sorted(map(str, mixing.mix(odd_docs).collect())) == sorted(map(str, rows))
    assert mixing.emit(mixed).count() == sum(r["copies"] for r in rows)
    assert mixing.mix(no_docs).count() == 0


def test_mixing_with_given_weights(odd_docs, spark):
    weights = spark.createDataFrame([("a", 1.0), (None, 1.0)], "source string, weight double")
    assert {r["source"] for r in mixing.mix(odd_docs, weights=weights).where("copies > 0").collect()} <= {"a", None}


def test_lm(odd_docs, no_docs):
    rows = lm.score(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r["lm_score"] is None) == (r["n_words"] == 0)
    scores = {r["doc_id"]: r["lm_score"] for r in rows}
    assert scores[1] == scores[2] > scores[6]  # copies vouch for each other
    assert lm.score(no_docs).count() == 0


def test_simhash(odd_docs, no_docs):
    prints = simhash.fingerprints(odd_docs)
    rows = simhash.groups_by_radius(prints).collect()
    assert len(rows) == odd_docs.count()
    found = {r["key"]: (r["fp"], r["component"]) for r in rows if r["key"] is not None}
    assert found[1][1] == found[2][1] == 1
    assert found[3] == found[4] == found[5] == (0, 3)
    assert simhash.groups_by_radius(simhash.fingerprints(no_docs)).count() == 0


def test_similar_documents(odd_docs, no_docs):
    left = simhash.drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    ids = sorted((r["doc_id"] for r in left.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 3, 6, 7, 9, 10, 11, 12, None, None]
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_embeddings(spark):
    half = [0.5, 0.5, 0.0, 0.0]
    rows = [(1, half), (2, [1.0, 1.0, 0.0, 0.0]), (3, None), (4, [0.0] * 4), (5, [1.0, None, 0.0, 0.0]),
            (6, [float("nan"), 1.0, 0.0, 0.0]), (7, [float("inf"), 1.0, 0.0, 0.0]), (8, half), (None, half),
            (9, []), (10, [0.5, 0.5]), (11, [-0.5, -0.5, 0.0, 0.0]), (12, [0.5, 0.5, 0.2, 0.0]), (12, [0.5, 0.5, 0.2, 0.0])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                  "vec_id long, embedding array<double>, node string, dim int")
    found = embeddings.near_duplicates(table)
    got = sorted(((r["key"], r["n_links"], r["component"], r["kept"]) for r in found.collect()),
                 key=lambda r: (r[0] is None, r))
    assert got == [(1, 4, 1, True), (2, 4, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
                   (6, 0, 6, True), (7, 0, 7, True), (8, 4, 1, False), (9, 0, 9, True), (10, 0, 10, True),
                   (11, 0, 11, True), (12, 4, 1, False), (12, 4, 1, False), (None, 0, None, True)]
    assert embeddings.near_duplicates(table.where("false")).count() == 0


def test_language(odd_docs, no_docs):
    filters = langid.train(odd_docs)
    assert filters.languages == ["en", "fr"]
    told = langid.predict(odd_docs, filters)
    assert told.columns == [c for c in odd_docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    for r in told.collect():
        text = r["text"] or ""
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text))
        assert 0 <= r["score"] <= 1
    assert langid.predict(no_docs, filters).count() == 0
    nothing = langid.train(no_docs)
    assert {r["lang_pred"] for r in langid.predict(odd_docs, nothing).collect()} == {"und"}


def test_false_positives_are_taken_off():
    rng = np.random.default_rng(1)
    grams = [rng.integers(0, 1 << 63, 4_000).astype(np.uint64) for _ in range(70)]
    filters = langid.Filters([f"l{k:02}" for k in range(70)], grams)
    strange = rng.integers(0, 1 << 63, 200_000).astype(np.uint64)
    for k in (0, 63, 64, 69):
        word = filters.masks[k >> 6]
        found = word[langid._slots(strange, filters.size)[0]]
        for at in langid._slots(strange, filters.size)[1:]:
            found = found & word[at]
        rate = np.count_nonzero(found & np.uint64(1 << (k & 63))) / len(strange)
        assert abs(rate - filters.false[k]) < 0.003
        inside = np.ones(len(grams[k]), bool)
        for at in langid._slots(grams[k], filters.size):
            inside &= (word[at] & np.uint64(1 << (k & 63))) > 0
        assert inside.all()


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, "http://a", "<p>x</p>", "r"), (2, "http://b\r\nX: y", "<p>x</p>", "r"), (3, None, None, None), (4, "u", "", None),
         (5, "v", "é" * 400_000, None), (5, "v", "é" * 400_000, None), (None, "w", "<p>x</p>", None), (2, "z", "<p>x</p>", "r")],
        "page_id long, url string, html string, path string")
    files = warc.write_archives(pages, shared_folder(spark, "warc"))
    rows = warc.read_archives(files).where("record_type <> 'warcinfo'").collect()
    assert all(r["error"] is None for r in rows)
    got = sorted((r["record_id"].rpartition(":")[2], r["record_type"], (r["refers_to"] or "").rpartition(":")[2],
                  r["payload_bytes"]) for r in rows)
    assert got == [("1", "revisit", "2", 8), ("2", "response", "", 8), ("2", "response", "", 8), ("3", "revisit", "4", 0),
                   ("4", "response", "", 0), ("5", "response", "", 800_000), ("5", "response", "", 800_000), ("null", "revisit", "2", 8)]
    assert {bytes(r["payload"]).decode() for r in rows if r["record_type"] == "response"} == {"<p>x</p>", "", "é" * 400_000}
    assert all("\n" not in r["target_uri"] for r in rows if r["target_uri"])
    none = warc.write_archives(pages.where("false"), shared_folder(spark, "warc"))
    assert warc.read_archives(none).count() == 0
    small = warc.write_archives(pages, shared_folder(spark, "warc"), least_bytes=9)
    kinds = [r["record_type"] for r in warc.read_archives(small).collect() if r["payload_bytes"] == 8]
    assert kinds == ["response"] * 4


def test_token_files(spark, odd_docs, no_docs, plain):
    files = token_files.write_tokens(odd_docs, shared_folder(spark, "tokens"))
    rows = token_files.read_tokens(files).orderBy("start").collect()
    assert len(rows) == odd_docs.count()
    want = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in odd_docs.collect()))
    at = 0
    for r, (known, key, text) in zip(rows, want):
        ids = [*plain(text), 0]
        assert (r["doc_id"], r["start"], r["ids"]) == (key if known else None, at, ids)
        at += len(ids)
    assert token_files.read_tokens(files, ids=False).columns == ["doc_id", "start", "n_tokens"]
    assert token_files.read_tokens(token_files.write_tokens(no_docs, shared_folder(spark, "tokens"))).count() == 0


def test_token_files_are_selective(spark, odd_docs):
    import pyarrow.parquet as pq

    files = token_files.write_tokens(odd_docs, shared_folder(spark, "tokens"))
    meta = pq.ParquetFile(files.first()["path"].removeprefix("file:")).metadata.row_group(0)
    columns = {meta.column(k).path_in_schema: meta.column(k) for k in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index
    plan = token_files.read_tokens(files, ids=False).where("doc_id = 6")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,6)" in plan and "ids:array" not in plan.rpartition("ReadSchema")[2]


@pytest.mark.parametrize("rows", ["kept", "none"])
def test_quality(odd_docs, no_docs, rows):
    docs = odd_docs if rows == "kept" else no_docs
    measured = quality.measure(docs)
    judged = quality.judge(measured, quality.fit(measured)).collect()
    assert len(judged) == docs.count()
    for r in judged:
        words = (r["text"] or "").encode().split()
        assert r["n_words"] == len(words)
        windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        twice = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)} if len(words) < 300 else set()
        if len(words) < 300:
            assert r["n_repeat_words"] == len(twice)
        assert not (r["base_failed"] and r["kept"])


def test_sketch_bins_hold_their_values(spark):
    rows = spark.range(0, 3_000_000, 997).select("id", quality.sketch_bin(F.col("id")).alias("b")).select(
        "id", "b", quality.bin_end(F.col("b")).alias("end"), quality.bin_end(F.col("b") - 1).alias("before"))
    assert rows.where("id > end or (id > 0 and id <= before) or end > id * 1.02 + 1").count() == 0


def test_packing(odd_docs, no_docs, plain):
    rows = packing.pack(odd_docs, size=256).collect()
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        documents.setdefault(r["doc_id"], []).append(r)
    for part in sequences.values():
        at = 0
        for r in sorted(part, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] * 4 == len(r["ids"])
            at += r["length"]
        assert at <= 256
    want = {}
    for r in odd_docs.collect():
        want.setdefault(r["doc_id"], []).append([*plain(r["text"]), 1])
    for key, texts in want.items():
        assert sum(r["length"] for r in documents[key]) == sum(map(len, texts))
        if len(texts) == 1:
            ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in sorted(documents[key], key=lambda r: r["start"])])
            assert ids.tolist() == texts[0]
    padding = sum(256 - sum(r["length"] for r in part) for part in sequences.values())
    assert padding < 0.05 * 256 * len(sequences) + 4 * 256
    assert packing.pack(no_docs).count() == 0


def test_cheapest_cuts():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(2, 14))
        places = np.r_[0, np.cumsum(rng.integers(1, 6, n))]
        penalties = rng.integers(0, 9, n + 1)
        size = 8

        def cost(chosen):
            ends = [0, *chosen]
            return sum(size - (b - a) + int(penalties[places.tolist().index(b)]) for a, b in zip(ends, ends[1:]))

        best = {0: 0}
        for j in range(1, n + 1):
            best[j] = min(best[i] + size - int(places[j] - places[i]) + int(penalties[j])
                          for i in range(j) if places[j] - places[i] <= size)
        found = packing.cuts(places, penalties, size, True)
        assert all(b - a <= size for a, b in zip([0, *found], found)) and found[-1] == places[-1]
        assert cost(found) == best[n]


def test_token_counts(spark, odd_docs, no_docs, plain):
    cache = shared_folder(spark, "counts")
    first = token_counts.count_tokens(odd_docs, cache, limit=10)
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()), len(plain(r["text"]))) for r in odd_docs.collect())

    def got(rows):
        return sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in rows.collect())

    assert got(first) == want
    assert {r["over_limit"] == (r["n_tokens"] > 10) for r in first.collect()} == {True}
    stored = spark.read.parquet(cache)
    distinct = odd_docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert stored.count() == distinct
    # All are hits now, also for another table; nothing is added.
    assert got(token_counts.count_tokens(odd_docs.unionByName(odd_docs), cache)) == sorted(want * 2)
    assert spark.read.parquet(cache).count() == distinct
    # Another tokenizer has counts of its own.
    import public_tokenizers
    other = token_counts.count_tokens(odd_docs.where("doc_id = 1"), cache, public_tokenizers.path("piece_bpe_32k.model"))
    assert other.first()["n_tokens"] > 0 and spark.read.parquet(cache).count() == distinct + 1
    assert token_counts.count_tokens(no_docs, cache).count() == 0


def test_parts_give_the_ids_of_whole_texts():
    import random
    made = random.Random(5)
    signs = [" ", " ", "\n", "\t", "\r", "a", "B", "é", "1", "'s", "'", "!", ".", ",", ". ", ", ", "\xa0", "　", "\x1c",
             "\x85", "日", "_", "\x00", "́", " x", "²"]
    texts = ["".join(made.choice(signs) for _ in range(made.randint(0, 14))) for _ in range(20_000)]
    texts += ["a <|endoftext|> b", "\n\x00.", "x\n\x00, y"]
    library = Encoder(default_path())
    assert library.by_parts
    for start in range(0, len(texts), 500):
        part = texts[start:start + 500]
        for text, got in zip([part], library.encode(part)):
            whole = library._whole(part)
            assert got[1].tolist() == [len(x) for x in whole]
            assert got[0].tolist() == [y for x in whole for y in x]
