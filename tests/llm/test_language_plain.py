"""Language by plain Python sets of n-grams; bounds of languages; a pipeline in plain Python."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from pagewell.llm import langid, mixing, quality
from pagewell.llm.shared import materialise
from pagewell.llm.tokens import Encoder, default_path

FOLDER = "/root/testdata/sf0.001"


def grams(text):
    text = " " + " ".join(text.lower().split()) + " "
    return [text[k:k + langid.N] for k in range(len(text) - langid.N + 1)]


def learned(rows):
    """Per language the n-grams of most of its different texts, all of which are learned from."""
    texts = defaultdict(set)
    for text, lang in rows:
        if text is not None and lang is not None:
            texts[lang].add(text)
    held = {}
    for lang, all_ in texts.items():
        assert len(all_) <= langid.LEARNED
        counts = Counter(g for t in all_ for g in set(grams(t)))
        often = [g for g, n in counts.items() if n >= max(1, len(all_) * langid.LEAST_SHARE)]
        # Of those that tie at the end the ones with the least hash are held.
        hashes = {g: h for t in all_ for g, h in zip(grams(t), langid._hashes(t).astype(np.int64).tolist())}
        held[lang] = set(sorted(often, key=lambda g: (-counts[g], hashes[g]))[:langid.GRAMS])
    return held


def shares(held, text):
    found = grams(text)
    return {lang: sum(g in known for g in found) / max(1, len(found)) for lang, known in held.items()}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_the_query_against_sets_of_n_grams(spark, docs):
    rows = docs.select("doc_id", "text", "lang", langid.held_out().alias("out")).collect()
    held = learned((r["text"], r["lang"]) for r in rows if not r["out"])
    got = {r["doc_id"]: r for r in langid.op5_language(spark, FOLDER).collect()}
    assert set(got) == {r["doc_id"] for r in rows}
    clear = 0
    for r in rows:
        mine = got[r["doc_id"]]
        assert mine["held_out"] == r["out"]
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert (mine["lang_pred"], mine["score"]) == ("und", 0.0)
            continue
        plain = shares(held, r["text"])
        assert mine["score"] == pytest.approx(max(plain.values()), abs=0.05)
        first, *rest = sorted(plain.values(), reverse=True)
        if not rest or first - rest[0] > 0.1:
            clear += 1
            assert mine["lang_pred"] == max(plain, key=plain.get)
    assert clear > 0.9 * len(rows)


def test_a_very_long_text_is_read_whole(spark):
    small = langid.Filters(["aa", "bb"], [langid._hashes("abcd " * 3), langid._hashes("wxyz " * 3)])
    text = "abcd " * 200_000 + "wxyz " * 300_000
    row = langid.predict(spark.createDataFrame([(1, text)], "id long, text string"), small).first()
    assert row["lang_pred"] == "bb" and row["score"] == pytest.approx(0.6, abs=0.01)


def test_bounds_are_those_of_each_language(spark):
    filters = langid.Filters(["aa", "bb", "cc"], [langid._hashes(t) for t in ("abcd " * 3, "wxyz " * 3, "klmn " * 3)])
    half = "wxyz wxyz " + "qqqqq" * 2
    labelled = spark.createDataFrame(
        [("abcd " * 50, "aa")] * 4 + [(half, "bb")] * 4 + [("abcd " * 9, "bb"), (None, "cc"), ("x", None)],
        "text string, lang string")
    least = langid.bounds(filters, labelled)
    assert least["aa"] == pytest.approx(0.5, abs=0.02) and 0.1 < least["bb"] < 0.4 and least["cc"] == 0
    texts = [("abcd " * 50, True), (half, True), ("abcd " + "q" * 60, False), ("12", False), (None, False), ("", False)]
    told = langid.predict(spark.createDataFrame(texts, "text string, stays boolean"), filters)
    assert sorted(map(str, langid.known(told, least).collect())) == sorted(
        str(r) for r in told.collect() if r["stays"])


def test_verdicts_do_not_jump_with_the_size_of_a_group(spark):
    """One text more moves a bin's weight by one text: fences of 199, 200 and 201 are near."""
    def fences(size):
        rows = [("en", "large", n, 100 + k) for n in quality.RATES for k in range(50) for _ in range(20)]
        rows += [("en", "small", n, 300 + k % 40) for n in quality.RATES for k in range(size)]
        bins = spark.createDataFrame(rows, "lang string, source string, rate string, bin int").groupBy(
            "lang", "source", "rate", "bin").agg(F.count(F.lit(1)).alias("texts"))
        found = quality.thresholds(bins).where("source = 'small'").collect()
        assert len(found) == 1
        return found[0]

    values = {size: fences(size)["word_length_high"] for size in (1, 198, 199, 200, 201, 20_000)}
    near = [values[s] for s in (198, 199, 200, 201)]
    assert max(near) <= 1.1 * min(near)
    assert values[1] < min(near) or values[1] > max(near)
    assert quality.thresholds(spark.createDataFrame(
        [], "lang string, source string, rate string, bin int, texts long")).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_against_plain_versions(spark, docs):
    """Each stage on what the one before kept, row for row."""
    stages = dict(pipeline.STAGES)
    run = lambda name, rows: materialise(stages[name](spark, rows, FOLDER), name)
    db = duckdb.connect()

    def ids(rows):
        return sorted(r["doc_id"] for r in rows.collect())

    db.register("documents", docs.toArrow())
    good = run("quality", docs)
    assert ids(good) == sorted(r[0] for r in db.execute(
        f"SELECT doc_id FROM ({quality.SQL['op8_quality']}) WHERE kept").fetchall())

    known = run("language", good)
    apart = (F.pmod(F.xxhash64("text"), F.lit(langid.FOLDS)) == 0).alias("apart")
    rows = good.select("doc_id", "text", "lang", apart).collect()
    held = learned((r["text"], r["lang"]) for r in rows if not r["apart"])
    plain = {r["doc_id"]: shares(held, r["text"]) for r in rows}
    told = {k: max(v, key=v.get) for k, v in plain.items()}
    scores = defaultdict(list)
    for r in rows:
        if r["apart"] and r["lang"] == told[r["doc_id"]]:
            scores[r["lang"]].append(plain[r["doc_id"]][r["lang"]])
    low = {k: 0.5 * sorted(v)[max(0, -(-len(v) // 100) - 1)] for k, v in scores.items()}
    kept = set(ids(known))
    for r in rows:
        margin = plain[r["doc_id"]][told[r["doc_id"]]] - low.get(told[r["doc_id"]], 0.0)
        assert abs(margin) < 0.05 or (r["doc_id"] in kept) == (margin > 0)

    distinct = run("near_duplicates", known)
    sets = {r["doc_id"]: shingles(r["text"]) for r in known.collect()}
    holders, up = defaultdict(list), {k: k for k in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, found in sets.items():
        for x in found:
            holders[x].append(k)
    shared = Counter((a, b) for h in holders.values() for i, a in enumerate(sorted(h)) for b in sorted(h)[i + 1:])
    for (a, b), n in shared.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    assert ids(distinct) == sorted(k for k in up if top(k) == k)

    mixed = run("mixing", distinct)
    db.unregister("documents")
    db.register("documents", distinct.toArrow())
    taken = {r[0]: (r[1], r[2]) for r in db.execute(
        f"SELECT doc_id, size, taken FROM ({mixing.SQL['op1_mixing']})").fetchall()}
    copies = Counter(ids(mixed))
    assert {k: copies[k] * size for k, (size, _) in taken.items()} == {k: n for k, (_, n) in taken.items()}

    packed = run("packing", mixed).collect()
    library = Encoder(default_path())
    texts = {r["doc_id"]: r["text"] for r in distinct.collect()}
    tokens = {k: len(library._whole([texts[k] or ""])[0]) + 1 for k in copies}
    assert sum(r["length"] for r in packed) == sum(tokens[k] * n for k, n in copies.items())
    ends = defaultdict(list)
    for r in packed:
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in ends.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
