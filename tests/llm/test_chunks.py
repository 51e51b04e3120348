"""Encoding by shared chunks against the tokenizer's library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pagewell.llm import chunks
from pagewell.llm.tokens import default_path

FOLDER = "/root/testdata/sf0.001"
PATH = default_path()
SIGNS = [" ", "  ", "\n", "\n\n", ".", ", ", "'s", "'ll", "ab", "word", "1", "23", "_", "\t", "\r\n", "\xa0", "é", "日本",
         "<|endoftext|>", "\x00", "!", "\U0001F642", "'", " the", " of"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def sign_soup(seed, length):
    made = random.Random(seed)
    return "".join(made.choice(SIGNS) for _ in range(length))


def test_joined_pieces_are_the_whole(library):
    """Cut anywhere between characters, outside of special tokens, a text keeps its ids."""
    tokenizer, made = chunks.Tokenizer(PATH), random.Random(4)
    for n in range(400):
        text = sign_soup(n, made.randint(1, 60))
        places = sorted(made.randrange(len(text) + 1) for _ in range(made.randint(0, 8)))
        inside = [k for k in range(len(text)) if text.startswith("<|endoftext|>", k)]
        places = [p for p in places if not any(k < p < k + 13 for k in inside)]
        pieces = [text[a:b] for a, b in zip([0, *places], [*places, len(text)])]
        got, = tokenizer.joined([tokenizer.encode(pieces)])
        assert got.tolist() == library.encode(text, add_special_tokens=False).ids, (text, pieces)
        assert tokenizer.decoded(got).decode() == library.decode(got.tolist(), skip_special_tokens=False) == text


def test_cuts_follow_the_content():
    tail, whole = sign_soup(1, 9000), (b"<|endoftext|>",)
    sets = []
    for head in ("", "x", "another beginning, " * 40):
        data = (head + tail).encode()
        ends = chunks.cuts(data, whole)
        assert ends[-1] == len(data) and ends == sorted(set(ends))
        for end in ends[:-1]:
            assert data[end] & 0xC0 != 0x80
        sets.append({chunks.digest(data[a:b]) for a, b in zip([0, *ends], ends)})
    assert len(sets[0]) > 5 and all(len(sets[0] & other) >= len(sets[0]) - 3 for other in sets[1:])
    assert chunks.cuts(b"") == [] and chunks.cuts(b"short") == [5]
    assert len(chunks.cuts(b"a" * 5000)) <= 5000 // chunks.LEAST_BYTES


def test_cuts_across_stretches(monkeypatch):
    data = sign_soup(2, 30_000).encode()
    once = chunks.cuts(data)
    monkeypatch.setattr(chunks, "STRETCH", 5000)
    chunks._powers.cache_clear()
    assert chunks.cuts(data) == once
    chunks._powers.cache_clear()


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    told = library.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(told.encode()).hexdigest())


COLUMNS = ("n_tokens", "ids_sha256", "decoded_sha256")


def test_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in chunks.op13_bpe(spark, FOLDER).collect()}
    assert got == {k: want(library, t) for k, t in texts.items()}


def test_shared_passages(spark, library):
    """Passages in many texts, whole copies, special tokens; all ids as those of whole texts."""
    passages = [sign_soup(100 + n, 3000) for n in range(3)]
    texts = [f"{sign_soup(n, n % 50)}{passages[n % 3]}{sign_soup(1000 + n, 40)}" for n in range(24)]
    texts += [passages[0] * 2, passages[0] * 2, passages[1] + passages[2]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in chunks.encode(docs, whole_ids=False).collect()}
    assert got == {k: want(library, t) for k, t in enumerate(texts)}
    shared = chunks.shared_chunks(docs.select("text").mapInArrow(chunks._digests(PATH), "digest binary"))
    data = passages[1].encode()
    ends = chunks.cuts(data, (b"<|endoftext|>",))
    inner = [chunks.digest(data[a:b]) for a, b in zip(ends, ends[1:-1])]
    assert len(inner) > 3 and shared.holds(inner).all()  # so these were encoded once
    ids = chunks.encode(docs)
    back = {r["doc_id"]: r["text"] for r in chunks.decode(ids).collect()}
    assert back == dict(enumerate(texts))


def test_filter(spark):
    made = random.Random(6)
    names = [made.randbytes(16) for _ in range(3000)]
    twice = spark.createDataFrame([(n,) for n in names[:1000] * 2 + names[1000:]], "digest binary")
    found = chunks.shared_chunks(twice)
    assert found.holds(names[:1000]).all() and found.holds(names[1000:]).mean() < 0.05
    assert not chunks.shared_chunks(twice.limit(0)).holds(names).any()


def test_odd_rows(odd_docs, no_docs, library):
    rows = odd_docs.collect()
    got = chunks.encode(odd_docs, whole_ids=False).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str((r["doc_id"], *want(library, r["text"]))) for r in rows)
    assert chunks.encode(no_docs).count() == 0
    other = public_tokenizers.path("word_bpe_49k.json")
    assert not chunks.can_be_cut(other) and chunks.can_be_cut(PATH)
    back = chunks.decode(chunks.encode(odd_docs).unionByName(odd_docs.selectExpr("99L as doc_id", "cast(null as array<int>) as ids").limit(1)))
    assert sorted(str(tuple(r)) for r in back.collect()) == sorted(
        str((r["doc_id"], r["text"] or "")) for r in [*rows, {"doc_id": 99, "text": ""}])
