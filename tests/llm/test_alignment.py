"""Alignment of two tokenizers against a plain version."""

import hashlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pagewell.llm import alignment

FOLDER = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(texts):
    """Result rows of the texts in order, by dictionaries and loops."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    named = {**{chr(c): c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}}
    rest = [c for c in range(256) if c not in named.values()]
    named.update({chr(256 + n): c for n, c in enumerate(rest)})
    found, counts = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        bytes_a = [bytes(named[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append(([], [], []))
            continue
        ends = []
        for parts in (bytes_a, bytes_b):
            at, out = 0, {}
            for n, part in enumerate(parts):
                at += len(part)
                out[at] = n
            ends.append(out)
        both = sorted(set(ends[0]) & set(ends[1]))
        links = [(ids_a[ends[0][e]], ids_b[ends[1][e]]) for e in both]
        counts.update(links)
        groups, i, j = [], 0, 0
        for e in both:
            groups.append((ids_a[i:ends[0][e] + 1], ids_b[j:ends[1][e] + 1]))
            i, j = ends[0][e] + 1, ends[1][e] + 1
        found.append((ids_a, ids_b, [links, groups]))
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    rows = []
    for ids_a, ids_b, told in found:
        links, groups = told or ([], [])
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((len(ids_a), len(ids_b), len(groups), len(links), sum(counts[p] == top[p[1]] for p in links),
                     sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = {r["doc_id"]: w for r, w in zip(rows, plain([r["text"] for r in rows]))}
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.op12_alignment(spark, FOLDER).collect()}
    assert got == want
    small = alignment.align(spark.read.parquet(f"{FOLDER}/documents.parquet"), A, B, block_bytes=1000)
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in small.collect()} == want


def test_odd_rows(odd_docs, no_docs):
    extra = ["a  b", " x", "x▁y", "tab\there", "<s> </s> <unk> <0x41>", "ａ full", "é combining", "\U0001F600" * 9,
             "\n\n", "<|endoftext|>", "12345 67", " "]
    docs = odd_docs.select("doc_id", "text", "n_words", "key", "ids").unionByName(
        odd_docs.sparkSession.createDataFrame(
            [(100 + n, t, "x", "x", "x") for n, t in enumerate(extra)],
            "doc_id long, text string, n_words string, key string, ids string"))
    rows = docs.collect()
    want = sorted(map(str, [(r["doc_id"], *w) for r, w in zip(rows, plain([r["text"] for r in rows]))]))
    got = alignment.align(docs, A, B).collect()
    assert sorted(str(tuple(r)) for r in got) == want
    assert alignment.align(no_docs, A, B).count() == 0


def test_blocks_do_not_change_links():
    import pyarrow as pa

    texts = ["The quick brown fox.", "", None, "jumps over ▁ it", "unbelievable  tokenization 2024", "ça va"]
    whole = alignment.Block(A, B, pa.array(texts, pa.string()))
    singly = [alignment.Block(A, B, pa.array([t], pa.string())) for t in texts]
    assert whole.digests == [d for s in singly for d in s.digests]
    assert whole.n_links.tolist() == [int(s.n_links[0]) for s in singly]
    pairs = Counter()
    for s in singly:
        pairs.update(dict(zip(s.codes.to_pylist(), s.counts.to_pylist())))
    assert dict(zip(whole.codes.to_pylist(), whole.counts.to_pylist())) == pairs


def test_spans(spark):
    rows = spark.createDataFrame([(1, "Hello world, again"), (2, None), (3, "x▁y")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in alignment.group_spans(rows, A, B).collect()}
    assert found[2]["ends"] == found[3]["ends"] == []
    assert found[1]["ends"][-1] == len(" Hello world, again")
    a = Tokenizer.from_file(A).encode(" Hello world, again").ids
    assert found[1]["a_until"][-1] == len(a) and len(found[1]["a_until"]) == len(found[1]["b_until"])


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_remembered_parts_are_bounded_for_both_sides(name):
    side = alignment._Side(public_tokenizers.path(name), name.endswith(".model"))
    side.encoder._forget()
    for block in range(3):
        text = " ".join(f"w{n}" for n in range(100_000 * block, 100_000 * (block + 1)))
        ids = side.lists(pa.array([text]))[0].as_py()
        assert ids == list(side.encoder._whole([text])[0])
    assert len(side.encoder.parts) < 250_000
