"""Alignment of two tokenizers over the same texts.

The tokens of a text by tokenizer A and by tokenizer B each cover its bytes once. Where a
token of both ends at the same byte, the two are linked, and these ends cut the text into
groups of tokens that stand for the same bytes. Links are counted over all texts.

A task works on blocks of texts as Arrow columns: lists of ids are flattened with the
index of their text, ends are cumulative sums within each text, an Acero hash join on text
and end finds the links, and `Table.group_by` counts the pairs of a block. A block keeps
its distinct pairs once, its texts point to them. Spark adds the counts up, joins the
totals to the pairs of each block and gives both back to the block's texts. So what is
shuffled are pairs per block, not per text, and no table of all pairs is held anywhere.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagewell.llm.shared import materialise, table
from pagewell.llm.tokens import Encoder, encoder

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: Parts of texts that each of the two encoders of a worker remembers.
KNOWN_PARTS = 150_000
SPACE_MARK = "▁"


def byte_level_bytes(entry: str) -> bytes:
    """What a byte-level vocabulary's entry stands for: bytes that print are their own
    characters, the others are numbered from 256."""
    return bytes(_bytes_by_char()[c] for c in entry)


@lru_cache(maxsize=1)
def _bytes_by_char() -> dict[str, int]:
    # The bytes that stand for themselves.
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printed)]
    return {chr(b): b for b in printed} | {chr(256 + n): b for n, b in enumerate(others)}


def piece_bytes(model, number: int) -> bytes:
    piece = model.id_to_piece(number)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace(SPACE_MARK, " ").encode()


class _Side:
    """A tokenizer's ids of texts, and the bytes of each id."""

    def __init__(self, path: str, pieces: bool):
        if pieces:
            self.encoder = Encoder(path, known_parts=KNOWN_PARTS)
            known = [piece_bytes(self.encoder.library, i) for i in range(len(self.encoder.vocabulary))]
        else:
            self.encoder = encoder(path, True, KNOWN_PARTS)
            known = [byte_level_bytes(v) for v in self.encoder.vocabulary]
        self.bytes = pa.array(known, pa.binary())
        self.widths = pc.binary_length(self.bytes).to_numpy().astype(np.int64)

    def lists(self, texts: pa.Array) -> pa.LargeListArray:
        ids, sizes = zip(*self.encoder.encode(texts))
        return pa.LargeListArray.from_arrays(
            np.r_[0, np.cumsum(np.concatenate(sizes))], pa.array(np.concatenate(ids), pa.uint32()))

    def same_bytes(self, lists: pa.LargeListArray, texts: list[memoryview]) -> np.ndarray:
        """By text: whether the bytes of its ids are those of the text."""
        ids = lists.flatten()
        ends = np.r_[0, np.cumsum(self.widths[ids.to_numpy()])][lists.offsets.to_numpy()]
        joined = _data(self.bytes.take(ids))
        return np.fromiter((joined[a:b] == t for a, b, t in zip(ends[:-1], ends[1:], texts)), bool, len(texts))


def _data(column: pa.Array) -> memoryview:
    """The bytes of a binary column one after another."""
    large = column.cast(pa.large_binary())
    offsets = np.frombuffer(large.buffers()[1], np.int64)[large.offset:large.offset + len(large) + 1]
    data = large.buffers()[2]
    return memoryview(data)[offsets[0]:offsets[-1]] if data is not None else memoryview(b"")


@lru_cache(maxsize=2)
def _sides(path_a: str, path_b: str) -> tuple[_Side, _Side, pa.Array]:
    """Both tokenizers, and each id as text followed by what may follow it in a list of groups."""
    a, b = _Side(path_a, False), _Side(path_b, True)
    size = max(len(a.widths), len(b.widths))
    return a, b, pa.array([f"{n}{end}".encode() for end in ",|;" for n in range(size)], pa.binary())


def _tokens(lists: pa.LargeListArray, widths: np.ndarray, name: str) -> pa.Table:
    """A row per token: its text, the byte of the text where it ends, and its place."""
    ids, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    ends = pc.cumulative_sum(pa.array(widths[ids.to_numpy()]))
    before = np.r_[0, ends.to_numpy()][lists.offsets.to_numpy()[:-1]]
    ends = pc.subtract(ends, pa.array(before).take(parents))
    return pa.table({"text": parents, "end": ends, name: ids, f"{name}_place": pa.array(np.arange(len(ids)))})


def _emptied(lists: pa.LargeListArray, kept: np.ndarray) -> pa.LargeListArray:
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().filter(pa.array(np.repeat(kept, sizes)))
    return pa.LargeListArray.from_arrays(np.r_[0, np.cumsum(np.where(kept, sizes, 0))], values)


class Block:
    """The alignment of some texts."""

    def __init__(self, path_a: str, path_b: str, texts: pa.Array):
        a, b, written = _sides(path_a, path_b)
        texts = pc.fill_null(texts, "")
        spaced = pc.binary_join_element_wise("", texts, " ")
        ends = np.r_[0, np.cumsum(pc.binary_length(spaced).to_numpy(), dtype=np.int64)].tolist()
        data = _data(spaced)
        views = [data[m:n] for m, n in zip(ends[:-1], ends[1:])]
        lists_a, lists_b = a.lists(spaced), b.lists(texts)
        kept = (pc.binary_length(texts).to_numpy() > 0) & a.same_bytes(lists_a, views) & b.same_bytes(lists_b, views)
        lists_a, lists_b = _emptied(lists_a, kept), _emptied(lists_b, kept)
        tokens_a, tokens_b = _tokens(lists_a, a.widths, "a"), _tokens(lists_b, b.widths, "b")
        links = tokens_a.join(tokens_b, ["text", "end"], join_type="inner", use_threads=False)
        links = links.take(pc.sort_indices(links, [("a_place", "ascending"), ("b_place", "ascending")]))
        self.n_a, self.n_b = (np.diff(x.offsets.to_numpy()) for x in (lists_a, lists_b))
        self.ends = links["end"].to_numpy()
        self.n_links = np.bincount(links["text"].to_numpy(), minlength=len(texts))
        self.until_a, self.until_b = (links[c].to_numpy() + 1 for c in ("a_place", "b_place"))
        codes = links["a"].to_numpy().astype(np.int64) * len(b.widths) + links["b"].to_numpy()
        pairs = pa.table({"code": codes}).group_by("code", use_threads=False).aggregate([([], "count_all")])
        self.codes, self.counts = pairs["code"].combine_chunks(), pairs["count_all"].combine_chunks()
        self.places = pc.index_in(pa.array(codes), value_set=self.codes).to_numpy()
        self.digests = self._digests(lists_a.flatten().to_numpy(), lists_b.flatten().to_numpy(), written)

    def _digests(self, a: np.ndarray, b: np.ndarray, written: pa.Array) -> list[str]:
        """SHA-256 of each text's groups as text, without tokens an empty string."""
        size = len(written) // 3
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[self.until_a - 1] = 1
        last_b[self.until_b - 1] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        elements = np.empty(len(a) + len(b), np.int64)
        elements[np.arange(len(a)) + np.r_[0, self.until_b][group_a]] = a + size * last_a
        elements[np.arange(len(b)) + self.until_a[group_b]] = b + 2 * size * last_b
        widths = pc.binary_length(written).to_numpy()[elements]
        ends = np.r_[0, np.cumsum(widths, dtype=np.int64)][np.r_[0, np.cumsum(self.n_a + self.n_b)]]
        out, data, begin = [], memoryview(b""), 0
        step = 1 << 22  # elements that are spelled out together
        spelled = [_data(written.take(pa.array(elements[k:k + step]))) for k in range(0, len(elements), step)]
        data = memoryview(b"".join(spelled)) if len(spelled) > 1 else spelled[0] if spelled else data
        for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
            out.append(hashlib.sha256(data[begin:end - 1]).hexdigest() if end > begin else "")
        return out

    def lists(self, values: np.ndarray, kind) -> pa.ListArray:
        """Values of links as a list per text."""
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(self.n_links)], pa.int32()), pa.array(values, kind))

    def within(self, until: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Places of tokens counted from the beginning of their text."""
        return until - np.repeat(np.cumsum(sizes) - sizes, self.n_links)


def _blocks(keys: pa.Array, texts: pa.Array, block_bytes: int):
    """Rows in blocks of about so many bytes of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    begin = 0
    while begin < len(texts):
        before = int(sizes[begin - 1]) if begin else 0
        end = min(int(np.searchsorted(sizes, before + block_bytes)) + 1, len(texts))
        yield keys.slice(begin, end - begin), texts.slice(begin, end - begin)
        begin = end


def _align(path_a: str, path_b: str, key_type, block_bytes: int):
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for keys, texts in _blocks(batch.column(0), batch.column(1), block_bytes):
                one = Block(path_a, path_b, texts)
                more = len(texts) + 1  # a last row holds the block's pairs
                ints = [pa.array([*x.tolist(), None], pa.int64()) for x in (one.n_a, one.n_b, one.n_links)]
                links = one.lists(one.places, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(more, number)), pa.concat_arrays([keys, pa.nulls(1, key_type)]), *ints,
                    pa.array([*one.digests, None], pa.string()),
                    pa.concat_arrays([links, pa.nulls(1, links.type)]),
                    *(pa.array([None] * len(texts) + [x.to_pylist()], pa.list_(pa.int64()))
                      for x in (one.codes, one.counts))],
                    names=["block", "key", "n_a", "n_b", "n_links", "groups_sha256", "places", "codes", "counts"])
                number += 1
                del one
                pa.default_memory_pool().release_unused()  # Arrow keeps what blocks have freed
    return run


def _with_totals(texts: pa.Table, totals: pa.Table) -> pa.Table:
    """The texts of a block with the totals of its pairs."""
    size = totals.num_rows
    count, best = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
    place = totals["place"].to_numpy()
    count[place] = totals["count"].to_numpy()
    best[place] = totals["best"].to_numpy()
    lists = texts["places"].combine_chunks()
    ends = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())]
    links = lists.flatten().to_numpy()
    n_best, count_sum = (np.diff(np.r_[0, np.cumsum(x[links])][ends]) for x in (best, count))
    return pa.table([*(texts[c].combine_chunks() for c in ("key", "n_a", "n_b", "n_links")), texts["n_links"].combine_chunks(),
                     pa.array(n_best), pa.array(count_sum), texts["groups_sha256"].combine_chunks()],
                    names=["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def pair_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """`code, count, best` of all pairs: how many links hold it, and whether no pair of its
    B id is held by more."""
    totals = blocks.groupBy("code").agg(F.sum("n").alias("count"))
    totals = totals.select("code", "count", F.pmod("code", F.lit(size_b)).alias("b"))
    tops = totals.groupBy("b").agg(F.max("count").alias("top"))
    return totals.join(tops, "b").select("code", "count", (F.col("count") == F.col("top")).cast("int").alias("best"))


def align(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, key: str = "doc_id", text: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of `docs`: `key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`.

    tokenizer_a: a byte-level .json, which encodes the text after a space; tokenizer_b: a
    sentencepiece .model, which adds the space. A text that is null, empty or not spelled by
    the tokens of both has none: all numbers are 0 and the digest is an empty string.
    Repeated rows and null keys are rows like others and their links count. A very long text
    is a block of its own. An empty table gives no rows, other columns are not carried.
    """
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_b).get_piece_size()
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = (f"block long, key {kind.simpleString()}, n_a long, n_b long, n_links long, groups_sha256 string, "
              "places array<int>, codes array<long>, counts array<long>")
    aligned = materialise(rows.mapInArrow(
        _align(tokenizer_a, tokenizer_b, to_arrow_type(kind), block_bytes), schema), "aligned")
    pairs = aligned.where(F.col("codes").isNotNull()).select(
        F.col("block").alias("of_block"), F.posexplode(F.arrays_zip("codes", "counts")).alias("place", "pair")).select(
        "of_block", "place", F.col("pair")["codes"].alias("code"), F.col("pair")["counts"].alias("n"))
    # A table of its own, so that a pair that most blocks hold is split in the join.
    known = materialise(pair_counts(pairs, size_b), "pairs")
    totals = pairs.drop("n").join(known, "code").select("of_block", "place", "count", "best")
    texts = aligned.where(F.col("codes").isNull()).drop("codes", "counts")
    out = f"key {kind.simpleString()}, " + ", ".join(f"{c} long" for c in (
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")) + ", groups_sha256 string"
    joined = texts.groupBy("block").cogroup(totals.groupBy("of_block")).applyInArrow(_with_totals, out)
    return joined.withColumnRenamed("key", key)


def _spans(path_a: str, path_b: str):
    def run(batches):
        for batch in batches:
            for keys, texts in _blocks(batch.column(0), batch.column(1), BLOCK_BYTES):
                one = Block(path_a, path_b, texts)
                yield pa.RecordBatch.from_arrays([
                    keys, one.lists(one.ends, pa.int64()), one.lists(one.within(one.until_a, one.n_a), pa.int64()),
                    one.lists(one.within(one.until_b, one.n_b), pa.int64())], names=["key", "ends", "a_until", "b_until"])
    return run


def group_spans(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, ends, a_until, b_until`: of each group the byte of the space and text where it
    ends, and how many tokens of A and of B stand before that."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(_spans(tokenizer_a, tokenizer_b),
                           f"key {kind}, ends array<long>, a_until array<long>, b_until array<long>").withColumnRenamed("key", key)


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op12_alignment": op12_alignment}
