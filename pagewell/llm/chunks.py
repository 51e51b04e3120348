"""Encoding and decoding with a byte-level BPE, chunks that texts share encoded once.

Texts are cut where a rolling hash of the last bytes says so, so equal passages are cut
alike wherever they stand. Chunks that occur more than once in the corpus are encoded
once and their ids joined to all texts that hold them; what lies between such chunks is
encoded where it is. Then the joins are repaired: the ids around each are those of the
text between the nearest places, on both sides, at which the pieces and the whole text
must agree on where a token ends, which are looked for as far as it takes.

A token ends before each blank or line end that follows a printed ASCII character, in
whatever text these two stand, as only the first character of a piece may be a blank.

Which chunks occur more than once is told to the tasks by a Bloom filter of bounded size.
A chunk that it takes for a shared one is only moved once more than needed.
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

from pagewell.llm.alignment import _data, byte_level_bytes
from pagewell.llm.shared import materialise, table
from pagewell.llm.tokens import default_path, encoder

#: Bytes that a cut depends on; mean and least bytes of a chunk.
WINDOW, MEAN_BYTES, LEAST_BYTES = 32, 1024, 128
#: Bytes that are hashed together; bytes of ids of texts that are put together at once.
STRETCH, HELD_BYTES = 1 << 20, 1 << 20
#: The filter: bits per shared chunk, and its least and greatest size in bits.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 26
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
    size = STRETCH + WINDOW
    return tuple(np.r_[np.uint64(1), np.cumprod(np.full(size - 1, f, np.uint64))] for f in (_FACTOR, inverse))


def cuts(data: bytes | memoryview, whole: tuple[bytes, ...] = ()) -> list[int]:
    """Where the chunks of a UTF-8 text end. Characters, and the strings in `whole`, stay whole."""
    size = len(data)
    if size < 2 * LEAST_BYTES:
        return [size] if size else []
    array = np.frombuffer(data, np.uint8)
    powers, inverses = _powers()
    found = []
    for begin in range(0, size, STRETCH):
        first = max(0, begin - WINDOW)
        part = array[first:begin + STRETCH].astype(np.uint64)
        sums = np.r_[np.uint64(0), np.cumsum(part * inverses[:len(part)])]
        ends = np.arange(max(WINDOW, begin - first + 1), len(part) + 1)
        rolled = (sums[ends] - sums[ends - WINDOW]) * powers[ends - 1] * _MIX
        found.append(first + ends[rolled >> np.uint64(32) < np.uint64((1 << 32) // MEAN_BYTES)])
    places = np.concatenate(found)
    places = places[places < size]
    places = places[array[places] & 0xC0 != 0x80]
    text = bytes(data) if whole else b""
    spans = []
    for token in whole:
        at = text.find(token)
        while at >= 0:
            spans.append((at, at + len(token)))
            at = text.find(token, at + 1)
    out, last = [], 0
    for place in places.tolist():
        if place - last >= LEAST_BYTES and size - place >= LEAST_BYTES and not any(a < place < b for a, b in spans):
            out.append(place)
            last = place
    return [*out, size]


def digest(chunk) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


class Tokenizer:
    """An encoder with the bytes of each id."""

    def __init__(self, path: str):
        self.encoder = encoder(path)
        self.bytes = pa.array([byte_level_bytes(v) for v in self.encoder.vocabulary], pa.binary())
        self.widths = pc.binary_length(self.bytes).to_numpy().astype(np.int64)
        self.whole = tuple(a.encode() for a in self.encoder.added)
        self.kind = np.dtype("<u2" if len(self.widths) <= 1 << 16 else "<u4")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for ids, sizes in self.encoder.encode(texts):
            out += np.split(ids, np.cumsum(sizes)[:-1])
        return out

    def spelled(self, ids: np.ndarray) -> memoryview:
        return _data(self.bytes.take(pa.array(ids)))

    def decoded(self, ids: np.ndarray) -> bytes:
        """The text in UTF-8; what is none is replaced, as the tokenizer's decoder does."""
        data = bytes(self.spelled(ids))
        try:
            data.decode()
        except UnicodeDecodeError:
            data = data.decode(errors="replace").encode()
        return data

    def _broken(self, pieces: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[int, int, str]]]:
        """The ids of a text's pieces one after another, and what of them must be encoded anew:
        from which id, up to which id, and the text that they stand for."""
        pieces = [p for p in pieces if len(p)]
        if len(pieces) < 2:
            return (pieces[0].astype(np.uint32) if pieces else np.zeros(0, np.uint32)), []
        ids = np.concatenate(pieces).astype(np.uint32)
        starts = np.r_[0, np.cumsum(self.widths[ids])]
        joins = starts[np.cumsum([len(p) for p in pieces])[:-1]]
        data = self.spelled(ids)
        array = np.frombuffer(data, np.uint8)
        before, after = array[:-1], array[1:]
        agreed = np.flatnonzero((before > 0x20) & (before < 0x7F) & ((after == 0x20) | (after == 0x0A))) + 1
        bounds = np.r_[0, agreed, len(array)]
        at = np.searchsorted(bounds, joins)
        broken = bounds[at] != joins
        windows = np.unique(np.stack([bounds[at[broken] - 1], bounds[at[broken]]]), axis=1)
        begins, ends = np.searchsorted(starts, windows)
        return ids, [(a, b, bytes(data[m:n]).decode()) for a, b, m, n in zip(
            begins.tolist(), ends.tolist(), *windows.tolist())]

    def joined(self, texts: list[list[np.ndarray]]) -> list[np.ndarray]:
        """The ids of each text, given those of its pieces by themselves."""
        told = [self._broken(pieces) for pieces in texts]
        anew = iter(self.encode([text for _, windows in told for *_, text in windows]))
        out = []
        for ids, windows in told:
            parts, last = [], 0
            for a, b, _ in windows:
                parts += [ids[last:a], next(anew)]
                last = b
            out.append(np.concatenate([*parts, ids[last:]]) if parts else ids)
        return out


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def can_be_cut(path: str) -> bool:
    """Whether texts may be encoded in pieces; else each text is one piece."""
    one = encoder(path)
    added = getattr(one.library, "get_added_tokens_decoder", dict)().values()
    return one.by_parts and path.endswith(".json") and not any(
        a.lstrip or a.rstrip or a.single_word or any(c.isspace() for c in a.content) for a in added)


def _texts(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


def _digests(path: str):
    def run(batches):
        whole = _tokenizer(path).whole
        for batch in batches:
            for begin in range(0, len(batch), 256):
                found = []
                for text in _texts(batch.column(0).slice(begin, 256)):
                    ends = cuts(text, whole)
                    found += [digest(text[a:b]) for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["digest"])
    return run


class Filter:
    """A Bloom filter of digests with two bits each."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, digests: list[bytes]) -> np.ndarray:
        if not len(self.words) or not digests:
            return np.zeros(len(digests), bool)
        halves = np.frombuffer(b"".join(digests), "<u4").reshape(-1, 4)[:, :2].astype(np.int64)
        bits = halves & (64 * len(self.words) - 1)
        return (self.words[bits >> 6] >> (bits & 63) & 1).all(axis=1)


def shared_chunks(digests: DataFrame) -> Filter:
    """The filter of the digests that occur more than once. It has at most MOST_BITS."""
    repeated = digests.groupBy("digest").count().where("count > 1").select("digest")
    repeated = materialise(repeated, "shared-chunks")
    n = repeated.count()
    if not n:
        return Filter(np.zeros(0, np.int64))
    bits = min(max(1 << (BITS_EACH * n - 1).bit_length(), LEAST_BITS), MOST_BITS)

    numbers = repeated.select(F.explode(F.array(*(
        F.conv(F.concat(*(F.substring(F.hex("digest"), at + k, 2) for k in (6, 4, 2, 0))), 16, 10).cast("long")
        for at in (1, 9)))).alias("_n")).select(F.col("_n").bitwiseAND(F.lit(bits - 1)).alias("_n"))
    words = numbers.groupBy(F.shiftright("_n", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_n & 63 as int))")).alias("bits")).toArrow()  # MOST_BITS / 64 rows at most
    array = np.zeros(bits >> 6, np.int64)
    array[words["word"].to_numpy()] = words["bits"].to_numpy()
    return Filter(array)


DIGESTS = (("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string()))
IDS = (("ids", "array<int>", pa.list_(pa.int32())),)


def _finished(tokenizer: Tokenizer, ids: np.ndarray, whole_ids: bool) -> tuple:
    if whole_ids:
        return (ids.astype(np.int32),)
    return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            hashlib.sha256(tokenizer.decoded(ids)).hexdigest())


def _pieces(path: str, known, key_type, whole_ids: bool, cut: bool):
    """Rows of finished texts, and for the others a row per piece."""
    result = IDS if whole_ids else DIGESTS

    def run(batches):
        tokenizer, told = _tokenizer(path), known.value
        row = TaskContext.get().partitionId() << 40
        given: set[bytes] = set()
        for batch in batches:
            for begin in range(0, len(batch), 256):
                texts = _texts(batch.column(1).slice(begin, 256))
                spans, digests = [], []
                for text in texts:
                    ends = cuts(text, tokenizer.whole) if cut else [len(text)]
                    spans.append(list(zip([0, *ends], ends)))
                    digests += [digest(text[a:b]) for a, b in spans[-1]]
                held = iter(told.holds(digests).tolist())
                names = iter(digests)
                plan, private = [], []
                for text, chunks in zip(texts, spans):
                    pieces = []
                    for a, b in chunks:
                        name = next(names)
                        if next(held):
                            pieces.append((name, text[a:b]))
                        elif pieces and pieces[-1][0] is None:
                            pieces[-1] = (None, pieces[-1][1] + text[a:b])
                        else:
                            pieces.append((None, text[a:b]))
                    plan.append(pieces)
                    private += [p.decode() for name, p in pieces if name is None]
                encoded = iter(tokenizer.encode(private))
                origin, out = [], []
                for n, pieces in enumerate(plan):
                    row += 1
                    if all(name is None for name, _ in pieces):
                        ids = next(encoded) if pieces else np.zeros(0, np.uint32)
                        origin.append(n)
                        out.append((row, None, None, None, None, *_finished(tokenizer, ids, whole_ids)))
                        continue
                    for place, (name, text) in enumerate(pieces):
                        ids = next(encoded).astype(tokenizer.kind).tobytes() if name is None else None
                        new = name is not None and name not in given
                        if new:
                            given.add(name)
                        origin.append(n)
                        out.append((row, place, name, ids, text.decode() if new else None, *[None] * len(result)))
                if len(given) > 1 << 20:  # texts of these are given once more
                    given.clear()
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string(), *(k for *_, k in result)]
                    columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(begin, 256).take(pa.array(origin, pa.int64())), *columns],
                        names=["key", "row", "place", "digest", "ids_bytes", "text", *(c for c, *_ in result)])
    return run


def _encode_chunks(path: str):
    def run(batches):
        tokenizer = _tokenizer(path)
        for batch in batches:
            ids = tokenizer.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([i.astype(tokenizer.kind).tobytes() for i in ids], pa.binary())],
                names=["digest", "ids_bytes"])
    return run


def _assemble(path: str, key_type, whole_ids: bool):
    """Pieces of texts, in order, become finished texts."""
    result = IDS if whole_ids else DIGESTS

    def run(batches):
        tokenizer = _tokenizer(path)
        row, waiting, size = None, [], 0  # texts as (key, pieces); the last one may go on

        def rows(texts):
            done = [_finished(tokenizer, ids, whole_ids) for ids in tokenizer.joined([p for _, p in texts])]
            columns = [pa.array([k for k, _ in texts], key_type)]
            columns += [pa.array(c, k) for c, (*_, k) in zip(zip(*done), result)]
            return pa.RecordBatch.from_arrays(columns, names=["key", *(c for c, *_ in result)])

        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                for key, number, ids in zip(*(part.column(k).to_pylist() for k in (0, 1, 3))):
                    if number != row:
                        if size >= HELD_BYTES:
                            yield rows(waiting)
                            waiting, size = [], 0
                        row = number
                        waiting.append((key, []))
                    waiting[-1][1].append(np.frombuffer(ids, tokenizer.kind))
                    size += len(ids)
        if waiting:
            yield rows(waiting)
    return run


def encode(docs: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text",
           whole_ids: bool = True) -> DataFrame:
    """One row per row of `docs`: `key, ids`, or without `whole_ids` the key with
    `n_tokens, ids_sha256, decoded_sha256` of the ids as little-endian unsigned 32-bit
    integers and of the decoded text in UTF-8.

    Ids are those of the tokenizer's library for the whole text, without begin, end or added
    special tokens; strings of special tokens in a text become these tokens. A null text is
    empty and has no ids. Repeated rows and null keys are rows like others. A text, however
    long, is put together in one task. An empty table gives no rows, other columns are not
    carried. With a tokenizer that pieces of a text do not tell the ids of, each text is
    one piece.
    """
    spark = docs.sparkSession
    path = tokenizer or default_path()
    kind = docs.schema[key].dataType
    cut = can_be_cut(path)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    result = IDS if whole_ids else DIGESTS
    names = [c for c, *_ in result]
    told = ", ".join(f"{c} {t}" for c, t, _ in result)
    known = shared_chunks(rows.select("text").mapInArrow(_digests(path), "digest binary")) if cut else Filter(np.zeros(0, np.int64))
    arrow = to_arrow_type(kind)
    pieces = materialise(rows.mapInArrow(
        _pieces(path, spark.sparkContext.broadcast(known), arrow, whole_ids, cut),
        f"key {kind.simpleString()}, row long, place long, digest binary, ids_bytes binary, text string, {told}"), "pieces")
    chunks = pieces.where(F.col("text").isNotNull()).groupBy("digest").agg(F.first("text").alias("text"))
    # A table of its own, so that a chunk that many texts hold is split in the join.
    encoded = materialise(chunks.mapInArrow(_encode_chunks(path), "digest binary, ids_bytes binary"), "encoded-chunks")
    places = pieces.where(F.col("place").isNotNull())
    common = places.where(F.col("digest").isNotNull()).select("key", "row", "place", "digest").join(encoded, "digest")
    own = places.where(F.col("digest").isNull())
    parts = common.select("key", "row", "place", "ids_bytes").unionByName(own.select("key", "row", "place", "ids_bytes"))
    joined = parts.repartition("row").sortWithinPartitions("row", "place").mapInArrow(
        _assemble(path, arrow, whole_ids), f"key {kind.simpleString()}, {told}")
    finished = pieces.where(F.col("place").isNull()).select("key", *names)
    return finished.unionByName(joined).withColumnRenamed("key", key)


def _decode(path: str):
    def run(batches):
        tokenizer = _tokenizer(path)
        for batch in batches:
            texts = [tokenizer.decoded(np.asarray(i or [], np.uint32)).decode() for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "text"])
    return run


def decode(rows: DataFrame, tokenizer: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`key, text` of rows of ids, special tokens spelled out; null ids give an empty text."""
    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(
        _decode(tokenizer or default_path()), f"key {kind}, text string").withColumnRenamed("key", key)


def op13_bpe(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), whole_ids=False)


QUERIES = {"op13_bpe": op13_bpe}
