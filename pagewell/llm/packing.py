"""Packing documents, in order, into sequences of bounded length.

The documents of a range of ids are one stream of tokens, cut into windows of at most
`SIZE`. A cut costs nothing at the end of a document and little at the end of a sentence;
elsewhere it costs more and is allowed only between two such places that are more than a
window apart. A window costs its padding. The cheapest cuts are found by dynamic
programming over the places where a cut is allowed. A window that ends at j and begins at
i costs `cost(i) + i - j + SIZE`, so the best i is the least `cost(i) + i` among those not
too far back: a sliding minimum, held in a monotone queue, constant time per place.

A stream is solved as it comes. What all places agree on from which a later window may
begin is final and given out; the rest is solved anew with what follows, so the cuts are
those of the whole stream, however much of it is held.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm.shared import give_back, table
from pagewell.llm.tokens import default_path, encoder

SIZE, END_ID = 2048, 1
#: What a cut costs, in tokens of padding: after a sentence, and at any other place.
SENTENCE_CUT, INNER_CUT = 4, 24
#: Parts of texts whose ids a worker remembers.
KNOWN_PARTS = 200_000
#: Tokens that are read before the stream is solved; cuts do not depend on it.
STRETCH = 1 << 18
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")
DIGESTS = PIECES.replace("ids binary", "ids_crc32 long")


def cuts(places: np.ndarray, penalties: np.ndarray, size: int, whole: bool) -> list[int]:
    """The cheapest cuts of a stream from 0, given the ascending places and their costs.

    The first place is 0 and steps are at most `size`. `whole`: the stream ends with the
    last place, which is cut; else the cuts are those that hold whatever follows.
    """
    pos, pen = places.tolist(), penalties.tolist()
    value = [0] * len(pos)  # cost + place
    back = [0] * len(pos)
    queue = deque([0])
    first = 0
    for j, (at, price) in enumerate(zip(pos, pen)):
        if not j:
            continue
        while at - pos[first] > size:
            queue.popleft()
            first = queue[0]
        back[j] = first
        v = value[j] = value[first] + size + price
        while queue and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
        first = queue[0]
    # Later windows begin at places of the queue; where their ways back meet is final.
    ways = [len(pos) - 1] if whole else [j for j in queue if pos[-1] - pos[j] < size]
    while len(ways) > 1:
        last = back[ways.pop()]
        k = bisect_left(ways, last)
        if k == len(ways) or ways[k] != last:
            ways.insert(k, last)
    end = ways[0]
    out = []
    while end:
        out.append(pos[end])
        end = back[end]
    return out[::-1]


def places_of(edges: np.ndarray, sentences: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream may be cut, ascending from 0, and what each cut costs.

    edges: 0 and the ends of documents; sentences: ends of sentences, both ascending.
    """
    cost = np.full(int(edges[-1]) + 1, -1, np.int64)
    cost[sentences] = SENTENCE_CUT
    cost[edges] = 0
    bounds = np.flatnonzero(cost >= 0)
    for k in np.flatnonzero(np.diff(bounds) > size):
        cost[bounds[k] + 1:bounds[k + 1]] = INNER_CUT
    places = np.flatnonzero(cost >= 0)
    return places, cost[places]


def _stretch(documents: list[tuple], ends_sentence: np.ndarray, size: int, whole: bool):
    """Windows of the stretch, each a list of (document, from, to), and what is left."""
    sizes = np.array([len(d[2]) for d in documents])
    edges = np.r_[0, np.cumsum(sizes)]
    ends = ends_sentence[np.concatenate([d[2] for d in documents])]
    ends[:-1] &= ~ends[1:]  # a stop and the line end after it end one sentence
    places, cost = places_of(edges, np.flatnonzero(ends) + 1, size)
    windows, begin = [], 0
    for end in cuts(places, cost, size, whole):
        first = int(np.searchsorted(edges, begin, "right")) - 1
        pieces = []
        while first < len(documents) and edges[first] < end:
            a, b = max(begin, int(edges[first])), min(end, int(edges[first + 1]))
            if b > a:
                pieces.append((first, a - int(edges[first]), b - int(edges[first])))
            first += 1
        windows.append(pieces)
        begin = end
    left = []
    for k in range(len(documents)):
        if edges[k + 1] > begin:
            key, start, ids, whole_size = documents[k]
            skip = max(0, begin - int(edges[k]))
            left.append((key, start + skip, ids[skip:], whole_size))
    return windows, left


def _pack(path: str, size: int, end_id: int | None, whole_ids: bool):
    kinds = [pa.int64()] * 3 + [pa.binary() if whole_ids else pa.int64()] + [pa.int64()] * 3
    names = [c.split()[0] for c in (PIECES if whole_ids else DIGESTS).split(", ")]

    def run(batches):
        tokenizer = encoder(path, known_parts=KNOWN_PARTS)
        ends_sentence = tokenizer.sentence_ends()
        sequence = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []
        tokens, enough = 0, STRETCH

        def solve(whole):
            nonlocal waiting, tokens, sequence, enough
            windows, left = _stretch(waiting, ends_sentence, size, whole)
            rows = []
            for pieces in windows:
                offset = 0
                for k, a, b in pieces:
                    key, start, ids, whole_size = waiting[k]
                    piece = ids[a:b].astype("<u4").tobytes()
                    rows.append((key, start + a, b - a, piece if whole_ids else zlib.crc32(piece), whole_size,
                                 sequence, offset))
                    offset += b - a
                sequence += 1
            waiting, tokens = left, sum(len(d[2]) for d in left)
            enough = max(STRETCH, 2 * tokens)
            columns = list(zip(*rows)) or [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            keys = iter(batch.column(0).to_pylist())
            for ids, sizes in tokenizer.encode(batch.column(1)):
                begin = 0
                for n in sizes.tolist():
                    one = ids[begin:begin + n]
                    begin += n
                    if end_id is not None:
                        one = np.append(one, np.uint32(end_id))
                    key = next(keys)
                    if len(one):
                        waiting.append((key, 0, one, len(one)))
                        tokens += len(one)
                    if tokens >= enough:
                        yield solve(False)
        if waiting:
            yield solve(True)
        batch = None
        tokenizer.forget()
        give_back()
    return run


def pack(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, end_id: int | None = END_ID,
         key: str = "doc_id", text: str = "text", whole_ids: bool = True) -> DataFrame:
    """One row per piece of a document in a sequence: `PIECES`, or `DIGESTS`, which have the
    CRC-32 of the ids in their place.

    ids: little-endian unsigned 32-bit token ids; start: the document's tokens before the
    piece; offset: the sequence's tokens before it; doc_tokens: the document's tokens with
    the end id. Documents follow each other by key, null first, equal keys by text, and
    each row is a document of its own, so repeated rows are packed as often as they occur.
    A null text is empty, its document only the end id; without an end id it has no piece.
    An empty table gives no rows. Other columns are not carried.
    """
    path = tokenizer or default_path()
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    return ordered.mapInArrow(_pack(path, size, end_id, whole_ids), PIECES if whole_ids else DIGESTS)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), whole_ids=False)


QUERIES = {"op9_packing": op9_packing}
