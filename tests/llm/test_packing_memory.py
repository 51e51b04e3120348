"""What a Python worker holds while it encodes and after a task of packing."""

from types import SimpleNamespace

import pyarrow as pa

from pagewell.llm import packing, tokens
from pagewell.llm.tokens import default_path


def test_few_words_are_remembered_and_none_after_the_task(monkeypatch):
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    encoder, most = packing.encoder(default_path(), known_parts=packing.KNOWN_PARTS), 0
    texts = [" ".join(f"w{n}" for n in range(k, k + 5_000)) for k in range(0, 600_000, 5_000)]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["key", "text"])
    pieces = []
    for out in packing._pack(default_path(), packing.SIZE, packing.END_ID, True)(iter([batch])):
        most = max(most, len(encoder.parts))
        pieces += zip(out["doc_id"].to_pylist(), out["ids"].to_pylist())
    assert most < 450_000 and len(encoder.parts) == len(encoder.flat) == 0
    ids = {}
    for key, piece in pieces:
        ids[key] = ids.get(key, b"") + piece
    for key in (0, 61, len(texts) - 1):
        whole = encoder._whole([texts[key]])[0] + [packing.END_ID]
        assert ids[key] == pa.array(whole, pa.uint32()).buffers()[1].to_pybytes()[:4 * len(whole)]


def test_the_library_gets_a_bounded_part_at_once(monkeypatch):
    encoder, given = tokens.Encoder(default_path()), []
    whole = encoder._whole
    monkeypatch.setattr(encoder, "_whole", lambda texts: given.append(sum(map(len, texts))) or whole(texts))
    texts = [" ".join(f"w{n}" for n in range(k, k + 20_000)) for k in range(0, 120_000, 20_000)] + ["", None]
    for by_parts in (True, False):
        encoder.by_parts = by_parts
        got = [(ids.tolist(), sizes.tolist()) for ids, sizes in encoder.encode(texts)]
        assert [i for ids, _ in got for i in ids] == [i for t in texts for i in whole([t or ""])[0]]
        assert sum((sizes for _, sizes in got), []) == [len(whole([t or ""])[0]) for t in texts]
    assert given and max(given) <= tokens.AT_ONCE
