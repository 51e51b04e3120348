"""The registered query of order 3 against plain counts."""

import math
from collections import Counter

import pytest

from pagewell.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_lm_of_order_3(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    words = {k: (t or "").encode().lower().split() for k, t in texts.items()}

    def counted(w):
        return [Counter(zip(*(w[j:] for j in range(n)))) for n in (1, 2, 3)]

    held = [Counter() for _ in range(3)]
    for w in words.values():
        for all_, own in zip(held, counted(w)):
            all_.update(own)
    everything = sum(held[0].values())
    rows = {r["doc_id"]: r for r in QUERIES["op2_lm_scores_order3"](spark, FOLDER).collect()}
    assert set(rows) == set(words)
    by_three = 0
    for key, w in words.items():
        own, total, rest = counted(w), 0.0, max(1, everything - len(w))

        def others(gram):
            return held[len(gram) - 1][gram] - own[len(gram) - 1][gram]

        for k in range(len(w)):
            for n in range(min(3, k + 1), 0, -1):
                gram = tuple(w[k - n + 1:k + 1])
                if others(gram):
                    total += math.log(others(gram) / (others(gram[:-1]) if n > 1 else rest))
                    by_three += n == 3
                    break
                total += math.log(0.4)
            else:
                total -= math.log(rest)
        assert rows[key]["log_score"] == pytest.approx(total)
    assert by_three > 1000
