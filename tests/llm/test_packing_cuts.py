"""Cuts of a stream that is solved as it comes, against those of the whole stream."""

import random

import numpy as np
import pytest

from pagewell.llm import packing


def stream(seed, documents, longest, sentence):
    rng = random.Random(seed)
    return [np.array([1 if rng.random() < sentence else 0 for _ in range(rng.randint(1, longest))], np.uint32)
            for _ in range(documents)]


def windows_of(documents, size, take):
    """Lengths of the windows if `take` documents more are there whenever it is solved."""
    ends = np.array([False, True])
    waiting, out = [], []
    for k in range(0, len(documents), take):
        waiting += [(n, 0, d, len(d)) for n, d in enumerate(documents[k:k + take], k)]
        windows, waiting = packing._stretch(waiting, ends, size, k + take >= len(documents))
        out += [sum(b - a for _, a, b in w) for w in windows]
    assert not waiting
    return out


@pytest.mark.parametrize("longest,sentence", [(30, 0.2), (30, 0.0), (400, 0.02), (90, 0.5)])
def test_stream_as_it_comes(longest, sentence):
    for seed in range(6):
        documents = stream(seed, 160, longest, sentence)
        whole = windows_of(documents, 64, len(documents))
        assert max(whole) <= 64 and sum(whole) == sum(map(len, documents))
        for take in (1, 7, 40):
            assert windows_of(documents, 64, take) == whole


def test_cheapest_of_the_whole_stream():
    for seed in range(4):
        documents = stream(seed, 60, 50, 0.1)
        edges = np.r_[0, np.cumsum([len(d) for d in documents])]
        ends = np.concatenate(documents) == 1
        sentences = np.array([k + 1 for k in range(len(ends)) if ends[k] and not ends[k + 1:k + 2].any()])
        places, cost = packing.places_of(edges, sentences, 40)
        best = {0: 0}
        for j in range(1, len(places)):
            best[j] = min(best[i] + 40 - (places[j] - places[i]) for i in range(j) if places[j] - places[i] <= 40) + cost[j]
        price = dict(zip(places.tolist(), cost.tolist()))
        ends = np.cumsum(windows_of(documents, 40, 5)).tolist()
        assert sum(40 - n for n in np.diff([0, *ends])) + sum(price[e] for e in ends) == best[len(places) - 1]


def test_cuts_elsewhere_only_where_a_window_has_no_other():
    documents = stream(9, 40, 700, 0.01)
    edges = np.r_[0, np.cumsum([len(d) for d in documents])]
    bounds = np.union1d(edges, np.flatnonzero(np.concatenate(documents) == 1) + 1)
    places, _ = packing.places_of(edges, bounds, 100)
    for place in np.setdiff1d(places, bounds):
        k = np.searchsorted(bounds, place)
        assert bounds[k] - bounds[k - 1] > 100
