"""Long runs of one sign have very many equally good segmentations."""

from __future__ import annotations

import heapq

import numpy as np
import pytest

from crawldelta.llm import pieces
from tests.llm.test_operators import PIECES


def best_scores(model, text, n):
    """The n best scores by keeping the n best of every position."""
    kept = [[0.0]] + [[] for _ in text]
    for end, into in enumerate(model.edges(text)):
        if end:
            kept[end] = heapq.nlargest(n, (s + score for start, score, _ in into for s in kept[start]))
    return kept[-1]


@pytest.mark.parametrize("run", ["-" * 5000, "=" * 3000, "a" * 4000, "*" * 383, "ab-" * 700])
def test_long_runs_stay_small(run, monkeypatch):
    model, pushed = pieces.Lattice(PIECES, 3), [0]

    def push(heap, item, add=heapq.heappush):
        pushed[0] += 1
        # A position goes on n times at most, by the pieces that end there.
        assert pushed[0] <= 3 * 20 * (len(run) + 2) + 1000
        add(heap, item)

    monkeypatch.setattr(pieces.heapq, "heappush", push)
    found = model.encode(run)
    assert len(found) == 3 and len({ids for _, ids in found}) == 3
    assert all(model.decode(np.frombuffer(ids, "<i4")) == run for _, ids in found)
    for seg in set(model.segments(run)):
        ranked = model.best_of(seg, 3)
        assert np.allclose([s for s, _ in ranked], best_scores(model, seg, 3)) and len({ids for _, ids in ranked}) == len(ranked)
