"""Bucket boundaries where lengths are over 1,024 tokens."""

import itertools
import random

import numpy as np

from contractlake.llm import packing


def test_long_lengths_pad_least(spark):
    lengths = [*random.Random(2).sample(range(1025, 30_000), 11), 5, 900]
    docs = spark.createDataFrame([(i, "w " * n) for i, n in enumerate(lengths)], "doc_id long, text string")
    rows = packing.pack(docs, buckets=4).collect()
    cost = lambda ends: sum(min(e for e in ends if e >= n) - n for n in lengths)
    best = min(cost([*ends, max(lengths)]) for m in range(4) for ends in itertools.combinations(sorted(lengths)[:-1], m))
    assert sum(r["padded_tokens"] - r["n_tokens"] for r in rows) == best
    for k in {r["bucket"] for r in rows}:
        held = [r for r in rows if r["bucket"] == k]
        assert {r["padded_tokens"] for r in held} == {max(r["n_tokens"] for r in held)}


def test_many_distinct_lengths():
    rng = np.random.default_rng(3)
    lengths = np.unique(rng.integers(0, 1 << 20, 700))
    counts = rng.integers(1, 50, len(lengths))
    before = np.concatenate(([0], np.cumsum(counts)))
    tokens = np.concatenate(([0], np.cumsum(counts * lengths)))
    pad = lengths * (before[1:] - before[:-1, None]) - (tokens[1:] - tokens[:-1, None])  # [i, j]: cells i..j in one bucket
    pad = np.where(np.tri(len(lengths), dtype=bool).T, pad, 1 << 60)
    least = pad[0]
    for _ in range(15):
        least = np.minimum(pad[0], np.concatenate(([1 << 60], (least[:-1, None] + pad[1:]).min(axis=0)[1:])))
    ends = packing.boundaries(lengths, counts, 16)
    to = np.array(ends)[np.searchsorted(ends, lengths)]
    assert ((to - lengths) * counts).sum() == least[-1]
