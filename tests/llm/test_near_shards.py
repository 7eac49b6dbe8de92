"""Copies of classes that the trees send to their shards: as many for each class at any size."""

import numpy as np
import pytest
from pyspark.sql.group import GroupedData

from stratalith.llm import simhash

HOW = {"radius": 20, "blocks": 4, "part_radius": 1, "sketch_radius": 40}


def fingerprints(rng, n, columns, shared=0):
    """Random fingerprints, every second one near the one before it; the first ``shared`` bits are alike in all."""
    fps = rng.integers(0, 1 << 64, (n, columns), np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (n // 2, columns, 12), np.uint64)
    fps[1::2] = fps[::2][: n // 2] ^ np.bitwise_xor.reduce(flips[:, :, : columns * 4], axis=2)
    return fps & ~np.uint64((1 << shared) - 1)


def components_of(n, pairs):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        p, q = root(a), root(b)
        up[max(p, q)] = min(p, q)
    return [root(x) for x in range(n)]


def sent(spark, monkeypatch, fps, **how):
    """Links found, and rows that went to the shards."""
    rows, apply = [], GroupedData.applyInArrow

    def watched(groups, *args):
        rows.append(groups._df.count())
        return apply(groups, *args)

    classes = spark.createDataFrame([(i, x) for i, x in enumerate(fps.view(np.int64).tolist())], "rep long, fps array<long>")
    with monkeypatch.context() as m:
        m.setattr(GroupedData, "applyInArrow", watched)
        links = [(r.a, r.b) for r in simhash.near_links(classes, **how).collect()]
    return links, rows[0]


@pytest.mark.parametrize("how", [{}, HOW])
def test_rows_sent_grow_no_faster_than_classes(spark, monkeypatch, how):
    monkeypatch.setattr(simhash, "SHARD_CLASSES", 250)
    fps = fingerprints(np.random.default_rng(1), 16_000, 2 if how else 1)
    links, many = sent(spark, monkeypatch, fps, **how)
    _, few = sent(spark, monkeypatch, fps[:1_000], **how)
    assert many <= 16 * 1.05 * few
    assert links or not how


@pytest.mark.parametrize("shared", [0, 24])
def test_parts_and_pieces_lose_no_pair(spark, monkeypatch, shared):
    """Links by a part's radius and by all bits, against brute force; pieces alike in all go on over their part."""
    monkeypatch.setattr(simhash, "SHARD_CLASSES", 100)
    monkeypatch.setattr(simhash, "LEAF", 16)
    fps = fingerprints(np.random.default_rng(2), 1_200, 2, shared)
    links, _ = sent(spark, monkeypatch, fps, **HOW)
    bits = fps[:, None, :] ^ fps[None, :, :]
    near = np.zeros(bits.shape, bool)
    for mask in simhash.masks(4):
        near |= np.bitwise_count(bits & np.uint64(mask)) <= 1
    near &= np.bitwise_count(bits) <= 20
    pairs = np.argwhere(near.any(axis=2) & (np.bitwise_count(bits).sum(axis=2) <= 40))
    pairs = [(int(a), int(b)) for a, b in pairs if a > b]
    assert len(pairs) > 300
    assert {tuple(sorted(p, reverse=True)) for p in links} <= set(pairs)
    assert components_of(len(fps), links) == components_of(len(fps), pairs)
