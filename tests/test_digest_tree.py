"""Trees of digests: what differs is found, and nothing else is read."""

import random

import pytest

from stratalith.operators import digest_tree


def changes(spark, one, other, buckets, fan=4):
    own = "k long, v string, w int"
    a, b = (spark.createDataFrame(rows, own).repartition(3) for rows in (one, other))
    trees = tuple(digest_tree.digest_tree(t, key="k", columns=["v", "w"], buckets=buckets, fan=fan) for t in (a, b))
    found = digest_tree.differing_lines(a, b, trees, key="k", columns=["v", "w"], buckets=buckets, fan=fan)
    return sorted(((r.k, r.state) for r in found.collect()), key=str), trees


def brute(one, other):
    lines = lambda rows: {k: sorted(map(str, (r for r in rows if r[0] == k))) for k in {r[0] for r in rows}}
    a, b = lines(one), lines(other)
    return sorted(((k, "missing" if k not in b else "added" if k not in a else "changed") for k in a.keys() | b.keys() if a.get(k) != b.get(k)), key=str)


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_changes(spark, buckets):
    rng = random.Random(buckets)
    one = [(k, rng.choice("abc"), rng.choice([1, None])) for k in range(120)] + [(5, "x", 1)] * 30 + [(None, "n", 1), (7, None, None)]
    other = [r if r[0] != 9 else (9, "changed", 1) for r in one if r[0] not in (3, 4)] + [(5, "x", 1), (900, "new", 1), (11, "second", 1)]
    rng.shuffle(other)
    found, trees = changes(spark, one, other, buckets)
    assert found == brute(one, other)
    nodes = digest_tree.differing_buckets(*trees, buckets=buckets, fan=4).count()
    assert nodes <= min(buckets, len(found))


def test_equal_and_empty_tables(spark):
    rows = [(k, "a", k) for k in range(50)]
    assert changes(spark, rows, rows[::-1], 16)[0] == []
    assert changes(spark, rows[:2], [], 16)[0] == [(0, "missing"), (1, "missing")]
    assert changes(spark, [], [], 16)[0] == []
    assert digest_tree.tree_buckets(0) == 1 and digest_tree.tree_buckets(10**6) == 16**4
