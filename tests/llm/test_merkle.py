"""Operator 13 against a tree built in one list."""

import hashlib

import pytest
from pyspark.sql import functions as F

from stratalith.llm import merkle
from stratalith.llm.merkle import fold, manifest, op13_merkle, row_digest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """(root, proof of each leaf) of hex digests."""
    proofs, level, at = [""] * len(leaves), list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i // 8 * 8 : i // 8 * 8 + 8]
            proofs[k] += "".join(run[: i % 8] + run[i % 8 + 1 :])
        level, at = [h(*level[i : i + 8]) for i in range(0, len(level), 8)], [i // 8 for i in at]
    return level[0], proofs


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r[1] is not None, (r[1] or "").encode()), []).append(r)
    order = sorted(groups)
    built = {g: (own := sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[2])), *tree([r[2] for r in own])) for g in order}
    root, upper = tree([built[g][1] for g in order])
    return sorted(
        ((r[0], r[2], built[g][1], root, p + u, r[3] is None or r[3] == r[2]) for g, u in zip(order, upper, strict=True) for r, p in zip(built[g][0], built[g][2], strict=True)), key=str
    )


def made(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "id long, group string, d string, c string").repartition(parts)
    found = manifest(df.select("id", "group", F.unhex("d").alias("digest"), F.unhex("c").alias("claimed"))).collect()
    for r in found:
        assert r.verified == (r.folded_root == r.root)
    return sorted(((r.id, *(bytes(x).hex() for x in (r.leaf, r.subroot, r.root, r.proof)), r.verified) for r in found), key=str)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8}, {"a": 9}, {"a": 65, None: 1, "": 7, "é": 64, "b": 513}, {f"g{k:02}": 1 + k % 3 for k in range(70)}])
def test_is_the_tree_of_a_list(spark, sizes):
    rows = [(k, g, h("leaf", str(g), str(k)), h("other") if k % 5 == 1 else None) for g, n in sizes.items() for k in range(n)]
    assert made(spark, rows) == brute(rows)


def test_repeated_rows_null_ids_and_hot_groups(spark):
    rows = [(k % 40, "hot", h(str(k % 7)), None) for k in range(300)] + [(None, "hot", h("null"), h("x"))] * 3 + [(5, "hot", h("same"), None)] * 100 + [(1, "cold", h("c"), None)]
    assert made(spark, rows, 5) == brute(rows)


def test_empty_table(spark):
    assert made(spark, []) == []


def test_fields(spark):
    row = spark.createDataFrame([(12, None, "é", "")], "a long, b string, c string, d string").select(F.lower(F.hex(row_digest([F.col(c) for c in "abcd"]))).alias("x")).first()
    assert row.x == h("2:12", "-", "2:é", "0:")


def test_fold_needs_each_sibling():
    leaves = [h(str(k)) for k in range(70)]
    root, proofs = tree(leaves)
    for k in (0, 7, 63, 64, 69):
        folded = lambda leaf, proof, k=k: fold(bytes.fromhex(leaf), bytes.fromhex(proof), [(k, 70), (0, 1)]).hex()
        assert folded(leaves[k], proofs[k]) == root
        assert folded(leaves[k], proofs[k][64:] + proofs[k][:64]) != root
        assert folded(leaves[(k + 1) % 70], proofs[k]) != root


def test_query_is_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    found = op13_merkle(spark, sf)
    want = con.sql(f"SELECT {', '.join(found.columns)} FROM ({merkle.SQL['op13_merkle']})").fetchall()
    got = [tuple(r) for r in found.collect()]
    assert sorted(got) == sorted(want)
    assert {r[-1] for r in got} == {True, False}
