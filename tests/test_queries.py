"""Every query of the library against its DuckDB SQL, and the same rows whatever the partition count."""

from pathlib import Path

import pytest

from stratalith.plans import catalogue

SF = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return tuple(map(plain, value)) if isinstance(value, list) else value


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_is_its_sql(spark, duck, name):
    found = catalogue.queries()[name](spark, SF)
    columns = sorted(found.columns)
    want = duck.sql(catalogue.oracle_sql()[name])
    assert sorted(want.columns) == columns
    places = [want.columns.index(c) for c in columns]
    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in found.collect())
    assert got == sorted(repr(tuple(plain(r[i]) for i in places)) for r in want.fetchall())


@pytest.mark.parametrize("name", ["overlay_winner", "order_violations", "chunk_assign", "lpt_balance", "progress_steps", "nearest_match"])
def test_partitions_do_not_matter(spark, name):
    rows = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows.append(sorted(map(str, catalogue.queries()[name](spark, SF).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert rows[0] == rows[1]


def test_queries_without_sql_are_few():
    assert set(catalogue.queries()) - set(catalogue.oracle_sql()) == {"lpt_balance"}
