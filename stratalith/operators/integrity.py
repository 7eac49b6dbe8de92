"""Checks that return what is wrong as rows, and ordered folds that digest groups in bounded memory."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def violations(rows: DataFrame, key: list[str], checks: dict[str, Column]) -> DataFrame:
    """A row (key, error_code) for each check that a row fails; a null result counts as failed."""
    codes = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in checks.items())))
    return rows.select(*key, F.explode(codes).alias("error_code"))


def strict(found: DataFrame, what: str) -> None:
    """Raise if there is any violation row."""
    first = found.first()
    if first is not None:
        raise ValueError(f"{what}: {first.asDict()}")


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def not_exactly_one(rows: DataFrame, keys: list[str], wanted: Column) -> DataFrame:
    """Groups without just one wanted row, with how many they have."""
    return rows.groupBy(*keys).agg(F.count_if(wanted).alias("n_wanted")).where("n_wanted <> 1")


def inconsistent_groups(rows: DataFrame, keys: list[str], signature: list[str]) -> DataFrame:
    """Groups whose rows do not all share one signature."""
    kinds = rows.select(*keys, *signature).distinct()
    return kinds.groupBy(*keys).agg(F.count("*").alias("n_signatures")).where("n_signatures > 1")


def presence(declared: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Each key with its state: present, missing (declared alone) or unmanifested (actual alone)."""
    sides = declared.select(*keys, F.lit(1).alias("side")).unionByName(actual.select(*keys, F.lit(2).alias("side")))
    seen = sides.groupBy(*keys).agg(F.bit_or("side").alias("sides"))
    state = F.when(F.col("sides") == 3, "present").when(F.col("sides") == 1, "missing").otherwise("unmanifested")
    return seen.select(*keys, state.alias("state"))


def missing_references(rows: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """Values of a column that the known side lacks, with their rows."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("reference")).agg(F.count("*").alias("n_rows"))
    return counts.join(known.select(F.col(known_column).alias("reference")), "reference", "left_anti")


def contiguity(rows: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Whether each group's indices are 1 to n, each once."""
    found = rows.groupBy(*keys).agg(
        F.min(index).cast("long").alias("first_index"),
        F.max(index).cast("long").alias("last_index"),
        F.count("*").alias("n_rows"),
        F.count_distinct(index).alias("n_distinct"),
    )
    fine = (F.col("first_index") == 1) & (F.col("last_index") == F.col("n_rows")) & (F.col("n_distinct") == F.col("n_rows"))
    return found.withColumn("contiguous", fine)


def totals_differ(declared: DataFrame, parts: DataFrame, keys: list[str], total: str, part: str) -> DataFrame:
    """Keys whose declared total is not the sum of their parts; keys without parts count as 0."""
    sums = parts.groupBy(*keys).agg(F.sum(part).alias("actual"))
    both = declared.select(*keys, F.col(total).alias("declared")).join(sums, keys, "left")
    both = both.withColumn("actual", F.coalesce("actual", F.lit(0)))
    return both.where("declared <> actual").withColumn("difference", F.col("actual") - F.col("declared"))


def lag_over_all(rows: DataFrame, order: str, columns: list[str], *, width: int = 1_000_000) -> DataFrame:
    """Each column's value in the row before, in the order of a whole number over all rows.

    Rows are windowed within ranges of ``width`` values; the last row of each range is handed to the
    next through a table with one row a range, so no task sorts all rows.
    """
    own = rows.withColumn("_range", F.floor(F.col(order) / width))
    within = Window.partitionBy("_range").orderBy(order)
    packed = F.struct(*columns)
    own = own.withColumn("_before", F.lag(packed).over(within)).withColumn("_first", F.row_number().over(within) == 1)
    ends = rows.groupBy(F.floor(F.col(order) / width).alias("_range")).agg(F.max_by(packed, order).alias("_end"))
    ends = ends.select("_range", F.lag("_end").over(Window.orderBy("_range")).alias("_handed"))
    both = own.join(ends, "_range").withColumn("_before", F.when(F.col("_first"), F.col("_handed")).otherwise(F.col("_before")))
    return both.select(*rows.columns, *(F.col(f"_before.{c}").alias(f"previous_{c}") for c in columns))


def order_violations(rows: DataFrame, order: str, keys: list[str]) -> DataFrame:
    """Rows whose key is not above that of the row before."""
    found = lag_over_all(rows, order, keys)
    before = F.struct(*(F.col(f"previous_{k}").alias(k) for k in keys))
    return found.where(F.col(f"previous_{keys[0]}").isNotNull() & (F.struct(*keys) <= before))


def fold_ordered(rows: DataFrame, key: str, order: list[str], value: str, start: Callable, step: Callable, end: Callable, kind: str) -> DataFrame:
    """Fold each group's values in order, holding one group's state at a time and never its rows.

    ``start()`` gives a state, ``step(state, value)`` the next, ``end(state)`` the result.
    """
    schema = T.StructType([rows.schema[key], T.StructField("n_rows", T.LongType()), T.StructType.fromDDL(f"result {kind}")[0]])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        state, n = None, 0
        for batch in batches:
            done: list[tuple] = []
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if current != (k,):
                    if current is not None:
                        done.append((*current, n, end(state)))
                    current, state, n = (k,), start(), 0
                state, n = step(state, v), n + 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), arrow, strict=True)], schema=arrow)
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*current, n, end(state)), arrow, strict=True)], schema=arrow)

    placed = rows.repartition(F.col(key)).sortWithinPartitions(key, *order).select(key, value)
    return placed.mapInArrow(run, schema)


def joined_digest(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """SHA-256 of each group's texts one after the other; nulls add nothing."""

    def step(state, text):
        state.update((text or "").encode())
        return state

    return fold_ordered(rows, key, order, value, hashlib.sha256, step, lambda s: s.hexdigest(), "string").withColumnRenamed("result", "digest")


def digest_chain(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Each group's chain: the digest of the last digest and the next text, from the empty text on."""
    step = lambda state, text: hashlib.sha256((state + (text or "")).encode()).hexdigest()
    return fold_ordered(rows, key, order, value, str, step, lambda s: s, "string").withColumnRenamed("result", "digest")


def set_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values of one side alone, with the side: required values that are missing, and unexpected ones."""
    return presence(left.select(column), right.select(column), [column]).where("state <> 'present'")


def keep_first(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key in an order."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(order)).alias("_row"))
    return best.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest)).select(*rows.columns)


def limit_violations(rows: DataFrame, *, keys: list[str], limits: dict[str, tuple[Column, int]]) -> DataFrame:
    """(keys, error_code) for groups where an aggregate passes its limit; ``limits``: code to (aggregate, limit)."""
    sums = rows.groupBy(*keys).agg(*(a.alias(code) for code, (a, _) in limits.items()))
    return violations(sums, keys, {code: F.col(code) <= most for code, (_, most) in limits.items()})


def total_join(rows: DataFrame, known: DataFrame, on: list[str], what: str) -> DataFrame:
    """An inner join in which every row must have a partner; reading one without raises."""
    marked = rows.join(known.withColumn("_known", F.lit(True)), on, "left")
    return marked.where(F.assert_true(F.col("_known").isNotNull(), F.lit(f"no match: {what}")).isNull()).drop("_known")


def same_ids(left: DataFrame, right: DataFrame, *, key: str, order: str, item: str) -> DataFrame:
    """Keys whose ordered items differ between two sides, found place by place."""
    both = left.select(key, order, F.col(item).alias("one")).join(right.select(key, order, F.col(item).alias("other")), [key, order], "full")
    return both.where(~F.col("one").eqNullSafe(F.col("other"))).groupBy(key).agg(F.count("*").alias("n_differ"), F.min(order).alias("first_place"))
