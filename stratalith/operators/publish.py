"""What is published of a tree: inclusion, projections by kind, orders, retained sources, capacity and ownership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_included(path: Column, *, files: list[str], folders: list[str], suffixes: list[str]) -> Column:
    """Whether a path is one of the root files, or lies in one of the folders and ends like one of the suffixes."""
    under = F.lit(False)
    for folder in folders:
        under = under | path.startswith(f"{folder}/")
    ends = F.lit(False)
    for suffix in suffixes:
        ends = ends | F.lower(path).endswith(suffix)
    return F.coalesce(path.isin(*files) | (under & ends), F.lit(False))


def by_kind(rows: DataFrame, *, kind: Column, fields: dict[str, dict[str, Column]], keep: list[str]) -> DataFrame:
    """Rows with one flat ``source``: its kind, and of the fields those of that kind alone; others are null. A kind that
    has no fields raises when its rows are read."""
    names = sorted({n for own in fields.values() for n in own})

    def pick(name: str) -> Column:
        value = F.lit(None)
        for k, own in fields.items():
            if name in own:
                value = F.when(kind == k, own[name]).otherwise(value)
        return value.alias(name)

    known = F.when(F.assert_true(kind.isin(*fields), F.lit("unknown kind")).isNull(), kind)
    return rows.select(*keep, F.struct(known.alias("kind"), *map(pick, names)).alias("source"))


def layer_order(layer: Column, order: list[Column]) -> list[Column]:
    """Sort columns: the base layer (null) first, then layers by name, then the given ones."""
    return [layer.asc_nulls_first(), *order]


def with_evidence(modules: DataFrame, sources: DataFrame, evidence: DataFrame, *, module: str, attribute: str) -> DataFrame:
    """Modules (rows of module and attribute) that are no source module and have an attribute with evidence."""
    seen = modules.join(evidence.select(attribute).distinct(), attribute, "left_semi").select(module).distinct()
    return seen.join(sources.select(module).distinct(), module, "left_anti")


def unretained(files: DataFrame, kept: DataFrame, *, path: str, suffixes: list[str]) -> DataFrame:
    """Compiled files whose source is not kept beside what was made of them."""
    ends = F.lit(False)
    for suffix in suffixes:
        ends = ends | F.lower(path).endswith(suffix)
    return files.where(ends).select(path).distinct().join(kept.select(path), path, "left_anti")


def zero_state_errors(files: DataFrame, *, keys: list[str], path: str, since: Column, delta_suffixes: list[str], delta_files: list[str]) -> DataFrame:
    """(keys, error_code) of installs that are no zero state: a step that starts elsewhere, a delta's file, a delta's
    service file."""
    name = F.element_at(F.split(path, "/"), -1)
    ends = F.lit(False)
    for suffix in delta_suffixes:
        ends = ends | F.lower(name).endswith(suffix)
    codes = F.array_compact(
        F.array(
            F.when(~F.coalesce(since.isin("", "0"), F.lit(True)), F.lit("not-zero-state")),
            F.when(ends, F.lit("delta-suffix")),
            F.when(name.isin(*delta_files), F.lit("delta-service-file")),
        )
    )
    return files.select(*keys, F.explode(codes).alias("error_code")).distinct()


def needed_space(plans: DataFrame, cached: DataFrame, *, keys: list[str], item: str, size: str, free: Column) -> DataFrame:
    """What a plan needs beyond what is cached already, and whether it fits: (keys, needed, fits). An item counts once;
    ``free`` is an aggregate over the plan's rows."""
    items = plans.groupBy(*keys, item).agg(F.max(size).alias("size"), free.alias("free"))
    new = items.join(cached.select(item, F.lit(True).alias("has")).distinct(), item, "left")
    sums = new.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("has").isNull(), F.col("size"))), F.lit(0)).cast("long").alias("needed"), F.max("free").alias("free"))
    return sums.select(*keys, "needed", (F.col("needed") <= F.col("free")).alias("fits"))


def owned(servers: DataFrame, *, name: Column, product: Column, terms: list[Column], deleted: Column) -> DataFrame:
    """Servers that bear all marks of ownership, but for deleted ones; a mark that is null does not count as borne."""
    marks = name & product
    for term in terms:
        marks = marks & term
    return servers.where(F.coalesce(marks & ~F.coalesce(deleted, F.lit(False)), F.lit(False)))


def quote_errors(quotes: DataFrame, *, key: list[str], wanted: dict[str, Column], price: Column, most: float, balance: Column, hours: float = 4.0) -> DataFrame:
    """(key, error_code) of quotes that lack something wanted (code to what must hold), cost too much an hour, or are not
    covered by the balance for so many hours."""
    from .integrity import violations

    checks = {**wanted, "price": price <= most, "balance": balance >= price * hours}
    return violations(quotes, key, checks)


def http_class(status: Column) -> Column:
    """ok, retry (not found yet, too many, server's fault) or fatal."""
    return F.when(status.between(200, 299), "ok").when(status.isin(404, 429) | status.between(500, 599), "retry").otherwise("fatal")
