"""Overlapping sources resolved by precedence, layers laid over each other, collisions found.

All group work is done by aggregates that combine before the shuffle, so a key that holds a large share
of all rows does not gather in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_first_wins(
    candidates: DataFrame, *, keys: list[str], precedence: str, tie: str, fallback_from: int | None = None
) -> DataFrame:
    """One row for each key: winner (its tie-breaker), n_candidates, n_best and the rule that decided.

    The lowest precedence wins, then the lowest tie-breaker. ``rule``: only-candidate, ambiguous (several
    share the best precedence), loose-fallback (the winner's precedence is ``fallback_from`` or more), or
    first-listed. Ambiguity is a label, see ``require_unambiguous`` for an error.
    """
    levels = candidates.groupBy(*keys, precedence).agg(F.count("*").alias("n"), F.min(tie).alias("tie"))
    best = F.min(F.struct(F.col(precedence), F.col("tie"), F.col("n")))
    out = levels.groupBy(*keys).agg(best.alias("best"), F.sum("n").alias("n_candidates"))
    rule = F.when(F.col("n_candidates") == 1, "only-candidate").when(F.col("best.n") > 1, "ambiguous")
    if fallback_from is not None:
        rule = rule.when(F.col(f"best.{precedence}") >= fallback_from, "loose-fallback")
    return out.select(
        *keys, F.col("best.tie").alias("winner"), "n_candidates", F.col("best.n").alias("n_best"), rule.otherwise("first-listed").alias("rule")
    )


def require_unambiguous(resolved: DataFrame) -> DataFrame:
    """The same rows; reading an ambiguous one raises."""
    fine = F.assert_true(F.col("rule") != "ambiguous", F.lit("ambiguous winner"))
    return resolved.where(fine.isNull())


def conflicting_candidates(candidates: DataFrame, resolved: DataFrame, *, keys: list[str], tie: str) -> DataFrame:
    """All candidates of keys with more than one, and whether each won; a row each, never a list."""
    several = resolved.where("n_candidates > 1").select(*keys, "winner", "n_candidates")
    joined = candidates.select(*keys, tie).join(several, keys)
    return joined.select(*keys, F.col(tie).alias("candidate"), (F.col(tie) == F.col("winner")).alias("won"), "n_candidates")


def overlay_layers(rows: DataFrame, *, keys: list[str], value: Column, rank: Column, layers: dict[int, str]) -> DataFrame:
    """The value of the highest layer for each key; the largest where a layer has several.

    ``rank`` orders layers and is null for rows of none; ``layers`` names ranks.
    """
    found = rows.where(rank.isNotNull()).groupBy(*keys).agg(
        F.max(F.struct(rank.alias("rank"), value.alias("value"))).alias("top"), F.count_distinct(rank).alias("n_layers")
    )
    name = F.create_map(*(F.lit(x) for pair in layers.items() for x in pair))[F.col("top.rank")]
    return found.select(*keys, F.col("top.value").alias("value"), name.alias("layer"), "n_layers")


def overlay(base: DataFrame, over: DataFrame, *, keys: list[str], value: str) -> DataFrame:
    """Rows of both sides by null-safe key; a key of ``over`` replaces the one of ``base``."""
    marked = base.select(*keys, value, F.lit(0).alias("layer")).unionByName(over.select(*keys, value, F.lit(1).alias("layer")))
    return marked.groupBy(*keys).agg(F.max_by(value, "layer").alias(value), F.max("layer").alias("layer"))


def collisions(rows: DataFrame, *, scope: list[str], name: Column, folded: Column) -> DataFrame:
    """Folded names that several spellings of a scope share, with the counts of spellings and rows."""
    sums = rows.groupBy(*scope, folded.alias("folded")).agg(F.count_distinct(name).alias("n_spellings"), F.count("*").alias("n_rows"))
    return sums.where("n_spellings > 1")
