"""Stages with an identity: run in order, kept by digest, reported by state."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.checkpoints import checkpointed, kept, release, stage_digest
from .integrity import strict, violations

_END = ("finished_at", "result_digest", "error")
#: States of a stage, and which of its fields each state has and must not have.
STATE_FIELDS = {
    "pending": ((), ("input_digest", "started_at", *_END)),
    "running": (("input_digest", "started_at"), _END),
    "succeeded": (("input_digest", "started_at", "finished_at", "result_digest"), ("error",)),
    "failed": (("input_digest", "started_at", "finished_at", "error"), ("result_digest",)),
    "interrupted": (("input_digest", "started_at", "finished_at", "error"), ("result_digest",)),
}


@dataclass(frozen=True)
class Stage:
    """One step: ``run(table) -> table``, and checks that each row of its result must pass."""

    name: str
    version: int
    run: Callable[[DataFrame], DataFrame]
    params: dict = field(default_factory=dict)
    key: tuple[str, ...] = ()
    checks: dict[str, Column] = field(default_factory=dict)


def run_stages(spark: SparkSession, root: str, first: DataFrame, source: str, stages: list[Stage]) -> tuple[DataFrame, list[dict]]:
    """Run stages in order; each is kept under the digest of its identity and all before it, and used again
    as long as that stays. ``source`` names the state of the first input. Returns the last table and a
    report row for each stage."""
    table, digest, report = first, source, []
    for stage in stages:
        digest = stage_digest(stage.name, stage.version, stage.params, [digest])
        table, reused = checkpointed(spark, root, digest, lambda t=table, s=stage: s.run(t))
        if stage.checks and not reused:
            strict(violations(table, list(stage.key), stage.checks), stage.name)
        report.append({"stage": stage.name, "digest": digest, "reused": reused})
    return table, report


def state_violations(stages: DataFrame, key: list[str]) -> DataFrame:
    """(key, error_code) for stages whose fields do not fit their state: a pending one has had no attempt, any other one at
    least, and of its fields those of STATE_FIELDS."""
    pending = F.col("state") == "pending"
    checks = {
        "unknown-state": F.col("state").isin(*STATE_FIELDS),
        "pending-with-attempt": ~pending | (F.col("attempt") == 0),
        "without-attempt": pending | (F.col("attempt") >= 1),
    }
    for state, (wanted, barred) in STATE_FIELDS.items():
        other = F.col("state") != state
        checks |= {f"{state}-without-{c}": other | F.col(c).isNotNull() for c in wanted}
        checks |= {f"{state}-with-{c}": other | F.col(c).isNull() for c in barred}
    return violations(stages, key, checks)


def interrupt_stale(stages: DataFrame, locked: DataFrame, run: str) -> DataFrame:
    """Running stages of runs that nobody holds a lock on become interrupted."""
    held = locked.select(F.col(run).alias("_held")).distinct()
    both = stages.join(held, F.col(run) == F.col("_held"), "left")
    state = F.when((F.col("state") == "running") & F.col("_held").isNull(), "interrupted").otherwise(F.col("state"))
    return both.withColumn("state", state).select(*stages.columns)


def with_missing(dimension: DataFrame, stages: DataFrame, *, on: str, state: str, missing: str = "pending") -> DataFrame:
    """All members of a dimension with their state; those without a row are ``missing``."""
    return dimension.join(stages, on, "left").withColumn(state, F.coalesce(state, F.lit(missing)))


def until_stable(start: DataFrame, step: Callable[[DataFrame], DataFrame], *, most: int) -> tuple[DataFrame, int]:
    """Repeat a step until it changes no row, ``most`` times at most; the table and the rounds taken.

    Each round is written, so a step reads one table; two rounds are held against each other by counts of equal rows.
    """
    table = kept(start)
    for n in range(most):
        new = kept(step(table))
        sides = table.withColumn("_side", F.lit(-1)).unionByName(new.withColumn("_side", F.lit(1)))
        differ = sides.groupBy(*start.columns).agg(F.sum("_side").alias("_side")).where("_side <> 0")
        if differ.isEmpty():
            release(new)
            return table, n
        release(table)
        table = new
    raise RuntimeError(f"not stable after {most} rounds")


def closure(facts: DataFrame, step: Callable[[DataFrame], DataFrame], *, most: int) -> tuple[DataFrame, int]:
    """All rows that follow from some facts, and the rounds taken: ``step`` gives what follows from new rows alone.

    Semi-naive: each round works on the rows that the last one added, and what is known is anti-joined, null-safe, so work
    grows with what is found. Rounds are written. More than ``most`` rounds raise.
    """
    known = kept(facts.distinct())
    new, rounds = known, 0
    while not new.isEmpty():
        if rounds == most:
            raise RuntimeError(f"not closed after {most} rounds")
        more = step(new).select(*facts.columns).distinct().alias("more")
        same = [F.col(f"more.{c}").eqNullSafe(F.col(f"known.{c}")) for c in facts.columns]
        whole = same[0]
        for s in same[1:]:
            whole = whole & s
        new = kept(more.join(known.alias("known"), whole, "left_anti"))
        known, rounds = kept(known.unionByName(new)), rounds + 1
    return known, rounds
