"""Run histories: latest rows, retry cycles, outcomes and costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, *, keys: list[str], order: list[str], limit: int | None = None) -> DataFrame:
    """The newest row of each key by an order; the newest of these first if limited."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row"))
    found = best.select(*keys, *(F.col(f"row.{c}").alias(c) for c in rest)).select(*rows.columns)
    return found if limit is None else found.orderBy(*(F.desc(c) for c in order), *keys).limit(limit)


def retry_cycles(runs: DataFrame, *, target: str, time: str, success: Column, failure: Column) -> DataFrame:
    """The open cycle of each target: failures since its last success, first and last.

    Targets whose last success has no failure behind it have none. Two aggregates and a join on the
    target, no sort.
    """
    at = F.col(time)
    last = runs.groupBy(target).agg(F.max(F.when(success, at)).alias("last_success"))
    both = runs.where(failure).select(target, time).join(last, target)
    open_ = both.where(F.col("last_success").isNull() | (at > F.col("last_success")))
    return open_.groupBy(target).agg(F.min(time).alias("first_failed"), F.max(time).alias("last_failed"), F.count("*").alias("n_failures"))


def run_state(runs: DataFrame, *, target: str, order: list[str], result: Column, release: Column, completed: Column) -> DataFrame:
    """State of each target after all its runs: (target, version, last_result, retry_release, first_failed, last_failed).

    A success sets the version and ends the retry. Another result keeps the version; if it names a release that is
    not the version, that release is the one to retry, first failed when the unbroken row of runs that name it
    began. Runs that name none, or the version, change nothing. By aggregates and joins on the target, so a target's
    runs need no sort and no state. ``order`` tells runs of a target apart.
    """
    at = F.struct(*order)
    own = runs.select(F.col(target), at.alias("at"), result.alias("result"), release.alias("release"), completed.alias("completed"))
    last = own.groupBy(target).agg(
        F.max_by("release", F.when(F.col("result") == "success", F.col("at"))).alias("version"),
        F.max(F.when(F.col("result") == "success", F.col("at"))).alias("since"),
        F.max_by("result", "at").alias("last_result"),
    )
    # before the first success a failed run's release never is the version
    names = own.join(last, target).where((F.col("result") != "success") & F.col("release").isNotNull())
    names = names.where((F.col("since").isNull() | (F.col("at") > F.col("since"))) & ~F.col("release").eqNullSafe(F.col("version")))
    retried = names.groupBy(target).agg(F.max_by("release", "at").alias("retry_release"), F.max_by("completed", "at").alias("last_failed"))
    both = names.join(retried.select(target, "retry_release"), target)
    broken = both.groupBy(target).agg(F.max(F.when(F.col("release") != F.col("retry_release"), F.col("at"))).alias("broken"))
    row = both.join(broken, target).where((F.col("release") == F.col("retry_release")) & (F.col("broken").isNull() | (F.col("at") > F.col("broken"))))
    began = row.groupBy(target).agg(F.min("completed").alias("first_failed"))
    return last.drop("since").join(retried, target, "left").join(began, target, "left").select(
        target, "version", "last_result", "retry_release", "first_failed", "last_failed"
    )


#: Results of a run; a run lasts no longer than so many seconds.
RESULTS, LONGEST_RUN = ("success", "failure", "cancelled"), 86400


def status_rules(*, now: Column) -> dict[str, Column]:
    """Rules of a status row (version, readable, result, run_release, started, completed, seconds, retry_release,
    first_failed, last_failed; times in whole seconds), for ``integrity.violations``: code to what must hold."""
    c = F.col
    ok = c("result") == "success"
    unpublished = c("run_release").isNotNull() & ~c("run_release").eqNullSafe(c("version"))
    retry = c("retry_release").isNotNull()
    return {
        "unknown-result": c("result").isin(*RESULTS),
        "version-without-text": c("version").isNull() == c("readable").isNull(),
        "success-without-version": ~ok | c("run_release").isNotNull(),
        "success-of-other-version": ~ok | c("run_release").eqNullSafe(c("version")),
        "completed-before-start": c("completed") >= c("started"),
        "completed-in-future": c("completed") <= now,
        "duration": (c("seconds") == c("completed") - c("started")) & (c("seconds") <= LONGEST_RUN),
        "failure-without-retry": ok | ~unpublished | retry,
        "retry-of-version": ~retry | ~c("retry_release").eqNullSafe(c("version")),
        "retry-after-success": ~retry | ~ok,
        "retry-order": ~retry | (c("first_failed") <= c("last_failed")),
        "retry-of-later-run": ~retry | (c("last_failed") <= c("completed")),
        "retry-of-other-run": ~retry | ok | ~unpublished | ((c("retry_release") == c("run_release")) & (c("last_failed") == c("completed"))),
    }


#: A retry waits so many seconds while its cycle is younger than so many; older ones wait a week.
RETRY_WAITS = ((3 * 86400, 12 * 3600), (10 * 86400, 86400))
LONGEST_WAIT = 7 * 86400


def next_retry(first: Column, last: Column) -> Column:
    """When to retry, by the age of the cycle from its first to its last failure; in whole seconds."""
    wait = F.lit(LONGEST_WAIT)
    for age, seconds in reversed(RETRY_WAITS):
        wait = F.when(last - first < age, seconds).otherwise(wait)
    return last + wait


def is_blocked(now: Column, due: Column, release: Column, failed_release: Column) -> Column:
    """Whether a release waits: it is the one that failed and its retry is not yet due."""
    return F.coalesce((release == failed_release) & (now < due), F.lit(False))


def outcome(rows: DataFrame, *, keys: list[str], failed: Column, cancelled: Column, succeeded: Column) -> DataFrame:
    """failure if any failed, else cancelled if any was, else success if all succeeded, else failure."""
    flags = rows.groupBy(*keys).agg(F.bool_or(failed).alias("f"), F.bool_or(cancelled).alias("c"), F.bool_and(succeeded).alias("s"), F.count("*").alias("n_rows"))
    result = F.when(F.col("f"), "failure").when(F.col("c"), "cancelled").when(F.col("s"), "success").otherwise("failure")
    return flags.select(*keys, result.alias("result"), "n_rows")


def ledger_cost(rows: DataFrame, *, keys: list[str], identity: list[str], cents: Column, refund: Column) -> DataFrame:
    """Charges less refunds in cents; null without a charge or where refunds exceed charges.

    Repeated postings count once. Zero amounts are dropped.
    """
    own = rows.select(*keys, *identity, F.abs(cents).alias("cents"), refund.alias("refund")).distinct().where("cents <> 0")
    sums = own.groupBy(*keys).agg(
        F.count_if(~F.col("refund")).alias("n_charges"),
        F.count_if(F.col("refund")).alias("n_refunds"),
        F.sum(F.when(F.col("refund"), -F.col("cents")).otherwise(F.col("cents"))).alias("net"),
    )
    return sums.withColumn("cost_cents", F.when((F.col("n_charges") > 0) & (F.col("net") >= 0), F.col("net"))).drop("net")


def conflicting_postings(rows: DataFrame, *, key: str, content: list[str]) -> DataFrame:
    """Ids that stand for postings of different content."""
    return rows.select(key, *content).distinct().groupBy(key).agg(F.count("*").alias("n_versions")).where("n_versions > 1")


def dimension_counts(dimension: DataFrame, facts: DataFrame, *, on: str, state: Column, states: list[str]) -> DataFrame:
    """Counts by state for each member of a dimension, and what they say together: missing without facts, problems
    if any is in the first state, else pending if any is, else ok."""
    counts = facts.groupBy(on).agg(*(F.count_if(state == s).alias(f"n_{s}") for s in states), F.count("*").alias("n_rows"))
    both = dimension.join(counts, on, "left")
    zero = [F.coalesce(f"n_{s}", F.lit(0)).alias(f"n_{s}") for s in states]
    overall = F.when(F.col("n_rows").isNull(), "missing").when(F.col(f"n_{states[0]}") > 0, "problems")
    if "pending" in states:
        overall = overall.when(F.col("n_pending") > 0, "pending")
    overall = overall.otherwise("ok")
    return both.select(*dimension.columns, *zero, overall.alias("overall"))


def since_last(rows: DataFrame, *, key: str, order: list[str], mark: Column) -> DataFrame:
    """Number of marked rows so far in each key's order: the cycle that a row belongs to."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("cycle", F.sum(mark.cast("int")).over(w))
