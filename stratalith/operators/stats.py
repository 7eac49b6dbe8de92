"""Statistics of stages and runs: conditional sums, rates, roll-ups and counter deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formats import rate


def transfer_stats(rows: DataFrame, *, keys: list[str], size: str, reused: Column, resumed: Column, seconds: Column) -> DataFrame:
    """Reused and fetched items; bytes taken up from earlier attempts, at most the item's size; what the
    network carried, and its rate."""
    taken_up = F.when(~reused, F.least(F.col(size), resumed)).otherwise(0)
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("n_items"),
        F.count_if(reused).alias("n_reused"),
        F.sum(F.when(reused, F.col(size)).otherwise(0)).cast("long").alias("reused_bytes"),
        F.sum(taken_up).cast("long").alias("resumed_bytes"),
        F.sum(F.when(~reused, F.col(size)).otherwise(0) - taken_up).cast("long").alias("network_bytes"),
        seconds.alias("seconds"),
    )
    return sums.withColumn("network_rate", rate(F.col("network_bytes"), F.col("seconds")))


def download_stats(
    rows: DataFrame, *, keys: list[str], size: Column, reused: Column, resumed: Column, attempts: Column, segments: Column, discarded: Column, method: Column,
    methods: list[str], seconds: Column,
) -> DataFrame:
    """All that a download stage counts for each key. ``discarded``: an array with the bytes that each fallback of
    an item threw away; ``seconds``: an aggregate. What was reused counts for nothing else; bytes thrown away
    were carried too."""
    fetched = ~reused
    of = lambda c: F.sum(F.when(fetched, F.coalesce(c, F.lit(0))).otherwise(0)).cast("long")
    taken_up = F.least(size, F.coalesce(resumed, F.lit(0)))
    many = F.coalesce(segments, F.lit(0)) > 1
    fallbacks = F.coalesce(F.size(discarded), F.lit(0))
    lost = F.coalesce(F.aggregate(discarded, F.lit(0).cast("long"), lambda a, b: a + F.coalesce(b, F.lit(0)).cast("long")), F.lit(0))
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("n_items"),
        F.count_if(fetched).alias("n_fetched"),
        F.count_if(reused).alias("n_reused"),
        F.coalesce(F.sum(F.when(reused, size)), F.lit(0)).cast("long").alias("reused_bytes"),
        of(taken_up).alias("resumed_bytes"),
        of(size - taken_up + lost).alias("network_bytes"),
        of(attempts).alias("attempts"),
        F.count_if(fetched & many).alias("n_parallel"),
        of(F.when(many, segments)).alias("parallel_segments"),
        F.count_if(fetched & (fallbacks > 0)).alias("n_fallback_items"),
        of(fallbacks).alias("n_fallbacks"),
        of(lost).alias("discarded_bytes"),
        *(F.count_if(fetched & (method == m)).alias(f"n_{m}") for m in methods),
        seconds.alias("seconds"),
    )
    return sums.withColumn("network_rate", rate(F.col("network_bytes"), F.col("seconds")))


def plan_stats(parts: DataFrame, descriptors: DataFrame, *, keys: list[str], artifacts: Column, descriptor_bytes: Column) -> DataFrame:
    """Parts and their artifacts (a part without a list has none), and descriptors with their bytes."""
    planned = parts.groupBy(*keys).agg(F.count("*").alias("n_parts"), F.sum(F.coalesce(F.size(artifacts), F.lit(0))).alias("n_artifacts"))
    described = descriptors.groupBy(*keys).agg(F.count("*").alias("n_descriptors"), F.sum(descriptor_bytes).cast("long").alias("descriptor_bytes"))
    none = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_descriptors", "descriptor_bytes")]
    return planned.join(described, keys, "left").select(*keys, "n_parts", "n_artifacts", *none)


def output_stats(files: DataFrame, *, keys: list[str], size: Column, plain: Column | None = None, diagnostics: Column | None = None, libraries: Column | None = None, seconds: Column | None = None) -> DataFrame:
    """What a transforming or verifying stage put out: files and bytes; as far as given, files passed through as
    they were and transformed ones, diagnostics, different libraries, and bytes a second."""
    aggregates = [F.count("*").alias("n_files"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("output_bytes")]
    if plain is not None:
        aggregates += [F.count_if(plain).alias("n_plain"), F.count_if(F.coalesce(~plain, F.lit(True))).alias("n_transformed")]
    if diagnostics is not None:
        aggregates.append(F.sum(F.coalesce(F.size(diagnostics), F.lit(0))).alias("n_diagnostics"))
    if libraries is not None:
        aggregates.append(F.count_distinct(libraries).alias("n_libraries"))
    if seconds is None:
        return files.groupBy(*keys).agg(*aggregates)
    sums = files.groupBy(*keys).agg(*aggregates, seconds.alias("seconds"))
    return sums.withColumn("output_rate", rate(F.col("output_bytes"), F.col("seconds")))


def record_stats(manifests: DataFrame, *, keys: list[str], kind: str, kinds: list[str], records: Column, seconds: Column) -> DataFrame:
    """Records of each kind of manifest, of all, and records a second; null unless every kind is there."""
    each = [F.sum(F.when(F.col(kind) == k, records)).cast("long").alias(f"{k}_records") for k in kinds]
    sums = manifests.groupBy(*keys).agg(*each, F.count_distinct(F.when(F.col(kind).isin(*kinds), F.col(kind))).alias("n_kinds"), seconds.alias("seconds"))
    whole = F.col("n_kinds") == len(kinds)
    total = F.when(whole, sum((F.col(f"{k}_records") for k in kinds[1:]), F.col(f"{kinds[0]}_records")))
    return sums.withColumn("records", total).withColumn("records_rate", rate(F.col("records"), F.col("seconds"))).drop("n_kinds")


def active_seconds(stages: DataFrame, *, run: str, seconds: Column) -> DataFrame:
    """Sum of the durations of a run's stages; one that has none counts 0."""
    return stages.groupBy(run).agg(F.sum(F.coalesce(seconds, F.lit(0))).alias("active_seconds"))


def pivot_counts(rows: DataFrame, *, keys: list[str], column: str, values: list[str]) -> DataFrame:
    """A count for each value of a column, and of all rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), *(F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values))


def conflict_stats(resolved: DataFrame, keys: list[str]) -> DataFrame:
    """Entries, candidates, conflicts (entries with several) and ambiguous entries."""
    return resolved.groupBy(*keys).agg(
        F.count("*").alias("n_entries"),
        F.sum("n_candidates").alias("n_candidates"),
        F.count_if(F.col("n_candidates") > 1).alias("n_conflicts"),
        F.count_if(F.col("rule") == "ambiguous").alias("n_ambiguous"),
    )


def roll_up_runs(stages: DataFrame, *, run: str, order: str, state: str, done: Column) -> DataFrame:
    """The prefix of finished stages of each run, and its first other stage, without sorting a run.

    completed: stages before the first that is not done; current_state: that stage's state, or succeeded.
    """
    stop = stages.groupBy(run).agg(F.min(F.when(~done, F.struct(F.col(order).alias("at"), F.col(state).alias("state")))).alias("stop"))
    both = stages.select(run, order).join(stop, run)
    before = F.col("stop").isNull() | (F.col(order) < F.col("stop.at"))
    return both.groupBy(run).agg(
        F.count_if(before).alias("completed"), F.count("*").alias("n_stages"), F.coalesce(F.first("stop.state"), F.lit("succeeded")).alias("current_state")
    )


def clipped_seconds(start: Column, end: Column, now: Column) -> Column:
    """Duration of a stage, an open end counting until now, never below 0, to 3 decimals."""
    return F.bround(F.greatest(F.lit(0.0), F.coalesce(end, now).cast("double") - start.cast("double")), 3)


def counter_rates(samples: DataFrame, *, keys: list[str], time: Column, counter: str, bucket_seconds: int) -> DataFrame:
    """Growth of a cumulative counter in each bucket of time, its rate, and how often it was reset.

    Growth is the sum of the rises from sample to sample; after a fall the counter began anew from 0, so its value counts
    whole. Samples are read in order of time, equal times in order of value.
    """
    at = time.cast("timestamp").cast("long")
    bucket = F.floor(at / bucket_seconds) * bucket_seconds
    own = samples.select(*keys, bucket.alias("bucket"), at.alias("_at"), F.col(counter).alias("_value"))
    before = F.lag("_value").over(Window.partitionBy(*keys, "bucket").orderBy("_at", "_value"))
    own = own.withColumn("_rise", F.when(F.col("_value") < before, F.col("_value")).otherwise(F.col("_value") - before)).withColumn("_reset", F.col("_value") < before)
    sums = own.groupBy(*keys, "bucket").agg(
        F.count("*").alias("n_samples"), F.coalesce(F.sum("_rise"), F.sum("_value") * 0).alias("growth"), (F.max("_at") - F.min("_at")).alias("seconds"), F.count_if("_reset").alias("n_resets")
    )
    return sums.withColumn("growth_rate", rate(F.col("growth"), F.col("seconds")))


def usage_percent(samples: DataFrame, *, keys: list[str], order: str, busy: str, total: str) -> DataFrame:
    """Share of a busy counter in a total one between neighbouring samples, in percent."""
    w = Window.partitionBy(*keys).orderBy(order)
    delta = lambda c: F.col(c) - F.lag(c).over(w)
    deltas = samples.select(*keys, order, delta(busy).alias("busy"), delta(total).alias("total")).where("total IS NOT NULL")
    return deltas.select(*keys, order, F.when(F.col("total") > 0, F.round(100 * F.col("busy") / F.col("total"), 3)).alias("percent"))


def two_level_greatest(rows: DataFrame, *, outer: list[str], inner: list[str], one: Column, other: Column) -> DataFrame:
    """For each outer key the sum over inner keys of the greater of two sums."""
    inner_sums = rows.groupBy(*outer, *inner).agg(F.sum(one).alias("one"), F.sum(other).alias("other"))
    return inner_sums.groupBy(*outer).agg(F.sum(F.greatest("one", "other")).alias("needed"))
