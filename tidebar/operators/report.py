"""What became of each requested day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def requested_days(calendar: DataFrame, symbols: list[str]) -> DataFrame:
    names = F.array(*map(F.lit, symbols))
    return calendar.select(F.explode(names).alias("symbol"), "day")


def rows_per_day(df: DataFrame, day: str, out: str = "n_rows") -> DataFrame:
    return df.groupBy("symbol", day).agg(F.count("*").alias(out))


def _to_targets(facts: DataFrame, tail_days: int) -> DataFrame:
    """Each source day's facts once per target day whose history holds it."""
    shift = F.explode(F.sequence(F.lit(0), F.lit(tail_days)))
    return facts.select("*", shift.alias("_k")).select(
        "*", F.date_add("source_day", F.col("_k")).alias("day")
    )


def input_coverage(inputs: DataFrame, tail_days: int = 7) -> DataFrame:
    """`day:n_files` of every source day with files in a target day's history, in day
    order and comma joined, from (symbol, day, n_files)."""
    spread = _to_targets(inputs.withColumnRenamed("day", "source_day"), tail_days)
    # At most tail_days + 1 entries per group.
    entries = F.array_sort(F.collect_list(F.struct("source_day", "n_files")))
    text = F.transform(entries, lambda e: F.concat_ws(":", e["source_day"], e["n_files"]))
    return spread.groupBy("symbol", "day").agg(F.array_join(text, ",").alias("inputs"))


def day_outcomes(
    requested: DataFrame,
    bar_counts: DataFrame,
    inputs: DataFrame,
    rejected: DataFrame,
    tail_days: int = 7,
) -> DataFrame:
    """The run report: one row per requested (symbol, day).

    * `error`: a day of the history was rejected; the first such day gives the message.
    * `no_data`: no bar in the whole history.
    * `ok`: otherwise, with the day's own number of feature rows, which may be 0.

    Takes `bar_counts` (symbol, source_day, n_bars), `inputs` (symbol, day, n_files) and
    `rejected` (symbol, day, error).
    """
    keys = ["symbol", "day"]
    own = F.when(F.col("source_day") == F.col("day"), F.col("n_bars"))
    counts = (
        _to_targets(bar_counts, tail_days)
        .groupBy(*keys)
        .agg(F.sum("n_bars").alias("_n_history"), F.sum(own).alias("_n_own"))
    )
    errors = (
        _to_targets(rejected.withColumnRenamed("day", "source_day"), tail_days)
        .groupBy(*keys)
        .agg(F.min_by(F.concat_ws(": ", "source_day", "error"), "source_day").alias("error"))
    )
    status = (
        F.when(F.col("error").isNotNull(), "error")
        .when(F.col("_n_history") > 0, "ok")
        .otherwise("no_data")
    )
    return (
        requested.join(counts, keys, "left")
        .join(input_coverage(inputs, tail_days), keys, "left")
        .join(errors, keys, "left")
        .select(
            *keys,
            status.alias("status"),
            F.when(status == "ok", F.coalesce("_n_own", F.lit(0))).alias("n_feat_rows"),
            F.when(status != "error", F.coalesce("inputs", F.lit(""))).alias("inputs"),
            "error",
        )
    )


def status_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count("*").alias("n_days"))


def first_days(report: DataFrame, status: str, n: int) -> DataFrame:
    """The first `n` days of a status, in day order."""
    return report.where(F.col("status") == status).orderBy("day", "symbol").limit(n)
