"""The requested days."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession


def as_date(value: str | date) -> date:
    """The day of a date, an instant, or an ISO text of either."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value.date() if isinstance(value, datetime) else value


def calendar(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """Every day from `start` to `end`, both included, as column `day`."""
    start, end = as_date(start), as_date(end)
    if end < start:
        raise ValueError("the end date must not lie before the start date")
    return spark.sql(
        f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)) AS day"
    )
