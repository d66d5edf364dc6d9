"""Parquet output under `symbol=S/date=D/`, replacing only the keys written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebar.sources.stores import system_of


def write_daily(df: DataFrame, out: str, clustered: bool = False) -> None:
    """Write `df` (with `symbol`, `date`, `ts`) as one file per symbol and day.

    With `clustered` the caller vouches that each key lies in a single partition, and
    the rows are written where they are; else they are shuffled by key first.
    """
    if not clustered:
        df = df.repartition("symbol", "date")
    (
        df.sortWithinPartitions("symbol", "date", "ts")
        .write.partitionBy("symbol", "date")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(out)
    )


def write_empty_days(schema: str, out: str, keys: DataFrame) -> None:
    """Replace the keys (symbol, date) of a table by empty files: dynamic overwrite leaves
    keys without rows as they are, which would keep what an earlier run wrote.

    One job for all keys: tasks first put a new empty file into each folder, then remove
    the others, so that a task that is run again ends with the same folder.
    """
    plain = keys.sparkSession.createDataFrame([], schema).drop("symbol", "date").schema

    def empty(batches):
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        for batch in batches:
            done = [
                _emptied(day_path(out, symbol, day), to_arrow_schema(plain), pq)
                for symbol, day in batch.itertuples(index=False)
            ]
            yield batch[["symbol"]].assign(n=done)

    emptied = keys.select("symbol", F.col("date").cast("string")).repartition("symbol", "date")
    emptied.mapInPandas(empty, "symbol string, n bigint").agg(F.sum("n")).collect()


def _emptied(folder: str, schema, pq) -> int:
    """Make `folder` hold one empty file; the number of files removed."""
    from pyarrow import fs

    system, inner = system_of(folder)
    system.create_dir(inner, recursive=True)
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    name = f"{inner}/part-empty-{uuid.uuid4().hex}.parquet"
    with system.open_output_stream(name) as f:
        pq.write_table(schema.empty_table(), f)
    old = [x.path for x in found if x.is_file]
    for path in old:
        system.delete_file(path)
    return len(old)


def day_path(out: str, symbol: str, day) -> str:
    return f"{out.rstrip('/')}/symbol={symbol}/date={day}"
