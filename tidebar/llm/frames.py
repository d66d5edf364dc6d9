"""Arrow batches over tables whose other columns pass through, whatever their names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def map_batches(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    added: list[T.StructField] = (),
) -> DataFrame:
    """`df` through `work`, which keeps the columns and appends those of `added`.

    Columns of `df` that bear a name of `added` are left out first. Inside, columns have
    numbers for names, so that dots and the like in names do no harm.
    """
    gone = {f.name for f in added}
    kept = [f for f in df.schema.fields if f.name not in gone]
    if len(kept) < len(df.columns):
        df = df.drop(*gone)
    inner = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate([*kept, *added])]
    plain = df.toDF(*(f"c{i}" for i in range(len(kept))))
    return plain.mapInArrow(work, T.StructType(inner)).toDF(*(f.name for f in [*kept, *added]))


def place(df: DataFrame, name: str, added: tuple[str, ...] = ()) -> int:
    """The number of column `name` within `map_batches`, where `added` are left out."""
    return [c for c in df.columns if c not in added].index(name)


def appended(batch: pa.RecordBatch, *columns: pa.Array) -> pa.RecordBatch:
    for column in columns:
        batch = batch.append_column(f"c{batch.num_columns}", column)
    return batch
