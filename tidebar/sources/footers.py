"""Parquet footers as a table: row counts, column names, types and time ranges."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from tidebar.schema import (
    PRICE_COLS,
    TAKER_ALIASES,
    TIME_ALIASES,
    VOLUME_ALIASES,
)
from tidebar.sources.stores import system_of

KNOWN_COLS = ["ts", *TIME_ALIASES, *PRICE_COLS, *VOLUME_ALIASES, *TAKER_ALIASES]
_FILES_PER_TASK = 32
UNREADABLE_MESSAGE = "unreadable file "


def _said(e: Exception) -> str:
    """The first line of what an exception says, or its kind."""
    return (str(e).splitlines() or [type(e).__name__])[0][:200]


def read_footers(files: DataFrame, n_files: int) -> DataFrame:
    """Add `n_rows`, `cols` and `unreadable` to a file listing: of each known column its
    name, Arrow type, and, where the footer tells, its number of values and numeric range.
    A file whose footer cannot be read has no rows and columns, and says why.

    Lets schemas be settled, and most days' time units too, without reading any data.
    Footers are fetched by tasks; only the fetching itself is Python.
    """
    known = set(KNOWN_COLS)

    def fetch(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        def describe(meta, field, index: int) -> dict:
            groups = [meta.row_group(g).column(index) for g in range(meta.num_row_groups)]
            stats = [c.statistics for c in groups if c.num_values]
            out = {"name": field.name, "type": str(field.type), "n": None, "lo": None, "hi": None}
            if all(s is not None and s.has_null_count for s in stats):
                out["n"] = meta.num_rows - sum(s.null_count for s in stats)
            if pa.types.is_integer(field.type) or pa.types.is_floating(field.type):
                valued = [s for s in stats if s is None or not s.has_null_count or s.num_values]
                if valued and all(s is not None and s.has_min_max for s in valued):
                    out["lo"] = float(min(s.min for s in valued))
                    out["hi"] = float(max(s.max for s in valued))
            return out

        for batch in batches:
            rows, cols, errors = [], [], []
            for path in batch["path"]:
                try:
                    system, inner = system_of(path)
                    with system.open_input_file(inner) as handle:
                        meta = pq.ParquetFile(handle).metadata
                except (OSError, pa.ArrowException) as e:
                    rows.append(0)
                    cols.append([])
                    errors.append(f"{UNREADABLE_MESSAGE}{path}: {_said(e)}")
                    continue
                errors.append(None)
                leaves = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
                rows.append(meta.num_rows)
                cols.append(
                    [
                        describe(meta, f, leaves[f.name])
                        for f in meta.schema.to_arrow_schema()
                        if f.name in known and f.name in leaves
                    ]
                )
            yield batch.assign(n_rows=rows, cols=cols, unreadable=errors)

    schema = files.schema.simpleString()[len("struct<") : -1] + (
        ",n_rows:bigint,cols:array<struct<name:string,type:string,n:bigint,lo:double,hi:double>>"
        ",unreadable:string"
    )
    tasks = max(1, -(-n_files // _FILES_PER_TASK))
    return files.repartition(tasks).mapInPandas(fetch, schema)
