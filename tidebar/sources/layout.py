"""Which files hold a day: a listing of daily folders under several layouts."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebar.sources.stores import files_below

# The layouts, in order of preference. A day takes the first that has any
# Parquet file; deeper files of a bare `D/` folder are never looked at.
LAYOUTS = {
    1: "date=D/*.parquet",
    2: "dt=D/*.parquet",
    3: "D/*.parquet",
    4: "date=D/**/*.parquet",
    5: "dt=D/**/*.parquet",
}

_FOLDERS = ["date=", "dt=", ""]
# A task lists this many folders, whatever the size of their files.
_FOLDERS_PER_TASK = 256

SYMBOL = "{symbol}"
_MANIFEST = "path string, length bigint, symbol string, day date, layout int, dir string"


def root_pattern(root: str) -> str:
    """Regex for what lies between a path's scheme and its daily folder; the `{symbol}`
    of a root becomes a group."""
    plain = re.sub(r"^[A-Za-z][\w+.-]*:/*", "", root).strip("/")
    return "(?:^|/)" + "([^/]+)".join(map(re.escape, plain.split(SYMBOL)))


def day_glob(root: str, symbols: list[str], start: date, end: date, prefixes: str) -> str:
    """Glob for the daily folders of `[start, end]`: whole months, and the days of others."""
    wanted, first = [], start.replace(day=1)
    while first <= end:
        after = (first + timedelta(days=31)).replace(day=1)
        if start <= first and after <= end + timedelta(days=1):
            wanted.append(f"{first:%Y-%m}-??")
        else:
            days = (first + timedelta(days=i) for i in range((after - first).days))
            wanted += [str(d) for d in days if start <= d <= end]
        first = after
    names = symbols[0] if len(symbols) == 1 else "{" + ",".join(symbols) + "}"
    return f"{root.rstrip('/').replace(SYMBOL, names)}/{prefixes}{{{','.join(wanted)}}}"


def check_root(root: str, symbols: list[str]) -> None:
    if not symbols:
        raise ValueError("no symbol given")
    if root.count(SYMBOL) > 1:
        raise ValueError(f"the input path may name {SYMBOL} once only: {root}")
    if SYMBOL not in root and len(symbols) > 1:
        raise ValueError(f"several symbols need {SYMBOL} in the input path: {root}")


def day_files(
    spark: SparkSession, root: str, symbols: list[str], start: date, end: date
) -> DataFrame:
    """Every Parquet file in a daily folder of `[start, end]`, whatever its layout."""
    check_root(root, symbols)
    base = root.rstrip("/")
    n_days = (end - start).days + 1
    folders = (
        spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}')) AS day")
        .select(F.explode(F.array(*map(F.lit, symbols))).alias("symbol"), "day")
        .select("*", F.explode(F.array(*map(F.lit, _FOLDERS))).alias("kind"))
        .select(
            "symbol",
            "day",
            "kind",
            F.concat(
                F.replace(F.lit(base), F.lit(SYMBOL), F.col("symbol")), F.lit("/"), "kind", F.col("day").cast("string")
            ).alias("dir"),
        )
    )
    tasks = -(-len(symbols) * n_days * len(_FOLDERS) // _FOLDERS_PER_TASK)
    return folders.repartition(max(1, tasks), "dir").mapInPandas(_listed, _MANIFEST)


def _listed(batches):
    """The files of each folder; a folder that is not there has none."""
    import pandas as pd

    for batch in batches:
        rows = []
        for symbol, day, kind, folder in batch.itertuples(index=False):
            for name, length in files_below(folder):
                layout = _layout_of(kind, "/" in name)
                rows.append((f"{folder}/{name}", length, symbol, day, layout, folder))
        yield pd.DataFrame(rows, columns=["path", "length", "symbol", "day", "layout", "dir"]).astype(
            {"layout": "Int32"}
        )


def _layout_of(kind: str, deep: bool) -> int | None:
    order = ["date=", "dt=", ""]
    if deep:
        return {"date=": 4, "dt=": 5}.get(kind)
    return 1 + order.index(kind)


def pick_layout(files: DataFrame) -> DataFrame:
    """Keep, for each symbol and day, the files of its first layout that has any."""
    found = files.where("layout IS NOT NULL")
    best = found.groupBy("symbol", "day").agg(F.min("layout").alias("layout"))
    return found.join(best, ["symbol", "day", "layout"]).select(*files.columns)
