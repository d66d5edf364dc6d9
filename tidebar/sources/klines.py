"""Scan of an archive of daily kline files whose layout and schema vary by day."""

from __future__ import annotations

import uuid
from collections import Counter
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebar.functions.scalars import parse_instant, parse_text, text_forms, text_stem, utc_day_number
from tidebar.schema import (
    MILLIS_THRESHOLD,
    PRICE_COLS,
    TAKER_ALIASES,
    TICK_COLS,
    TIME_ALIASES,
    VOLUME_ALIASES,
)
from tidebar.session import materialize, use_utc
from tidebar.sources.footers import KNOWN_COLS, read_footers
from tidebar.sources.layout import SYMBOL, day_files, day_glob, pick_layout, root_pattern
from tidebar.sources.normalize import (
    MISSING_MESSAGE,
    NO_TIME_MESSAGE,
    epoch_counts,
    instant_of,
    is_epoch,
    tick_columns,
    unit_of,
)

DAY = ["symbol", "day"]
# Terms of a filter on folders.
_MOST_RUNS = 500
_TICKS = (
    "symbol string, source_day date, ts timestamp, open double, high double, low double, "
    "close double, volume double, taker_base double"
)


class KlineScan(NamedTuple):
    """Raw rows as ticks, those without an instant too; `inputs` (symbol, day, n_files, n_rows)
    of every day that has files; `rejected` (symbol, day, error) of the days that cannot be read
    as klines; `texts` (symbol, day, n_texts) of the days whose instants are texts, by what their
    footers say.

    Pages that cannot be decoded give no rows instead of ending the run: where fewer rows come
    than `inputs` promises, the day is damaged (`short_days`)."""

    rows: DataFrame
    inputs: DataFrame
    rejected: DataFrame
    texts: DataFrame

    @property
    def ticks(self) -> DataFrame:
        """The rows to compute with."""
        return self.rows.where("ts IS NOT NULL")


def short_days(scan: KlineScan, met: DataFrame) -> DataFrame:
    """(symbol, day, error) of the days of which fewer rows came, by `met` (symbol, source_day,
    n_rows), than their footers promise; days that were rejected before any reading are none."""
    met = met.select("symbol", F.col("source_day").alias("day"), F.col("n_rows").alias("n_met"))
    known = scan.inputs.join(scan.rejected, DAY, "left_anti").join(met, DAY, "left")
    lost = F.col("n_rows") - F.coalesce("n_met", F.lit(0))
    error = F.concat(F.lit("damaged files: "), lost, F.lit(" of "), "n_rows", F.lit(" rows cannot be read"))
    return known.where(lost > 0).select(*DAY, error.alias("error"))


class _Archive(NamedTuple):
    root: str
    symbols: list[str]
    start: date
    end: date
    files: DataFrame
    scratch: str


def scan_klines(
    spark: SparkSession,
    root: str,
    symbols: list[str],
    start: date,
    end: date,
    scratch: str,
) -> KlineScan:
    """Ticks of all source days in `[start, end]`.

    `root` is the folder of the daily folders; with `{symbol}` in it, one scan serves many
    symbols. File facts are settled first, on a table of footers kept under `scratch`;
    days of equal schema and time unit are then read together, so the plan has one branch
    per distinct schema, no matter how many days or symbols there are.
    """
    use_utc(spark)
    files = materialize(day_files(spark, root, symbols, start, end), f"{scratch}/files")
    chosen = pick_layout(files)
    footers = materialize(read_footers(chosen, files.count()), f"{scratch}/footers")
    archive = _Archive(root, symbols, start, end, files, scratch)

    inputs = footers.groupBy(*DAY).agg(
        F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows")
    )
    broken = footers.groupBy(*DAY).agg(F.min("unreadable").alias("error")).where("error IS NOT NULL")
    n_broken, n_files = footers.agg(F.count("unreadable"), F.count("*")).first()
    if n_files and n_broken == n_files:
        raise OSError(broken.first().error)
    readable = materialize(_with_picks(footers).join(broken, DAY, "left_anti"), f"{scratch}/readable")
    error = F.when(F.col("mode") == "none", NO_TIME_MESSAGE).when(
        F.col("missing") != "", F.concat(F.lit(MISSING_MESSAGE), "missing")
    )
    judged = readable.join(_time_modes(archive, readable), DAY).withColumn("error", error)
    judged = materialize(judged, f"{scratch}/judged")
    rejected = judged.where("error IS NOT NULL").select(*DAY, "error").distinct()
    good = judged.where("error IS NULL")
    ticks = _read_ticks(archive, good)
    return KlineScan(ticks, inputs, rejected.unionByName(broken), _texts(good))


def _texts(good: DataFrame) -> DataFrame:
    """Number of non-null texts in the time column of each day that is read by one."""
    used = F.when(F.col("mode") == "ts", F.lit("ts")).otherwise(F.col("alt_col"))
    column = F.get(F.filter("cols", lambda x: x["name"] == used), F.lit(0))
    texts = good.select(*DAY, "n_rows", column.alias("time")).where("time.type LIKE '%string'")
    n = F.sum(F.coalesce(F.col("time.n"), F.col("n_rows")))
    return texts.groupBy(*DAY).agg(n.alias("n_texts")).where("n_texts > 0")


def _with_picks(footers: DataFrame) -> DataFrame:
    """Add each day's column picks and missing columns to its files, leaving out days
    without rows.

    Presence counts per day: a name that any file of the day carries is present.
    """

    def first_present(names):
        return F.coalesce(*[F.when(F.col(f"has_{n}"), F.lit(n)) for n in names])

    has = [F.bool_or(F.array_contains("cols.name", c)).alias(f"has_{c}") for c in KNOWN_COLS]
    lacking = [F.when(~F.col(f"has_{c}"), F.lit(c)) for c in PRICE_COLS]
    lacking.append(F.when(first_present(VOLUME_ALIASES).isNull(), F.lit("volume")))
    days = (
        footers.groupBy(*DAY)
        .agg(F.sum("n_rows").alias("_rows"), *has)
        .where("_rows > 0")
        .select(
            *DAY,
            "has_ts",
            first_present(TIME_ALIASES).alias("alt_col"),
            first_present(VOLUME_ALIASES).alias("volume_col"),
            first_present(TAKER_ALIASES).alias("taker_col"),
            F.concat_ws(", ", *lacking).alias("missing"),
        )
    )
    return footers.where("n_rows > 0").join(days, DAY)


_TYPED = "^(timestamp|date|int|uint)"
_COUNTED = "^(int|uint|float|double|halffloat|decimal)"


def _time_modes(archive: _Archive, readable: DataFrame) -> DataFrame:
    """Per day `mode`: `ts`, or for the alias column `s`, `ms` or `parsed`, or `none`; and
    `form`, that of the texts it goes by.

    Footers decide wherever they can. Days they leave open (text columns, no statistics,
    a range that straddles the threshold) have their time columns read.
    """

    def col_facts(name):
        return F.get(F.filter("cols", lambda x: x["name"] == name), F.lit(0))

    facts = readable.select(
        *DAY,
        "has_ts",
        "alt_col",
        col_facts(F.lit("ts")).alias("_ts"),
        col_facts(F.col("alt_col")).alias("_alt"),
    )
    ts_sure = F.col("_ts.type").rlike(_TYPED) & F.col("_ts.n").isNotNull()
    alt_numeric = F.col("_alt.type").rlike(_COUNTED)
    alt_blank = F.coalesce(F.col("_alt.n") == 0, F.lit(False))
    is_text = F.coalesce(F.col("_ts.type").like("%string"), F.lit(False)), F.coalesce(F.col("_alt.type").like("%string"), F.lit(False))
    per_day = facts.groupBy(*DAY, "has_ts", "alt_col").agg(
        F.bool_or(ts_sure & (F.col("_ts.n") > 0)).alias("ts_yes"),
        F.bool_and(F.coalesce((ts_sure | (F.col("_ts.n") == 0)), F.col("_ts").isNull())).alias(
            "ts_known"
        ),
        F.bool_or(alt_numeric).alias("numeric"),
        F.bool_or(is_text[0]).alias("ts_text"),
        F.bool_or(is_text[1]).alias("alt_text"),
        F.bool_and(
            F.coalesce(alt_blank | (F.col("_alt.lo") > MILLIS_THRESHOLD), F.col("_alt").isNull())
        ).alias("all_ms"),
        F.bool_and(
            F.coalesce(alt_blank | (F.col("_alt.hi") <= MILLIS_THRESHOLD), F.col("_alt").isNull())
        ).alias("all_s"),
    )
    yes = F.coalesce(F.col("ts_yes"), F.lit(False))
    # An all-blank epoch column passes both tests and counts as seconds.
    alias_mode = (
        F.when(F.col("alt_col").isNull(), "none")
        .when(~F.col("numeric"), "parsed")
        .when(F.col("all_s"), "s")
        .when(F.col("all_ms"), "ms")
    )
    settled = per_day.select(
        *DAY,
        "ts_text",
        "alt_text",
        F.when(F.col("has_ts") & yes, "ts")
        .when(F.col("has_ts") & ~F.col("ts_known"), None)
        .otherwise(alias_mode)
        .alias("mode"),
    )
    is_open = F.col("mode").isNull() | F.col("ts_text") | (F.col("alt_text") & (F.col("mode") == "parsed"))
    open_days = settled.where(is_open).select(*DAY)
    known = settled.where(~is_open).select(*DAY, "mode", F.lit(None).cast("string").alias("form"))
    if open_days.isEmpty():
        return known

    stems = _stems(archive, readable.join(open_days, DAY))
    sums = [F.sum("n_epoch"), F.sum("n_above"), F.max("low"), F.min("high")]
    measured = (
        per_day.join(open_days, DAY)
        .select(*DAY, "alt_col", "numeric")
        .join(stems.groupBy(*DAY).agg(F.bool_or("typed").alias("typed"), unit_of(*sums).alias("unit")), DAY, "left")
        .join(_voted(stems, "ts_stem", "ts_form"), DAY, "left")
        .join(_voted(stems, "alt_stem", "alt_form"), DAY, "left")
    )
    by_ts = F.coalesce("typed", F.lit(False)) | F.col("ts_form").isNotNull()
    mode = (
        F.when(by_ts, "ts")
        .when(F.col("alt_col").isNull(), "none")
        .when(~F.col("numeric"), "parsed")
        .otherwise(F.coalesce("unit", F.lit("s")))
    )
    form = F.when(by_ts, F.col("ts_form")).when(mode == "parsed", F.col("alt_form"))
    return known.unionByName(measured.select(*DAY, mode.alias("mode"), form.alias("form")))


def _stems(archive: _Archive, pending: DataFrame) -> DataFrame:
    """What the time columns of the pending days hold, in a row per day and stem of their
    texts, of which a day has few; a table."""
    facts = _read_groups(archive, pending, [], _time_columns)
    counts = zip(("n_epoch", "n_above", "low", "high"), epoch_counts(F.col("epoch")), strict=True)
    stems = facts.groupBy(*DAY, "ts_stem", "alt_stem").agg(
        F.count("*").alias("n"), F.bool_or(F.col("ts").isNotNull()).alias("typed"), *[c.alias(n) for n, c in counts]
    )
    return materialize(stems, f"{archive.scratch}/stems")


def _voted(stems: DataFrame, stem: str, out: str) -> DataFrame:
    """The form of each day's texts: the one by which most are instants of the day, then of
    the day or a day beside it, as zones may shift them, then of any day."""
    own = stems.where(F.col(stem).isNotNull()).groupBy(*DAY, stem).agg(F.sum("n").alias("n"))
    tried = own.select(*DAY, "n", F.explode(text_forms(F.col(stem))).alias("try"))
    off = F.abs(utc_day_number(F.col("try.instant")) - F.unix_date("day"))
    votes = tried.groupBy(*DAY, F.col("try.rank").alias("rank"), F.col("try.form").alias("form")).agg(
        F.sum(F.when(off == 0, F.col("n")).otherwise(0)).alias("exact"),
        F.sum(F.when(off <= 1, F.col("n")).otherwise(0)).alias("near"),
        F.sum("n").alias("every"),
    )
    best = F.max_by("form", F.struct("exact", "near", "every", -F.col("rank"), "form"))
    return votes.groupBy(*DAY).agg(best.alias(out))


def _time_columns(raw: DataFrame, group: Row, dtypes: dict[str, T.DataType]) -> DataFrame:
    """Typed `ts`, epoch counts, and the stems of texts."""
    none, alt = F.lit(None), group.alt_col

    def stem(name: str | None) -> Column:
        return text_stem(F.col(name)) if isinstance(dtypes.get(name), T.StringType) else none.cast("string")

    typed = "ts" in dtypes and not isinstance(dtypes["ts"], T.StringType)
    ts = parse_instant(F.col("ts"), dtypes["ts"]) if typed else none.cast("timestamp")
    counted = alt in dtypes and is_epoch(dtypes[alt])
    epoch = F.col(alt).cast("double") if counted else none.cast("double")
    return raw.select(
        *DAY, ts.alias("ts"), epoch.alias("epoch"), stem("ts").alias("ts_stem"), stem(alt).alias("alt_stem")
    )


def _tick_rows(raw: DataFrame, group: Row, dtypes: dict[str, T.DataType]) -> DataFrame:
    name = "ts" if group.mode == "ts" else group.alt_col
    if name in dtypes:
        unit = group.mode if group.mode in ("s", "ms") else None
        text = isinstance(dtypes[name], T.StringType)
        ts = parse_text(F.col(name), group.form) if text else instant_of(name, dtypes[name], unit)
    else:
        ts = F.lit(None).cast("timestamp")
    return raw.select(
        "symbol",
        F.col("day").alias("source_day"),
        ts.alias("ts"),
        *tick_columns(dtypes, group.volume_col, group.taker_col),
    )


def _read_ticks(archive: _Archive, good: DataFrame) -> DataFrame:
    ticks = _read_groups(archive, good, ["mode", "form"], _tick_rows)
    if ticks is None:
        return good.sparkSession.createDataFrame([], _TICKS)
    return ticks.select(*TICK_COLS)


def _read_groups(archive: _Archive, files: DataFrame, by: list[str], shape) -> DataFrame | None:
    """Read files of equal picks, physical types and kind of folder together."""
    spark = files.sparkSession
    picked = F.array("alt_col", "volume_col", "taker_col", F.lit("ts"), *map(F.lit, PRICE_COLS))
    used = F.filter("cols", lambda c: F.array_contains(F.array_compact(picked), c["name"]))
    described = F.transform(used, lambda c: F.concat_ws(":", c["name"], c["type"]))
    key = [
        F.least("layout", F.lit(3)).alias("kind"),
        "alt_col",
        "volume_col",
        "taker_col",
        *by,
        F.array_join(F.array_sort(described), ",").alias("types"),
    ]
    names = ["kind", "alt_col", "volume_col", "taker_col", *by, "types"]
    keyed = files.select("path", "dir", *DAY, *key).withColumn("group", F.to_json(F.struct(*names)))
    groups = (
        keyed.groupBy("group", *names)
        .agg(F.min("path").alias("sample"), F.count("*").alias("n_files"))
        .orderBy(*names)
    )
    # One entry per distinct schema, not per file.
    listed = groups.collect()
    in_folders = _folder_counts(archive) if listed else {}
    whole = [g for g in listed if g.kind in in_folders and g.n_files == in_folders[g.kind].n]
    runs, paths = _parts(archive, keyed, in_folders) if len(whole) < len(listed) else ({}, {})

    pieces = []
    for group in listed:
        parts = [_Part()]
        if group not in whole:
            parts = [_Part(runs=runs[group.group])] if group.group in runs else []
            parts += [_Part(paths=paths[group.group])] if group.group in paths else []

        def read(group=group, parts=parts) -> DataFrame:
            wanted = {t.split(":", 1)[0] for t in group.types.split(",") if t}
            schema = spark.read.parquet(group.sample).schema
            fields = [f for f in schema.fields if f.name in wanted]
            raws = [_load(archive, group.kind, fields, part) for part in parts]
            raw = raws[0] if len(raws) == 1 else raws[0].unionByName(raws[1])
            return shape(raw, group, {f.name: f.dataType for f in fields})

        if "timestamp[ns" in group.types:
            pieces.append(_with_nanos(spark, read, f"{archive.scratch}/nanos-{uuid.uuid4().hex}"))
        else:
            pieces.append(read())
    if not pieces:
        return None
    out = pieces[0]
    for piece in pieces[1:]:
        out = out.unionByName(piece)
    return out


def _with_nanos(spark: SparkSession, read, path: str) -> DataFrame:
    """`read()` with nanosecond instants as integers, which takes a setting of the session:
    computed while it holds, kept at `path`, and the setting put back."""
    name = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        return materialize(read(), path)
    finally:
        spark.conf.set(name, before)


class _Part(NamedTuple):
    """What of a group is read at once: files and folders by name, runs of daily folders, or,
    with neither, all folders of its kind."""

    paths: list[str] | None = None
    runs: list[Row] | None = None


def _folder_kind() -> Column:
    return F.when(F.col("layout").isin(1, 4), 1).when(F.col("layout").isin(2, 5), 2)


def _folder_counts(archive: _Archive) -> dict[int, Row]:
    """All `date=` (1) and all `dt=` (2) folders: how many files lie below them, at any depth,
    and whether any lies deep."""
    kinds = archive.files.groupBy(_folder_kind().alias("kind"))
    counts = kinds.agg(F.count("*").alias("n"), F.max("layout").alias("deepest")).collect()
    return {r.kind: r for r in counts if r.kind}


def _is_hive(archive: _Archive, kind: int) -> bool:
    """Whether folders of the kind give both symbol and day as partition columns."""
    return kind in (1, 2) and (SYMBOL not in archive.root or archive.root.split(SYMBOL)[0].endswith("/symbol="))


def _parts(
    archive: _Archive, keyed: DataFrame, in_folders: dict[int, Row]
) -> tuple[dict[str, list[Row]], dict[str, list[str]]]:
    """Per group the runs of its hive folders, and the paths of the rest: folders all of whose
    files belong to it, else the files themselves.

    A run (lo, hi, symbols) holds every folder that these symbols have between two days, so its
    folders are found by a filter on partition columns. There are as many as schemas change, not
    as there are days. A group that changes more than `_MOST_RUNS` times, for which a filter is
    no use, gives its folders by name; so do kinds of folders with folders below, which
    Spark would take for more partition columns.
    """
    totals = archive.files.groupBy("dir").agg(F.count("*").alias("_all"))
    folders = (
        keyed.groupBy("group", "kind", *DAY, "dir")
        .agg(F.count("*").alias("_mine"))
        .join(totals, "dir")
        .where("_mine = _all")
    )
    flat = [k for k, found in in_folders.items() if _is_hive(archive, k) and found.deepest == k]
    runs = _runs(archive, folders.where(F.col("kind").isin(flat))).collect()
    in_runs = [g for g, n in Counter(r.group for r in runs).items() if n <= _MOST_RUNS]
    by_run: dict[str, list[Row]] = {g: [] for g in in_runs}
    for run in runs:
        if run.group in by_run:
            by_run[run.group].append(run)

    path = F.when(F.col("_whole"), F.col("dir")).otherwise(F.col("path")).alias("p")
    left = (
        keyed.join(folders.select("dir", F.lit(True).alias("_whole")), "dir", "left")
        .where(~(F.coalesce("_whole", F.lit(False)) & F.col("group").isin(in_runs)))
        .select("group", path)
        .distinct()
    )
    by_path: dict[str, list[str]] = {}
    for row in left.collect():
        by_path.setdefault(row.group, []).append(row.p)
    return by_run, {group: sorted(paths) for group, paths in by_path.items()}


def _runs(archive: _Archive, folders: DataFrame) -> DataFrame:
    """group, lo, hi, symbols: days that follow each other among a symbol's folders of a kind,
    equal runs of many symbols in one row."""
    places = Window.partitionBy("symbol", "kind").orderBy("day")
    every = archive.files.select(*DAY, _folder_kind().alias("kind")).where("kind IS NOT NULL").distinct()
    own = Window.partitionBy("group", "symbol").orderBy("day")
    run = F.col("_place") - F.row_number().over(own)
    return (
        folders.join(every.withColumn("_place", F.row_number().over(places)), [*DAY, "kind"])
        .select("group", *DAY, run.alias("_run"))
        .groupBy("group", "symbol", "_run")
        .agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
        .groupBy("group", "lo", "hi")
        .agg(F.sort_array(F.collect_list("symbol")).alias("symbols"))
        .orderBy("group", "lo", "hi")
    )


def _within(runs: list[Row], symbols: list[str]) -> Column:
    """Whether symbol and day lie in one of the runs; halved, so that the condition stays flat."""
    if len(runs) > 1:
        half = len(runs) // 2
        return _within(runs[:half], symbols) | _within(runs[half:], symbols)
    days = F.col("day").between(F.lit(runs[0].lo), F.lit(runs[0].hi))
    return days if set(symbols) <= set(runs[0].symbols) else F.col("symbol").isin(runs[0].symbols) & days


def _load(archive: _Archive, kind: int, fields: list[T.StructField], part: _Part) -> DataFrame:
    """Rows with `symbol` and `day`. Hive-style folders give both as partition columns,
    which cost nothing per row; other folders have them cut from the file's path."""
    spark = archive.files.sparkSession
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("ignoreCorruptFiles", True)
    head = archive.root.split(SYMBOL)[0] if SYMBOL in archive.root else None
    paths = part.paths
    if _is_hive(archive, kind):
        name = {1: "date", 2: "dt"}[kind]
        schema = T.StructType(list(fields)).add(name, T.DateType())
        base = archive.root.rstrip("/")
        if head is not None:
            schema = schema.add("symbol", T.StringType())
            base = head[: -len("/symbol=")]
        if paths is None:
            paths = [
                day_glob(archive.root, archive.symbols, archive.start, archive.end, f"{name}=")
            ]
        raw = reader.schema(schema).option("basePath", base).parquet(*paths)
        symbol = F.lit(archive.symbols[0]) if head is None else F.col("symbol")
        raw = raw.select(symbol.alias("symbol"), F.col(name).alias("day"), *[f.name for f in fields])
        raw = raw.where(F.col("day").between(F.lit(archive.start), F.lit(archive.end)))
        return raw.where(_within(part.runs, archive.symbols)) if part.runs else raw

    globbed = paths is None
    if globbed:
        name = {1: "date=", 2: "dt="}[kind]
        paths = [day_glob(archive.root, archive.symbols, archive.start, archive.end, name)]
    raw = (
        reader.schema(T.StructType(fields)).option("recursiveFileLookup", True).parquet(*paths)
    )
    path = F.url_decode(F.col("_metadata.file_path"))
    pattern = f"{root_pattern(archive.root)}/(?:date=|dt=|)(\\d{{4}}-\\d{{2}}-\\d{{2}})/"
    symbol = F.lit(archive.symbols[0])
    day_at = 1
    if SYMBOL in archive.root:
        symbol, day_at = F.regexp_extract(path, pattern, 1), 2
    raw = raw.select(
        symbol.alias("symbol"),
        F.regexp_extract(path, pattern, day_at).cast("date").alias("day"),
        *[f.name for f in fields],
    )
    # Chosen paths lie in the wanted days; what a glob matches may not.
    return raw.where(F.col("day").between(F.lit(archive.start), F.lit(archive.end))) if globbed else raw
