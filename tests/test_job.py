"""Calendar, layouts, scan, report and the whole job over temporary folders."""

import glob
import os
import re
from datetime import date, datetime, timedelta

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidebar.operators.report import day_outcomes, first_days, requested_days, status_counts
from tidebar.operators.sink import write_daily
from tidebar.plans.cli import parse_args, summary_lines
from tidebar.plans.job import run_regime_features
from tidebar.schema import BAR_COLS, FEATURE_COLS, RegimeSpec
from tidebar.session import scratch_dir
from tidebar.sources.calendar import calendar
from tidebar.sources.klines import scan_klines
from tidebar.sources.layout import day_files, pick_layout

SPEC = RegimeSpec(short=3, day=6, week=30, min_short=2, min_day=3, min_week=10)
D0 = date(2024, 1, 1)


def day(k):
    return D0 + timedelta(days=k)


def klines(k, n=10, **replace):
    """n one-minute klines of day k as a pandas frame."""
    start = int(pd.Timestamp(day(k)).timestamp())
    price = [100.0 + (i * 7 + k) % 11 for i in range(n)]
    cols = {
        "open_time": [(start + 60 * i) * 1000 for i in range(n)],
        "open": price, "high": price, "low": price, "close": price,
        "volume": [1.0 + i for i in range(n)],
        "taker_buy_base_asset_volume": [0.5] * n,
    }
    cols.update(replace)
    return pd.DataFrame({k: v for k, v in cols.items() if v is not None})


def put(frame, *path, **options):
    os.makedirs(os.path.join(*path[:-1]), exist_ok=True)
    pq.write_table(pa.Table.from_pandas(frame, preserve_index=False), os.path.join(*path), **options)


def scan(spark, root, first=0, last=9, symbols=("A",)):
    return scan_klines(
        spark, str(root), list(symbols), day(first), day(last), scratch_dir(spark, "t")
    )


# --- calendar ---------------------------------------------------------------------


def test_calendar(spark):
    days = [r.day for r in calendar(spark, "2024-02-28", "2024-03-01").orderBy("day").collect()]
    assert days == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    assert calendar(spark, D0, D0).count() == 1
    with pytest.raises(ValueError):
        calendar(spark, "2024-01-02", "2024-01-01")


# --- layouts ----------------------------------------------------------------------


def test_layout_order(spark, tmp_path):
    f, r = klines(0, 1), str(tmp_path / "a b")
    put(f, r, f"date={day(0)}", "x.parquet")
    put(f, r, f"dt={day(0)}", "x.parquet")
    put(f, r, f"dt={day(1)}", "x.parquet")
    put(f, r, f"dt={day(1)}", "y.parquet")
    put(f, r, f"{day(1)}", "x.parquet")
    put(f, r, f"{day(2)}", "x.parquet")
    put(f, r, f"date={day(2)}", "h=0", "x.parquet")
    put(f, r, f"date={day(3)}", "h=0", "q=1", "x.parquet")
    put(f, r, f"dt={day(3)}", "h=0", "x.parquet")
    put(f, r, f"dt={day(4)}", "h=0", "x.parquet")
    put(f, r, f"{day(5)}", "h=0", "x.parquet")
    put(f, r, f"date={day(6)}", "x.parquet")
    put(f, r, f"date={day(6)}", "h=0", "x.parquet")
    put(f, r, f"date={day(7)}", "x.csv")
    put(f, r, "date=2023-12-31", "x.parquet")
    got = pick_layout(day_files(spark, r, ["A"], day(0), day(9)))
    seen = got.groupBy("day", "layout").count().orderBy("day").collect()
    assert [tuple(x) for x in seen] == [
        (day(0), 1, 1), (day(1), 2, 2), (day(2), 3, 1), (day(3), 4, 1), (day(4), 5, 1),
        (day(6), 1, 1),
    ]
    ticks = scan(spark, r).ticks.groupBy("source_day").count().orderBy("source_day").collect()
    # Files tell their day by the folder, whatever instants they hold.
    assert [tuple(x) for x in ticks] == [
        (day(0), 1), (day(1), 2), (day(2), 1), (day(3), 1), (day(4), 1), (day(6), 1),
    ]


def test_nothing_found(spark, tmp_path):
    assert day_files(spark, str(tmp_path / "none"), ["A"], day(0), day(1)).count() == 0
    found = scan(spark, tmp_path)
    assert found.ticks.count() == found.inputs.count() == found.rejected.count() == 0


def test_many_symbols_in_one_scan(spark, tmp_path):
    for s, k in (("A", 0), ("B-1", 0), ("B-1", 1), ("C", 0)):
        put(klines(k), str(tmp_path), f"symbol={s}", "interval=1s", f"date={day(k)}", "x.parquet")
    root = str(tmp_path / "symbol={symbol}" / "interval=1s")
    got = scan(spark, root, symbols=("A", "B-1")).ticks.groupBy("symbol", "source_day").count()
    assert sorted(tuple(r) for r in got.collect()) == [
        ("A", day(0), 10), ("B-1", day(0), 10), ("B-1", day(1), 10),
    ]
    with pytest.raises(ValueError):
        scan(spark, tmp_path, symbols=("A", "B"))


def test_symbol_in_a_plain_folder_name(spark, tmp_path):
    for s in "AB":
        put(klines(0), str(tmp_path), f"{s}_1s", f"date={day(0)}", "x.parquet")
        put(klines(1), str(tmp_path), f"{s}_1s", f"{day(1)}", "x.parquet")
    got = scan(spark, tmp_path / "{symbol}_1s", symbols=("A", "B")).ticks
    got = got.groupBy("symbol", "source_day").count()
    assert sorted(tuple(r) for r in got.collect()) == [
        (s, day(k), 10) for s in "AB" for k in (0, 1)
    ]


# --- schemas ----------------------------------------------------------------------


def test_schemas_of_a_day_are_resolved_together(spark, tmp_path):
    """A name any file of the day carries counts as present; the others give NULL."""
    r = str(tmp_path)
    put(klines(0, 2), r, f"date={day(0)}", "a.parquet")
    put(klines(0, 3, volume=None, base_volume=[5.0] * 3), r, f"date={day(0)}", "b.parquet")
    put(klines(1, 3, volume=None, base_volume=[5.0] * 3), r, f"date={day(1)}", "a.parquet")
    put(klines(2, 2, close=["1.5", "x"]), r, f"date={day(2)}", "a.parquet")
    got = scan(spark, r).ticks.groupBy("source_day").agg(
        F.count("*"), F.sum("volume"), F.count("close")
    )
    assert [tuple(x) for x in got.orderBy("source_day").collect()] == [
        (day(0), 5, 3.0, 5), (day(1), 3, 15.0, 3), (day(2), 2, 3.0, 1),
    ]


def test_time_columns_of_files(spark, tmp_path):
    r = str(tmp_path)
    ms = klines(0).open_time
    at = [pd.Timestamp(v, unit="ms") for v in ms]

    def shift(k):
        return [v + 86_400_000 * k for v in ms]

    put(klines(0, open_time=[v // 1000 for v in shift(0)]), r, f"date={day(0)}", "s.parquet")
    put(klines(1, open_time=[v * 1000 for v in shift(1)]), r, f"date={day(1)}", "us.parquet")
    # Nanosecond instants, with a conflicting epoch.
    frame = klines(2, open_time=[0] * 10)
    frame["ts"] = [t + pd.Timedelta(days=2) for t in at]
    put(frame, r, f"date={day(2)}", "ns.parquet", version="2.6")
    frame = klines(3)
    frame["ts"] = pd.Series([None] * 10, dtype="datetime64[us]")
    put(frame, r, f"date={day(3)}", "blank.parquet")
    frame = klines(4, open_time=None)
    frame["ts"] = [str(t + pd.Timedelta(days=4)) for t in at]
    put(frame, r, f"date={day(4)}", "text.parquet")
    frame = klines(5)
    frame["ts"] = ["?"] * 10
    put(frame, r, f"date={day(5)}", "bad_text.parquet")
    # No statistics, and values on both sides of the threshold.
    mixed = [v if i > 2 else v // 1000 for i, v in enumerate(shift(6))]
    put(klines(6, open_time=mixed), r, f"date={day(6)}", "x.parquet", write_statistics=False)
    put(klines(7, open_time=[float(v) for v in shift(7)]), r, f"date={day(7)}", "f.parquet")
    frame = klines(8, open_time=None)
    frame["startTime"] = [str(t + pd.Timedelta(days=8)) for t in at]
    put(frame, r, f"date={day(8)}", "alias_text.parquet")

    found = scan(spark, r)
    in_day = F.count_if(F.expr("CAST(ts AS date) = source_day"))
    got = found.ticks.groupBy("source_day").agg(F.count("*"), in_day).orderBy("source_day")
    assert [tuple(x) for x in got.collect()] == [
        (day(k), 10, 7 if k == 6 else 10) for k in (0, 2, 3, 4, 5, 6, 7, 8)
    ]
    assert found.rejected.count() == 0


def test_rejected_and_empty_days(spark, tmp_path):
    r = str(tmp_path)
    put(klines(0, close=None, low=None), r, f"date={day(0)}", "x.parquet")
    put(klines(1, open_time=None), r, f"date={day(1)}", "x.parquet")
    put(klines(2, volume=None), r, f"date={day(2)}", "x.parquet")
    frame = klines(3, open_time=None)
    frame["ts"] = ["?"] * 10
    put(frame, r, f"date={day(3)}", "x.parquet")
    put(klines(4, close=None).iloc[:0], r, f"date={day(4)}", "x.parquet")
    found = scan(spark, r)
    got = {x.day: x.error for x in found.rejected.collect()}
    assert got == {
        day(0): "missing required columns: low, close",
        day(1): "no timestamp column found",
        day(2): "missing required columns: volume",
        day(3): "no timestamp column found",
    }
    assert found.ticks.count() == 0 and found.inputs.count() == 5


def test_uniform_archive_is_one_pruned_scan(spark, tmp_path):
    for k in range(4):
        put(klines(k).assign(extra=1), str(tmp_path), f"date={day(k)}", "x.parquet")
    plan = scan(spark, tmp_path, 1, 2).ticks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "extra" not in plan
    assert "PartitionFilters: [isnotnull(date" in plan
    assert scan(spark, tmp_path, 1, 2).ticks.count() == 20


def test_days_of_many_schemas_are_found_by_a_filter(spark, tmp_path, monkeypatch):
    """Schemas that change by symbol and day, and a folder that holds two of them."""
    texts = {"close": [str(i) for i in range(10)]}
    odd = {("A", 3), ("A", 6), ("A", 7), ("B", 0), ("C", 5)}
    for s in "ABCD":
        for k in range(9):
            if (s, k) != ("B", 4):
                kind = "date" if (s, k) != ("D", 2) else "dt"
                data = klines(k, **texts) if (s, k) in odd else klines(k)
                put(data, str(tmp_path), f"symbol={s}", f"{kind}={day(k)}", "x.parquet")
    put(klines(8, **texts), str(tmp_path), "symbol=A", f"date={day(8)}", "y.parquet")
    put(klines(1, volume=None), str(tmp_path), "symbol=C", f"date={day(1)}", "y.parquet")

    def counted():
        found = scan(spark, tmp_path / "symbol={symbol}", 0, 8, "ABC")
        rows = found.ticks.groupBy("symbol", "source_day").agg(F.count("*"), F.count("close"))
        return found, sorted(tuple(r) for r in rows.collect())

    found, got = counted()
    want = {(s, day(k)): 10 for s in "ABC" for k in range(9) if (s, k) != ("B", 4)}
    want |= {("A", day(8)): 20, ("C", day(1)): 20}
    assert got == sorted((*key, n, n) for key, n in want.items())
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    try:
        plan = found.ticks._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
    # Floats and texts by runs, and the three schemas of the mixed folders by name.
    assert len(filters) == 5 and sum(" OR " in x for x in filters) == 2

    monkeypatch.setattr("tidebar.sources.klines._MOST_RUNS", 1)
    assert counted()[1] == got


# --- report -----------------------------------------------------------------------


def test_outcomes(spark):
    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    counts = table([("A", day(0), 5), ("A", day(3), 7)], "symbol string, source_day date, n_bars long")
    inputs = table(
        [("A", day(0), 2), ("A", day(1), 1), ("A", day(3), 3), ("B", day(2), 1)],
        "symbol string, day date, n_files long",
    )
    rejected = table([("B", day(2), "bad"), ("B", day(3), "worse")],
                     "symbol string, day date, error string")
    days = requested_days(calendar(spark, day(0), day(6)), ["A", "B"])
    report = day_outcomes(days, counts, inputs, rejected, tail_days=2).orderBy("symbol", "day")
    got = [tuple(r)[1:] for r in report.collect()]
    a, b, c, d = (day(k) for k in range(4))
    assert got[:7] == [
        (a, "ok", 5, f"{a}:2", None),
        (b, "ok", 0, f"{a}:2,{b}:1", None),
        (c, "ok", 0, f"{a}:2,{b}:1", None),
        (d, "ok", 7, f"{b}:1,{d}:3", None),
        (day(4), "ok", 0, f"{d}:3", None),
        (day(5), "ok", 0, f"{d}:3", None),
        (day(6), "no_data", None, "", None),
    ]
    assert [r[1:] for r in got[7:]] == [
        ("no_data", None, "", None),
        ("no_data", None, "", None),
        ("error", None, None, f"{c}: bad"),
        ("error", None, None, f"{c}: bad"),
        ("error", None, None, f"{c}: bad"),
        ("error", None, None, f"{d}: worse"),
        ("no_data", None, "", None),
    ]
    assert {r.status: r.n_days for r in status_counts(report).collect()} == {
        "ok": 6, "error": 4, "no_data": 4,
    }
    assert [r.day for r in first_days(report, "error", 2).collect()] == [day(2), day(3)]


# --- job --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    r = str(tmp_path_factory.mktemp("archive"))
    for k in (0, 1, 2, 3, 12):
        put(klines(k, 20), r, f"date={day(k)}", "x.parquet")
    put(klines(13, 20, close=None), r, f"date={day(13)}", "x.parquet")
    return r


def run(spark, archive, out, first=0, last=14, **options):
    return run_regime_features(
        spark, archive, "A", f"{out}/f", f"{out}/b",
        start=day(first), end=day(last), spec=SPEC, tail_days=3, **options,
    )


def test_job(spark, archive, tmp_path):
    out = str(tmp_path)
    report = run(spark, archive, out)
    status = [(r.status, r.n_feat_rows) for r in report.orderBy("day").collect()]
    assert status == (
        [("ok", 20)] * 4 + [("ok", 0)] * 3 + [("no_data", None)] * 5 + [("ok", 20)]
        + [("error", None)] * 2
    )
    features, bars = spark.read.parquet(f"{out}/f"), spark.read.parquet(f"{out}/b")
    assert set(features.columns) == {"symbol", "date", "ts", *FEATURE_COLS}
    assert set(bars.columns) == {"date", *BAR_COLS} - {"source_day"}
    assert features.count() == bars.count() == 100
    assert features.where("CAST(ts AS date) <> date").count() == 0
    # One file per day, and an empty one where there are no rows.
    for k in (0, 12, 4):
        assert len(glob.glob(f"{out}/f/symbol=A/date={day(k)}/*.parquet")) == 1
    assert not os.path.exists(f"{out}/f/symbol=A/date={day(13)}")
    error = f"{day(13)}: missing required columns: close"
    assert summary_lines(report, 2) == [
        "symbol\tstatus\tdays\tbars\tfirst days",
        f"A\terror\t2\t0\t{day(13)} ({error}); {day(14)} ({error})",
        f"A\tno_data\t5\t0\t{day(7)}; {day(8)}",
        f"A\tok\t8\t100\t{day(0)}; {day(1)}",
    ]
    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/tidebar/regime-job-*/work")


def test_rerun_replaces_only_its_days(spark, archive, tmp_path):
    out = str(tmp_path)
    run(spark, archive, out, 0, 3)
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{out}/f/*/*/*.parquet")}
    same = spark.read.parquet(f"{out}/f").where(F.col("date") == F.lit(day(2)))
    same = sorted(map(tuple, same.collect()))
    run(spark, archive, out, 2, 2)
    after = {p: os.path.getmtime(p) for p in glob.glob(f"{out}/f/*/*/*.parquet")}
    assert {p.split("/")[-2] for p in before.keys() ^ after.keys()} == {f"date={day(2)}"}
    again = spark.read.parquet(f"{out}/f").where(F.col("date") == F.lit(day(2)))
    assert sorted(map(tuple, again.collect())) == same


def test_stale_days_are_emptied(spark, archive, tmp_path):
    out = str(tmp_path)
    stale = spark.createDataFrame(
        [("A", day(4), datetime(2024, 1, 5), *[1.0] * 8), ("Z", day(4), None, *[1.0] * 8)],
        "symbol string, date date, ts timestamp, "
        + ", ".join(f"{c} double" for c in FEATURE_COLS),
    )
    write_daily(stale, f"{out}/f")
    run(spark, archive, out, 4, 4)
    left = spark.read.parquet(f"{out}/f").where(F.col("date") == F.lit(day(4)))
    assert [r.symbol for r in left.collect()] == ["Z"]


def test_arguments(spark, archive, tmp_path):
    with pytest.raises(ValueError):
        run(spark, archive, str(tmp_path), 3, 2)
    args = parse_args("in A B --days 2024-01-01:2024-01-02 --features f".split())
    assert (args.symbols, args.history, args.bars) == (["A", "B"], 7, None)


def test_unreadable_files_fail_their_days_alone(spark, archive, tmp_path):
    """Garbage and a cut file: the days that see them are errors, all else is computed."""
    out = str(tmp_path)
    put(klines(7, 20), archive, f"date={day(7)}", "x.parquet")
    put(klines(7, 20), archive, f"date={day(7)}", "y.parquet")
    with open(f"{archive}/date={day(7)}/y.parquet", "r+b") as f:
        f.truncate(200)
    os.makedirs(f"{archive}/date={day(8)}")
    with open(f"{archive}/date={day(8)}/g.parquet", "wb") as f:
        f.write(b"garbage")
    report = {r.day: r for r in run(spark, archive, out).collect()}
    failed = [k for k in range(15) if report[day(k)].status == "error"]
    assert failed == [7, 8, 9, 10, 11, 13, 14]
    assert "unreadable file" in report[day(9)].error
    assert spark.read.parquet(f"{out}/f").count() == 5 * 20
    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/tidebar/regime-job-*/work")
    with pytest.raises(Exception, match="unreadable file"):
        scan(spark, archive, 8, 8)


def test_damaged_pages_fail_their_days_alone(spark, tmp_path):
    """Pages that cannot be decoded under a good footer; one row group of two stays whole."""
    r = str(tmp_path / "in")
    for k in (0, 1, 2, 12):
        put(klines(k, 20), r, f"date={day(k)}", "x.parquet")
    for k in (3, 8):
        put(klines(k), r, f"date={day(k)}", "x.parquet", row_group_size=5)
        path = os.path.join(r, f"date={day(k)}", "x.parquet")
        with open(path, "rb") as f:
            whole = f.read()
        second = pq.ParquetFile(path).metadata.row_group(1).column(0)
        start = 4 if k == 8 else min(x for x in (second.dictionary_page_offset, second.data_page_offset) if x)
        end = len(whole) - 8 - int.from_bytes(whole[-8:-4], "little")
        with open(path, "wb") as f:
            f.write(whole[:start] + b"\xff" * (end - start) + whole[end:])
    report = {x.day: x for x in run(spark, r, tmp_path / "out").collect()}
    bad = {day(k + i) for k in (3, 8) for i in range(4)}
    assert {d for d, x in report.items() if x.status == "error"} == bad
    assert report[day(3)].error == f"{day(3)}: damaged files: 5 of 10 rows cannot be read"
    assert report[day(9)].error == f"{day(8)}: damaged files: 10 of 10 rows cannot be read"
    assert report[day(2)].n_feat_rows == 20 and report[day(12)].n_feat_rows == 20
    written = {r.date for r in spark.read.parquet(f"{tmp_path}/out/f").select("date").distinct().collect()}
    assert written == {day(k) for k in (0, 1, 2, 12)}


TEXTS = {
    "slash": "%Y/%m/%d %H:%M:%S", "month_first": "%m/%d/%Y %H:%M:%S", "compact": "%Y%m%d %H:%M:%S",
    "named": "%d %b %Y %H:%M", "iso": "%Y-%m-%dT%H:%M:%S", "long": "%B %d, %Y %H:%M:%S",
}


def test_texts_of_many_forms(spark, tmp_path):
    for k, form in enumerate(TEXTS.values()):
        frame = klines(k, 10)
        at = pd.to_datetime(frame.open_time, unit="ms").dt.floor("min")
        frame = frame.drop(columns="open_time").assign(startTime=at.dt.strftime(form))
        put(frame, str(tmp_path), f"date={day(k)}", "x.parquet")
    got = scan(spark, tmp_path).ticks.where("CAST(ts AS date) = source_day")
    assert sorted(r["count"] for r in got.groupBy("source_day").count().collect()) == [10] * len(TEXTS)


def test_the_folder_settles_what_texts_leave_open(spark, tmp_path):
    """Day first and month first, half days, zones and weekdays, on days of which either reads."""
    forms = {
        1: "%d/%m/%Y %H:%M:%S", 2: "%m/%d/%Y %I:%M:%S %p", 3: "%a, %d %b %Y %H:%M:%S GMT",
        4: "%d-%m-%Y %H:%M:%S +0000", 5: "%Y-%m-%d %I:%M %p", 6: "%d.%m.%Y %H:%M:%S.%f UTC", 7: "%d/%m/%Y %H:%M",
    }
    for k, form in forms.items():
        at = pd.to_datetime(klines(k).open_time, unit="ms") + pd.Timedelta(hours=11, minutes=55)
        name = "ts" if k % 2 else "startTime"
        frame = klines(k, open_time=None).assign(**{name: at.dt.strftime(form)})
        put(frame, str(tmp_path), f"date={day(k)}", "x.parquet")
    # a local time whose day is not the folder's, and a few texts of another form
    late = [f"{day(8)} 22:0{i}:00-05:00" for i in range(10)]
    put(klines(9, ts=late), str(tmp_path), f"date={day(9)}", "x.parquet")
    mixed = [f"10/01/2024 00:0{i}:00" for i in range(8)] + ["2024-01-10", "01/10/2024 00:09:00"]
    put(klines(10, ts=[t.replace("10/01", "11/01") for t in mixed]), str(tmp_path), f"date={day(10)}", "x.parquet")
    ticks = scan(spark, tmp_path, last=10).ticks
    got = ticks.groupBy("source_day").agg(F.count("*").alias("n"), F.min("ts"), F.max("ts"), F.first("ts"))
    rows = {r.source_day: r for r in got.collect()}
    for k in forms:
        noon = datetime.combine(day(k), datetime.min.time()) + timedelta(hours=11, minutes=55)
        assert rows[day(k)][1:4] == (10, noon, noon + timedelta(minutes=9)), forms[k]
    assert rows[day(9)][1:3] == (10, datetime(2024, 1, 10, 3))
    # the text of the other form is read by the day's form, as an instant of another day
    assert rows[day(10)][1:4] == (9, datetime(2024, 1, 11), datetime(2024, 10, 1, 0, 9))


def test_texts_that_say_nothing_leave_old_output(spark, tmp_path):
    r, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(klines(0, 10), r, f"date={day(0)}", "x.parquet")
    run(spark, r, out, 0, 0)
    frame = klines(0, 10).drop(columns="open_time").assign(startTime="?")
    put(frame, r, f"date={day(0)}", "x.parquet")
    report = run(spark, r, out, 0, 0).first()
    assert report.status == "error" and report.error.endswith("in any of 10 texts")
    assert spark.read.parquet(f"{out}/f").count() == 10


def test_the_session_is_left_as_found(spark, archive, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        before = dict(spark.conf.getAll)
        run(spark, archive, str(tmp_path), 0, 2)
        with pytest.raises(ValueError):
            run(spark, archive, str(tmp_path), 2, 0)
        assert dict(spark.conf.getAll) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
