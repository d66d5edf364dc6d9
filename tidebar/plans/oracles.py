"""The queries of `queries.py` written independently in SQL for DuckDB."""

from __future__ import annotations

from tidebar.plans.queries import (
    BAD_DAY,
    BY_TYPE,
    DENSITY,
    FILE_SPLITS,
    GAP_DAY,
    number_text_sql,
)
from tidebar.schema import FEATURE_COLS, RegimeSpec

_PRICE = "value + 1.0"
_VOLUME = "1.0 + event_id % 10"
_TAKER = "(1.0 + event_id % 10) * (event_id % 5) / 4.0"
_DAY = "CAST(ts AS DATE)"


def _dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def _ticks(symbol="'ALL'", day=_DAY, open=_PRICE, close=_PRICE, volume=_VOLUME, taker=_TAKER,
           source="events") -> str:
    return (
        f"SELECT {symbol} AS symbol, {day} AS source_day, ts, {_dbl(open)} AS open, "
        f"{_dbl(_PRICE)} AS high, {_dbl(_PRICE)} AS low, {_dbl(close)} AS close, "
        f"{_dbl(volume)} AS volume, {_dbl(taker)} AS taker_base FROM {source}"
    )


def _bars(ticks: str) -> str:
    """CTEs `ticks` and `bars`, the latter over all minutes of each source day."""
    return f"""ticks AS ({ticks}),
bars AS (
  SELECT symbol, source_day, date_trunc('minute', ts) AS ts,
    arg_min(open, (ts, open)) FILTER (open IS NOT NULL) AS open, max(high) AS high, min(low) AS low,
    arg_max(close, (ts, close)) FILTER (close IS NOT NULL) AS close,
    coalesce(sum(volume), 0.0) AS volume, coalesce(sum(taker_base), 0.0) AS taker_base
  FROM ticks WHERE ts IS NOT NULL GROUP BY 1, 2, date_trunc('minute', ts))"""


def _returns(ticks: str) -> str:
    """`_bars`, and `rets` with returns, before the clip; `day` after it."""
    return f"""{_bars(ticks)},
logs AS (
  SELECT *, CASE WHEN close > 0 THEN ln(close) WHEN close = 0 THEN CAST('-inf' AS DOUBLE) END
    AS lnc FROM bars),
diffs AS (
  SELECT *, lnc - lag(lnc) OVER (PARTITION BY symbol, source_day ORDER BY ts) AS d FROM logs),
rets AS (
  SELECT * EXCLUDE (d), CASE WHEN d IS NULL OR isnan(d) THEN 0.0 ELSE d END AS ret1m FROM diffs),
day AS (
  SELECT *, ret1m * ret1m AS ret2_1m, abs(ret1m) AS absret1m FROM rets
  WHERE ts >= source_day AND ts < source_day + INTERVAL 1 DAY)"""


def _roll(agg: str, x: str, rows: int, least: int, part: str) -> str:
    w = f"(PARTITION BY {part} ORDER BY ts ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) OVER {w} >= {least} THEN {agg}({x}) OVER {w} END"


def _features(ticks: str, spec: RegimeSpec, tail: int, first: str, last: str) -> str:
    """CTEs up to `feat`, computed on a full copy of each target day's history."""
    part = "symbol, target_day"
    day, week = (spec.day, spec.min_day, part), (spec.week, spec.min_week, part)
    return f"""{_returns(ticks)},
fan AS (
  SELECT day.*, CAST(source_day + CAST(k AS INTEGER) AS DATE) AS target_day
  FROM day, (SELECT unnest(range({tail + 1})) AS k)
  WHERE CAST(source_day + CAST(k AS INTEGER) AS DATE) BETWEEN {first} AND {last}),
ratios AS (
  SELECT *, taker_base / nullif(volume, 0) AS share,
    (2 * taker_base - volume) / nullif(volume, 0) AS imb FROM fan),
level AS (
  SELECT *,
    lag(ln(close), {spec.day}) OVER (PARTITION BY {part} ORDER BY ts) AS back,
    {_roll('sum', 'ret2_1m', spec.short, spec.min_short, part)} AS var_short,
    {_roll('sum', 'ret2_1m', *day)} AS var_day,
    {_roll('sum', 'ret2_1m', *week)} AS var_week,
    {_roll('avg', 'absret1m', *day)} AS abs_day,
    {_roll('avg', 'share', *day)} AS share_day,
    {_roll('avg', 'imb', *day)} AS imb_day,
    {_roll('sum', 'volume', *day)} AS vol_day,
    {_roll('sum', 'volume', *week)} AS vol_week
  FROM ratios),
vols AS (SELECT *, sqrt(var_day) AS rv FROM level),
vols2 AS (
  SELECT *, {_roll('avg', 'rv', *week)} AS rv_mean, {_roll('stddev_samp', 'rv', *week)} AS rv_std
  FROM vols),
feat AS (
  SELECT symbol, target_day AS date, ts,
    (ln(close) - back) / {spec.trend_seconds} AS trend24,
    abs_day / nullif(rv, 0) AS chop24,
    imb_day AS taker_imb24,
    share_day AS taker_share24,
    var_short / nullif(var_day, 0) AS rv_burst_1h,
    rv / nullif(sqrt(var_week), 0) AS rv24_over_rv168,
    vol_day / nullif(vol_week, 0) AS vol24_over_vol168,
    (rv - rv_mean) / nullif(rv_std, 0) AS rv24_z168
  FROM vols2 WHERE source_day = target_day)"""


def _r(places: int, *cols: str) -> str:
    return ", ".join(f"round({c}, {places}) + 0.0 AS {c}" for c in cols)


_FEATURES = f"{_r(12, 'trend24')}, {_r(6, *FEATURE_COLS[1:])}"
_FIRST = f"(SELECT min({_DAY}) FROM events)"
_LAST = f"(SELECT max({_DAY}) FROM events)"
_BAR = "symbol, source_day, ts, open, high, low, close, volume, taker_base"
_D = "day(ts)"

# What the archive of `kline_archive` yields as ticks.
_ARCHIVE_TICKS = _ticks(
    taker=f"CASE WHEN {_D} % 5 = 0 THEN NULL ELSE {_TAKER} END",
    source=f"(SELECT * REPLACE (CASE {_D} % 5 WHEN 2 THEN date_trunc('second', ts) "
    "WHEN 0 THEN ts ELSE date_trunc('millisecond', ts) END AS ts) "
    f"FROM events WHERE {_D} NOT IN ({GAP_DAY}, {BAD_DAY}))",
)

_WHOLE_TICKS = _ARCHIVE_TICKS.replace(f" WHERE {_D} NOT IN ({GAP_DAY}, {BAD_DAY})", "")


def _by_minute(ticks: str) -> str:
    return f"""WITH t AS ({ticks})
SELECT symbol, source_day, date_trunc('minute', ts) AS minute, count(*) AS n,
  round(sum(close), 6) + 0.0 AS close, sum(volume) AS volume, sum(taker_base) AS taker_base
FROM t GROUP BY 1, 2, 3"""


_ARCHIVE_DAYS = f"""
files AS (
  SELECT {_DAY} AS day, count(DISTINCT event_id % {FILE_SPLITS} + {FILE_SPLITS} *
    CASE WHEN {_D} % 5 IN (0, 4) AND {_D} <> {BAD_DAY} THEN hour(ts) // 12 ELSE 0 END) AS n_files
  FROM events WHERE {_D} <> {GAP_DAY} GROUP BY 1)"""

_COVERAGE = """
coverage AS (
  SELECT target AS day, string_agg(day || ':' || n_files, ',' ORDER BY day) AS inputs
  FROM (SELECT *, CAST(day + CAST(k AS INTEGER) AS DATE) AS target
        FROM files, (SELECT unnest(range(8)) AS k)) GROUP BY 1)"""

_MISSING = "missing required columns: close"


_REPORT = f"""
days AS (SELECT CAST(unnest(generate_series(CAST({_FIRST} AS TIMESTAMP),
  CAST({_LAST} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day),
requested AS (SELECT symbol, day FROM days, (SELECT unnest(
  ['click', 'error', 'purchase', 'signup', 'view']) AS symbol)),
present AS (SELECT event_type AS symbol, {_DAY} AS day, ts FROM events
  WHERE NOT (event_type = 'click' AND {_D} > 9)),
facts AS (SELECT symbol, day, count(*) AS n FROM present GROUP BY 1, 2),
spread AS (SELECT r.symbol, r.day, f.day AS source_day, f.n,
    f.symbol = 'error' AND day(f.day) = 12 AS bad
  FROM requested r LEFT JOIN facts f
    ON r.symbol = f.symbol AND f.day BETWEEN r.day - 7 AND r.day),
grouped AS (SELECT symbol, day, min(CASE WHEN bad THEN source_day END) AS bad_day,
    sum(CASE WHEN NOT bad THEN n END) AS n_history,
    sum(CASE WHEN NOT bad AND source_day = day THEN n END) AS n_own,
    string_agg(source_day || ':' || n, ',' ORDER BY source_day) AS inputs
  FROM spread GROUP BY 1, 2),
report AS (SELECT symbol, day,
    CASE WHEN bad_day IS NOT NULL THEN 'error' WHEN n_history > 0 THEN 'ok' ELSE 'no_data' END
      AS status,
    CASE WHEN bad_day IS NULL AND n_history > 0 THEN CAST(coalesce(n_own, 0) AS BIGINT) END
      AS n_feat_rows,
    CASE WHEN bad_day IS NULL THEN coalesce(inputs, '') END AS inputs,
    CASE WHEN bad_day IS NOT NULL THEN bad_day || ': {_MISSING}' END AS error
  FROM grouped)"""

_NUMBER = r"^[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)$"


def _rolled(agg: str, col: str) -> str:
    part = "symbol, source_day"
    return f"""WITH {_returns(_ticks())},
x AS (SELECT *, taker_base / nullif(volume, 0) AS share FROM day),
y AS (SELECT *, {_roll(agg, col, 12, 4, part)} AS short,
  {_roll(agg, col, 120, 30, part)} AS long FROM x)
SELECT symbol, source_day, ts, {_r(6, 'short', 'long')} FROM y"""


def oracle_sql() -> dict[str, str]:
    by_type = _ticks("event_type")
    stray = (
        f"CASE WHEN event_id % 11 = 0 THEN {_DAY} - 1 "
        "ELSE CAST(ts + INTERVAL 90 MINUTE AS DATE) END"
    )
    zero = (
        "CASE WHEN event_id % 40 = 0 THEN 0.0 WHEN event_id % 41 = 0 THEN -value ELSE value END"
    )
    z_part = "symbol, source_day"
    out = {
        "minute_bars": f"WITH {_bars(by_type)} SELECT {_BAR} FROM bars",
        "bars_null_open_close": "WITH "
        + _bars(
            _ticks(
                open=f"CASE WHEN event_id % 3 <> 0 THEN {_PRICE} END",
                close=f"CASE WHEN event_id % 4 <> 0 THEN {_PRICE} END",
                volume=f"CASE WHEN event_id % 6 <> 0 THEN {_VOLUME} END",
                taker="NULL",
            )
        )
        + f" SELECT {_BAR} FROM bars",
        "drop_null_ts": "SELECT date_trunc('minute', ts) AS minute, count(*) AS n "
        "FROM events WHERE event_id % 7 <> 0 GROUP BY 1",
        "log_returns_by_day": f"WITH {_returns(by_type)} "
        f"SELECT symbol, source_day, ts, {_r(9, 'ret1m')} FROM day",
        "returns_sq_abs": f"WITH {_returns(by_type)} "
        f"SELECT symbol, source_day, ts, {_r(9, 'ret2_1m', 'absret1m')} FROM day",
        "zero_price_returns": f"WITH {_returns(_ticks('event_type', close=zero))} "
        "SELECT symbol, source_day, ts, CASE WHEN ret1m = CAST('inf' AS DOUBLE) THEN 'inf' "
        "WHEN ret1m = CAST('-inf' AS DOUBLE) THEN '-inf' ELSE 'finite' END AS kind, "
        "CASE WHEN isfinite(ret1m) THEN round(ret1m, 9) + 0.0 END AS ret1m FROM day",
        "day_clip": f"WITH {_returns(_ticks('event_type', day=stray))} "
        f"SELECT {_BAR}, {_r(9, 'ret1m')} FROM day",
        "clip_to_day": f"WITH t AS ({_ticks(day='CAST(ts + INTERVAL 6 HOUR AS DATE)')}) "
        f"SELECT source_day, count(*) AS n FROM t WHERE {_DAY} = source_day GROUP BY 1",
        "lag_n": f"WITH {_returns(by_type)} SELECT symbol, source_day, ts, close, "
        f"lag(close, 7) OVER (PARTITION BY {z_part} ORDER BY ts) AS close_back FROM day",
        "rolling_sum_min": _rolled("sum", "ret2_1m"),
        "rolling_mean_min": _rolled("avg", "share"),
        "rolling_std_min": _rolled("stddev_samp", "close"),
        "rolling_zscore": f"""WITH {_returns(_ticks())},
a AS (SELECT *, sqrt({_roll('sum', 'ret2_1m', 30, 10, z_part)}) AS rv FROM day),
b AS (SELECT *, {_roll('avg', 'rv', 100, 40, z_part)} AS m,
  {_roll('stddev_samp', 'rv', 100, 40, z_part)} AS s FROM a),
c AS (SELECT *, (rv - m) / nullif(s, 0) AS z FROM b)
SELECT symbol, source_day, ts, {_r(6, 'rv', 'z')} FROM c""",
        "regime_features_all": f"WITH {_features(by_type, BY_TYPE, 7, _FIRST, _LAST)} "
        f"SELECT symbol, date, ts, {_FEATURES} FROM feat",
        "regime_features_default_windows": "WITH "
        f"{_features(_ticks(), RegimeSpec(), 7, _FIRST, _LAST)} "
        f"SELECT symbol, date, ts, {_FEATURES} FROM feat",
        "tail_truncated_features": "WITH "
        f"{_features(_ticks(), DENSITY, 4, f'{_FIRST} + 5', f'{_LAST} - 3')} "
        f"SELECT symbol, date, ts, {_FEATURES} FROM feat",
        "tail_fanout": f"""WITH {_features(by_type, BY_TYPE, 7, _FIRST, _LAST)}
SELECT symbol, target_day, count(*) AS n_bars, min(ts) AS first_ts, max(ts) AS last_ts,
  sum(volume) AS volume FROM fan GROUP BY 1, 2""",
        "calendar": f"SELECT CAST(unnest(generate_series(CAST({_FIRST} AS TIMESTAMP), "
        f"CAST({_LAST} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day",
        "safe_div_null": "SELECT event_id, value / nullif(event_id % 4, 0) AS quotient FROM events",
        "inf_cleanup": "SELECT event_id, CASE WHEN event_id % 5 > 2 THEN value END AS x FROM events",
        "numeric_coerce": f"""WITH t AS (SELECT event_id, {number_text_sql()} AS t FROM events)
SELECT event_id, CASE WHEN regexp_full_match(lower(trim(t)), '{_NUMBER}')
  THEN TRY_CAST(trim(t) AS DOUBLE) END AS number, CAST(event_id AS DOUBLE) AS from_int FROM t""",
        "epoch_unit_detect": f"""WITH raw AS (
  SELECT event_type AS symbol, {_DAY} AS source_day,
    CASE WHEN (CASE WHEN {_D} % 7 = 0 THEN event_id ELSE {_D} END) % 2 = 0
      THEN CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) ELSE CAST(floor(epoch_us(ts) / 1000) AS BIGINT) END AS t FROM events),
units AS (SELECT symbol, source_day, median(CAST(t AS DOUBLE)) > 10000000000 AS ms
  FROM raw GROUP BY 1, 2),
parsed AS (SELECT symbol, source_day,
    CASE WHEN ms THEN t * 1000 WHEN t < 9223372036 THEN t * 1000000 END AS us
  FROM raw JOIN units USING (symbol, source_day))
SELECT symbol, source_day, count(us) AS n, make_timestamp(min(us)) AS first_ts,
  make_timestamp(max(us)) AS last_ts FROM parsed WHERE us IS NOT NULL GROUP BY 1, 2""",
        "ts_resolution": f"""SELECT {_DAY} AS source_day,
  CASE WHEN {_D} % 3 = 0 THEN date_trunc('millisecond', ts) + INTERVAL 1 HOUR ELSE ts END AS ts,
  CAST(event_id AS DOUBLE) AS open
FROM events WHERE {_D} % 3 = 0 OR event_id % 5 <> 0""",
        "alias_pick": "WITH "
        + _bars(
            _ticks(
                "event_type",
                volume=f"CASE WHEN event_id % 2 = 0 THEN {_VOLUME} END",
            )
        )
        + " SELECT symbol, source_day, ts, close, volume, taker_base FROM bars",
        "taker_default": f"WITH {_bars(_ticks('event_type', taker='NULL'))} "
        "SELECT symbol, source_day, ts, taker_base, taker_base / nullif(volume, 0) AS share, "
        "(2 * taker_base - volume) / nullif(volume, 0) AS imbalance FROM bars",
        "union_by_name": "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value "
        f"ELSE value + 1.0 END AS open, CASE WHEN event_id % 2 = 1 THEN {_dbl(_TAKER)} END "
        "AS taker_base FROM events",
        "layout_pick": f"""WITH {_ARCHIVE_DAYS}
SELECT day, CAST(CASE WHEN day(day) = {BAD_DAY} THEN 1 ELSE
  CASE day(day) % 5 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 4 ELSE 5 END END
  AS INTEGER) AS layout, n_files FROM files""",
        "scan_ticks": _by_minute(_WHOLE_TICKS),
        "scan_hive_uniform": _by_minute(_ticks()),
        "scan_bare_days": _by_minute(_ticks()),
        "scan_nested": _by_minute(_ticks()),
        "scan_many_symbols": _by_minute(_ticks("event_type")),
        "ts_text_formats": _by_minute(_ticks()),
        "rejected_days": f"SELECT DISTINCT 'ALL' AS symbol, {_DAY} AS day, "
        f"'{_MISSING}' AS error FROM events WHERE {_D} = {BAD_DAY}",
        "input_coverage": f"WITH {_ARCHIVE_DAYS}, {_COVERAGE} "
        "SELECT 'ALL' AS symbol, day, inputs FROM coverage",
        "status_report": f"""WITH {_ARCHIVE_DAYS}, {_COVERAGE}, {_returns(_ARCHIVE_TICKS)},
own AS (SELECT source_day AS day, count(*) AS n FROM day GROUP BY 1),
days AS (SELECT CAST(unnest(generate_series(CAST({_FIRST} AS TIMESTAMP),
  CAST({_LAST} AS TIMESTAMP) + INTERVAL 10 DAY, INTERVAL 1 DAY)) AS DATE) AS day),
bads AS (SELECT DISTINCT {_DAY} AS bad FROM events WHERE {_D} = {BAD_DAY}),
facts AS (SELECT days.day,
    (SELECT min(bad) FROM bads WHERE days.day BETWEEN bad AND bad + 7) AS bad_day,
    EXISTS (SELECT 1 FROM own WHERE own.day BETWEEN days.day - 7 AND days.day) AS seen
  FROM days)
SELECT 'ALL' AS symbol, facts.day,
  CASE WHEN bad_day IS NOT NULL THEN 'error' WHEN seen THEN 'ok' ELSE 'no_data' END AS status,
  CASE WHEN bad_day IS NULL AND seen THEN coalesce(n, 0) END AS n_feat_rows,
  CASE WHEN bad_day IS NULL THEN coalesce(inputs, '') END AS inputs,
  CASE WHEN bad_day IS NOT NULL THEN bad_day || ': {_MISSING}' END AS error
FROM facts LEFT JOIN own USING (day) LEFT JOIN coverage USING (day)""",
        "damaged_page_features": "WITH "
        + _features(
            _ticks(
                taker="CAST(NULL AS DOUBLE)",
                source="(SELECT * REPLACE (date_trunc('millisecond', ts) AS ts) FROM events)",
            ),
            DENSITY, 7, _FIRST, f"{_LAST} + 10",
        )
        + f""" SELECT symbol, date, ts, {_FEATURES} FROM feat
WHERE date NOT IN (SELECT {_DAY} + CAST(k AS INTEGER) FROM events, range(8) r(k) WHERE {_D} = {BAD_DAY})""",
        "status_unreadable_file": f"""WITH {_returns(_ticks())},
own AS (SELECT source_day AS day, count(*) AS n FROM day GROUP BY 1),
days AS (SELECT CAST(unnest(generate_series(CAST({_FIRST} AS TIMESTAMP),
  CAST({_LAST} AS TIMESTAMP) + INTERVAL 10 DAY, INTERVAL 1 DAY)) AS DATE) AS day),
bads AS (SELECT DISTINCT {_DAY} AS bad FROM events WHERE {_D} = {BAD_DAY}),
facts AS (SELECT days.day,
    EXISTS (SELECT 1 FROM bads WHERE days.day BETWEEN bad AND bad + 7) AS failed,
    EXISTS (SELECT 1 FROM own JOIN days d USING (day) WHERE day NOT IN (SELECT bad FROM bads)
      AND own.day BETWEEN days.day - 7 AND days.day) AS seen
  FROM days)
SELECT 'ALL' AS symbol, facts.day,
  CASE WHEN failed THEN 'error' WHEN seen THEN 'ok' ELSE 'no_data' END AS status,
  CASE WHEN NOT failed AND seen THEN coalesce(n, 0) END AS n_feat_rows
FROM facts LEFT JOIN own USING (day)""",
        "regime_job": "WITH "
        f"{_features(_WHOLE_TICKS, DENSITY, 7, _FIRST, f'{_LAST} + 10')} "
        f"SELECT symbol, date, ts, {_FEATURES} FROM feat",
        "bar_sink": f"WITH {_returns(_WHOLE_TICKS)} "
        "SELECT symbol, source_day AS date, ts, open, high, low, close, volume, taker_base, "
        f"{_r(9, 'ret1m', 'ret2_1m', 'absret1m')} FROM day",
        "status_by_symbol": f"WITH {_REPORT} SELECT * FROM report",
        "status_counts": f"WITH {_REPORT} SELECT status, count(*) AS n_days FROM report GROUP BY 1",
        "first_no_data_days": f"WITH {_REPORT} SELECT symbol, day, status FROM report "
        "WHERE status = 'no_data' ORDER BY day, symbol LIMIT 20",
        "first_ok_days": f"WITH {_REPORT} SELECT symbol, day, status, n_feat_rows FROM report "
        "WHERE status = 'ok' ORDER BY day, symbol LIMIT 7",
        "scan_two_schemas": _by_minute(_ticks(taker=f"CASE WHEN event_id % 2 = 1 THEN {_TAKER} END")),
        "scan_schema_runs": _by_minute(_ticks(taker=f"CASE WHEN day(ts) // 7 % 2 = 1 THEN {_TAKER} END")),
        "rows_per_day": f"WITH {_returns(by_type)} SELECT symbol, source_day, "
        "count(*) AS n_feat_rows FROM day GROUP BY 1, 2",
    }
    out["status_damaged_page"] = out["status_unreadable_file"]
    one = f"WITH {_features(_ticks(), DENSITY, 7, _FIRST, _LAST)} SELECT symbol, date, ts, "
    for f in FEATURE_COLS:
        out[f] = one + _r(12 if f == "trend24" else 6, f) + " FROM feat"
    return out
