"""Column expressions shared by the operators. All are JVM-side built-ins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INF = float("inf")

# What counts as a number, and the instants a 64-bit count of
# nanoseconds can hold (about 1677-09-21 to 2262-04-11), in microseconds.
NUMBER_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"
ISO_TEXT = r"^\s*[+-]?\d{4}-"
# Other forms of a date, each alone or with a time of day and a zone; of equally good ones the
# first is taken, so the month comes first where texts leave it open.
TEXT_DATES = [
    "yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "yyyyMMdd", "M-d-yyyy", "d-M-yyyy", "d.M.yyyy",
    "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy",
    "yyyy-M-d",
]
_FRACTION = "".join(f"[.{'S' * n}]" for n in range(9, 0, -1))
_ZONE = "[' '][XXX][XX][z]"
TEXT_TIME = f"[' ']['T'][H:mm[:ss]{_FRACTION}]{_ZONE}"
TEXT_HALF_DAY = f"[' ']['T'][h:mm[:ss]{_FRACTION}][' ']a{_ZONE}"
TEXT_CLOCK = r"(?s)^(.*?)\d{1,2}:\d{2}(?::\d{2})?(\.\d{1,9}(?!\d))?(?!\d)(.*)$"
TEXT_WEEKDAY = r"^[A-Za-z]{3,9},\s+"
TEXT_NOON = r"(?i)\d\s*[ap]m\b"
ISO_FORM = "iso"
MIN_MICROS = -9_223_372_036_854_775
MAX_MICROS = 9_223_372_036_854_775


def nan_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(float("nan")))


def finite_or_null(c: Column) -> Column:
    """NULL for NaN and both infinities (Spark orders NaN above infinity)."""
    return F.when(F.abs(c) < F.lit(_INF), c)


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(a, b)


def ln_ieee(c: Column) -> Column:
    """Natural log with ln 0 = -inf; Spark's own `ln` gives NULL there."""
    return F.when(c > 0, F.ln(c)).when(c == 0, F.lit(-_INF))


def minute_floor(ts: Column) -> Column:
    """Start of the UTC minute, whatever the session zone."""
    sec = F.unix_seconds(ts)
    return F.timestamp_seconds(sec - F.pmod(sec, F.lit(60)))


def utc_day_number(ts: Column) -> Column:
    """Days since 1970-01-01 in UTC, whatever the session zone."""
    return F.floor(F.unix_seconds(ts) / 86400).cast("int")


def day_start(day: Column) -> Column:
    """UTC midnight that opens `day`."""
    return F.timestamp_seconds(F.unix_date(day).cast("bigint") * 86400)


def in_day(ts: Column, day: Column) -> Column:
    """Half-open test: day <= ts < day + 1, in UTC."""
    return utc_day_number(ts) == F.unix_date(day)


def parse_number(c: Column, dtype: T.DataType) -> Column:
    """To double, NULL where the value is no number.

    Text is matched first: a bare cast would also take Java suffixes such as '1.0d'.
    """
    if isinstance(dtype, T.DoubleType):
        return nan_to_null(c)
    if isinstance(dtype, T.StringType):
        return nan_to_null(F.when(c.rlike(NUMBER_TEXT), c.try_cast("double")))
    if isinstance(dtype, T.BooleanType) or isinstance(dtype, T.NumericType):
        return nan_to_null(c.cast("double"))
    return F.lit(None).cast("double")


def from_epoch(c: Column, unit: str, dtype: T.DataType) -> Column:
    """Epoch count in `s`, `ms` or `ns` to an instant; out-of-range counts become NULL."""
    per_second = {"s": 1, "ms": 1_000, "ns": 1_000_000_000}[unit]
    if isinstance(dtype, T.IntegralType):
        c = c.cast("bigint")
        if unit == "ns":
            return F.timestamp_micros(
                F.call_function("div", c - F.pmod(c, F.lit(1000)), F.lit(1000))
            )
        scale = 1_000_000 // per_second
        ok = c.between(MIN_MICROS // scale + 1, MAX_MICROS // scale)
        return F.when(ok, F.timestamp_micros(c * scale))
    c = c.cast("double")
    micros = c * (1_000_000 / per_second)
    return F.when(
        micros.between(float(MIN_MICROS), float(MAX_MICROS)),
        F.timestamp_micros(F.round(micros).cast("bigint")),
    )


def _from_text(c: Column) -> Column:
    """ISO texts by a cast, others by the first of `TEXT_DATES` that fits, else NULL."""
    text = F.trim(c)
    iso = F.when(c.rlike(ISO_TEXT), c.try_cast("timestamp"))
    year = F.when(c.rlike(r"^\s*\d{4}\s*$"), c.try_cast("timestamp"))
    others = [F.try_to_timestamp(text, F.lit(d + TEXT_TIME)) for d in TEXT_DATES]
    return F.coalesce(iso, year, *others)


def text_stem(c: Column) -> Column:
    """A time text with its time of day replaced by a fixed one of the same shape.

    The texts of a day have few stems, so what form they have can be settled on these.
    """
    text = F.trim(c)
    ones = F.translate(F.regexp_extract(text, TEXT_CLOCK, 2), "023456789", "111111111")
    clocked = F.concat(F.regexp_extract(text, TEXT_CLOCK, 1), F.lit("11:11:11"), ones, F.regexp_extract(text, TEXT_CLOCK, 3))
    return F.when(text.rlike(TEXT_CLOCK), clocked).otherwise(text)


def _looks_like(pattern: str) -> str:
    """A regular expression that texts of a date pattern match, so that few are tried in vain."""
    shapes = {"yyyy": r"\d{4}", "MMMM": "[A-Za-z]{3,9}", "MMM": "[A-Za-z]{3}", "MM": r"\d{2}", "dd": r"\d{2}"}
    parts = re.split(r"(y+|M+|d+)", pattern)
    return "^" + "".join(shapes.get(p, r"\d{1,2}") if p[:1] in ("y", "M", "d") else re.escape(p) for p in parts) + r"(?!\d)"


def text_forms(stem: Column) -> Column:
    """The forms that a stem may have, each with its instant: an array of (rank, form, instant).

    A form is `ISO_FORM`, or a datetime pattern, after an `E` where a weekday stands in front.
    """
    iso = F.struct(
        F.lit(0).alias("rank"), F.lit(ISO_FORM).alias("form"),
        F.when(stem.rlike(ISO_TEXT) | stem.rlike(r"^\d{4}$"), stem.try_cast("timestamp")).alias("instant"),
    )
    named = stem.rlike(TEXT_WEEKDAY)
    body = F.regexp_replace(stem, TEXT_WEEKDAY, "")
    tail = F.when(stem.rlike(TEXT_NOON), TEXT_HALF_DAY).otherwise(TEXT_TIME)
    others = []
    for i, date in enumerate(TEXT_DATES):
        form = F.concat(F.lit(date), tail)
        instant = F.when(body.rlike(_looks_like(date)), F.try_to_timestamp(body, form))
        form = F.concat(F.when(named, "E").otherwise(""), form)
        others.append(F.struct(F.lit(i + 1).alias("rank"), form.alias("form"), instant.alias("instant")))
    return F.filter(F.array(iso, *others), lambda x: x["instant"].isNotNull())


def parse_text(c: Column, form: str | None) -> Column:
    """Texts of one form to instants (UTC where they name no zone); others are NULL."""
    if form is None:
        return F.lit(None).cast("timestamp")
    if form == ISO_FORM:
        out = F.when(c.rlike(ISO_TEXT) | c.rlike(r"^\s*\d{4}\s*$"), c.try_cast("timestamp"))
    elif form.startswith("E"):
        out = F.try_to_timestamp(F.regexp_replace(F.trim(c), TEXT_WEEKDAY, ""), F.lit(form[1:]))
    else:
        out = F.try_to_timestamp(F.trim(c), F.lit(form))
    return _in_range(out)


def _in_range(ts: Column) -> Column:
    return F.when(
        ts.between(F.timestamp_micros(F.lit(MIN_MICROS)), F.timestamp_micros(F.lit(MAX_MICROS))), ts
    )


def parse_instant(c: Column, dtype: T.DataType) -> Column:
    """A `ts`-like column to an instant: typed values as they are, integers as
    nanoseconds, texts parsed (UTC when they name no zone), anything else NULL."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        out = c.cast("timestamp")
    elif isinstance(dtype, T.StringType):
        out = _from_text(c)
    elif isinstance(dtype, T.NumericType):
        return from_epoch(c, "ns", dtype)
    else:
        return F.lit(None).cast("timestamp")
    return _in_range(out)
