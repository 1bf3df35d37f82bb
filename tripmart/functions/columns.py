"""Column builders (the reference's SQL macros and scalar idioms).

Every function returns a ``Column`` built from ``pyspark.sql.functions``, so
the work stays inside whole-stage codegen; there is no Python UDF here.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, FloatType, TimestampNTZType, TimestampType

ColumnOrName = Column | str

# Fixed values that must equal the reference's for equal results.
# Vendor codes and names of the vendor macro (no ELSE branch: others give NULL).
VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
    4: "Unknown/Other",
}
# Null marker of the surrogate-key macro and its field separator.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- casts -----------------------------------------------------------------

def cast_int(c: ColumnOrName, rounding: str = "half_away") -> Column:
    """Integer cast that rounds instead of truncating (FN-2).

    Spark truncates 2.5 to 2; the warehouse the reference targets rounds half
    away from zero.  ``rounding='half_even'`` gives DuckDB's behaviour.
    """
    dec = _c(c).cast("decimal(38,9)")
    r = F.bround(dec, 0) if rounding == "half_even" else F.round(dec, 0)
    return r.cast("int")


def safe_cast(c: ColumnOrName, data_type: str | DataType) -> Column:
    """NULL instead of an error on a bad value (FN-3).

    Integer targets go through DECIMAL so that text such as '1.0' or ' 1 '
    becomes 1 (a direct string->int try_cast gives NULL for '1.0').
    """
    col = _c(c)
    dt = data_type if isinstance(data_type, str) else data_type.simpleString()
    if dt in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        target = "int" if dt in ("int", "integer") else dt
        return F.round(col.try_cast("decimal(38,9)"), 0).try_cast(target)
    return col.try_cast(dt)


def numeric(c: ColumnOrName) -> Column:
    """The reference's NUMERIC type."""
    return _c(c).cast("decimal(38,9)")


# --- hashing ---------------------------------------------------------------

def render(c: ColumnOrName, data_type: DataType | None = None) -> Column:
    """Stable text of a value for hashing: dates ``yyyy-MM-dd``, timestamps
    ``yyyy-MM-dd HH:mm:ss``, floating point numbers in plain decimal notation
    without an exponent (10000000.0, 0.05), everything else its string cast."""
    col = _c(c)
    if isinstance(data_type, DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    if isinstance(data_type, (DoubleType, FloatType)):
        # Engines agree on decimals but not on when to write an exponent.
        exact = col.try_cast("decimal(38,9)")
        digits = F.rtrim(exact.cast("string"), F.lit("0"))
        plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
        return F.when(exact.cast(data_type) == col, plain).otherwise(col.cast("string"))
    return col.cast("string")


def row_hash(df_schema, cols: Sequence[str]) -> Column:
    """Row id of the staged loads (FN-4, FN-5): md5 over the concatenation of
    the rendered fields, NULL rendered as '' and no separator (so ('1','2x')
    and ('12','x') collide, as in the reference)."""
    types = {f.name: f.dataType for f in df_schema.fields}
    parts = [F.coalesce(render(c, types.get(c)), F.lit("")) for c in cols]
    return F.md5(F.concat(*parts))


def surrogate_key(*cols: ColumnOrName) -> Column:
    """Surrogate key (FN-6): md5 of the string casts joined by '-', NULLs
    replaced by a fixed marker."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


# --- dates and times -------------------------------------------------------

def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (FN-13).

    00:00:59 -> 00:01:01 is 1, 00:00:01 -> 00:00:59 is 0, negative when end
    is before start.  Built from calendar fields, so it does not depend on the
    session time zone for TIMESTAMP_NTZ input.
    """
    s, e = _c(start), _c(end)
    days = F.datediff(F.to_date(e), F.to_date(s)).cast("bigint")
    mins_e = F.hour(e) * 60 + F.minute(e)
    mins_s = F.hour(s) * 60 + F.minute(s)
    return days * 1440 + (mins_e - mins_s).cast("bigint")


def month_start(ts: ColumnOrName) -> Column:
    """``date_trunc('month', ts)`` as a DATE (FN-12)."""
    return F.trunc(F.to_date(_c(ts)), "MM")


def ts_literal(value, like: DataType | None = None) -> Column:
    """A timestamp literal typed like the column it is compared with, so the
    comparison is pushed to the Parquet reader without a cast on the column."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    elif isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    if isinstance(like, TimestampNTZType):
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def in_window(ts: ColumnOrName, start, end, like: DataType | None = None,
              date_col: ColumnOrName | None = None) -> Column:
    """Half-open ``start <= ts < end`` (FLT-4).  With ``date_col`` (the derived
    partition date of a clustered table) the implied date range is added so
    that partition pruning applies."""
    t = _c(ts)
    pred = (t >= ts_literal(start, like)) & (t < ts_literal(end, like))
    if date_col is not None:
        d = _c(date_col)
        s = ts_literal(start).cast("date")
        e = ts_literal(end).cast("date")
        pred = pred & (d >= s) & (d <= e)
    return pred


def on_date(ts: ColumnOrName, day, like: DataType | None = None) -> Column:
    """``DATE(ts) = day`` rewritten as a half-open range (FLT-3), which the
    Parquet reader can use, unlike ``to_date(ts) = day``."""
    if isinstance(day, str):
        day = _dt.date.fromisoformat(day)
    return in_window(ts, day, day + _dt.timedelta(days=1), like)


def in_range_inclusive(ts: ColumnOrName, start, end, like: DataType | None = None) -> Column:
    """``ts BETWEEN start AND end`` (FLT-5); an end of 23:59:59 drops the last
    fractional second, as in the reference."""
    t = _c(ts)
    return (t >= ts_literal(start, like)) & (t <= ts_literal(end, like))


def in_date_window(ts: ColumnOrName, start, end) -> Column:
    """``[date(start), date(end))`` on the date part of ``ts`` (FLT-6)."""
    d = F.to_date(_c(ts))
    return (d >= ts_literal(start).cast("date")) & (d < ts_literal(end).cast("date"))


# --- mappings, text, predicates ------------------------------------------

def map_literal(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """Simple CASE from a dictionary (FN-10); constant-folded by Catalyst."""
    col = _c(c)
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out


def vendor_name(c: ColumnOrName) -> Column:
    return map_literal(c, VENDOR_NAMES)


def normalize_text(c: ColumnOrName) -> Column:
    """``lower(trim(cast(c as string)))`` (FN-16)."""
    return F.lower(F.trim(_c(c).cast("string")))


def is_credit(payment: ColumnOrName) -> Column:
    """Credit-card payment: text containing 'credit' or the code '1'."""
    p = _c(payment).cast("string")
    return F.lower(F.trim(p)).like("%credit%") | (F.trim(p) == F.lit("1"))


def pct_where(pred: Column, digits: int = 2) -> Column:
    """``ROUND(100 * AVG(CASE WHEN pred THEN 1 ELSE 0 END), digits)`` (AGG-9),
    computed exactly in DECIMAL and returned as DOUBLE."""
    hits = F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("decimal(38,0)")
    n = F.count(F.lit(1)).cast("decimal(38,0)")
    return F.round(hits * F.lit(100) / n, digits).cast("double")


def sum_zero(c: ColumnOrName) -> Column:
    """``SUM(COALESCE(c, 0))`` (AGG-10): 0 rather than NULL over all-null input."""
    return F.sum(F.coalesce(_c(c), F.lit(0)))


def avg_rounded(c: ColumnOrName, digits: int = 2) -> Column:
    """``ROUND(AVG(c), digits)`` as DOUBLE (AGG-11).  Text values that are
    not numbers (such as a default 'N/A') are skipped; the average is taken
    in DECIMAL, so the rounding of a half is exact (half away from zero)."""
    return F.round(F.avg(_c(c).try_cast("decimal(18,2)")), digits).cast("double")
