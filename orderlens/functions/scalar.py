"""Column-level helpers (all built-in expressions, so they stay in codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values ------------------------------------------------------------
# Token that stands for a missing categorical value in association tables.
NA_TOKEN = "__NA__"
# Plain decimal / scientific number, optional sign, surrounding blanks allowed.
# Spark's own cast also takes suffixes such as '1.0d' or '2f'; pandas does not.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Weekday names, Monday first (index = weekday()).
DAY_NAMES_ES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
# Month names, January first (index = month - 1).
MONTH_NAMES_ES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
                  "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_numeric(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Numeric coercion where unparsable text becomes null.

    Numbers pass through as double; strings must look like a plain number.
    """
    col = _col(c)
    return F.when(col.cast("string").rlike(NUMERIC_TEXT),
                  F.trim(col.cast("string")).try_cast("double"))


def to_numeric_typed(c: str | Column, source: T.DataType) -> Column:
    """Like :func:`to_numeric` but skips the text check when already numeric."""
    col = _col(c)
    if isinstance(source, T.NumericType):
        return F.nanvl(col.cast("double"), F.lit(None).cast("double")) if isinstance(
            source, (T.FloatType, T.DoubleType)) else col.cast("double")
    return to_numeric(col)


def to_timestamp_lenient(c: str | Column, source: T.DataType | None = None) -> Column:
    """Timestamp parse where bad text becomes null.

    Timestamp and date inputs keep their value; text is parsed without a
    time zone shift (the test tables hold TIMESTAMP_NTZ).
    """
    col = _col(c)
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return col
    if isinstance(source, T.DateType):
        return col.cast("timestamp_ntz")
    return F.try_to_timestamp(col.cast("string")).cast("timestamp_ntz")


_EPOCH_NTZ = "1970-01-01 00:00:00"


def epoch_micros(c: str | Column, source: T.DataType | None = None) -> Column:
    """Microseconds since 1970-01-01.  TIMESTAMP_NTZ / DATE values are wall
    clock, read as UTC whatever the session time zone; TIMESTAMP values are
    instants."""
    col = _col(c)
    if isinstance(source, T.TimestampType):
        return F.unix_micros(col)
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"),
                            col.cast("timestamp_ntz"))


def wall_clock_as_utc(c: str | Column) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP holding the same wall clock in UTC
    (independent of the session time zone)."""
    return F.timestamp_micros(epoch_micros(c))


def utc_as_wall_clock(c: str | Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ with its UTC wall clock (inverse of
    :func:`wall_clock_as_utc`)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(c)),
                           F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def weekday_monday0(c: str | Column) -> Column:
    """Day of week with Monday = 0 .. Sunday = 6."""
    return F.weekday(_col(c))


def quarter(c: str | Column) -> Column:
    """Quarter 1-4."""
    return F.quarter(_col(c))


def day_name(c: str | Column, names: Sequence[str] = DAY_NAMES_ES) -> Column:
    """Translated day name."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.weekday(_col(c)) + 1)


def month_name(c: str | Column, names: Sequence[str] = MONTH_NAMES_ES) -> Column:
    """Translated month name (C4)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.month(_col(c)))


def with_na_token(c: str | Column, token: str = NA_TOKEN) -> Column:
    """Missing (null or NaN) to a visible token, everything as text.

    NaN is a missing number; the text "NaN" in a string column is a value.
    """
    col = _col(c)
    as_text = col.cast("string")
    nan = F.typeof(col).isin("double", "float") & (as_text == "NaN")
    return F.when(col.isNull() | nan, F.lit(token)).otherwise(as_text)


def clean_text(c: str | Column) -> Column:
    """Cast to text and trim."""
    return F.trim(_col(c).cast("string"))


def truncate_to_int(c: str | Column) -> Column:
    """Text or float to int by truncation; '2.7' -> 2, 'abc' -> null."""
    return to_numeric(c).cast("int")


def argmax_index(probs: str | Column) -> Column:
    """0-based index of the largest entry, first maximum wins."""
    p = _col(probs)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def index_to_label(idx: str | Column, labels: Sequence[str]) -> Column:
    """0-based class index to class name."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), _col(idx) + 1)


def all_finite_nonneg(arr: str | Column) -> Column:
    """True when every entry is finite and >= 0."""
    return F.forall(_col(arr), lambda x: (x >= 0) & ~F.isnan(x) & (x < float("inf")))


def clamp(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """greatest/least clamp (C11)."""
    col = _col(c)
    if lo is not None:
        col = F.greatest(col, F.lit(lo))
    if hi is not None:
        col = F.least(col, F.lit(hi))
    return col


def to_json_record(*cols: str | Column) -> Column:
    """JSON text of a record."""
    return F.to_json(F.struct(*[_col(c) for c in cols]))


def uri_tail(c: str | Column) -> Column:
    """Last path element of a URI, e.g. a model version."""
    return F.element_at(F.split(_col(c), "/"), -1)
