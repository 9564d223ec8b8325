"""Validation and selective casting."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.config import CastConfig
from orderlens.functions.scalar import to_numeric_typed, to_timestamp_lenient

log = logging.getLogger(__name__)


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "operation") -> None:
    """Schema check before any job runs."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns for {what}: {missing}")


def check_not_empty(df: DataFrame, fail_if_empty: bool = True) -> bool:
    """Empty guard (P5): raise, or report False to let the caller pass through."""
    if df.isEmpty():
        if fail_if_empty:
            raise ValueError("input DataFrame is empty")
        log.warning("empty DataFrame received; passing it through")
        return False
    return True


def validate_and_cast(df: DataFrame, config: CastConfig, *, check_empty: bool = True) -> DataFrame:
    """Coerce the columns named in ``config.dtype_map`` (P1-P4) and parse dates.

    * 'float*'/'double' targets: unparsable text becomes null (P1).
    * other targets: a strict cast; when any non-null value would fail, the
      column is kept as it was (P2).  All failure counts come from ONE
      aggregate over the frame.
    * absent columns are skipped (P4).
    * an empty frame raises or passes through (P5); looking for a first row runs
      the plan behind ``df``, so a caller that writes the result and looks at
      what was written turns this off with ``check_empty``.
    """
    if check_empty and not check_not_empty(df, config.fail_if_empty):
        return df
    types = dict(df.dtypes)
    schema = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    if config.coerce_dtypes and config.dtype_map:
        strict = {}
        for col, dtype in config.dtype_map.items():
            if col not in types:
                continue
            if dtype.startswith("float") or dtype == "double":
                exprs[col] = to_numeric_typed(col, schema[col])
            else:
                strict[col] = dtype
        if strict:
            fails = df.agg(*[
                F.sum((F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).cast("long")).alias(c)
                for c, t in strict.items()]).first().asDict()
            for c, t in strict.items():
                if fails[c]:
                    log.warning("could not cast %s to %s (%d values); kept as is", c, t, fails[c])
                else:
                    exprs[c] = F.col(c).try_cast(t)
    for col in config.timestamp_cols:
        if col in types:
            exprs[col] = to_timestamp_lenient(col, schema[col])
    if not exprs:
        return df
    return df.withColumns({c: e.alias(c) for c, e in exprs.items()})


def drop_id_columns(df: DataFrame, pattern: str = "_id", keep: Iterable[str] = ()) -> DataFrame:
    """Drop columns whose lower-cased name contains ``pattern``."""
    keep = set(keep)
    return df.drop(*[c for c in df.columns if pattern in c.lower() and c not in keep])


def align_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select ``columns`` in model order; missing ones raise."""
    require_columns(df, columns, "model input")
    return df.select(*columns)
