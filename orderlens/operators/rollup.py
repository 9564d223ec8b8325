"""Customer roll-up and row de-duplication (A1-A3).

The roll-up is ONE ``groupBy(key).agg(...)``: ``first``/``last`` are
``min_by``/``max_by`` over an ordering struct, which aggregate partially on
the map side, so a hot key with a third of all rows reaches the shuffle as
one row per map task instead of as a sorted run.  No global sort is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.config import RollupSpec, TransactionSchema
from orderlens.operators.cast import require_columns


def _order_struct(schema: TransactionSchema, df: DataFrame) -> Column:
    """(date IS NULL, date, tiebreak): missing dates sort last, as pandas does."""
    parts = [F.col(schema.date).isNull(), F.col(schema.date)]
    if schema.tiebreak and schema.tiebreak in df.columns:
        parts.append(F.col(schema.tiebreak))
    return F.struct(*parts)


def _clean_number(c: str, dtype: T.DataType) -> Column:
    col = F.col(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.nanvl(col, F.lit(None).cast(dtype))  # NaN poisons Spark sums
    return col


def rollup_exprs(df: DataFrame, spec: RollupSpec, schema: TransactionSchema) -> list[Column]:
    """The aggregate expressions for ``spec`` (A1a-A1d)."""
    order = _order_struct(schema, df)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c, how in spec.aggregations.items():
        col = F.col(c)
        if how == "first":  # first non-missing in (key, date, tiebreak) order
            e = F.min_by(col, F.when(col.isNotNull(), order))
        elif how == "last":  # last non-missing; missing dates count as latest
            e = F.max_by(col, F.when(col.isNotNull(), order))
        elif how == "sum":  # missing skipped, all-missing -> 0
            e = F.coalesce(F.sum(_clean_number(c, types[c])), F.lit(0).cast(
                "double" if not isinstance(types[c], T.IntegralType) else "long"))
        else:  # max
            e = F.max(col)
        out.append(e.alias(c))
    return out


def aggregate_to_customer(df: DataFrame, spec: RollupSpec, schema: TransactionSchema) -> DataFrame:
    """One row per key (A1).  Rows with a null key are dropped, like pandas groupby."""
    require_columns(df, [schema.key], "roll-up key")
    require_columns(df, spec.columns(), "roll-up")
    return (df.filter(F.col(schema.key).isNotNull())
            .groupBy(schema.key)
            .agg(*rollup_exprs(df, spec, schema)))


def aggregate_with_attributes(facts: DataFrame, attributes: DataFrame, spec: RollupSpec,
                              schema: TransactionSchema) -> DataFrame:
    """Roll up the fact columns, THEN attach per-key attribute columns (A1, skew-safe form).

    ``attributes`` holds one row per key (a dimension such as customer ⋈
    nation ⋈ region).  For such columns 'first'/'last' over a key's rows is
    the attribute itself, so joining after the aggregate gives the same
    result as rolling up the denormalised table - but the big side is
    combined map-side before any shuffle, and the join is 1:1 per key, so a
    key holding a third of all rows never reaches one task as raw rows.
    """
    fact_cols = [c for c in spec.columns() if c in facts.columns]
    attr_cols = [c for c in spec.columns() if c not in facts.columns]
    bad = [c for c in attr_cols if spec.aggregations[c] not in ("first", "last")]
    if bad:
        raise ValueError(f"attribute columns need 'first'/'last', got: {bad}")
    require_columns(attributes, [schema.key, *attr_cols], "roll-up attributes")
    rolled = aggregate_to_customer(
        facts, RollupSpec({c: spec.aggregations[c] for c in fact_cols}), schema)
    attrs = attributes.select(schema.key, *attr_cols)
    return rolled.join(attrs, schema.key, "left").select(schema.key, *spec.columns())


def keep_last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row of each key by ``order`` (A2).

    ``max_by(struct(row), struct(order))`` instead of a row_number window:
    the window would stream every row of a hot key through one task, the
    aggregate combines on the map side first.
    """
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    picked = (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_row")))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Exact duplicate rows removed (A3); partial de-dup runs map-side."""
    return df.dropDuplicates()
