"""Record validation with quarantine, payload explode.

Rules are data: allowed values per column, numeric ranges, integer
truncation and trimming.  ``validate_records`` adds an ``errors`` array
(empty = valid), computed with built-in expressions only; valid rows and
the quarantine are two filters of the same frame, so
valid + quarantine = input, always.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.scalar import to_numeric


@dataclass(frozen=True)
class RecordRules:
    allowed: dict = field(default_factory=dict)   # column -> list of allowed values
    ranges: dict = field(default_factory=dict)    # column -> (low or None, high or None)
    int_cols: tuple = ()                          # truncated to int ('2.7' -> 2) before checks
    strip: bool = True                            # trim text columns


# The reference's scoring request schema.
SCORING_RULES = RecordRules(
    allowed={
        "pais_cd": ["GT", "EC", "PE", "SV"],
        "tipo_cliente_cd": ["TIENDA", "MINIMARKET", "MAYORISTA"],
        "madurez_digital_cd": ["BAJA", "MEDIA", "ALTA"],
        "frecuencia_visitas_cd": ["LM", "L", "LMI", "LMV"],
        "estrellas_txt": [1, 2, 3],
    },
    ranges={
        "cajas_fisicas": (0, None),
        "fecha_pedido_dt_day_of_week": (0, 6),
        "fecha_pedido_dt_quarter": (1, 4),
    },
    int_cols=("estrellas_txt",),
)

# Batch size limits of one request payload.
PAYLOAD_MIN, PAYLOAD_MAX = 1, 100


def normalise(df: DataFrame, rules: RecordRules) -> DataFrame:
    """Trim text (C6) and truncate integer fields."""
    types = dict(df.dtypes)
    exprs = {}
    if rules.strip:
        exprs.update({c: F.trim(F.col(c)) for c, t in types.items() if t == "string"})
    for c in rules.int_cols:
        if c in types:
            exprs[c] = to_numeric(F.col(c)).cast("int")
    return df.withColumns(exprs) if exprs else df


def validate_records(df: DataFrame, rules: RecordRules, errors_col: str = "errors") -> DataFrame:
    """Add ``errors``: one text per failed rule (V1)."""
    df = normalise(df, rules)
    checks = []
    for c, allowed in rules.allowed.items():
        col = F.col(c)
        checks.append(F.when(col.isNull(), F.lit(f"{c}: missing"))
                      .when(~col.isin(*allowed), F.concat(F.lit(f"{c}: not allowed "),
                                                         col.cast("string"))))
    for c, (lo, hi) in rules.ranges.items():
        col = F.col(c)
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (col < F.lit(lo))
        if hi is not None:
            bad = bad | (col > F.lit(hi))
        checks.append(F.when(col.isNull(), F.lit(f"{c}: missing"))
                      .when(bad, F.concat(F.lit(f"{c}: out of range "), col.cast("string"))))
    errs = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array()
    return df.withColumn(errors_col, errs)


def split_valid(df_checked: DataFrame, errors_col: str = "errors"):
    """(valid rows, quarantined rows with reasons)."""
    valid = df_checked.filter(F.size(errors_col) == 0).drop(errors_col)
    bad = df_checked.filter(F.size(errors_col) > 0)
    return valid, bad


def payload_size_ok(records_col: str, lo: int = PAYLOAD_MIN, hi: int = PAYLOAD_MAX):
    """Payload batch size check (V2)."""
    n = F.size(F.col(records_col))
    return (n >= lo) & (n <= hi)


def payload_to_rows(payloads: DataFrame, records_col: str = "records",
                    categories: dict | None = None, keep: list[str] | None = None) -> DataFrame:
    """Explode ``records: array<struct>`` into rows; values outside the fixed
    category lists become null (I1)."""
    base = payloads.select(*(keep or []), F.posexplode(records_col).alias("record_pos", "_r"))
    rows = base.select(*(keep or []), "record_pos", "_r.*")
    for c, cats in (categories or {}).items():
        if c in rows.columns:
            rows = rows.withColumn(c, F.when(F.col(c).isin(*cats), F.col(c)))
    return rows
