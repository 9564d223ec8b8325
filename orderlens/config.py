"""Immutable configuration objects."""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Literal

AggFunc = Literal["first", "sum", "max", "last"]
ALLOWED_AGGS = ("first", "sum", "max", "last")


@dataclass(frozen=True)
class TransactionSchema:
    """Column roles of a transaction table.

    ``tiebreak`` orders rows that share (key, date); without it the reference
    falls back to file order, which is not deterministic.
    """

    key: str = "cliente_id"
    date: str = "fecha_pedido_dt"
    label: str = "canal_pedido_cd"
    tiebreak: str | None = None


@dataclass(frozen=True)
class RollupSpec:
    """Column -> aggregate ('first' | 'sum' | 'max' | 'last')."""

    aggregations: dict = field(default_factory=dict)

    def __post_init__(self):
        bad = {c: a for c, a in self.aggregations.items() if a not in ALLOWED_AGGS}
        if bad:
            raise ValueError(f"unknown aggregations: {bad}")
        object.__setattr__(self, "aggregations", MappingProxyType(dict(self.aggregations)))

    def columns(self) -> list[str]:
        return list(self.aggregations)


# The reference's default customer roll-up spec.
DEFAULT_ROLLUP = RollupSpec({
    "pais_cd": "first",
    "region_comercial_txt": "first",
    "agencia_id": "first",
    "ruta_id": "first",
    "tipo_cliente_cd": "first",
    "madurez_digital_cd": "first",
    "estrellas_txt": "first",
    "frecuencia_visitas_cd": "first",
    "facturacion_usd_val": "sum",
    "materiales_distintos_val": "sum",
    "cajas_fisicas": "sum",
    "fecha_pedido_dt": "max",
    "canal_pedido_cd": "last",
})


@dataclass(frozen=True)
class CastConfig:
    """Selective coercion settings.

    ``dtype_map`` maps column -> target type name; names starting with
    'float'/'double' go through lenient numeric coercion.
    """

    dtype_map: dict | None = None
    coerce_dtypes: bool = True
    fail_if_empty: bool = True
    timestamp_cols: tuple = ()
