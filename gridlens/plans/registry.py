"""Registration of queries together with their reference SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.plans.fixtures import VIEWS, Fixtures, duck
from gridlens.session import tune

# Both sides round the same way. The bias keeps exact ties on one side whatever the
# last bits of a sum, which depend on the order of addition, may be.
_SCALE, _BIAS = 10_000.0, 0.5001


_WHOLE = 2.0 ** 52  # doubles from here on have no places after the point


def rounded(column: Column) -> Column:
    moved = column * _SCALE + _BIAS
    return F.when(F.abs(moved) < _WHOLE, F.floor(moved).cast("double")).otherwise(moved) / _SCALE


def rounded_sql(name: str) -> str:
    return f"floor({name} * {_SCALE} + {_BIAS}) / {_SCALE} AS {name}"


@dataclass(frozen=True)
class Query:
    build: Callable[[Fixtures], DataFrame]
    keys: list[str]
    doubles: list[str]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        out = self.build(Fixtures(tune(spark), sf_dir))
        cells = []
        for name in [*self.keys, *self.doubles]:
            cell = rounded(F.col(name).cast("double")) if name in self.doubles else F.col(name)
            kind = out.schema[name].dataType.typeName()
            if kind in ("timestamp", "date"):
                cell = cell.cast("timestamp_ntz" if kind == "timestamp" else "string")
            cells.append(cell.alias(name))
        return out.select(*cells)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        cells = [*self.keys, *[rounded_sql(d) for d in self.doubles]]
        parts = [f"{name} AS ({sql})" for name, sql in _needed(self.sql)]
        parts.append(f"_result AS ({self.sql})")
        return f"WITH {', '.join(parts)}\nSELECT {', '.join(cells)} FROM _result"


REGISTRY: dict[str, Query] = {}
HELPERS: dict[str, str] = {}


def helper(name: str, sql: str) -> None:
    """A named part of the reference SQL that several queries share."""
    HELPERS[name] = sql


def _needed(sql: str) -> list[tuple[str, str]]:
    known = {**{k: duck(v) for k, v in VIEWS.items()}, **HELPERS}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:fx|h)_\w+", text):
            if name in known and name not in order:
                visit(known[name])
                order.append(name)

    visit(sql)
    return [(name, known[name]) for name in order]


def query(name: str, keys: str, doubles: str = "", sql: str | None = None):
    """Register a query: its exact columns, its rounded columns and its reference SQL."""
    def wrap(build: Callable[[Fixtures], DataFrame]):
        REGISTRY[name] = Query(build, keys.split(), doubles.split(), sql)
        return build
    return wrap


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.oracle() for name, q in REGISTRY.items() if q.sql is not None}
