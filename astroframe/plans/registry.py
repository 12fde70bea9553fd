"""Registry of checked queries: Spark builder + DuckDB oracle per operator key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from astroframe.functions.columns import rounded
from astroframe.plans.oracle_views import with_views


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    views: Sequence[str] = ()
    round_cols: Sequence[str] = field(default_factory=tuple)
    places: int = 6

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        if self.round_cols:
            df = df.withColumns({c: rounded(c, self.places) for c in self.round_cols})
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        body = self.sql
        if self.round_cols:
            reps = ", ".join(sql_rounded(f'"{c}"', self.places) + f' AS "{c}"' for c in self.round_cols)
            body = f"SELECT * REPLACE ({reps}) FROM ({body}) AS q__"
        return with_views(self.views, body)


def sql_rounded(expr: str, places: int = 6) -> str:
    """SQL twin of ``functions.columns.rounded``."""
    scale = f"{10 ** places}.0"
    expr = f"({expr})"
    return (f"CASE WHEN abs({expr}) * {scale} < 4503599627370496.0 THEN CAST(floor({expr} * {scale} + 0.5) AS DOUBLE)"
            f" / {scale} + 0.0 ELSE {expr} END")


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: Sequence[str] = (),
          round_cols: Sequence[str] = (), places: int = 6):
    """Decorator registering ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(views), tuple(round_cols), places)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every query module (registration happens on import)."""
    from astroframe.plans import checks  # noqa: F401

    return REGISTRY
