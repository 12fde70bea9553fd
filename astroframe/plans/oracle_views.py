"""SQL text of the views the DuckDB oracles build on (CTEs, with dependencies)."""

from __future__ import annotations

from astroframe.constants import CLASS_MAPPING
from astroframe.sources.fixtures import duckdb_cte


def _class_case(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CLASS_MAPPING.items())
    return f"CASE {col} {whens} ELSE {col} END"


CLEANED = """
SELECT spkid, full_name, kind, class, neo, pha, e, a,
  CASE WHEN i > 180 THEN 180.0e0 WHEN i < 0 THEN 0.0e0 ELSE i END AS i,
  om, w, q, ad, per_y, epoch,
  CASE WHEN "H" < -5 OR "H" > 35 THEN NULL ELSE "H" END AS "H",
  CASE WHEN diameter <= 0 THEN NULL ELSE diameter END AS diameter,
  albedo, moid
FROM bodies WHERE e IS NOT NULL AND a IS NOT NULL AND e >= 0
"""

PROCESSED = f"""
SELECT *,
  CASE WHEN e <= 1 THEN (CASE WHEN a <> 0 THEN 5.2044e0 / a END)
       + 2.0e0 * cos(radians(i)) * sqrt(abs(a / 5.2044e0) * (1.0e0 - e * e)) END AS tisserand_j,
  CASE WHEN e > 1.0 THEN (CASE WHEN a <> 0 THEN sqrt(abs(1.0e0 / a)) * 29.78e0 END) ELSE 0.0e0 END AS v_inf,
  CASE WHEN a <> 0 THEN -1.0e0 / (2.0e0 * a) END AS energy_param,
  CASE WHEN a <> 0 THEN abs(q / a) END AS q_over_a,
  CASE WHEN kind = 'iso' THEN 'ISO' WHEN e > 1.0 THEN 'ISO' ELSE {_class_case('class')} END AS object_type
FROM cleaned
"""

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "bodies": (duckdb_cte("bodies"), ()),
    "galaxies": (duckdb_cte("galaxies"), ()),
    "ephemeris": (duckdb_cte("ephemeris"), ()),
    "model_runs": (duckdb_cte("model_runs"), ()),
    "cleaned": (CLEANED, ("bodies",)),
    "processed": (PROCESSED, ("cleaned",)),
}


def add_view(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    VIEWS[name] = (sql, deps)


def with_views(names, body: str) -> str:
    """``WITH`` clause holding the named views and their dependencies, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][0]})" for n in order)
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"
