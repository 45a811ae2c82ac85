"""Small helpers that render fixed lookup tables into oracle SQL text."""

from __future__ import annotations


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_map(expr: str, d: dict, default: str | None = "NULL") -> str:
    """CASE expr WHEN k THEN v ... ELSE default END (string or int values)."""
    parts = []
    for k, v in d.items():
        val = q(v) if isinstance(v, str) else str(v)
        parts.append(f"WHEN {expr} = {q(k)} THEN {val}")
    return "CASE " + " ".join(parts) + f" ELSE {default} END"


def mode_cte(name: str, src: str, key: str, col: str, order: str = "season, row_no") -> str:
    """Most frequent non-blank ``col`` per ``key``; ties go to the value whose
    first row (by ``order``) comes first."""
    return f"""
{name} AS (
  SELECT {key}, v AS {name} FROM (
    SELECT {key}, v, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, fs, fr) AS rk FROM (
      SELECT {key}, v, count(*) AS n,
             min(s1) AS fs, min(CASE WHEN s1 = fs0 THEN r1 END) AS fr
      FROM (SELECT {key}, {col} AS v, season AS s1, row_no AS r1,
                   min(season) OVER (PARTITION BY {key}, {col}) AS fs0
            FROM {src} WHERE {col} IS NOT NULL AND {col} <> '') t
      GROUP BY {key}, v) c) r
  WHERE rk = 1
)"""
