"""Small DuckDB SQL fragments used by the oracle texts of the catalogue.

They spell out the same semantics as ``riskfeat.functions.exprs`` in plain
SQL (IEEE division, exact money sums, null-counting distinct).
"""

from __future__ import annotations

MONEY = "DECIMAL(18,4)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE))"


def sum0(x: str, exact: bool = True) -> str:
    if exact:
        return f"COALESCE(CAST(SUM(CAST({x} AS {MONEY})) AS DOUBLE), CAST(0 AS DOUBLE))"
    return f"COALESCE(SUM({x}), 0)"


def mean(x: str, exact: bool = True) -> str:
    if exact:
        return f"(CAST(SUM(CAST({x} AS {MONEY})) AS DOUBLE) / COUNT({x}))"
    return f"(CAST(SUM({x}) AS DOUBLE) / COUNT({x}))"


def count_if(cond: str) -> str:
    return f"COUNT(*) FILTER (WHERE {cond})"


def n_unique(x: str) -> str:
    return f"(COUNT(DISTINCT {x}) + MAX(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END))"
