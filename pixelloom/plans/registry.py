"""Decorator-based registry of queries and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelloom.plans import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, use: str = "") -> Callable:
    """Register f(spark, sf_dir). sql: its oracle, which sees the views named in use and may itself begin with WITH."""

    def add(f: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered already")
        QUERIES[name] = f
        if sql is not None:
            body = sql.strip()
            ctes = [views.sql(v) for v in use.split()]
            if body[:5].upper() == "WITH ":
                ctes.append(body[5:])
                ORACLES[name] = f"WITH {', '.join(ctes)}"
            else:
                ORACLES[name] = f"WITH {', '.join(ctes)} {body}" if ctes else body
        return f

    return add


#: Part of the last kept digit that is added before rounding, so that short fractions are never at the edge between two.
OFFSET = 0.123


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded (see OFFSET), negative zero as zero: sums in another order then compare equal."""
    fix = lambda c: (F.round(F.col(f"`{c}`") + OFFSET / 10**digits, digits) + 0.0).alias(c)
    return df.select(*[fix(c) if k in ("double", "float") else F.col(f"`{c}`") for c, k in df.dtypes])


def rounds(sql: str, columns: str, digits: int = 4) -> str:
    """The same in SQL, for the named columns."""
    return f"SELECT * REPLACE ({', '.join(f'round({c} + {OFFSET / 10**digits!r}::DOUBLE, {digits}) + 0.0 AS {c}' for c in columns.split())}) FROM ({sql})"


def with_rounds(ctes: str, sql: str, columns: str, digits: int = 4) -> str:
    return f"WITH {ctes} {rounds(sql, columns, digits)}"
