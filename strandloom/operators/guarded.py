"""User queries: one reading statement, limited before anything reaches the driver, answered as records."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ..functions.guards import check_query

#: Rows that an answer has at most, and has if no limit is given.
MOST_ROWS, ROWS = 100_000, 1_000


def guarded(spark: SparkSession, sql: str, limit: int | None = ROWS) -> DataFrame:
    """The result of a checked statement, limited in the plan, so that tasks stop early."""
    if limit is not None and not 1 <= limit <= MOST_ROWS:
        raise ValueError(f"a limit is from 1 to {MOST_ROWS}")
    return spark.sql(check_query(sql)).limit(limit or MOST_ROWS)


def plain(value):
    """A value as JSON has it: no NaN and infinities, decimals as numbers, times as text."""
    if isinstance(value, float):
        return value if value == value and abs(value) != float("inf") else None
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (bytes, bytearray)):
        return value.hex()
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if hasattr(value, "asDict"):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    return [plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def answer(rows: DataFrame) -> dict:
    """{"rows": how many, "data": records}; ``rows`` must be limited already."""
    data = [plain(r) for r in rows.collect()]
    return {"success": True, "rows": len(data), "data": data}


def run_query(spark: SparkSession, sql: str, limit: int | None = ROWS) -> dict:
    return answer(guarded(spark, sql, limit))


def list_tables(spark: SparkSession) -> dict:
    """Names of the relations there are, and which are views."""
    found = sorted((t.name, "view" if t.tableType in ("TEMPORARY", "VIEW") else "table") for t in spark.catalog.listTables())
    views = sum(kind == "view" for _, kind in found)
    return {"success": True, "rows": len(found), "tables": len(found) - views, "views": views, "data": [{"name": n, "type": k} for n, k in found]}
