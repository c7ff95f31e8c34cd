"""Registration of a query together with its checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures

STEP = 0.41421356237

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Attribute access to the driver tables and the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir, self.known = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        return fixtures.view(self.spark, self.sf_dir, name, self.known)

    def store(self, *names: str) -> None:
        """Write these views once; later views of this query read the written rows."""
        fixtures.stored(self.spark, self.sf_dir, list(names), self.known)


def rounded(df: DataFrame, places: int) -> DataFrame:
    """Doubles to ``places`` decimals and narrow integers to bigint, for comparison across engines.

    ``floor(x * 10^n + STEP) / 10^n`` is the same arithmetic in both, and its steps lie
    where no short decimal or simple fraction falls, so that the last bit of a sum
    does not matter. Dates become text.
    """
    unit = 10.0**places
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.simpleString()
        if kind == "double":
            c = F.floor(c * unit + STEP) / unit
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind == "date":
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, doubles: str = "", places: int = 4, dates: str = ""):
    """Register ``fn(tables) -> DataFrame``; ``doubles`` and ``dates`` name the SQL's columns of these types."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(Tables(spark, sf_dir)), places)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            body = fixtures.duck(sql)
            if doubles or dates:
                unit = f"{10**places}.0::DOUBLE"
                cells = ", ".join(f"floor({c} * {unit} + {STEP}::DOUBLE) / {unit} AS {c}" for c in doubles.split())
                cells = ", ".join([*filter(None, [cells]), *[f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]])
                body = f"SELECT * REPLACE ({cells}) FROM (\n{body}\n)"
            ORACLES[name] = body
        return fn

    return register
