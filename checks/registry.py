"""Registered queries: each pairs a Spark call with its output columns and,
where plain SQL can say the same, an oracle.

Column kinds: ``s`` text, ``i`` integer, ``f`` float rounded to 6 places,
``d`` date, ``b`` boolean. The kinds are applied on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.oracles import with_ctes
from checks.testbed import Testbed
from creditspine.sources.session import tune

SPARK_KIND = {"s": "string", "i": "bigint", "d": "date", "b": "boolean"}
DUCK_KIND = {"s": "VARCHAR", "i": "BIGINT", "d": "DATE", "b": "BOOLEAN"}


@dataclass(frozen=True)
class Query:
    run: Callable[[Testbed], DataFrame]
    columns: dict[str, str]
    sql: str | None

    def spark(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.run(Testbed(tune(spark), folder))
        out = []
        for name, kind in self.columns.items():
            c = F.col(name)
            # adding zero turns a negative zero into plain zero
            c = F.round(c.cast("double"), 6) + F.lit(0.0) if kind == "f" else c.cast(SPARK_KIND[kind])
            out.append(c.alias(name))
        return df.select(*out)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        out = ", ".join(
            f'round(CAST("{n}" AS DOUBLE), 6) + 0.0 AS "{n}"' if k == "f" else f'CAST("{n}" AS {DUCK_KIND[k]}) AS "{n}"'
            for n, k in self.columns.items()
        )
        return with_ctes(f"SELECT {out} FROM ({self.sql}) AS q")


QUERIES: dict[str, Query] = {}


def kinds(text: str) -> dict[str, str]:
    """``"label:i bad_rate:f"`` as a dict."""
    return dict(part.rsplit(":", 1) for part in text.split())


def query(name: str, columns: str | dict[str, str], sql: str | None = None):
    """Register the decorated function as a query."""

    def add(run: Callable[[Testbed], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(run, kinds(columns) if isinstance(columns, str) else columns, sql)
        return run

    return add
