"""Small fixed inputs, the same rows for Spark and for the checking engine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SQL = {"long": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


def _literal(value: object, kind: str) -> str:
    if value is None:
        return f"CAST(NULL AS {_SQL[kind]})"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    return f"CAST({value} AS {_SQL[kind]})"


@dataclass(frozen=True)
class Static:
    """A named table of literals; ``schema`` as in "a long, b string"."""

    name: str
    schema: str
    rows: tuple[tuple, ...]

    def df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), self.schema)

    def read(self, spark: SparkSession, folder: str, *without: str) -> DataFrame:
        """A user's table of this name and these columns, in place of the literals."""
        columns = [f.split() for f in self.schema.split(", ")]
        return spark.read.parquet(f"{folder}/{self.name}.parquet").select(*[F.col(n).cast(k) for n, k in columns if n not in without])

    @property
    def sql(self) -> str:
        fields = [f.split() for f in self.schema.split(", ")]
        rows = ", ".join("(" + ", ".join(_literal(v, k) for v, (_, k) in zip(r, fields, strict=True)) + ")" for r in self.rows)
        return f"{self.name}({', '.join(n for n, _ in fields)}) AS (VALUES {rows})"
