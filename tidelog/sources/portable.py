"""Inputs derived row by row from a given table by expressions that Spark and the checking engine read alike."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Q = "CHR(39)"  # a quote, and a backslash: literals of the two engines escape differently
B = "CHR(92)"


def text(*parts: str) -> str:
    """A concatenation: parts in double quotes are literals, the others expressions cast to text."""
    return " || ".join(f"'{p[1:-1]}'" if p[0] == '"' else p if p in (Q, B) else f"CAST({p} AS STRING)" for p in parts)


def choice(of: str, *values: str) -> str:
    """The k-th value where ``of`` leaves rest k when divided by their number."""
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values))
    return f"CASE {of} % {len(values)} {cases} END"


@dataclass(frozen=True)
class Portable:
    """A named view of a given table: its columns and the expressions that make them."""

    name: str
    table: str
    columns: dict[str, str]

    def df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{self.table}.parquet").selectExpr(*[f"{e} AS {c}" for c, e in self.columns.items()])

    @property
    def sql(self) -> str:
        return f"{self.name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in self.columns.items())} FROM {self.table})"
