"""Errors of the source: typed codes, and the code and action of an error number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The typed codes and their names; reading goes on by itself after those of 1000.
CODES = {
    "CDC-1001": "transient-database",
    "CDC-1002": "mining-step-retry",
    "CDC-2001": "log-gap",
    "CDC-2002": "log-purged",
    "CDC-3001": "decode",
    "CDC-3002": "corruption",
    "CDC-3003": "lob-too-large",
    "CDC-4001": "buffer-exhausted",
    "CDC-4002": "journal-corruption",
    "CDC-4003": "mining-stalled",
    "CDC-4004": "transaction-too-old",
    "CDC-5001": "topology",
    "CDC-5002": "privilege",
    "CDC-6001": "dictionary-unavailable",
    "CDC-6002": "unsupported-ddl",
    "CDC-6003": "schema-mismatch",
    "CDC-6004": "name-collision",
    "CDC-7001": "orphan-release-violation",
    "CDC-7002": "orphan-transaction",
    "CDC-7003": "resume-floor-violation",
    "CDC-8001": "snapshot-too-old",
}
#: Error numbers by what they ask for.
PRIVILEGE = [942, 1017, 1031, 1045, 28000]
STEP_RETRY = [310, 334, 1013, 1289, 1291, 1368]
PURGED = [308, 1284, 1285, 16226]
TRANSIENT = [28, 31, 1033, 1034, 1089, 1090, 1092, 1109, 3113, 3114, 3135, 4068, 12170, 12514, 12516, 12528, 12537, 12541, 12543, 16331, 17002, 17008, 17410, 17800, 25408]
STALE = [1555, 8181]
LAYOUT_CHANGED = [1466]
RECURSIVE = 604


def codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, n, c < "CDC-2") for c, n in CODES.items()], "code string, name string, goes_on boolean")


def effective_code(message: Column) -> Column:
    """The number that counts in a message: of a recursive statement's error, the first other one that it wraps."""
    found = F.transform(F.regexp_extract_all(message, F.lit(r"ORA-(\d{5})"), F.lit(1)), lambda x: x.cast("long"))
    own = F.get(found, F.lit(0))
    return F.when(own == RECURSIVE, F.coalesce(F.get(F.filter(found, lambda x: x != RECURSIVE), F.lit(0)), own)).otherwise(own)


def classify(ora: Column, more_transient: list[int] | None = None) -> tuple[Column, Column]:
    """Typed code of an error number, null where none is known, and what to do about it."""
    transient = ora.isin(TRANSIENT + (more_transient or []))
    code = F.when(ora.isin(PRIVILEGE), "CDC-5002").when(ora.isin(STEP_RETRY), "CDC-1002").when(ora.isin(PURGED), "CDC-2002").when(transient, "CDC-1001").when(ora.isin(STALE), "CDC-8001")
    stop = ora.isin(PRIVILEGE) | ora.isin(PURGED)
    action = F.when(stop, "stop").when(ora.isin(STEP_RETRY), "mine again").when(transient, "retry").when(ora.isin(STALE), "split").when(ora.isin(LAYOUT_CHANGED), "wait").otherwise("stop")
    return code, action
