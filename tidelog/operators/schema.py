"""Schema versions: as-of lookup, pruning, DDL classification, key choice, evolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(versions: DataFrame, table: str = "tab", start: str = "valid_from") -> DataFrame:
    """Adds ``valid_to``, the start of the next version (exclusive; null for the last)."""
    return versions.withColumn("valid_to", F.lead(start).over(Window.partitionBy(table).orderBy("version")))


def as_of(rows: DataFrame, versions: DataFrame, table: str = "tab", at: str = "scn") -> DataFrame:
    """Each row with the last version valid at its position, or ``error`` where there is none or it is inexact."""
    v = intervals(versions, table).select(table, "version", "valid_from", "valid_to", "exact")
    inside = (F.col(at) >= F.col("v.valid_from")) & (F.col("v.valid_to").isNull() | (F.col(at) < F.col("v.valid_to")))
    joined = rows.alias("r").join(v.alias("v"), (F.col(f"r.{table}") == F.col(f"v.{table}")) & inside, "left")
    error = F.when(F.col("v.version").isNull(), "no version").when(~F.col("v.exact"), "inexact version")
    return joined.select("r.*", F.col("v.version").alias("version"), error.alias("error"))


def by_number(rows: DataFrame, versions: DataFrame, table: str = "tab", number: str = "schema_version") -> DataFrame:
    """Each row with the version that it names; 0 names the current one."""
    current = versions.groupBy(table).agg(F.max("version").alias("_current"))
    named = rows.join(current, table, "left").withColumn("version", F.when(F.col(number) == 0, F.col("_current")).otherwise(F.col(number))).drop("_current")
    return named.join(versions.select(table, "version", "valid_from", "exact"), [table, "version"], "left")


def prune(versions: DataFrame, position: int, table: str = "tab") -> DataFrame:
    """The newest version valid at a position, and all later ones."""
    newest = F.max(F.when(F.col("valid_from") <= position, F.col("valid_from"))).over(Window.partitionBy(table))
    return versions.withColumn("_n", newest).where(F.col("_n").isNull() | (F.col("valid_from") >= F.col("_n"))).drop("_n")


def words(ddl: Column) -> Column:
    """Upper-case words of a statement: comments and literals gone, ``schema.name`` one word, ``(`` a word."""
    text = F.regexp_replace(ddl, r"(?s)/\*.*?\*/|--[^\n]*", " ")
    text = F.regexp_replace(text, r"'(?:[^']|'')*'", " ")
    text = F.regexp_replace(F.regexp_replace(text, r'"[^"]*"', "Q"), r"\s*\.\s*", ".")
    text = F.regexp_replace(F.upper(F.regexp_replace(text, r"\(", " ( ")), r"[^A-Z0-9_$#.(]+", " ")
    return F.filter(F.split(text, " "), lambda w: w != "")


#: Storage clauses that leave the layout alone.
_STORAGE = (
    "MOVE|SHRINK|COMPRESS|NOCOMPRESS|LOGGING|NOLOGGING|PARALLEL|NOPARALLEL|CACHE|NOCACHE|READ|ALLOCATE|DEALLOCATE|PCTFREE|PCTUSED|INITRANS|STORAGE|INMEMORY|NO|ILM|FLASHBACK|ROW|"
    "MONITORING|NOMONITORING|RESULT_CACHE|UPGRADE|MEMOPTIMIZE"
)
#: The kind of a statement by the beginning of its words; ``T`` stands for ALTER TABLE and a name. The first that fits counts.
_KINDS = [
    (r"CREATE (OR REPLACE )?((GLOBAL|PRIVATE|TEMPORARY|SHARDED|DUPLICATED|BLOCKCHAIN|IMMUTABLE) )*TABLE", "CREATE_TABLE"),
    (r"DROP TABLE", "DROP_TABLE"),
    (r"TRUNCATE TABLE", "TRUNCATE"),
    (r"RENAME|T RENAME TO", "RENAME_TABLE"),
    (r"T (ADD|MODIFY|DROP) (SUB)?PARTITION|T MODIFY DEFAULT|T (SPLIT|MERGE|TRUNCATE|EXCHANGE|COALESCE)", "PARTITION"),
    (r"T (ADD|DROP) SUPPLEMENTAL", "SUPPLEMENTAL_LOG"),
    (r"T ADD ([(] )?(CONSTRAINT|PRIMARY|UNIQUE|FOREIGN|CHECK)|T (DROP|MODIFY) (CONSTRAINT|PRIMARY|UNIQUE)|T (ENABLE|DISABLE) (CONSTRAINT|PRIMARY|UNIQUE|NOVALIDATE|VALIDATE)", "CONSTRAINTS"),
    (rf"T DROP UNUSED|T MODIFY (LOB|VARRAY|NESTED)|T RENAME (CONSTRAINT|(SUB)?PARTITION)|T (ENABLE|DISABLE)|T (SET )?({_STORAGE})", "NO_SCHEMA_CHANGE"),
    (r"T (ADD|DROP|MODIFY)|T SET UNUSED|T RENAME COLUMN", "COLUMNS"),
    (r"T", "UNKNOWN"),
    (r"CREATE|ALTER|DROP|TRUNCATE|COMMENT|GRANT|REVOKE|ANALYZE|AUDIT|NOAUDIT|PURGE|ASSOCIATE|DISASSOCIATE", "NO_SCHEMA_CHANGE"),
]


def ddl_kind(ddl: Column) -> Column:
    """Kind of change that a DDL statement makes, by the beginning of its words."""
    line = F.regexp_replace(F.array_join(words(ddl), " "), r"^ALTER TABLE( [^ ]+)?", "T")
    out = F.when(line.isNull(), "UNKNOWN")
    for pattern, kind in _KINDS:
        out = out.when(line.rlike(f"^(?:{pattern})(?: |$)"), kind)
    return out.otherwise("UNKNOWN")


def new_name(ddl: Column) -> Column:
    """The name that a statement gives a table, null for other statements; a name in quotes keeps its case."""
    text = F.regexp_replace(ddl, r"(?s)/\*.*?\*/|--[^\n]*", " ")
    found = F.regexp_extract(text, r"(?is)^\s*(?:alter\s+table\s.*?\s|)rename\s+(?:[^\s]+\s+)?to\s+(\"[^\"]+\"|[\w$#]+)\s*;?\s*$", 1)
    return F.when(found.startswith('"'), F.regexp_replace(found, '"', "")).when(found != "", F.upper(found))


def cuts_step(kind: Column, captured: Column) -> Column:
    """Whether a statement ends a reading step: any table made or dropped, a captured one renamed or repartitioned."""
    return kind.isin("CREATE_TABLE", "DROP_TABLE") | (kind.isin("PARTITION", "RENAME_TABLE") & captured)


def versions_of(ddl: DataFrame, table: str = "tab", layout: str = "layout") -> DataFrame:
    """New versions where a statement left another layout than the one before; ``ddl(tab, scn, layout)``."""
    by = Window.partitionBy(table).orderBy("scn")
    changed = ddl.withColumn("_before", F.lag(layout).over(by)).where(~F.col(layout).eqNullSafe(F.col("_before")))
    return changed.select(table, F.row_number().over(by).cast("long").alias("version"), F.col("scn").alias("valid_from"), layout)


def key_source(override: Column, primary: Column, unique: Column, policy: str) -> Column:
    """Where the record key comes from: an override, the primary key, the first unique index without nullable columns, a policy."""
    rest = {"ROWID": F.lit("ROWID"), "NONE": F.lit("NONE"), "FAIL": F.lit("ERROR")}[policy]
    return F.when(override.isNotNull(), "OVERRIDE").when(primary.isNotNull(), "PRIMARY_KEY").when(unique.isNotNull(), "UNIQUE_INDEX").otherwise(rest)


def startup_verdict(stored: Column, current: Column, last_ddl: Column, resume: Column) -> Column:
    """Whether a stored layout may be gone on with: the same, gone, or changed by a DDL that is still ahead; anything else was missed.

    Positions map to times within ten seconds, so a DDL that close to the resume time counts as ahead.
    """
    ahead = F.coalesce(last_ddl > resume - F.expr("INTERVAL 10 SECONDS"), F.lit(False))
    return F.when(current.isNull(), "dropped since").when(stored == current, "same").when(ahead, "explained").otherwise("stop")
