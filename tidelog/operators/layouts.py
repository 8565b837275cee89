"""Table layouts as of a change's position, and images as typed JSON by them.

``layouts(pdb, owner, tab, version, valid_from, exact, columns, key)``: a row a version of a table, its columns in
order as ``array<struct<name,type,precision,scale>>`` (precision and scale -1 where the dictionary has none) and
the names of its key columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidelog.functions import types, values
from tidelog.operators import schema
from tidelog.operators.render import adjust_name

TABLE = ["pdb", "owner", "tab"]
LAYOUT = "pdb string, owner string, tab string, version long, valid_from long, exact boolean, columns array<struct<name:string,type:string,precision:int,scale:int>>, key array<string>"
LAYOUT_COLUMNS = ["pdb", "owner", "tab", "version", "valid_from", "exact", "columns", "key"]
#: Children of a node of the search tree over a table's versions, and how many versions at most are broadcast whole.
FAN = 64
BROADCAST_VERSIONS = 100_000


def _last_version(changes: DataFrame, versions: DataFrame, at: str, most: int) -> DataFrame:
    """Changes with ``_n``, the number from 0 of their table's last version valid at their position, null where there is none.

    A search tree: a node holds the first positions of up to ``FAN`` children, and a row goes down a level by a join, so its work is the
    logarithm of its table's ``most`` versions at most. The levels are broadcast: they hold a little over a position a version.
    """
    depth = 1
    while FAN**depth < most:
        depth += 1
    rows = changes.withColumn("_n", F.lit(0).cast("long"))
    for level in reversed(range(depth)):
        step = FAN**level
        nodes = versions.where(F.col("_n") % step == 0).groupBy(*TABLE, F.expr(f"_n div {step * FAN}").alias("_n")).agg(F.array_sort(F.collect_list("valid_from")).alias("_starts"))
        before = F.size(F.filter("_starts", lambda s: s <= F.col(at)))
        rows = rows.join(F.broadcast(nodes), [*TABLE, "_n"], "left").withColumn("_n", F.when(before > 0, F.col("_n") * FAN + before - 1)).drop("_starts")
    return rows


def resolve(changes: DataFrame, layouts: DataFrame, at: str = "scn", decimals: str = "PRECISE", temporals: str = "ADAPTIVE") -> DataFrame:
    """Each change with ``layout``, the last version of its table valid at its position, null where there is none; its columns have their kind and output type.

    The version is found by its number, so a row meets one version of its table, not all. Up to ``BROADCAST_VERSIONS`` are broadcast,
    lest a table that holds most changes lands in one task; more are joined by table and number, where a table is many keys.
    """
    kind = lambda c: types.kind(c["type"])
    out = lambda c: types.envelope_type(c["kind"], c["precision"], c["scale"], decimals, temporals)
    columns = F.transform(F.transform("columns", lambda c: c.withField("kind", kind(c))), lambda c: c.withField("out", out(c)))  # null once a table is gone
    numbers = F.row_number().over(Window.partitionBy(*TABLE).orderBy("valid_from", "version", "exact"))
    versions = layouts.where("valid_from is not null").withColumn("_n", (numbers - 1).cast("long"))
    total, most = versions.agg(F.count("*"), F.coalesce(F.max("_n") + 1, F.lit(0))).first()
    layout = F.when(F.col("columns").isNotNull(), F.struct("valid_from", "version", "exact", columns.alias("columns"), "key"))
    known = versions.select(*TABLE, "_n", layout.alias("layout"))
    known = F.broadcast(known) if total <= BROADCAST_VERSIONS else known
    return _last_version(changes, versions, at, most).join(known, [*TABLE, "_n"], "left").drop("_n")


def quoted(text: Column) -> Column:
    """A JSON string."""
    array = F.to_json(F.array(text))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def _instant(text: Column) -> Column:
    """Microseconds since 1970 of a local time text as it stands, nine digits of fraction at most."""
    return F.unix_micros(values.zoned_instant(F.regexp_replace(text, r"(\.\d{6})\d+", "$1")))


def literal(column: Column, value: Column) -> Column:
    """JSON of a literal's text by its column's kind and output type; null where it is not of that type."""
    kind, out = column["kind"], column["out"]
    number = value.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    bits = F.regexp_extract(out, r"\d+$", 0).cast("int")
    whole = types.exact_integer(value, 64)
    whole = F.when((bits == 64) | F.abs(whole).between(0, F.pow(F.lit(2.0), bits - 1) - 1) | (whole == -F.pow(F.lit(2.0), bits - 1)), whole).cast("string")
    double = F.when(number, value.try_cast("double").cast("string"))
    clock = values.zoned_instant(F.regexp_replace(value, r"(\.\d{6})\d+", "$1"))
    iso = F.regexp_replace(F.regexp_replace(value, r"^(\S+) (\d)", "$1T$2"), r" ([+-]\d\d:\d\d)$", "$1")
    micros = F.when(kind == "INTERVAL_YM", values.months_to_micros(values.months(value))).when(kind == "INTERVAL_DS", values.interval_micros(value))
    return (
        F.when(out.isin("int8", "int16", "int32", "int64"), whole)
        .when(out.isin("float32", "float64"), F.when(value.isin("Nan", "NaN", "Inf", "-Inf"), quoted(value)).otherwise(double))
        .when(out.startswith("decimal") | out.startswith("struct"), F.when(number, quoted(values.canonical_number(value))))
        .when(out == "bytes", quoted(F.base64(values.hex_bytes(value))))
        .when(out == "int64:ms", F.floor(_instant(value) / 1000).cast("long").cast("string"))
        .when(out == "int64:us", _instant(value).cast("string"))
        .when(out == "int64:ns", (_instant(value) * 1000 + values.nanos(value) % 1000).cast("string"))
        .when(out == "float64:us", micros.cast("double").cast("string"))
        .when(kind.isin("DATE", "TIMESTAMP", "TIMESTAMP_TZ", "TIMESTAMP_LTZ"), F.when(clock.isNotNull(), quoted(iso)))
        .when(kind.isin("INTERVAL_YM", "INTERVAL_DS"), F.when(micros.isNotNull(), quoted(value)))
        .when(kind.isin("NUMBER", "FLOAT"), F.when(number, quoted(value)))
        .when(out == "string", quoted(value))
    )


def fields(image: Column, layout: Column) -> Column:
    """``array<struct<name, type, json>>`` of the columns that an image has, in the layout's order; json is null for what cannot be decoded."""
    here = F.filter(layout["columns"], lambda c: F.map_contains_key(image, c["name"]))
    value = lambda c: F.try_element_at(image, c["name"])
    found = F.transform(here, lambda c: F.struct(c["name"].alias("name"), c["type"].alias("type"), F.when(value(c).isNull(), "null").otherwise(literal(c, value(c))).alias("json")))
    return F.when(image.isNotNull(), found)


def problem(image: Column, found: Column, layout: Column) -> Column:
    """Why an image cannot be decoded, or null."""
    bad = F.get(F.filter(found, lambda f: f["json"].isNull()), F.lit(0))
    strange = F.get(F.filter(F.map_keys(image), lambda k: ~F.exists(layout["columns"], lambda c: c["name"] == k)), F.lit(0))
    return (
        F.when(layout.isNull(), "no layout at this position")
        .when(~layout["exact"], "no exact layout at this position")
        .when(strange.isNotNull(), F.concat(F.lit("column "), strange, F.lit(" is not in the layout")))
        .when(bad.isNotNull(), F.concat(F.lit("column "), bad["name"], F.lit(" is no "), bad["type"]))
    )


def as_object(found: Column, names: str = "NONE") -> Column:
    """A JSON object of decoded columns."""
    return F.concat(F.lit("{"), F.array_join(F.transform(found, lambda f: F.concat(quoted(adjust_name(f["name"], names)), F.lit(":"), f["json"])), ","), F.lit("}"))


def key_object(found: Column, layout: Column, names: str = "NONE") -> Column:
    """A JSON object of the key columns; null where the layout names none or the image lacks one."""
    parts = F.transform(layout["key"], lambda k: F.get(F.filter(found, lambda f: (f["name"] == k) & (f["json"] != "null")), F.lit(0)))
    return F.when((F.size(layout["key"]) > 0) & F.forall(parts, lambda f: f.isNotNull()), as_object(parts, names))


# -- layouts from the log -------------------------------------------------------------------------------

COLUMNS = "array<struct<name:string,type:string,precision:int,scale:int>>"
#: What the dictionary showed of a table when it was read at a position and a time: ``columns`` null where the table was gone; ``last_ddl`` its last DDL.
DICTIONARY = f"pdb string, owner string, tab string, read_scn long, read_ts timestamp_ntz, last_ddl timestamp_ntz, columns {COLUMNS}, primary array<string>, uniq array<string>"
REPLAYED = f"{LAYOUT}, cause string, sql string"
#: Fixed value: positions map to times within some seconds only.
SLACK = "INTERVAL 10 SECONDS"
#: Kinds of statements after which the dictionary is read.
_READ = ("CREATE_TABLE", "COLUMNS", "CONSTRAINTS", "SUPPLEMENTAL_LOG")
START, DDL = 0, 1


class UnknownStatement(ValueError):
    """A statement on a captured table that fits no known kind: reading can't go on with a guessed layout."""


def scn_at(times: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(at)`` with ``scn``, the least position whose time is not before; ``times(scn, ts)`` has a row a second of the log at most.

    A time before the log's first gives 0; one after its last the position behind it.
    """
    back = Window.orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    everywhere = Window.partitionBy(F.lit(0))
    points = times.select(F.col("ts").alias("at"), "scn", F.lit(False).alias("asks"))
    both = points.unionByName(wanted.select("at", F.lit(True).alias("asks")).distinct(), allowMissingColumns=True)
    found = both.withColumns({"least": F.min("scn").over(back), "first": F.min(F.when(~F.col("asks"), F.col("at"))).over(everywhere), "behind": F.max("scn").over(everywhere) + 1}).where("asks")
    return found.select("at", F.when(F.col("at") < F.col("first"), 0).otherwise(F.coalesce("least", "behind", F.lit(0))).cast("long").alias("scn"))


def time_at(times: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(scn)`` with ``ts``, the latest time of a position up to it, null before the log's first."""
    so_far = Window.orderBy("scn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = times.select("scn", "ts", F.lit(False).alias("asks")).unionByName(wanted.select("scn", F.lit(True).alias("asks")).distinct(), allowMissingColumns=True)
    return both.withColumn("ts", F.max("ts").over(so_far)).where("asks").select("scn", "ts")


def _next_reading(rows: DataFrame, readings: DataFrame) -> DataFrame:
    """Rows with ``seen``, the first reading of their table at or after their position."""
    reading = F.struct(F.lit(True).alias("found"), "last_ddl", "columns", "key")
    both = rows.unionByName(readings.select(*TABLE, F.col("read_scn").alias("scn"), reading.alias("seen")), allowMissingColumns=True)
    back = Window.partitionBy(*TABLE).orderBy(F.desc("scn"), F.desc(F.col("what").isNull())).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("seen", F.last("seen", ignorenulls=True).over(back)).where("what is not null")


class _Tables:
    """The layouts of one owner's tables as its statements go by, in order of their positions."""

    def __init__(self) -> None:
        self.known: dict[str, dict] = {}

    def take(self, row: dict) -> Iterator[dict]:
        tab, seen = row["tab"], row["seen"]
        out = {c: row[c] for c in ("pdb", "owner", "tab")} | {"valid_from": row["scn"], "sql": row["sql"]}
        held = self.known.get(tab)
        if row["what"] == START:
            if held is None and seen is not None and seen["columns"] is not None:
                yield self._put(tab, out, 1, row["since"], True, seen, "start")
            return
        if not row["captured"] and held is None:
            return
        kind = row["kind"]
        if kind == "UNKNOWN":
            raise UnknownStatement(f"CDC-6002: the statement on {row['pdb']}.{row['owner']}.{tab} at {row['scn']} is of no known kind: {' '.join((row['sql'] or '').split())[:300]}")
        if kind in _READ:
            if seen is None or seen["columns"] is None:
                if self.known.pop(tab, None):
                    yield self._gone(out, "gone")
                return
            ahead = seen["last_ddl"] is not None and seen["last_ddl"] > row["until"]
            if held and (held["columns"], held["key"]) == (seen["columns"], seen["key"]) and (held["exact"] or ahead):
                return
            yield self._put(tab, out, held["version"] + 1 if held else 1, row["scn"], not ahead, seen, "ddl")
        elif kind in ("DROP_TABLE", "RENAME_TABLE"):
            self.known.pop(tab, None)
            yield self._gone(out, "drop" if kind == "DROP_TABLE" else "rename")
            if kind == "RENAME_TABLE" and held and row["new_name"]:
                yield self._put(row["new_name"], out | {"tab": row["new_name"]}, 1, row["scn"], held["exact"], held, "rename")

    def _put(self, tab: str, out: dict, version: int, since: int, exact: bool, layout: dict, cause: str) -> dict:
        held = {"version": version, "exact": exact, "columns": layout["columns"], "key": layout["key"]}
        self.known[tab] = held
        return out | held | {"valid_from": since, "cause": cause}

    @staticmethod
    def _gone(out: dict, cause: str) -> dict:
        return out | {"version": None, "exact": True, "columns": None, "key": None, "cause": cause}


def _folded(rows: DataFrame) -> DataFrame:
    shape = StructType.fromDDL(REPLAYED)
    arrow = to_arrow_schema(shape)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        owner, tables = None, _Tables()
        for row in (r for batch in batches for r in batch.to_pylist()):
            if (row["pdb"], row["owner"]) != owner:
                owner, tables = (row["pdb"], row["owner"]), _Tables()
            yield from tables.take(row)

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = made(batches)
        while part := list(islice(found, 10_000)):
            yield pa.RecordBatch.from_pylist(part, schema=arrow)

    return rows.repartition("pdb", "owner").sortWithinPartitions("pdb", "owner", "scn", "what", "pos").mapInArrow(batches_of, shape)


def replayed(ddl: DataFrame, dictionary: DataFrame, times: DataFrame, start: int, captured: str, quiet: int | None = None, joined: DataFrame | None = None, overrides: Column | None = None) -> DataFrame:
    """Layouts by a replay of readings of the dictionary and of statements in the order of the log, as ``REPLAYED``.

    ``ddl(pdb, owner, tab, scn, pos, ts, sql)`` are the log's statements with a column ``captured`` of whether their table is, ``dictionary``
    readings (``DICTIONARY``) of captured tables. A table's first version is that of its first reading. It is valid from ``start`` (or from the
    position in ``joined(pdb, owner, tab, at)``) where its last DDL is more than ``SLACK`` before the time of ``quiet`` (``start`` if not given),
    so that none can lie behind it; otherwise from ``SLACK`` after that DDL. A statement that may change the layout takes the next
    reading: a new version where it differs, inexact where the table's last DDL is later than the statement by more than ``SLACK``.
    A dropped table has no layout from there on (a row without columns); a renamed one goes on under its new name. A statement of no
    known kind on a captured table raises ``UnknownStatement``. An owner's statements are walked through by one task, a row at a time.
    """
    key = F.coalesce(*([overrides] if overrides is not None else []), "primary", "uniq", F.array().cast("array<string>"))
    readings = dictionary.withColumn("key", key)
    none = times.sparkSession.createDataFrame([], "pdb string, owner string, tab string, at long")
    joins = (none if joined is None else joined).withColumnRenamed("at", "_joins")
    first = readings.groupBy(*TABLE).agg(F.min_by("last_ddl", "read_scn").alias("_ddl")).join(joins, TABLE, "left")
    first = first.withColumns({"at": F.coalesce("_joins", F.lit(start)).cast("long"), "_quiet": F.coalesce("_joins", F.lit(start if quiet is None else quiet)).cast("long")})
    first = first.join(F.broadcast(time_at(times, first.select(F.col("_quiet").alias("scn"))).withColumnsRenamed({"scn": "_quiet", "ts": "t"})), "_quiet", "left")
    after = F.col("_ddl") + F.expr(SLACK)
    is_quiet = F.coalesce(after <= F.col("t"), F.lit(False))
    first = first.withColumn("_after", F.when(~is_quiet, after))
    later = scn_at(times, first.where("_after is not null").select(F.col("_after").alias("at"))).withColumnsRenamed({"at": "_after", "scn": "_later"})
    first = first.join(F.broadcast(later), "_after", "left").withColumn("since", F.when(is_quiet, F.col("at")).otherwise(F.coalesce("_later", F.lit(0))).cast("long"))
    begin = first.select(*TABLE, F.coalesce("_joins", F.lit(-1)).cast("long").alias("scn"), F.lit(START).alias("what"), "since", F.lit(True).alias("captured"))
    statements = ddl.select(*TABLE, "scn", F.lit(DDL).alias("what"), "pos", "sql", schema.ddl_kind(F.col("sql")).alias("kind"), schema.new_name(F.col("sql")).alias("new_name"), (F.col("ts") + F.expr(SLACK)).alias("until"), F.col(captured).alias("captured"))
    statements = statements.join(F.broadcast(joins), TABLE, "left").withColumn("captured", F.col("captured") & (F.col("_joins").isNull() | (F.col("scn") >= F.col("_joins")))).drop("_joins")
    return _folded(_next_reading(begin.unionByName(statements, allowMissingColumns=True), readings))
