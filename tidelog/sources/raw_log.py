"""The derived change log as raw mined rows: 34 columns and statements as a log reader returns them.

Each event is a row of table ``ITEMS`` or ``CARTS`` with columns ``ID``, ``RID`` and ``VALUE`` (hundredths). Every seventh statement
stands in two rows, every 37th cannot be read, and every ``EVERY``-th event of a table is preceded by a statement, in a
transaction of its own, that adds column ``NOTE`` or drops it again. Inserts while the column stands fill it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import codes
from tidelog.functions.types import RAW_ROW
from tidelog.sources import derived as d

EVERY = 199
PDB, OWNER = "P1", "APP"
PLAIN = [("ID", "NUMBER", 18, 0), ("RID", "VARCHAR2", -1, -1), ("VALUE", "NUMBER", 18, 0)]
NOTE = ("NOTE", "VARCHAR2", -1, -1)

#: For SQL: statements on the row's table up to it, hundredths, and how many statements are on each table before event e.
CHANGED_SQL = f"CASE WHEN event_id % 2 = 0 THEN (event_id // {EVERY}) // 2 ELSE (event_id // {EVERY} + 1) // 2 END"
CENTS_SQL = "CAST(FLOOR(value * 100 + 0.5) AS BIGINT)"


def _changed(event: Column) -> Column:
    """How many statements on its table precede an event, or come with it."""
    turns = F.floor(event / EVERY)
    return F.when(event % 2 == 0, F.floor(turns / 2)).otherwise(F.floor((turns + 1) / 2)).cast("long")


def cents(value: Column) -> Column:
    return F.floor(value * 100 + 0.5).cast("long")


def _quoted(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _row(rows: DataFrame, **given: Column) -> DataFrame:
    """Raw rows; columns that are not given are null."""
    return rows.select(*[given.get(f.name.replace("#", ""), F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_ROW])


def raw_log(spark: SparkSession, sf_dir: str, statements: bool = True) -> DataFrame:
    """Rows of the log; without ``statements`` the tables keep their first layout."""
    rows = d.data_rows(spark, sf_dir)
    event, value = F.col("event_id"), F.coalesce(_quoted("'", cents(F.col("value")), "'"), F.lit("NULL"))
    noted = (_changed(event) % 2 == 1) if statements else F.lit(False)
    names = F.when(noted, '"ID","RID","VALUE","NOTE"').otherwise('"ID","RID","VALUE"')
    had = _quoted('"ID" = \'', event, '\' and "RID" = \'', F.col("rid"), '\' and "VALUE" ')
    sql = (
        F.when(event % 37 == 0, "Unsupported")
        .when(F.col("op_code") == codes.INSERT, _quoted('insert into "APP"."', F.col("tab"), '"(', names, ") values ('", event, "','", F.col("rid"), "',", value, F.when(noted, _quoted(",'n", event, "'")).otherwise(""), ")"))
        .when(F.col("op_code") == codes.DELETE, _quoted('delete from "APP"."', F.col("tab"), '" where ', had, F.when(value == "NULL", "IS NULL").otherwise(F.concat(F.lit("= "), value))))
        .otherwise(_quoted('update "APP"."', F.col("tab"), '" set "VALUE" = ', value, " where ", had, "= '0'"))
    )
    address = F.concat(F.lit("0x"), F.lpad(F.col("scn").cast("string"), 18, "0"))
    common = {"SCN": F.col("scn"), "THREAD": F.col("con_id"), "XIDUSN": F.col("user_id"), "XIDSLT": F.lit(0), "XIDSQN": F.col("sqn"), "RS_ID": address, "SRC_CON_ID": F.col("con_id"), "SRC_CON_NAME": F.lit(PDB), "USERNAME": F.concat(F.lit("U"), (F.col("user_id") % 10).cast("string"))}
    data = rows.withColumn("_sql", sql)
    cut = F.floor(F.length("_sql") / 2).cast("int")
    halves = F.when(event % 7 == 3, F.array(F.struct(F.lit(0).alias("ssn"), F.lit(1).alias("csf"), F.substring("_sql", F.lit(1), cut).alias("text")), F.struct(F.lit(1).alias("ssn"), F.lit(0).alias("csf"), F.substring("_sql", cut + 1, F.length("_sql")).alias("text"))))
    data = data.withColumn("_p", F.explode(F.coalesce(halves, F.array(F.struct(F.lit(0).alias("ssn"), F.lit(0).alias("csf"), F.col("_sql").alias("text"))))))
    code = F.when(event % 37 == 0, codes.UNSUPPORTED).otherwise(F.col("op_code"))
    data = _row(data, **common, TIMESTAMP=F.col("ts"), OPERATION_CODE=code, ROLLBACK=F.col("undo").cast("int"), SEG_OWNER=F.lit(OWNER), TABLE_NAME=F.col("tab"), ROW_ID=F.col("rid"), SSN=F.col("_p.ssn"), CSF=F.col("_p.csf"), SQL_REDO=F.col("_p.text"))
    tx = d.transactions(rows)
    ends = tx.select("*", F.explode(F.array(F.struct(F.col("start_scn").alias("scn"), F.lit(codes.START).alias("code")), F.struct(F.col("end_scn").alias("scn"), F.col("end_code").alias("code")))).alias("e")).where("e.code is not null")
    ends = _row(ends.select(*d.TX, "e.*"), **common, OPERATION_CODE=F.col("code"), ROLLBACK=F.lit(0), SSN=F.lit(0), CSF=F.lit(0))
    log = data.unionByName(ends)
    return log.unionByName(_statements(rows, common)) if statements else log


def _turns(rows: DataFrame) -> DataFrame:
    """A row a statement, with how many came before it and it on its table."""
    return rows.where((F.col("event_id") % EVERY == 0) & (F.col("event_id") > 0)).withColumn("turn", _changed(F.col("event_id")))


def _statements(rows: DataFrame, common: dict[str, Column]) -> DataFrame:
    text = F.concat(F.lit("alter table app."), F.lower("tab"), F.when(F.col("turn") % 2 == 1, " add (note varchar2(30))").otherwise(" drop column note"))
    steps = F.array(*[F.struct(F.lit(-4 + k).alias("off"), F.lit(code).alias("code"), t.alias("text")) for k, (code, t) in enumerate(((codes.START, F.lit(None)), (codes.DDL, text), (codes.COMMIT, F.lit(None))))])
    made = _turns(rows).withColumn("_e", F.explode(steps)).withColumn("user_id", -F.col("event_id")).withColumn("scn", F.col("scn") + F.col("_e.off"))
    return _row(made, **common, TIMESTAMP=F.col("ts"), OPERATION_CODE=F.col("_e.code"), ROLLBACK=F.lit(0), SEG_OWNER=F.lit(OWNER), TABLE_NAME=F.when(F.col("_e.code") == codes.DDL, F.col("tab")), SSN=F.lit(0), CSF=F.lit(0), SQL_REDO=F.col("_e.text"))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of the dictionary (``operators.layouts.DICTIONARY``): of both tables before the log, and of a statement's table behind it."""
    shown = lambda columns: F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("name", "type", "precision", "scale"), c, strict=True)]) for c in columns])
    first = spark.createDataFrame([("ITEMS",), ("CARTS",)], "tab string").select("tab", F.lit(0).cast("long").alias("read_scn"), F.lit(None).cast("timestamp_ntz").alias("last_ddl"), shown(PLAIN).alias("columns"))
    later = _turns(d.data_rows(spark, sf_dir)).select("tab", (F.col("scn") - 2).alias("read_scn"), F.col("ts").cast("timestamp_ntz").alias("last_ddl"), F.when(F.col("turn") % 2 == 1, shown([*PLAIN, NOTE])).otherwise(shown(PLAIN)).alias("columns"))
    both = first.unionByName(later)
    none = F.lit(None)
    given = {"pdb": F.lit(PDB), "owner": F.lit(OWNER), "read_ts": none.cast("timestamp_ntz"), "primary": F.array(F.lit("ID")), "uniq": none.cast("array<string>")}
    return both.withColumns(given).select("pdb", "owner", "tab", "read_scn", "read_ts", "last_ddl", "columns", "primary", "uniq")
