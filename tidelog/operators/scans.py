"""Range and cursor scans, row filters, classification and ordered helpers over mined rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import codes

ZERO_ADDRESS = "000000.00000000.0000"


def range_scan(rows: DataFrame, start: int, end: int, ops: Iterable[int]) -> DataFrame:
    """Rows with ``start <= scn < end`` and a wanted operation; both reach the scan as pushed filters."""
    return rows.where((F.col("scn") >= start) & (F.col("scn") < end) & F.col("op_code").isin(list(ops)))


def cursor_scan(rows: DataFrame, cursors: DataFrame, floor: int) -> DataFrame:
    """Rows after a thread's own address cursor; of threads without one, and of rows without an address, those at or past the floor.

    ``cursors`` has one row a thread of the database, so it is small by nature; Spark picks the join.
    """
    c = cursors.select(F.col("thread").alias("_t"), F.col("rs_id").alias("_rs"), F.col("ssn").alias("_ssn"))
    address = F.rtrim("rs_id")
    past = (address > F.col("_rs")) | ((address == F.col("_rs")) & (F.col("ssn") > F.col("_ssn")))
    keep = F.when(F.col("rs_id") == ZERO_ADDRESS, F.col("scn") >= floor).when(F.col("_t").isNotNull(), past).otherwise(F.col("scn") >= floor)
    return rows.join(c, F.col("thread") == F.col("_t"), "left").where(keep).drop("_t", "_rs", "_ssn")


def not_applied(rows: DataFrame, marks: DataFrame, key: str, order: str) -> DataFrame:
    """Rows beyond the mark of their thread; ``marks(key, mark)``."""
    return rows.join(marks, key, "left").where(F.col("mark").isNull() | (F.col(order) > F.col("mark"))).drop("mark")


def join_continuations(rows: DataFrame, by: list[str], order: str, text: str, more: str) -> DataFrame:
    """Pieces flagged ``more`` joined with what follows them; a chain that never ends gives nothing."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    island = F.coalesce(F.sum(F.when(F.col(more) == 0, 1).otherwise(0)).over(before), F.lit(0))
    grouped = rows.withColumn("_island", island).groupBy(*by, "_island").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), "").alias("statement"), F.count("*").alias("n"), F.min(more).alias("_open")
    )
    return grouped.where("_open = 0").drop("_island", "_open")


def event_kind() -> Column:
    op = F.col("op_code")
    named = {codes.START: "tx_start", codes.COMMIT: "commit", codes.ROLLBACK: "rollback", codes.DDL: "ddl", codes.MISSING_SCN: "missing_scn", codes.UNSUPPORTED: "unsupported"}
    out = F.when(F.lit(False), "")
    for code, name in named.items():
        out = out.when(op == code, name)
    return out.when(F.col("undo"), "undo").when(op.isin([c for c in codes.ROW_CODES if c != codes.UNSUPPORTED]), "dml").otherwise("other")


def resolve_objects(rows: DataFrame, objects: DataFrame) -> DataFrame:
    """Adds ``name``: of ``objects(con_id, object, obj_id)``, or the object number where it is unknown."""
    known = objects.select("con_id", "obj_id", F.concat(F.lit("APP."), "object").alias("_name"))
    return rows.join(known, ["con_id", "obj_id"], "left").withColumn("name", F.coalesce("_name", F.concat(F.lit("OBJ# "), F.col("obj_id").cast("string")))).drop("_name")


def user_allowed(excluded: list[str], user: str = "username") -> Column:
    """Null users pass, excluded ones don't; DDL passes whoever ran it."""
    return (F.col("op_code") == codes.DDL) | F.col(user).isNull() | ~F.col(user).isin(excluded)


def whole(name: str | Column, patterns: list[str]) -> Column:
    """Whether a pattern matches all of the name, in either case."""
    name = F.col(name) if isinstance(name, str) else name
    return name.rlike("(?i)^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$")


def table_selected(name: str, include: list[str], exclude: list[str], pdb: str | None = None, pdbs: list[str] | None = None) -> Column:
    """No include pattern means all tables; exclusion wins."""
    keep = whole(name, include) if include else F.lit(True)
    keep = keep & ~whole(name, exclude) if exclude else keep
    return keep & F.col(pdb).isin(pdbs) if pdb and pdbs else keep


def first_start_scope(rows: DataFrame, open_at_start: DataFrame, floor: int, open_scn: int, tx: list[str]) -> DataFrame:
    """Below the floor only rows of transactions open at the start, or whose start row came at or after ``open_scn``."""
    so_far = Window.partitionBy(*tx).orderBy("scn").rowsBetween(Window.unboundedPreceding, 0)
    started = F.max(((F.col("op_code") == codes.START) & (F.col("scn") >= open_scn)).cast("int")).over(so_far)
    marked = rows.withColumn("_started", started).join(open_at_start.select(*tx).distinct().withColumn("_open", F.lit(True)), tx, "left")
    keep = (F.col("scn") >= floor) | (((F.col("_started") == 1) | F.col("_open").isNotNull()) & (F.col("op_code") != codes.DDL))
    return marked.where(keep).drop("_started", "_open")


def global_place(rows: DataFrame, order: str, keys: list[Column]) -> DataFrame:
    """Adds ``place``, the row's number in the order of ``keys`` (the first is ``order``) over all rows.

    Rows are numbered within ranges of ``order``, a fixed number of quantiles, and each range begins
    after the rows of those before it, so no task sees more than a range.
    """
    spark = rows.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(rows.agg(F.percentile_approx(order, [k / n for k in range(1, n)]).alias("q")).first()["q"] or []))
    part = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col(order))) if bounds else F.lit(0)
    ranged = rows.withColumn("_part", part)
    counts = sorted((r["_part"], r["count"]) for r in ranged.groupBy("_part").count().collect())  # a row a range
    bases, total = [], 0
    for p, c in counts:
        bases.append((p, total))
        total += c
    base = F.broadcast(spark.createDataFrame(bases, "_part int, _base long"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return ranged.withColumn("_own", own).join(base, "_part").withColumn("place", (F.col("_base") + F.col("_own")).cast("long")).drop("_part", "_own", "_base")


def spill_victims(sized: DataFrame, by: list[str], size: str, ties: list[str], budget: int) -> DataFrame:
    """Largest first, those to put on disk until what is left fits the budget."""
    larger = Window.partitionBy(*by).orderBy(F.desc(size), *ties).rowsBetween(Window.unboundedPreceding, -1)
    held = F.sum(size).over(Window.partitionBy(*by)) - F.coalesce(F.sum(size).over(larger), F.lit(0))
    return sized.withColumn("_held", held).where(F.col("_held") > budget).drop("_held")


def estimated_size(rowid: str, image: str) -> Column:
    """Bytes of a buffered change: fixed cost, row id, and each image entry by name and value size."""
    entries = F.aggregate(F.map_entries(image), F.lit(0), lambda a, x: a + 48 + 2 * F.length(x["key"]) + x["value"])
    return F.lit(160) + 2 * F.length(rowid) + 32 + entries


def resolve_partial(rows: DataFrame, slot: list[str], order: str, number: str, ends: str) -> DataFrame:
    """Rows without a sequence number get the highest one open in their slot; those with none open are dropped."""
    before = Window.partitionBy(*slot).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    lives = rows.withColumn("_life", F.coalesce(F.sum(F.col(ends).cast("int")).over(before), F.lit(0)))
    held = F.max(number).over(Window.partitionBy(*slot, "_life").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return lives.withColumn("resolved", F.coalesce(F.col(number), held)).where("resolved is not null").drop("_life")
