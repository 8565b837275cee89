"""Rendering of changes as nested envelope records and as flat records, routing, keys, headers and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.codes import DELETE, INSERT, UPDATE


def images(op: Column, set_: Column, where: Column) -> tuple[Column, Column]:
    """Before and after maps: an insert sets, a delete had, an update had and sets over it."""
    over = F.map_concat(F.map_filter(where, lambda k, _: ~F.map_contains_key(set_, k)), set_)
    before = F.when(op != INSERT, where)
    after = F.when(op == INSERT, set_).when(op == UPDATE, over)
    return before, after


def partial(op: Column, where: Column, columns: Column | int) -> Column:
    """Whether an update's or delete's before image lacks columns that the table has."""
    return op.isin(UPDATE, DELETE) & (F.size(where) < columns)


def envelope_op(op: Column, snapshot: Column | None = None) -> Column:
    named = F.when(op == INSERT, "c").when(op == UPDATE, "u").when(op == DELETE, "d")
    return named if snapshot is None else F.when(snapshot, "r").otherwise(named)


def envelope_records(changes: DataFrame, old_key: Column, new_key: Column, tombstones: bool = True) -> DataFrame:
    """One to three records for each change, numbered ``sub``: ``op, key, has_value``.

    An update that moves the key is a delete of the old and a create of the new; deletes of a known key are
    followed by a tombstone where those are on.
    """
    rec = lambda op, key, value: F.struct(F.lit(op).alias("op"), key.cast("string").alias("key"), F.lit(value).alias("has_value"))
    grave = lambda key: [F.when(key.isNotNull(), rec("tombstone", key, False))] if tombstones else []
    moved = F.array(rec("d", old_key, True), *grave(old_key), rec("c", new_key, True))
    one = F.array(F.struct(envelope_op(F.col("op_code")).alias("op"), F.coalesce(new_key, old_key).cast("string").alias("key"), F.lit(True).alias("has_value")))
    out = F.when((F.col("op_code") == UPDATE) & ~old_key.eqNullSafe(new_key), moved).when(F.col("op_code") == DELETE, F.array(rec("d", old_key, True), *grave(old_key))).otherwise(one)
    return changes.withColumn("_r", out).select("*", F.posexplode(F.array_compact("_r")).alias("sub", "record")).select(*changes.columns, "sub", "record.*")


def flat_records(changes: DataFrame, old_key: Column, new_key: Column, tombstones: bool) -> DataFrame:
    """Flat records: with tombstones on a delete is one tombstone and nothing else; a moved key is always a tombstone, then an insert."""
    rec = lambda op, key: F.struct(F.lit(op).alias("op_type"), key.cast("string").alias("key"))
    moved = F.array(rec(None, old_key), rec("I", new_key))
    deleted = F.array(rec(None if tombstones else "D", old_key))
    one = F.array(F.struct(F.when(F.col("op_code") == INSERT, "I").otherwise("U").alias("op_type"), new_key.cast("string").alias("key")))
    out = F.when((F.col("op_code") == UPDATE) & ~old_key.eqNullSafe(new_key), moved).when(F.col("op_code") == DELETE, deleted).otherwise(one)
    return changes.select("*", F.posexplode(out).alias("sub", "record")).select(*changes.columns, "sub", "record.*")


def topic(template: str, **parts: str) -> tuple[Column, Column]:
    """Expanded and sanitised topic name of a ``${part}`` template; parts are columns."""
    out: list[Column] = []
    for k, piece in enumerate(template.split("${")):
        if k:
            name, _, piece = piece.partition("}")
            out.append(F.col(parts[name]).cast("string"))
        out.append(F.lit(piece))
    name = F.concat(*out)
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9._-]", "_"), r"\.\.+", "."), r"^\.+", "")
    return name, F.substring(clean, 1, 249)


def topic_collisions(named: DataFrame, expanded: str = "expanded", clean: str = "topic") -> DataFrame:
    """Topics that different tables reach only because names were sanitised."""
    return named.groupBy(clean).agg(F.count_distinct(expanded).alias("tables")).where("tables > 1")


def adjust_name(name: Column, mode: str) -> Column:
    """Field names under NONE, AVRO (bad characters become ``_``) or AVRO_UNICODE (they become ``_uXXXX``)."""
    if mode == "NONE":
        return name
    if mode == "AVRO":
        clean = F.regexp_replace(name, "[^A-Za-z0-9_]", "_")
        return F.when(clean.rlike("^[0-9]"), F.concat(F.lit("_"), clean)).otherwise(clean)
    code = lambda c: F.concat(F.lit("_u"), F.lpad(F.lower(F.hex(F.ascii(c))), 4, "0"))
    bad = lambda c, i: ~c.rlike("^[A-Za-z0-9]$") | ((i == 0) & c.rlike("^[0-9]$"))
    return F.array_join(F.transform(F.filter(F.split(name, ""), lambda c: c != ""), lambda c, i: F.when(bad(c, i), code(c)).otherwise(c)), "")


def joined_key(*columns: str) -> Column:
    """Key columns joined by ``_``; null where one is missing (``concat_ws`` would skip it)."""
    some_null = F.lit(False)
    for c in columns:
        some_null = some_null | F.col(c).isNull()
    return F.when(~some_null, F.concat_ws("_", *[F.col(c).cast("string") for c in columns]))


def only_large_changed(before: Column, after: Column, large: list[str]) -> Column:
    """Whether an update's scalar columns are all equal, so that it touched large values alone."""
    rest = lambda m: F.map_filter(m, lambda k, _: ~k.isin(large))
    same = lambda m: F.array_sort(F.map_entries(rest(m)))
    return same(before).eqNullSafe(same(after))


def large_value_records(changes: DataFrame, columns: dict[str, str], key: str) -> DataFrame:
    """A record for each touched large column: ``table, column, primary_key`` and bytes, null once the row is gone."""
    values = F.array(*[F.struct(F.lit(name).alias("column"), F.col(c).cast("string").alias("value")) for name, c in columns.items()])
    rows = changes.select("*", F.explode(values).alias("x")).where(F.col("x.value").isNotNull() | (F.col("op_code") == DELETE))
    data = F.when(F.col("op_code") != DELETE, F.encode(F.coalesce("x.value", F.lit("")), "UTF-8"))
    return rows.select(F.col("tab").alias("table"), F.col("x.column"), F.col(key).alias("primary_key"), "scn", data.alias("data"))


def headers(tx: list[str]) -> Column:
    return F.create_map(
        F.lit("cdc.scn"), F.col("scn").cast("string"),
        F.lit("cdc.commit_scn"), F.col("commit_scn").cast("string"),
        F.lit("cdc.xid"), F.concat_ws(".", *[F.col(c).cast("string") for c in tx]),
        F.lit("cdc.event_index"), F.col("event_index").cast("string"),
        F.lit("cdc.event_count"), F.col("event_count").cast("string"),
        F.lit("cdc.schema_version"), F.lit("1"),
    )


def dead_letters(changes: DataFrame, error: Column, sql: str, withheld: Column) -> DataFrame:
    """Rows that could not be decoded, their statement kept back where it may hold an excluded column."""
    bad = changes.withColumn("exception", error).where("exception is not null")
    return bad.withColumn("kind", F.when(F.col("op_code") == 255, "unsupported").otherwise("decode-error")).withColumn(sql, F.when(~withheld, F.col(sql)))
