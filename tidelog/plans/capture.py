"""A whole capture: raw mined rows to rendered records, one pass of shuffles by transaction.

Raw rows have the 34 columns of ``functions.types.RAW_ROW``. The steps are those of the operators: join continued
statements, filter, assemble transactions and undo, fold edits of large values into their changes, number, parse, resolve
each row's layout by its position, decode by type, render. Without ``layouts`` values stay literal texts and keys come
from ``keys``. ``streaming.capture`` renders with the same functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import codes, redo
from tidelog.llm.shared import Workspace
from tidelog.operators import large, layouts as lay, render, schema, scans
from tidelog.operators.transactions import mark_survivors
from tidelog.options import DecodeErrorAction, KeyPolicy, LargeMode, Options, OutputFormat

TX = ["con_id", "usn", "slot", "sqn"]
LARGE_CODES = (codes.SELECT_LOB_LOCATOR, codes.LOB_WRITE, codes.LOB_TRIM, codes.LOB_ERASE)
#: Fixed value: keys of transactions with edits of large values that are broadcast at most.
BROADCAST_EDITED = 100_000


@dataclass
class Captured:
    """``records``: topic, key, value, headers and their place; ``dead``: rows that could not be decoded."""

    records: DataFrame
    dead: DataFrame


def _plain(raw: DataFrame) -> DataFrame:
    c = lambda name: F.col(f"`{name}`")
    return raw.select(
        c("SRC_CON_ID").alias("con_id"), c("XIDUSN").alias("usn"), c("XIDSLT").alias("slot"), c("XIDSQN").alias("sqn"), c("THREAD#").alias("thread"), c("SCN").alias("scn"),
        F.struct(F.rtrim(c("RS_ID")).alias("rs_id"), c("SSN").alias("ssn"), c("SCN").alias("scn")).alias("pos"), c("OPERATION_CODE").alias("op_code"), (c("ROLLBACK") == 1).alias("undo"), c("CSF").alias("csf"),
        c("SEG_OWNER").alias("owner"), c("TABLE_NAME").alias("tab"), c("USERNAME").alias("username"), c("ROW_ID").alias("rid"), c("SRC_CON_NAME").alias("pdb"), c("TIMESTAMP").alias("ts"), c("SQL_REDO").alias("sql"),
    )


def _joined(rows: DataFrame) -> DataFrame:
    """Continued statements as one row each, where their first piece stands."""
    before = Window.partitionBy(*TX).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    marked = rows.withColumn("_island", F.coalesce(F.sum(F.when(F.col("csf") == 0, 1).otherwise(0)).over(before), F.lit(0)))
    rest = [c for c in rows.columns if c not in (*TX, "sql", "csf")]
    whole = marked.groupBy(*TX, "_island").agg(
        F.min_by(F.struct(*rest), "pos").alias("x"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sql"))), lambda p: p["sql"]), "").alias("sql"), F.min("csf").alias("_open")
    )
    return whole.where("_open = 0").select(*TX, "x.*", "sql")


def _wanted(options: Options) -> Column:
    """Whether the table of a row with its full name in ``_name`` is captured."""
    return scans.table_selected("_name", options.include, options.exclude, pdb="pdb", pdbs=options.containers)


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_name", F.concat_ws(".", "pdb", "owner", "tab"))


def log_layouts(raw: DataFrame, dictionary: DataFrame, options: Options = Options(), start: int = 0, quiet: int | None = None, joined: DataFrame | None = None) -> DataFrame:
    """Layouts of the captured tables (``operators.layouts.REPLAYED``) by readings of the dictionary and the log's own statements.

    ``options.include`` and ``exclude`` say which tables; see ``operators.layouts.replayed``.
    """
    plain = _plain(raw)
    ddl = _named(_joined(plain.where(F.col("op_code") == codes.DDL)).where("owner is not null and tab is not null"))
    captured = ddl.withColumn("_captured", _wanted(options)).drop("_name")
    readings = _named(dictionary).where(_wanted(options)).drop("_name")
    read = readings.where("read_ts is not null").select(F.col("read_ts").alias("ts"), F.col("read_scn").alias("scn"))
    times = plain.select("ts", "scn").unionByName(read).groupBy("ts").agg(F.min("scn").alias("scn"))
    return lay.replayed(captured, readings, times, start, "_captured", quiet, joined)


def _kept(rows: DataFrame, options: Options) -> DataFrame:
    wanted = _wanted(options)
    rows = _named(rows)
    control = F.col("op_code").isin(*codes.TX_CODES)
    rows_of = [c for c in codes.ROW_CODES if c not in LARGE_CODES or options.large_values != LargeMode.SKIP]
    kept = F.col("op_code").isin(rows_of)
    if options.truncates:
        kept |= (F.col("op_code") == codes.DDL) & (schema.ddl_kind(F.col("sql")) == "TRUNCATE")
    user = scans.user_allowed(options.exclude_users) if options.exclude_users else F.lit(True)
    return rows.where((control | (kept & wanted)) & user).drop("_name")


def _image(side: Column, options: Options) -> Column:
    plain = F.transform_values(side, lambda _, v: F.when(v["kind"] != "NULL", v["value"]))
    if not options.exclude_columns:
        return plain
    named = lambda k: F.concat_ws(".", F.col("pdb"), F.col("owner"), F.col("tab"), k)
    return F.map_filter(plain, lambda k, _: ~scans.whole(named(k), options.exclude_columns))


def _only(image: Column, columns: list[str]) -> Column:
    return F.map_filter(image, lambda k, _: k.isin(columns))


def _key(image: Column, keys: dict[str, list[str]]) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for table, columns in keys.items():
        values = _only(image, columns)
        out = out.when((F.concat_ws(".", "owner", "tab") == table) & (F.size(values) == len(columns)), F.to_json(values))
    return out


def _parsed(changes: DataFrame) -> DataFrame:
    """Column ``p``: parsed statements; a truncation has no images and is no error."""
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in redo.DML_TYPE])
    return changes.withColumn("p", F.when(F.col("op_code") == codes.DDL, empty).otherwise(redo.parse_redo_once(F.when(F.col("op_code") != codes.DDL, F.col("sql")))))


def _surviving(plain: DataFrame, options: Options) -> DataFrame:
    """Surviving changes of committed transactions, each with its commit; rows are dealt out by transaction once, in ``_joined``."""
    commit = F.when(F.col("op_code") == codes.COMMIT, F.struct(F.col("scn").alias("commit_scn"), F.col("ts").alias("commit_ts")))
    rows = _kept(_joined(plain), options).withColumn("_ends", F.collect_list(commit).over(Window.partitionBy(*TX)))
    changes = rows.where(~F.col("op_code").isin(*codes.TX_CODES)).where(F.size("_ends") > 0).dropna(subset=TX)
    changes = mark_survivors(changes, TX, "rid", "pos").where("survives")
    return changes.select("*", F.explode("_ends").alias("_end")).select("*", "_end.*").drop("_ends", "_end")


def _with_large(changes: DataFrame) -> DataFrame:
    """Parsed changes, edits of large values folded into the change of their row before them, or a change of their own.

    An edit belongs to the last change of its row id in its transaction; its value is known where that change made the value
    empty or the edits cover all of it, and a column whose value is not known stays out of the record.
    """
    is_large = F.col("op_code").isin(*LARGE_CODES)
    at = Window.partitionBy(*TX, "rid").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = _parsed(changes).withColumn("l", redo.parse_large_block(F.when(F.col("op_code").isin(codes.LOB_WRITE, codes.LOB_TRIM, codes.LOB_ERASE), F.col("sql"))))
    rows = rows.withColumn("_change", F.sum(F.when(is_large, 0).otherwise(1)).over(at)).withColumn("_sets", F.last(F.when(~is_large, F.col("p.sets")), ignorenulls=True).over(at))
    edits = rows.where(is_large & F.col("l.error").isNull()).select(*TX, "rid", "_change", F.col("l.column").alias("column"), "pos", "_sets", F.posexplode("l.edits").alias("k", "e"))
    empty = F.try_element_at("_sets", F.col("column"))["kind"]
    edits = edits.select(*TX, "rid", "_change", "column", F.struct("pos", "k").alias("ord"), "e.edit", "e.amount", "e.offset", "e.data", F.coalesce("e.binary", empty == "EMPTY_BLOB", F.lit(False)).alias("binary"), F.when(empty.isin("EMPTY_CLOB", "EMPTY_BLOB"), "").alias("base"))
    folded = large.fold_edits(edits, [*TX, "rid", "_change", "column"]).where("known")
    entry = F.struct(F.col("column"), F.struct(F.lit("LARGE").alias("kind"), F.col("value"), F.lit(None).cast("string").alias("format")))
    folded = folded.groupBy(*TX, "rid", "_change").agg(F.map_from_entries(F.collect_list(entry)).alias("_large"))
    first = F.row_number().over(Window.partitionBy(*TX, "rid", "_change").orderBy("pos"))
    alone = rows.where(is_large & (F.col("_change") == 0) & F.col("l.error").isNull() & F.col("l").isNotNull()).where(F.size("l.edits") > 0).withColumn("_n", first).where("_n = 1").drop("_n")
    none = F.lit(None).cast("string")
    update = F.struct(F.lit("UPDATE").alias("op"), F.col("l.owner").alias("owner"), F.col("l.table").alias("table"), F.create_map().cast(redo.DML_TYPE["sets"].dataType).alias("sets"), F.col("l.where").alias("where"), F.col("l.rowid").alias("rowid"), none.alias("error"))
    alone = alone.withColumn("p", update).withColumn("op_code", F.lit(codes.UPDATE))
    broken = rows.where(is_large & (F.col("op_code") != codes.SELECT_LOB_LOCATOR) & F.col("l.error").isNotNull())
    broken = broken.withColumn("p", F.col("p").withField("error", F.col("l.error")))
    whole = rows.where(~is_large).unionByName(alone).join(folded, [*TX, "rid", "_change"], "left")
    over = F.map_concat(F.map_filter("p.sets", lambda k, _: ~F.map_contains_key("_large", k)), F.col("_large"))
    whole = whole.withColumn("p", F.when(F.col("_large").isNotNull() & F.col("op_code").isin(codes.INSERT, codes.UPDATE), F.col("p").withField("sets", over)).otherwise(F.col("p"))).drop("_large")
    return whole.unionByName(broken).drop("l", "_change", "_sets")


def numbered(changes: DataFrame) -> DataFrame:
    """Place of each change in its transaction and among those of its table."""
    by_tx, by_table = Window.partitionBy(*TX).orderBy("pos"), Window.partitionBy(*TX, "owner", "tab").orderBy("pos")
    return changes.withColumn("event_index", (F.row_number().over(by_tx) - 1).cast("long")).withColumn("event_count", F.count("*").over(Window.partitionBy(*TX))).withColumn("collection_order", F.row_number().over(by_table).cast("long"))


def rendered(parsed: DataFrame, keys: dict[str, list[str]], options: Options, server: str, layouts: DataFrame | None = None) -> Captured:
    """Records and dead letters of numbered changes with their parsed statements ``p``; no shuffle, so a stream may be rendered too."""
    images = zip(("before", "after"), render.images(F.col("op_code"), _image(F.col("p.sets"), options), _image(F.col("p.where"), options)), strict=True)
    parsed = parsed.withColumns(dict(images))
    problem = F.col("p.error")
    row_key = F.to_json(F.struct(F.col("rid").alias("ROWID"))) if options.keyless == KeyPolicy.ROWID else F.lit(None).cast("string")
    if layouts is not None:
        layout = F.col("layout")
        parsed = lay.resolve(parsed, layouts, decimals=options.decimals, temporals=options.temporals)
        parsed = parsed.withColumns({f"{side}_fields": lay.fields(F.col(side), layout) for side in ("before", "after")})
        of_table = F.when(F.col("op_code") != codes.DDL, F.coalesce(*[lay.problem(F.col(side), F.col(f"{side}_fields"), layout) for side in ("before", "after")]))
        no_key = F.when((F.size(layout["key"]) == 0) & (F.col("op_code") != codes.DDL), "the table has no key") if options.keyless == KeyPolicy.FAIL else F.lit(None).cast("string")
        problem = F.coalesce(problem, of_table, no_key)
        json = {side: lay.as_object(F.col(f"{side}_fields"), options.field_names) for side in ("before", "after")}
        key = {side: F.when(F.size(layout["key"]) > 0, lay.key_object(F.col(f"{side}_fields"), layout, options.field_names)).otherwise(row_key) for side in ("before", "after")}
        number = layout["version"].cast("string")
    else:
        json = {side: F.to_json(side) for side in ("before", "after")}
        key = {side: _key(F.col(side), keys) for side in ("before", "after")}
        number = F.lit("1")
    parsed = parsed.withColumns({"_problem": problem, "before_json": json["before"], "after_json": json["after"], "old_key": key["before"], "new_key": key["after"], "_version": number})
    bad = F.col("_problem").isNotNull()
    dead = parsed.where(bad).select(*TX, "scn", "owner", "tab", "op_code", F.col("_problem").alias("exception"), F.when(F.lit(not options.exclude_columns), F.col("sql")).alias("sql_redo"))
    if options.decode_error == DecodeErrorAction.FAIL:
        good = parsed.where(F.when(bad, F.raise_error(F.concat(F.lit("cannot decode: "), F.col("_problem")))).otherwise(F.lit(True)))
    else:
        good = parsed.where(~bad)
    _, topic = render.topic(options.topic_template.replace("${server}", server), pdb="pdb", schema="owner", table="tab")
    headers = F.map_concat(F.map_filter(render.headers(TX), lambda k, _: k != "cdc.schema_version"), F.create_map(F.lit("cdc.schema_version"), F.col("_version")))
    place = [headers.alias("headers"), *TX, "commit_scn", "thread", "event_index", "sub"]
    inner = lambda text: F.substring(text, F.lit(2), F.length(text) - 2)
    if options.format == OutputFormat.FLAT:
        flat = render.flat_records(good.where(F.col("op_code") != codes.DDL), F.col("old_key"), F.col("new_key"), options.tombstones)
        columns = inner(F.when(F.col("op_type") == "D", F.col("before_json")).otherwise(F.col("after_json")))
        more = F.to_json(F.struct(F.concat_ws(".", "pdb", "owner", "tab").alias("table"), F.col("scn").cast("string").alias("scn"), "op_type", F.col("commit_ts").cast("string").alias("op_ts"), F.col("rid").alias("row_id"), "username"))
        value = F.concat(F.lit("{"), columns, F.when(columns == "", "").otherwise(","), inner(more), F.lit("}"))
        return Captured(flat.select(topic.alias("topic"), "key", F.when(F.col("op_type").isNotNull(), value).alias("value"), *place), dead)
    records = render.envelope_records(good, F.col("old_key"), F.col("new_key"), options.tombstones)
    records = records.withColumn("op", F.when(F.col("op_code") == codes.DDL, "t").otherwise(F.col("op")))
    ms = F.floor(F.unix_micros(F.to_timestamp("commit_ts")) / 1000).cast("long")
    xid = F.concat_ws(".", *[F.col(c).cast("string") for c in TX[1:]])
    source = F.struct(F.lit(server).alias("name"), "pdb", F.col("owner").alias("schema"), F.col("tab").alias("table"), xid.alias("txId"), F.col("scn").cast("string").alias("scn"), F.col("commit_scn").cast("string").alias("commit_scn"), F.col("rid").alias("row_id"), F.col("username").alias("user_name"))
    block = F.struct(xid.alias("id"), (F.col("event_index") + 1).alias("total_order"), F.col("collection_order").alias("data_collection_order"))
    side = lambda name, op: F.coalesce(F.when(F.col("op") != op, F.col(f"{name}_json")), F.lit("null"))
    value = F.concat(F.lit('{"before":'), side("before", "c"), F.lit(',"after":'), side("after", "d"), F.lit(","), inner(F.to_json(F.struct(source.alias("source"), "op", ms.alias("ts_ms"), block.alias("transaction")))), F.lit("}"))
    return Captured(records.select(topic.alias("topic"), "key", F.when(F.col("has_value"), value).alias("value"), *place), dead)


def capture(raw: DataFrame, keys: dict[str, list[str]] | None = None, options: Options = Options(), server: str = "server", layouts: DataFrame | None = None, dictionary: DataFrame | None = None, start: int = 0) -> Captured:
    """Records of the surviving changes of committed transactions.

    ``layouts`` (``operators.layouts.LAYOUT``) type the values and name the keys; so does ``dictionary``, readings of it from which and from
    the log's statements the layouts are made (``log_layouts``). Without either ``keys`` has the key columns by ``OWNER.TABLE``.
    Edits of large values are folded by joins of their rows with themselves, so only transactions that hold some take that way.
    """
    if layouts is None and dictionary is not None:
        layouts = Workspace(raw.sparkSession).save(log_layouts(raw, dictionary, options, start).select(*lay.LAYOUT_COLUMNS), "layouts")
    if options.large_values in (LargeMode.RESELECT, LargeMode.TOPIC):
        raise ValueError(f"large_values: {options.large_values} reads the source or writes topics of its own; see the queries j11_ and s14_")
    plain = _plain(raw)
    if options.large_values != LargeMode.INLINE:
        return rendered(_parsed(numbered(_surviving(plain, options))), keys or {}, options, server, layouts)
    edited = plain.where(F.col("op_code").isin(*LARGE_CODES)).select(*TX).distinct()
    n = edited.count()
    known = F.broadcast(edited) if n <= BROADCAST_EDITED else edited
    parsed = _parsed(numbered(_surviving(plain.join(known, TX, "left_anti") if n else plain, options)))
    if n:
        parsed = parsed.unionByName(numbered(_with_large(_surviving(plain.join(known, TX, "left_semi"), options))))
    return rendered(parsed, keys or {}, options, server, layouts)
