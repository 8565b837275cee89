"""Log analytics: redo profile, sizing, coverage, continuity, selection, lag explanation, preflight findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIB64 = 64 << 20
#: Rows from which a table counts as reloaded, and how alike deletes and inserts must be.
RELOAD_ROWS, RELOAD_SHARE = 1000, 0.8


def redo_samples(rows: DataFrame) -> DataFrame:
    """Counts by container, owner, table and operation; truncates among them."""
    return rows.groupBy("container", "owner", "tab", "operation").agg(F.count("*").alias("rows"), F.count_if("truncate").alias("truncates"))


def redo_profile(samples: DataFrame, captured: Column, reload_rows: int = RELOAD_ROWS) -> DataFrame:
    """A row a table: its operations, its total, whether it is captured and the workload pattern that it shows."""
    op, n = F.col("operation"), F.col("rows")
    kinds = {"inserts": op.contains("INSERT"), "updates": op == "UPDATE", "deletes": op == "DELETE", "ddl": op == "DDL"}
    named = reduce(lambda a, b: a | b, kinds.values())
    sums = [F.sum(F.when(cond, n).otherwise(0)).alias(name) for name, cond in kinds.items()]
    of = samples.where("tab is not null").groupBy("container", "owner", "tab").agg(*sums, F.sum("truncates").alias("truncates"), F.sum(F.when(~named, n).otherwise(0)).alias("other"), F.sum("rows").alias("total"))
    less, more = F.least("deletes", "inserts"), F.greatest("deletes", "inserts")
    pattern = F.when((F.col("truncates") > 0) & (F.col("inserts") >= reload_rows), "truncate-and-reload").when((less >= reload_rows) & (less >= RELOAD_SHARE * more), "delete-and-reload")
    return of.withColumn("captured", captured).withColumn("pattern", pattern)


def discard_share(profile: DataFrame) -> DataFrame:
    total, kept = F.sum("total"), F.sum(F.when(F.col("captured"), F.col("total")).otherwise(0))
    return profile.agg(total.alias("table_rows"), kept.alias("captured_rows"), F.coalesce(F.try_divide(total - kept, total), F.lit(0.0)).alias("discard_share"))


def in_window(logs: DataFrame, start: str, end: str) -> DataFrame:
    return logs.where((F.col("next_time") >= F.lit(start).cast("timestamp_ntz")) & (F.col("next_time") < F.lit(end).cast("timestamp_ntz")))


def hourly(logs: DataFrame) -> DataFrame:
    return logs.where("next_time is not null").groupBy(F.date_trunc("hour", "next_time").cast("timestamp_ntz").alias("hour"), "thread").agg(F.count("*").alias("logs"), F.sum("bytes").alias("bytes"))


def sizing(logs: DataFrame, current: DataFrame, hours: float) -> DataFrame:
    """By thread: switches an hour, the earliest peak hour, peak bytes, bytes a day and a size for four switches in the peak hour."""
    per = hourly(logs)
    peak = per.groupBy("thread").agg(F.max("logs").alias("peak_switches"), F.max("bytes").alias("peak_bytes"), F.max_by("hour", F.struct(F.col("logs"), -F.unix_micros(F.to_timestamp("hour")))).alias("peak_hour"))
    total = logs.groupBy("thread").agg(F.count("*").alias("logs"), F.sum("bytes").alias("_bytes"))
    out = total.join(peak, "thread").join(current, "thread", "left")
    quarter = F.floor(F.col("peak_bytes") / 4)
    rounded = (F.ceil(quarter / MIB64) * MIB64).cast("long")
    return out.select(
        "thread", "logs", (F.col("logs") / hours).alias("switches_per_hour"), "peak_switches", "peak_hour", "peak_bytes",
        F.floor(F.col("_bytes") / (hours / 24) + 0.5).cast("long").alias("bytes_per_day"), F.greatest(F.coalesce("current_bytes", F.lit(0)), rounded).alias("recommended_bytes"),
    )


def archive_space(logs: DataFrame, retention_hours: int) -> DataFrame:
    """Busiest hour and day over all threads, and the space that the retention needs."""
    hour = logs.groupBy(F.date_trunc("hour", "next_time").alias("h")).agg(F.sum("bytes").alias("b")).agg(F.max("b").alias("peak_hour_bytes"))
    day = logs.groupBy(F.date_trunc("day", "next_time").alias("d")).agg(F.sum("bytes").alias("b")).agg(F.max("b").alias("peak_day_bytes"))
    both = hour.withColumn("_k", F.lit(1)).join(day.withColumn("_k", F.lit(1)), "_k").drop("_k")  # one row each
    space = F.col("peak_hour_bytes") * retention_hours if retention_hours <= 24 else F.floor(F.col("peak_day_bytes") * (retention_hours / 24) + 0.5).cast("long")
    return both.withColumn("space_bytes", space)


def reach(logs: DataFrame) -> DataFrame:
    """Since when redo of every thread is there: the latest of the threads' earliest; and whether purging was seen."""
    per = logs.groupBy("thread").agg(F.min(F.when(~F.col("deleted"), F.col("first_time"))).alias("t"), F.max("deleted").alias("d"))
    return per.agg(F.max("t").alias("available_from"), F.max("d").alias("purge_seen"))


def sequence_gaps(logs: DataFrame) -> DataFrame:
    """``thread, after_seq, missing``: holes in each thread's sequence of present logs."""
    w = Window.partitionBy("thread").orderBy("seq")
    return logs.withColumn("_b", F.lag("seq").over(w)).where(F.col("seq") - F.col("_b") > 1).select("thread", F.col("_b").alias("after_seq"), (F.col("seq") - F.col("_b") - 1).alias("missing"))


def range_text(numbers: DataFrame, by: str, value: str) -> DataFrame:
    """``1 to 3, 5``: runs of consecutive values as one text; one group's runs stand in one row."""
    run = F.col(value) - F.row_number().over(Window.partitionBy(by).orderBy(value))
    runs = numbers.withColumn("_r", run).groupBy(by, "_r").agg(F.min(value).alias("a"), F.max(value).alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat(F.col("a").cast("string"), F.lit(" to "), F.col("b").cast("string")))
    return runs.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", text.alias("t")))), lambda x: x["t"]), ", ").alias("ranges"))


def overlapping(logs: DataFrame, start: int, end: int) -> DataFrame:
    """Logs that hold a position of ``[start, end]``."""
    return logs.where((F.col("next_scn") > start) & (F.col("first_scn") <= end))


def locate(rows: DataFrame, logs: DataFrame, width: int) -> DataFrame:
    """Each row with the log of its thread that holds its position.

    Positions and logs meet in buckets of ``width``, so a thread with most of the rows is many keys.
    """
    top = rows.agg(F.max("scn")).first()[0]
    if top is None:
        return rows.join(logs, "thread").limit(0)
    bucket = lambda c: F.floor(c / width).cast("long")
    spans = logs.where(F.col("first_scn") <= top).withColumn("_b", F.explode(F.sequence(bucket(F.col("first_scn")), bucket(F.least(F.col("next_scn") - 1, F.lit(top))))))
    inside = (F.col("scn") >= F.col("first_scn")) & (F.col("scn") < F.col("next_scn"))
    return rows.withColumn("_b", bucket(F.col("scn"))).join(spans, ["thread", "_b"]).where(inside).drop("_b")


def one_copy(copies: DataFrame) -> DataFrame:
    """One copy of each log, a readable one first."""
    best = F.row_number().over(Window.partitionBy("thread", "seq").orderBy(F.desc("readable"), "dest"))
    return copies.withColumn("_r", best).where("_r = 1").drop("_r")


def coverage(logs: DataFrame, position: int) -> DataFrame:
    """By thread whether its logs run from a position to its newest without a hole: ``thread, from_seq, covered, holes``.

    ``from_seq`` is the first that is there, ``holes`` how many are not, deleted or never listed. A thread none of whose logs
    reaches the position is not covered.
    """
    needed = F.col("next_scn") > position
    by = logs.groupBy("thread").agg(
        F.min(F.when(needed & ~F.col("deleted"), F.col("seq"))).alias("from_seq"),
        F.min(F.when(needed, F.col("first_scn"))).alias("_first"),
        (F.max("seq") - F.min(F.when(needed, F.col("seq"))) + 1 - F.count_if(needed & ~F.col("deleted"))).alias("_holes"),
    )
    holes = F.coalesce("_holes", F.lit(0))
    return by.select("thread", "from_seq", (F.coalesce(F.col("_first") <= position, F.lit(False)) & (holes == 0)).alias("covered"), holes.alias("holes"))


def least_whole(logs: DataFrame) -> DataFrame:
    """One row ``least``: the least position from which all logs of all threads are there, up to the newest of each."""
    before = F.lag("seq").over(Window.partitionBy("thread").orderBy("seq"))
    lacking = F.when(F.col("deleted"), F.col("next_scn")).when(F.col("_b").isNull() | (F.col("seq") - F.col("_b") > 1), F.col("first_scn"))
    return logs.withColumn("_b", before).agg(F.max(lacking).alias("least"))


def position_plans(logs: DataFrame, targets: DataFrame, stored: int, allow_skip: bool = False, current: DataFrame | None = None) -> DataFrame:
    """``target, plan``: whether a stored position may move to each target; a move forward skips changes.

    ``current`` has the database's position in one row ``current``; without it that is the end of the newest log. A target is refused
    where it lies beyond that, or where from it on a log of any thread is lacking.
    """
    if current is None:
        current = logs.agg(F.max(F.when(F.col("next_scn") < 2**63 - 1, F.col("next_scn")).otherwise(F.col("first_scn"))).alias("current"))
    ends = least_whole(logs).withColumn("_k", F.lit(1)).join(current.withColumn("_k", F.lit(1)), "_k")
    plan = (
        F.when(F.col("target") > F.col("current"), "beyond the end")
        .when(F.col("least").isNull() | (F.col("target") < F.col("least")), "redo is gone")
        .when((F.col("target") > stored) & ~F.lit(allow_skip), "needs allow-skip")
        .otherwise("ok")
    )
    return targets.withColumn("_k", F.lit(1)).join(F.broadcast(ends), "_k").select("target", plan.alias("plan"))  # one row of ends


def first_available(logs: DataFrame, position: int) -> DataFrame:
    """One row ``position, resume``: the least position from a given one on from which every log of every thread is there.

    ``resume`` is the position itself where nothing is lacking, and null where no later start is whole or no log ends
    after it. Log metadata has a row a log.
    """
    by_seq = Window.partitionBy("thread").orderBy("seq")
    later = logs.where(F.col("next_scn") > position).withColumn("_b", F.lag("seq").over(by_seq))
    lacking = F.when(F.col("deleted"), F.col("next_scn")).when(F.col("_b").isNull() | (F.col("seq") - F.col("_b") > 1), F.col("first_scn"))
    least = later.agg(F.greatest(F.lit(position), F.max(lacking)).alias("_least")).withColumn("_k", F.lit(1))
    both = later.withColumn("_k", F.lit(1)).join(F.broadcast(least), "_k")  # one row
    start = F.min(F.when(~F.col("deleted") & (F.col("first_scn") >= F.col("_least")), F.col("first_scn")))
    return both.agg(F.lit(position).cast("long").alias("position"), F.when(F.max("_least") == position, F.lit(position).cast("long")).otherwise(start).alias("resume"))


def resnapshot_plan(logs: DataFrame, captured: DataFrame, position: int, named: list[str], skip_unlisted: bool = False) -> DataFrame:
    """One row ``position, resume, unknown, unlisted, plan``: what a new snapshot of named tables does to a stored position.

    ``captured(tab)`` has a row a captured table; names match in either case. Tables that are not named would lose
    their changes in a gap, so a move past it is refused unless that is allowed.
    """
    wanted = sorted({n.strip().upper() for n in named})
    held = F.collect_set(F.upper("tab"))
    tables = captured.agg(
        F.array_join(F.array_sort(F.array_except(F.lit(wanted).cast("array<string>"), held)), ",").alias("unknown"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.upper("tab").isin(wanted), F.col("tab")))), ",").alias("unlisted"),
    ).withColumn("_k", F.lit(1))
    one = first_available(logs, position).withColumn("_k", F.lit(1)).join(F.broadcast(tables), "_k").drop("_k")  # one row each
    plan = (
        F.when(F.col("unknown") != "", "refused: not captured")
        .when(F.col("resume") == F.col("position"), "signal")
        .when(F.col("resume").isNull(), "refused: no later start")
        .when((F.col("unlisted") != "") & ~F.lit(skip_unlisted), "refused: unlisted tables")
        .otherwise("signal and move")
    )
    return one.select(F.lit(position).cast("long").alias("position"), "resume", "unknown", "unlisted", plan.alias("plan"))


def window_end(logs: DataFrame, start: int, n: int) -> DataFrame:
    """The least over threads of the end of the n-th log from a position."""
    later = logs.where(F.col("next_scn") > start)
    nth = later.withColumn("_r", F.row_number().over(Window.partitionBy("thread").orderBy("seq"))).where(F.col("_r") == n)
    return nth.agg(F.min("next_scn").alias("window_end"))


def dictionary_build(logs: DataFrame, position: int) -> DataFrame:
    """By thread the newest dictionary build (begin to end, all readable) that ends at or before a position."""
    upto = Window.partitionBy("thread").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    marked = logs.withColumn("_begin", F.last(F.when(F.col("dict_begin"), F.col("seq")), ignorenulls=True).over(upto))
    bad = F.max(F.when(F.col("deleted"), F.col("seq"))).over(upto)
    ends = marked.withColumn("_bad", bad).where(F.col("dict_end") & F.col("_begin").isNotNull() & (F.col("first_scn") <= position) & (F.col("_bad").isNull() | (F.col("_bad") < F.col("_begin"))))
    return ends.groupBy("thread").agg(F.max_by("_begin", "seq").alias("begin_seq"), F.max("seq").alias("end_seq"))


def counter_rates(samples: DataFrame, by: str, at: str, counters: list[str], seconds: Column) -> DataFrame:
    """Growth of counters between neighbouring samples; a counter that fell back counts as 0."""
    w = Window.partitionBy(by).orderBy(at)
    grown = [F.when(F.lag(c).over(w).isNotNull(), F.greatest(F.lit(0), F.col(c) - F.lag(c).over(w))).alias(f"{c}_delta") for c in counters]
    return samples.select(by, at, *grown, seconds.alias("seconds")).where(F.col(f"{counters[0]}_delta").isNotNull())


#: How full a queue must be to be the cause, and lag in ms that needs one.
QUEUE_FULL, LAG_MS, LARGE_EVENTS = 0.9, 10_000, 100_000


def explain_lag(pairs: DataFrame, target_ms: int = 2000) -> DataFrame:
    """Causes of lag of each pair of samples, best first: ``id, cause, score, place``."""
    full = F.least("fill_before", "fill_after") >= QUEUE_FULL
    slow = (F.col("timeouts") > 0) | (~full & (F.col("step_ms") >= max(5000, 2 * target_ms)))
    mining = F.when(F.col("timeouts") > 0, 1.4).otherwise(F.least(F.lit(1.3), F.greatest(F.lit(0.6), F.col("step_ms") / (4.0 * target_ms))))
    heavy = (F.col("spilled_bytes") > 0) | ((F.col("events") >= LARGE_EVENTS) & F.col("open_tx").between(1, 3))
    cause = lambda cond, name, score: F.when(cond, F.struct(F.lit(name).alias("cause"), score.cast("double").alias("score")))
    found = F.array_compact(F.array(
        cause(full, "KAFKA", 1 + F.col("fill_after")),
        cause(heavy, "LARGE_TRANSACTION", F.when(F.col("spilled_bytes") > 0, 1.2).otherwise(0.9)),
        cause(slow, "MINING", mining),
        cause(F.col("replays") > 0, "LAG_REPLAY", F.lit(1.1)),
    ))
    lagging = (F.col("behind_ms") >= LAG_MS) | (F.col("timeouts") > 0) | full | ((F.col("scn_growth") > 0) & (F.col("steps") == 0))
    none = F.array(F.when(lagging, F.struct(F.lit("UNCLEAR").alias("cause"), F.lit(0.1).alias("score"))).otherwise(F.struct(F.lit("NONE").alias("cause"), F.lit(0.0).alias("score"))))
    one = pairs.select("id", F.explode(F.when(F.size(found) > 0, found).otherwise(none)).alias("x")).select("id", "x.cause", "x.score")
    return one.withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "cause")).cast("long"))


def findings(rule: str, rows: DataFrame, severity: Column, obj: Column, bad: Column) -> DataFrame:
    """Findings of one rule: a row for each row of its input that is bad."""
    return rows.where(bad).select(F.lit(rule).alias("rule"), severity.alias("severity"), obj.cast("string").alias("object"))
