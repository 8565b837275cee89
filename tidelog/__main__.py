"""Command line: run registered queries and reports over a folder of tables.

    python -m tidelog list
    python -m tidelog query NAME --data DIR [--rows N]
    python -m tidelog check|redo-profile|sizing|explain-lag|offsets|transactions|journal|verify|workload --data DIR
    python -m tidelog resnapshot --data DIR --position N --tables A,B [--skip-unlisted]
    python -m tidelog offsets --data DIR --position N --target M [--allow-skip]
    python -m tidelog options key=value ...
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidelog.operators import doctor, replay
from tidelog.options import Options
from tidelog.plans import QUERIES
from tidelog.plans import doctor_queries as dq
from tidelog.plans import replay_queries as rq

def _logs(spark: SparkSession, data: str) -> DataFrame:
    return spark.read.parquet(f"{data}/logs.parquet")


#: Reports over tables of a user's own in ``--data``: logs, settings, catalog, grants, topics, lags, journal, active.
OVER_TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "findings": lambda spark, data: dq.findings_of(_logs(spark, data), *(x.read(spark, data) for x in (dq.SETTINGS, dq.CATALOG, dq.GRANTS, dq.TOPICS))),
    "causes": lambda spark, data: dq.ranked_causes(dq.LAGS.read(spark, data, "causes")),
    "chunks": lambda spark, data: rq.chunks_by_transaction(rq.JOURNAL.read(spark, data)),
    "state": lambda spark, data: replay.journal_state(rq.JOURNAL.read(spark, data)),
    "journaled": lambda spark, data: rq.with_activity(rq.JOURNAL.read(spark, data), rq.ACTIVE.read(spark, data)),
}

#: Names of reports over tables of the user's own, or else of queries.
REPORTS = {
    "check": ["findings"],
    "redo-profile": ["a2_a4_redo_profile", "a3_discard_share"],
    "sizing": ["a6_log_sizing", "a6_archive_space", "a7_redo_reach"],
    "explain-lag": ["causes"],
    "offsets": ["k7_resume_points", "r5_r6_position_plans"],
    "resnapshot": ["r3_redo_coverage", "s7_snapshot_strategy"],
    "transactions": ["journaled", "t3_top_open_transactions", "j13_k14_orphans"],
    "journal": ["chunks", "state"],
    "verify": ["r7_verdict", "j4_state_diff", "a8_transaction_invariants"],
    "workload": ["r11_workload_ledger"],
    "soak": ["a15_soak_metrics", "r10_alerts"],
}


def _planned(given: argparse.Namespace) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Reports of a stored position: a new snapshot of tables, or a target for it."""
    named = [t for t in given.tables.split(",") if t.strip()]

    def snapshot(spark: SparkSession, data: str) -> DataFrame:
        columns = dq.CATALOG.read(spark, data).select("tab").distinct()
        return doctor.resnapshot_plan(_logs(spark, data), columns, given.position, named, given.skip_unlisted)

    def move(spark: SparkSession, data: str) -> DataFrame:
        targets = spark.createDataFrame([(given.target,)], "target long")
        return doctor.position_plans(_logs(spark, data), targets, given.position, given.allow_skip)

    if given.command == "resnapshot":
        return {"snapshot": snapshot}
    if given.command == "offsets" and given.target is not None:
        return {"move": move}
    return {}


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidelog")
    parser.add_argument("command", choices=["list", "query", "options", *REPORTS])
    parser.add_argument("names", nargs="*")
    parser.add_argument("--data")
    parser.add_argument("--position", type=int, help="stored position, of resnapshot and offsets")
    parser.add_argument("--tables", default="", help="tables of a new snapshot, comma-separated")
    parser.add_argument("--skip-unlisted", action="store_true", help="tables that are not named may lose a gap's changes")
    parser.add_argument("--target", type=int, help="position that offsets would move to")
    parser.add_argument("--allow-skip", action="store_true", help="a move forward may skip changes")
    parser.add_argument("--rows", type=int, default=20, help="rows shown of each result")
    given = parser.parse_args(args)
    if given.command == "list":
        print(*QUERIES, sep="\n")
        return 0
    if given.command == "options":
        print(Options.of(dict(x.split("=", 1) for x in given.names)))
        return 0
    known = OVER_TABLES | (_planned(given) if given.position is not None else {})
    names = given.names if given.command == "query" else [n for n in known if n not in OVER_TABLES] or REPORTS[given.command]
    if not given.data or not names:
        parser.error("--data and a query name are needed")
    spark = SparkSession.builder.appName("tidelog").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    lacking = 0
    for name in names:
        print(f"-- {name}")
        run = QUERIES[name] if given.command == "query" else (known | QUERIES)[name]
        try:
            run(spark, given.data).show(given.rows, truncate=False)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            print(f"needs {error.getMessageParameters()['path']}")
            lacking = 1
    return lacking


if __name__ == "__main__":
    raise SystemExit(main())
