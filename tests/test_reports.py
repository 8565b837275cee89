"""Reports over a user's own tables, plans of positions, and operational events."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidelog.__main__ import main
from tidelog.operators import doctor, ops
from tidelog.plans import doctor_queries as dq
from tidelog.plans import replay_queries as rq

def logs(spark, rows):
    some = spark.createDataFrame(rows, "thread long, seq long, first_scn long, next_scn long, deleted boolean")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return some.select("thread", "seq", "first_scn", "next_scn", F.lit(1).cast("long").alias("bytes"), at.alias("first_time"), at.alias("next_time"), "deleted")


def plain_first(rows, position):
    """The least of the position and the starts of present logs from which each thread's logs are all there."""
    def whole(p):
        for thread in {r[0] for r in rows}:
            own = sorted(r for r in rows if r[0] == thread and r[3] > p)
            if not own or any(r[4] for r in own) or own[0][2] > p or any(b[1] - a[1] > 1 for a, b in zip(own, own[1:], strict=False)):
                return False
        return True

    return min((p for p in {position, *(r[2] for r in rows if not r[4] and r[2] >= position)} if whole(p)), default=None)


END = 1000
CASES = {
    "whole": [(1, 1, 10, 20, False), (1, 2, 20, END, False)],
    "purged": [(1, 1, 10, 20, True), (1, 2, 20, 30, False), (1, 3, 30, END, False), (2, 1, 10, 25, False), (2, 2, 25, END, False)],
    "hole": [(1, 1, 10, 20, False), (1, 3, 30, 40, False), (1, 4, 40, END, False), (2, 1, 10, END, False)],
    "last purged": [(1, 1, 10, 20, False), (1, 2, 20, END, True)],
    "late thread": [(1, 1, 10, END, False), (2, 5, 50, END, False)],
}


@pytest.mark.parametrize("case", CASES)
def test_first_available(spark, case):
    for position in (5, 10, 15, 30):
        assert doctor.first_available(logs(spark, CASES[case]), position).collect() == [(position, plain_first(CASES[case], position))]


def test_no_logs_have_no_start(spark):
    assert doctor.first_available(logs(spark, []), 5).collect() == [(5, None)]


def test_resnapshot_and_moves_over_tables(spark, tmp_path, capsys):
    logs(spark, CASES["purged"]).write.parquet(f"{tmp_path}/logs.parquet")
    dq.CATALOG.df(spark).write.parquet(f"{tmp_path}/catalog.parquet")
    shown = lambda *a: (main([*a, "--data", str(tmp_path)]), capsys.readouterr().out)
    assert "refused: unlisted tables" in shown("resnapshot", "--position", "12", "--tables", "t1")[1]
    assert "signal and move" in shown("resnapshot", "--position", "12", "--tables", "t1", "--skip-unlisted")[1]
    assert "refused: not captured" in shown("resnapshot", "--position", "12", "--tables", "other")[1]
    assert "|signal|" in shown("resnapshot", "--position", "27", "--tables", "T1")[1]
    assert "needs allow-skip" in shown("offsets", "--position", "12", "--target", "25")[1]
    assert "|ok" in shown("offsets", "--position", "12", "--target", "25", "--allow-skip")[1]


def test_reports_follow_the_tables(spark, tmp_path, capsys):
    data = str(tmp_path)
    assert main(["check", "--data", data]) == 1 and "needs" in capsys.readouterr().out
    logs(spark, CASES["whole"]).write.parquet(f"{data}/logs.parquet")
    for table in (dq.CATALOG, dq.GRANTS, dq.TOPICS):
        table.df(spark).limit(0).write.parquet(f"{data}/{table.name}.parquet")
    settings = spark.createDataFrame([("archive_mode", 0), ("version", 21)], "name string, value long")
    settings.write.parquet(f"{data}/settings.parquet")
    assert main(["check", "--data", data]) == 0
    out = capsys.readouterr().out
    assert "DOC-1|" in out and "DOC-15" not in out
    dq.LAGS.df(spark).where("id = 2").drop("causes").write.parquet(f"{data}/lags.parquet")
    assert main(["explain-lag", "--data", data]) == 0
    out = capsys.readouterr().out
    assert "KAFKA" in out and "MINING" not in out
    spark.createDataFrame([("c", 1, 1, 1, 9, 90)], rq.JOURNAL.schema).write.parquet(f"{data}/journal.parquet")
    assert main(["journal", "--data", data]) == 0
    out = capsys.readouterr().out
    assert "|c " in out and "|a " not in out


def test_event_records(spark):
    row = spark.range(1)
    got = ops.records(row, "ddl-seen", "db", F.lit(1234), F.lit(5000), owner=F.lit("APP"), sql=F.lit(None)).first()
    assert got == (1, "ddl-seen", 1234, "db", 5000, {"owner": "APP"})
    long = ops.records(row, "ddl-seen", "db", F.lit(1), F.lit(None), sql=F.repeat(F.lit("x"), 3000)).first()
    assert long.resume_scn is None and len(long.details["sql"]) == 2000
    assert ops.records(row, "startup", "db", F.lit(1), F.lit(None)).first().details == {}
    for kind, details in (("position-committed", {}), ("dance", {}), ("table-removed", {"owner": F.lit("x")})):
        with pytest.raises(ValueError):
            ops.records(row, kind, "db", F.lit(1), F.lit(None), **details)
