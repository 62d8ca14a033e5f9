"""The incremental query-log job over real files."""

import json
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from logweir.fixed_values import QUERY_LOG_DIRECTORIES, QUERY_LOG_FIELDS
from logweir.plans.query_log import (
    QueryLogJob,
    load_checkpoint,
    read_query_log,
    run_query_log_etl,
    save_checkpoint,
)
from logweir.schemas import INGEST_CHECKPOINT, QUERY_LOG_OUT
from logweir.sinks.tables import replace_table

def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def line(ts, first="srv", n=24):
    return json.dumps({"@timestamp": ts, "log": "\t".join([first] + [f"v{i}" for i in range(1, n)])})


class Logs:
    def __init__(self, spark, folder, **job):
        self.spark, self.base = spark, Path(folder) / "in"
        self.job = QueryLogJob(
            source=str(self.base),
            table=f"{folder}/out/queries",
            checkpoint=f"{folder}/out/mark",
            quarantine=f"{folder}/out/bad",
            tenant="t1",
            first_day=date(2024, 1, 1),
            **job,
        )

    def add(self, directory, day, *lines):
        path = self.base / directory / (QUERY_LOG_DIRECTORIES[directory] + day)
        path.parent.mkdir(parents=True, exist_ok=True)
        with open(path, "a") as out:
            out.writelines(text + "\n" for text in lines)

    def run(self, last=date(2024, 1, 31), job=None):
        return run_query_log_etl(self.spark, job or self.job, last, now())

    def names(self):
        return sorted(row[0] for row in read_query_log(self.spark, self.job).select("ServerName").collect())

    def bad(self):
        return self.spark.read.parquet(self.job.quarantine)


@pytest.fixture
def logs(spark, folder):
    return Logs(spark, folder)


def test_no_file_is_empty(logs):
    assert logs.run().status == "EMPTY"
    assert load_checkpoint(logs.spark, logs.job.checkpoint) == (None, None)


def test_first_run_has_the_output_schema(logs):
    logs.add("AVDP1", "01022024", line("2024-01-02T10:00:00.123Z", "a"), line("2024-01-02T10:00:00.123Z", "a"))
    logs.add("AVDP2", "01032024", line("2024-01-03T11:00:00Z", "b"))
    result = logs.run()
    assert (result.status, result.n_rows, result.file_date) == ("OK", 3, "20240103")
    assert result.last_timegenerated == datetime(2024, 1, 3, 11, tzinfo=timezone.utc)
    table = read_query_log(logs.spark, logs.job)
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in QUERY_LOG_OUT]
    row = table.where("ServerName = 'a'").first()
    assert row.MetadataLogDate == 20240102100000123
    assert row.TimeGenerated == "2024-02-01 00:00:00"
    assert row.MetadataLogFileName.endswith("/AVDP1/dev_azure_vdp1-queries.log.01022024")
    assert (row.WebServiceName, row.TenantId, len(row.MetadataLogId)) == ("v23", "t1", 128)
    assert (row.MetadataLogType, row.Type) == ("logm.denodo.queries", "LOGM_DENODO_QUERIES_CL")


def test_content_id_is_the_hash_of_the_whole_row(logs):
    import hashlib

    logs.add("AVDP1", "01022024", line("2024-01-02T10:00:00.5Z", "a"))
    logs.run()
    row = read_query_log(logs.spark, logs.job).first()
    body = {"TimeGenerated": "2024-01-02T10:00:00.500Z"}
    body |= {name: row[name] for name in QUERY_LOG_FIELDS}
    body["input_file_path"] = row.MetadataLogFileName
    text = json.dumps(body, separators=(",", ":"))
    assert row.MetadataLogId == hashlib.sha512(text.encode()).hexdigest()


def test_only_rows_above_the_mark(logs):
    logs.add("AVDP1", "01022024", line("2024-01-02T10:00:00Z", "a"), line("2024-01-02T11:00:00Z", "b"))
    logs.run()
    assert logs.run().status == "EMPTY"
    logs.add("AVDP1", "01022024", line("2024-01-02T11:00:00Z", "same time"), line("2024-01-02T12:00:00Z", "c"))
    logs.add("AVDP2", "01032024", line("2024-01-03T00:00:00Z", "d"))
    assert logs.run().n_rows == 2
    assert logs.names() == ["a", "b", "c", "d"]
    assert logs.run().status == "EMPTY"
    assert logs.names() == ["a", "b", "c", "d"]


def test_two_runs_equal_one(spark, folder):
    split, whole = Logs(spark, f"{folder}/a"), Logs(spark, f"{folder}/b")
    for day in range(1, 6):
        lines = [line(f"2024-01-0{day}T0{hour}:00:00Z", f"{day}-{hour}") for hour in range(5)]
        for logs in (split, whole):
            logs.add("AVDP1", f"010{day}2024", *lines[:3])
            logs.add("AVDP2", f"010{day}2024", *lines[3:])
    split.run(date(2024, 1, 2))
    split.run(date(2024, 1, 5))
    whole.run()
    assert split.names() == whole.names() and len(whole.names()) == 25


def test_run_that_died_before_its_checkpoint(logs):
    """Rows are stored but the mark is not moved: the next run must not store them again."""
    logs.add("AVDP1", "01022024", line("2024-01-02T10:00:00Z", "a"), line("2024-01-02T10:00:00Z", "a"))
    logs.run()
    logs.add("AVDP1", "01032024", line("2024-01-03T10:00:00Z", "b"), line("2024-01-03T10:00:00Z", "b"))
    before = load_checkpoint(logs.spark, logs.job.checkpoint)
    logs.run()
    save_checkpoint(logs.spark, logs.job.checkpoint, "20240102", before[1])
    logs.add("AVDP1", "01042024", line("2024-01-04T10:00:00Z", "c"))
    assert logs.run().n_rows == 3
    assert logs.names() == ["a", "a", "b", "b", "c"]


def test_unusable_lines_go_to_quarantine_once(logs):
    bad = ["{broken", '{"@timestamp":"soon","log":"x"}', '{"log":"y"}', '{"@timestamp":null,"log":"z"}']
    logs.add("AVDP1", "01022024", line("2024-01-02T10:00:00Z", "a"), *bad, "{broken")
    result = logs.run()
    assert (result.n_rows, result.n_unusable) == (1, 5)
    logs.add("AVDP1", "01022024", line("2024-01-02T11:00:00Z", "b"), "{new")
    result = logs.run()
    assert (result.n_rows, result.n_unusable) == (1, 6)
    raw = sorted(row.raw for row in logs.bad().collect())
    assert raw == sorted([*bad[:2], '{"log":"y"}', '{"log":"z"}', "{broken", "{new"])
    reasons = {row.raw: row.reason for row in logs.bad().collect()}
    assert reasons['{"log":"y"}'] == "no event time" and reasons["{broken"] == "unreadable"
    assert logs.names() == ["a", "b"]


def test_only_unusable_lines(logs):
    logs.add("AVDP1", "01022024", "{broken")
    assert (logs.run().status, logs.run().n_unusable) == ("EMPTY", 1)
    assert logs.bad().count() == 1
    assert read_query_log(logs.spark, logs.job).count() == 0


def test_short_long_and_missing_lines(logs):
    logs.add(
        "AVDP1",
        "01022024",
        line("2024-01-02T10:00:00Z", "short", 3),
        line("2024-01-02T10:00:00Z", "long", 26),
        '{"@timestamp":"2024-01-02T10:00:00Z","log":""}',
        '{"@timestamp":"2024-01-02T10:00:00Z"}',
    )
    logs.run()
    rows = {row.ServerName: row for row in read_query_log(logs.spark, logs.job).collect()}
    assert rows["short"].Port == "v2" and rows["short"].Id_ is None
    assert rows["long"].WebServiceName == "v23"
    assert rows[""].Host is None and rows[None].Host is None


def test_exact_fields_quarantines_shifted_lines(spark, folder):
    logs = Logs(spark, folder, exact_fields=True)
    logs.add("AVDP1", "01022024", line("2024-01-02T10:00:00Z", "ok"), line("2024-01-02T10:00:00Z", "x", 25))
    assert logs.run().n_unusable == 1
    assert logs.names() == ["ok"] and logs.bad().first().reason == "field count"


def test_missing_days_and_directories_are_skipped(logs):
    logs.add("AVDP2", "01052024", line("2024-01-05T10:00:00Z", "a"))
    assert logs.run().n_rows == 1


def test_day_given_as_a_folder_of_parts(spark, folder):
    logs = Logs(
        spark,
        folder,
        layout="server={directory}/day={day}",
        day_pattern=r"/day=(\d{8})/",
    )
    parts = logs.base / "server=AVDP1" / "day=01022024"
    parts.mkdir(parents=True)
    for at in range(3):
        (parts / f"part-{at}.json").write_text(line("2024-01-02T10:00:00Z", f"p{at}") + "\n")
    assert logs.run().file_date == "20240102"
    assert logs.names() == ["p0", "p1", "p2"]


def test_late_rows_within_the_allowance(spark, folder):
    logs = Logs(spark, folder, allowed_lateness=timedelta(hours=3))
    logs.add("AVDP1", "01022024", line("2024-01-02T10:00:00Z", "a"), line("2024-01-02T12:00:00Z", "b"))
    logs.run()
    logs.add(
        "AVDP1",
        "01022024",
        line("2024-01-02T08:00:00Z", "too late"),
        line("2024-01-02T11:00:00Z", "late"),
        line("2024-01-02T12:00:00Z", "tied"),
    )
    assert logs.run().n_rows == 2
    assert logs.names() == ["a", "b", "late", "tied"]
    logs.add("AVDP1", "01022024", line("2024-01-02T13:00:00Z", "c"))
    logs.run()
    assert logs.names() == ["a", "b", "c", "late", "tied"]
    logs.run()
    assert logs.names() == ["a", "b", "c", "late", "tied"]


@pytest.mark.parametrize("forced", [False, True])
def test_late_rows_stay_when_later_runs_find_nothing(spark, folder, forced, monkeypatch):
    """Run 2 stores late rows only, so the mark stays while the files read again move on."""
    if forced:  # the look-up by shuffle, on whole enveloped rows
        monkeypatch.setattr("logweir.operators.joins.fits_broadcast", lambda *a, **k: False)
    logs = Logs(spark, folder, allowed_lateness=timedelta(days=1))
    logs.add("AVDP1", "01102024", line("2024-01-10T12:00:00Z", "a"))
    logs.run()
    logs.add("AVDP1", "01092024", line("2024-01-09T20:00:00Z", "late"))
    logs.add("AVDP1", "01112024", line("2024-01-10T11:00:00Z", "other"))
    assert logs.run().n_rows == 2
    for path in logs.base.rglob("*01092024"):
        path.write_text("")  # the source rotates
    for _ in range(2):
        logs.run()
        assert logs.names() == ["a", "late", "other"]


def test_jobs_run_in_utc(spark, folder):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        logs = Logs(spark, folder)
        logs.add("AVDP1", "01022024", line("2024-01-02T02:00:00Z", "a"))
        logs.run()
        row = read_query_log(spark, logs.job).first()
        assert str(row.MetadataLogDate).startswith("2024010202")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dense_ids(spark, folder):
    logs = Logs(spark, folder, guid="dense")
    for day in range(1, 9):
        logs.add("AVDP1", f"010{day}2024", *[line(f"2024-01-0{day}T10:0{i}:00Z", "a") for i in range(5)])
    logs.run()
    ids = [row[0] for row in read_query_log(spark, logs.job).select("MetadataLogGuid").collect()]
    assert len(set(ids)) == 40 and {i % 10**9 for i in ids} == {0}
    assert min(ids) // 10**9 == 2401011000


def test_dense_ids_do_not_repeat_over_runs(spark, folder):
    logs = Logs(spark, folder, guid="dense", allowed_lateness=timedelta(hours=1))
    minute = "2024-01-10T12:00:"
    logs.add("AVDP1", "01102024", *[line(f"{minute}{at:02}Z", f"a{at}") for at in (10, 20, 30)])
    assert logs.run().n_rows == 3
    logs.add("AVDP1", "01102024", line(f"{minute}05Z", "late"), line(f"{minute}40Z", "new"), "{broken")
    result = logs.run()
    assert (result.n_rows, result.n_unusable) == (2, 1)
    ids = [row[0] for row in read_query_log(spark, logs.job).select("MetadataLogGuid").collect()]
    assert sorted(ids) == [2401101200000000000 + at for at in range(5)]


def test_checkpoint_states(spark, folder):
    path = f"{folder}/mark"
    replace_table(spark.createDataFrame([], INGEST_CHECKPOINT), path)
    assert load_checkpoint(spark, path) == (None, None)
    mark = datetime(2024, 5, 1, 1, 2, 3, 4, tzinfo=timezone.utc)
    save_checkpoint(spark, path, None, mark)
    assert load_checkpoint(spark, path) == (None, mark)
    save_checkpoint(spark, path, "20240501", mark)
    assert load_checkpoint(spark, path) == (date(2024, 5, 1), mark)


def test_checkpoint_in_the_future_reads_nothing(logs):
    logs.add("AVDP1", "01022024", line("2024-01-02T10:00:00Z"))
    save_checkpoint(logs.spark, logs.job.checkpoint, "20300101", datetime(2030, 1, 1, tzinfo=timezone.utc))
    assert logs.run().status == "EMPTY"


# ---- files as a stream ----


def start(logs, **limits):
    from logweir.plans import run_query_log_stream

    query = run_query_log_stream(logs.spark, logs.job, limits=limits, now=now())
    query.awaitTermination()
    return query


def stored(logs, job=None):
    rows = read_query_log(logs.spark, job or logs.job).collect()
    return sorted(((r.ServerName, r.MetadataLogTimeGenerated, r.MetadataLogId, r.MetadataLogFileName) for r in rows), key=repr)


def test_stream_of_files_equals_the_batch_job(logs, folder):
    from dataclasses import replace

    for day in range(2, 6):
        for server in ("AVDP1", "AVDP2"):
            logs.add(server, f"010{day}2024", line(f"2024-01-0{day}T10:00:00Z", f"{server}-{day}"), "{broken", line(None, "x"))
    start(logs, maxFilesPerTrigger=3)
    batch = replace(logs.job, table=f"{folder}/b", checkpoint=f"{folder}/bm", quarantine=f"{folder}/bq")
    from logweir.plans import run_query_log_etl

    run_query_log_etl(logs.spark, batch, date(2024, 1, 5), now())
    assert stored(logs) == stored(logs, batch) and len(stored(logs)) == 8
    bad = [sorted((r.raw, r.reason, r.MetadataLogFileName) for r in logs.spark.read.parquet(q).collect()) for q in (logs.job.quarantine, batch.quarantine)]
    assert bad[0] == bad[1] and len(bad[0]) == 16


def test_a_file_added_to_an_old_day_is_taken(logs):
    logs.add("AVDP1", "01052024", line("2024-01-05T10:00:00Z", "new"))
    assert start(logs).lastProgress.numInputRows == 1
    logs.add("AVDP2", "01022024", line("2024-01-02T09:00:00Z", "old"))
    assert start(logs).lastProgress.numInputRows == 1
    start(logs)
    assert [r[0] for r in stored(logs)] == ["new", "old"]
    assert {r.log_day.isoformat() for r in logs.spark.read.parquet(logs.job.table).select("log_day").collect()} == {"2024-01-05", "2024-01-02"}


def test_stream_of_files_gives_stable_ids_only(logs):
    from dataclasses import replace

    from logweir.plans import run_query_log_stream

    with pytest.raises(ValueError, match="stable row ids"):
        run_query_log_stream(logs.spark, replace(logs.job, guid="dense"))


def test_late_runs_parse_files_once_and_leave_no_work_folder(spark, folder, monkeypatch):
    import logweir.plans.query_log as plan

    logs = Logs(spark, folder, allowed_lateness=timedelta(days=2))
    logs.add("AVDP1", "01022024", line("2024-01-02T10:00:00Z", "a"), "{broken")
    logs.run()
    logs.add("AVDP2", "01022024", line("2024-01-02T09:00:00Z", "late"), "{also")
    reads, folders, read, make = [], [], plan.read_json_logs, plan.work_folder
    monkeypatch.setattr(plan, "read_json_logs", lambda *a: reads.append(a) or read(*a))
    monkeypatch.setattr(plan, "work_folder", lambda *a: folders.append(make(*a)) or folders[-1])
    result = logs.run()
    assert (result.status, result.n_rows, result.n_unusable) == ("OK", 1, 2)
    assert len(reads) == 1 and len(folders) == 1
    import os

    assert not os.path.exists(folders[0])
    assert sorted(r.raw for r in spark.read.parquet(logs.job.quarantine).collect()) == ["{also", "{broken"]
    assert [r[0] for r in stored(logs)] == ["a", "late"]


def test_a_late_run_makes_rows_of_new_lines_only(spark, folder, monkeypatch):
    """Lines that are stored already, or twice in the files, are told by their ids."""
    import logweir.plans.query_log as plan

    logs = Logs(spark, folder, allowed_lateness=timedelta(days=2))
    old = [line(f"2024-01-02T10:0{at}:00Z", f"a{at}") for at in range(5)]
    logs.add("AVDP1", "01022024", *old, "{broken")
    logs.run()
    late = line("2024-01-02T09:00:00Z", "late")
    logs.add("AVDP2", "01022024", late, late, line("2024-01-02T11:00:00Z", "new"))
    made, output = [], plan._output
    monkeypatch.setattr(plan, "_output", lambda lines, *a: made.append(lines.count()) or output(lines, *a))
    assert logs.run().n_rows == 3
    assert logs.run().n_rows == 0
    assert made == [3, 0]
    assert [r[0] for r in stored(logs)] == ["a0", "a1", "a2", "a3", "a4", "late", "late", "new"]
