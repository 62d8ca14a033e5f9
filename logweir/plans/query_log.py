"""Incremental query-log job: new lines since the checkpoint into the query-log table.

One pass over the files does it all. Counting unusable lines, filtering on the mark, splitting,
the envelope, the write, and the next checkpoint's two maxima are one plan. The maxima are
observed on the rows being written, so the checkpoint cannot run ahead of the table. Only when
unusable lines were seen is there a second pass, over the days that had them. With lateness the
lines that a run can need are parsed into a work folder first, and all else reads them there. Those
below the mark have their content id there; only the ones whose id is new become rows.

`run_query_log_stream` takes files as a stream instead of days, into the same table.
"""

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone
from math import ceil

from pyspark.sql import Observation
from pyspark.sql import functions as F

from logweir.fixed_values import (
    FILE_DAY_FORMAT,
    FILE_DAY_PATTERN,
    QUERY_LOG_DIRECTORIES,
    QUERY_LOG_FIELDS,
    QUERY_LOG_LAYOUT,
    QUERY_LOG_TYPE,
    QUERY_TABLE_TYPE,
)
from logweir.functions import canonical_body, content_id, field_count, file_day
from logweir.operators.envelope import envelope, with_dense_guid
from logweir.operators.joins import bounded_join
from logweir.operators.parse import parse_query_log
from logweir.operators.watermark import latest_checkpoint, next_checkpoint_columns, since, unseen
from logweir.schemas import CORRUPT, INGEST_CHECKPOINT, QUERY_LOG_OUT, QUERY_LOG_QUARANTINE
from logweir.session import pin_utc, work_folder
from logweir.sinks.streams import default_checkpoint, stream_tables
from logweir.sinks.tables import published_number, replace_table, write_run
from logweir.sources.files import (
    candidate_files,
    existing_paths,
    read_json_logs,
    stream_json_logs,
)
from logweir.sources.folders import remove
from logweir.sources.tables import read_table, table_exists

TIME = "@timestamp"
PATH = "input_file_path"
LINE_ID = "line_id"
#: What a line's content id is made of.
CONTENT = ["TimeGenerated", *QUERY_LOG_FIELDS, PATH]
DAY = timedelta(days=1)


@dataclass(frozen=True)
class QueryLogJob:
    """Where the logs are, where they go and how they are tagged.

    `first_day` is where a run without a checkpoint starts. `layout` and the two day settings say
    how a day's file or folder is named. With `exact_fields` a line with another number of
    fields than expected is unusable. `allowed_lateness` also takes lines up to that far below
    the mark whose content is not in the table yet.
    """

    source: str
    table: str
    checkpoint: str
    tenant: str
    first_day: date
    quarantine: str = None
    directories: dict = field(default_factory=lambda: dict(QUERY_LOG_DIRECTORIES))
    layout: str = QUERY_LOG_LAYOUT
    day_format: str = FILE_DAY_FORMAT
    day_pattern: str = FILE_DAY_PATTERN
    exact_fields: bool = False
    allowed_lateness: timedelta = timedelta(0)
    guid: str = "stable"
    bits: int = 512
    fmt: str = "parquet"

    def day_of(self, path):
        return file_day(path, self.day_pattern, self.day_format)


@dataclass(frozen=True)
class RunResult:
    """What a run did. Status is EMPTY when there was no file or no new line."""

    status: str
    n_rows: int = 0
    n_unusable: int = 0
    file_date: str = None
    last_timegenerated: datetime = None


EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _moment(micros):
    """Times cross to the driver as microseconds, so the host's zone plays no part."""
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def _day(text):
    return date.fromisoformat(text) if text else None


def load_checkpoint(spark, path, fmt="parquet"):
    """(file day, last event time), or (None, None) when the table is absent or empty."""
    if not table_exists(spark, path, fmt):
        return None, None
    newest = latest_checkpoint(read_table(spark, path, fmt, INGEST_CHECKPOINT))
    row = newest.select("day", F.unix_micros("last_timegenerated").alias("micros")).first()
    return (None, None) if row is None else (row.day, _moment(row.micros))


def save_checkpoint(spark, path, file_date, last_timegenerated, fmt="parquet", number=0):
    """Replace the checkpoint by this one row. `number` tells checkpoints with one mark apart."""
    values = (file_date, last_timegenerated)
    row = spark.range(0, 1, 1, 1).select(
        *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, INGEST_CHECKPOINT)]
    )
    replace_table(row, path, fmt, token=str(number))


def read_query_log(spark, job):
    """The query-log table, without the columns that only organise its files."""
    rows = read_table(spark, job.table, job.fmt, _stored(QUERY_LOG_OUT, "log_day date"))
    return rows.select(*QUERY_LOG_OUT.names)


def _stored(schema, *partitions):
    for name, kind in [part.split() for part in ("ingest_run string", *partitions)]:
        schema = type(schema)(list(schema.fields)).add(name, kind)
    return schema


def _paths(spark, job, first, last):
    """Existing files of the days from first to last: at most days times directories."""
    days = spark.range(0, 1, 1, 1).select(
        F.lit(first).alias("first_day"), F.lit(last).alias("last_day")
    )
    grid = candidate_files(days, job.source, job.directories, job.layout, job.day_format)
    return existing_paths(spark, [row.path for row in grid.select("path").collect()])


def _unusable(job):
    """Why a line cannot be used; NULL when it can."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "unreadable").when(
        F.col(TIME).isNull(), "no event time"
    )
    if job.exact_fields:
        reason = reason.when(field_count(F.col("log")) != len(QUERY_LOG_FIELDS), "field count")
    return reason


def _output(lines, job, now):
    """Usable lines as output rows with the day they are stored under."""
    parsed = parse_query_log(
        lines.select(F.col(TIME).alias("TimeGenerated"), "log", PATH), keep=["TimeGenerated", PATH]
    )
    rows = envelope(
        parsed.select(*CONTENT),
        time="TimeGenerated",
        source=PATH,
        tenant=job.tenant,
        log_type=QUERY_LOG_TYPE,
        table_type=QUERY_TABLE_TYPE,
        now=now,
        bits=job.bits,
    )
    return rows.withColumn("log_day", F.to_date("MetadataLogTimeGenerated"))


def _numbered(spark, rows, job, mark, run_id):
    """The run's rows, late ones among them, with dense ids that no other run has given. All of
    them lie above the lower end of the lateness window, so only stored days from there on count."""
    if not mark or not table_exists(spark, job.table, job.fmt):
        return with_dense_guid(rows)
    floor = (mark - job.allowed_lateness).date()
    stored = read_table(spark, job.table, job.fmt, _stored(QUERY_LOG_OUT, "log_day date"))
    others = stored.where((F.col("ingest_run") != run_id) & (F.col("log_day") >= F.lit(floor)))
    return with_dense_guid(rows, stored=others.select("MetadataLogGuid"))


def _with_line_id(lines, job, late):
    """The lines, with the content id of the `late` ones as bytes."""
    parsed = parse_query_log(
        lines.withColumn("TimeGenerated", F.col(TIME)), keep=[*lines.columns, "TimeGenerated"]
    )
    line_id = F.unhex(content_id(CONTENT, job.bits))
    return parsed.select(*lines.columns, F.when(late, line_id).alias(LINE_ID))


def _late(spark, lines, job, mark, run_id, folder):
    """Of the lines that have an id, those that earlier runs have not stored.

    Ids of lines and of stored rows meet in one grouping, without what they are made of; only the
    new ids are looked up in the lines again."""
    floor = mark - job.allowed_lateness
    stored = read_table(spark, job.table, job.fmt, _stored(QUERY_LOG_OUT, "log_day date"))
    known = stored.where(
        (F.col("ingest_run") != run_id)
        & (F.col("log_day") >= F.lit(floor.date()))
        & (F.col("MetadataLogTimeGenerated") > F.lit(floor))
    )
    late = lines.where(F.col(LINE_ID).isNotNull())
    ids = late.select(LINE_ID, F.lit(True).alias("new")).unionByName(
        known.select(F.unhex("MetadataLogId").alias(LINE_ID), F.lit(False).alias("new"))
    )
    new = ids.groupBy(LINE_ID).agg(F.bool_and("new").alias("new")).where("new").select(LINE_ID)
    new.write.parquet(folder)
    new = spark.read.schema(new.schema).parquet(folder)
    return bounded_join(late, new, [LINE_ID], "left_semi")


def _quarantine_rows(lines, job):
    """Unusable lines as they came, with the reason."""
    raw = F.coalesce(CORRUPT, canonical_body([TIME, "log"]))
    bad = lines.select(raw.alias("raw"), _unusable(job).alias("reason"), PATH)
    bad = bad.where(F.col("reason").isNotNull()).withColumnRenamed(PATH, "MetadataLogFileName")
    return bad.withColumn("content_id", content_id(["MetadataLogFileName", "raw"], job.bits))


def _quarantine(spark, lines, job, run_id, first_bad, last_bad):
    """Store the unusable lines of the days that had some, except those stored before.

    A checkpoint day is read again by the next run, and its unusable lines have no event time to
    tell old from new, so they are compared by file and content.
    """
    day = job.day_of(F.col(PATH))
    in_range = day.isNull()
    if first_bad:
        in_range = in_range | day.between(F.lit(first_bad), F.lit(last_bad))
    # the day is cut out of the paths of unusable lines alone
    rows = _quarantine_rows(lines.where(_unusable(job).isNotNull()).where(in_range), job)
    if table_exists(spark, job.quarantine, job.fmt):
        stored = read_table(spark, job.quarantine, job.fmt, _stored(QUERY_LOG_QUARANTINE))
        known = stored.where(F.col("ingest_run") != run_id)
        if first_bad:
            stored_day = job.day_of(F.col("MetadataLogFileName"))
            known = known.where(
                stored_day.isNull() | stored_day.between(F.lit(first_bad), F.lit(last_bad))
            )
        rows = unseen(rows, known, "content_id")
    write_run(rows, job.quarantine, run_id, job.fmt)


def run_query_log_etl(spark, job, last_day, now=None):
    """Take the lines that are new since the checkpoint, up to the files of `last_day`.

    A run is named after the checkpoint it starts from: its mark, and how often in a row that has
    been saved. If it dies before it saves its own, the next run starts from the same one, has the
    same name and replaces what the first one wrote. A run that stored rows saves a checkpoint even
    if they leave the mark where it was, as late ones do, so no later run has its name.
    """
    pin_utc(spark)
    day, mark = load_checkpoint(spark, job.checkpoint, job.fmt)
    first_day = (day - timedelta(days=ceil(job.allowed_lateness / DAY))) if day else job.first_day
    paths = _paths(spark, job, first_day, last_day)
    if not paths:
        return RunResult("EMPTY")
    number = published_number(spark, job.checkpoint, job.fmt)
    run_id = f"after-{mark:%Y%m%dT%H%M%S%f}-{number}" if mark else "first"

    reason = _unusable(job)
    bad_day = F.when(reason.isNotNull(), job.day_of(F.col(PATH)))
    scanned, written = Observation(), Observation()
    lines = read_json_logs(spark, paths)
    observed = lines.observe(
        scanned,
        F.count(reason).alias("n_unusable"),
        F.min(bad_day).cast("string").alias("first_bad"),
        F.max(bad_day).cast("string").alias("last_bad"),
    )
    folder = None
    if mark and job.allowed_lateness and table_exists(spark, job.table, job.fmt):
        # lines that earlier runs have taken for good need not be kept
        folder = work_folder(spark, "late")
        in_reach = F.col(TIME) > F.lit(mark - job.allowed_lateness)
        late = reason.isNull() & in_reach & (F.col(TIME) <= F.lit(mark))
        needed = _with_line_id(observed.where(reason.isNotNull() | in_reach), job, late)
        needed.write.parquet(f"{folder}/lines")
        lines = spark.read.schema(needed.schema).parquet(f"{folder}/lines")
        late = _late(spark, lines, job, mark, run_id, f"{folder}/ids")
        rows = _output(since(lines.where(reason.isNull()), TIME, mark).unionByName(late), job, now)
    else:
        rows = _output(since(observed.where(reason.isNull()), TIME, mark), job, now)
    try:
        return _stored_run(spark, job, rows, lines, scanned, written, run_id, day, mark, number)
    finally:
        if folder:
            remove(spark, folder)


def _stored_run(spark, job, rows, lines, scanned, written, run_id, day, mark, number):
    """Write a run's rows and unusable lines and save the checkpoint after it."""
    if job.guid == "dense":
        rows = _numbered(spark, rows, job, mark, run_id)
    source_day = job.day_of(F.col("MetadataLogFileName"))
    file_date, last_time = next_checkpoint_columns(day=source_day)
    rows = rows.observe(
        written,
        F.count(F.lit(1)).alias("n_rows"),
        file_date.alias("file_date"),
        F.unix_micros(last_time).alias("micros"),
    )
    write_run(rows, job.table, run_id, job.fmt, ["log_day"])

    seen, stored = scanned.get, written.get
    if seen["n_unusable"] and job.quarantine:
        _quarantine(spark, lines, job, run_id, _day(seen["first_bad"]), _day(seen["last_bad"]))
    if not stored["n_rows"]:
        return RunResult("EMPTY", n_unusable=seen["n_unusable"])
    top = max(filter(None, [_moment(stored["micros"]), mark]))
    days = filter(None, [stored["file_date"], day and f"{day:%Y%m%d}"])
    result = RunResult("OK", stored["n_rows"], seen["n_unusable"], max(days, default=None), top)
    number = number + 1 if top == mark else 0
    save_checkpoint(spark, job.checkpoint, result.file_date, top, job.fmt, number)
    return result


def run_query_log_stream(spark, job, *, checkpoint=None, limits=None, now=None, **trigger):
    """Start a stream over the log files into the job's table; returns the running query.

    Every file of the job's layout is taken once, whatever its day and the times of its lines, as
    the stream's own log of files says; no day grid and no mark is used. `limits` bounds a
    micro-batch, such as {"maxFilesPerTrigger": 1000}. Files must be complete when they appear:
    lines that are added to a file that was taken are not seen, which the batch job is for. A table
    is fed by one of the two. Row ids are the stable ones."""
    if job.guid != "stable" or job.fmt != "parquet":
        raise ValueError("a stream of files gives stable row ids and parquet tables")
    pin_utc(spark)
    layout = job.layout
    for part in ("{directory}", "{prefix}", "{day}"):
        layout = layout.replace(part, "*")
    # "**" would be a folder at any depth
    lines = stream_json_logs(spark, f"{job.source}/{layout.replace('**', '*')}", **(limits or {}))

    def tables(batch):
        usable = batch.where(_unusable(job).isNull())
        found = {job.table: _output(usable, job, now)}
        if job.quarantine:
            found[job.quarantine] = _quarantine_rows(batch, job)
        return found

    checkpoint = checkpoint or default_checkpoint(job.table)
    return stream_tables(lines, tables, checkpoint, partition_by={job.table: ["log_day"]}, **trigger)
