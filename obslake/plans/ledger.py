"""Work ledger and run journal: two append-only tables.

Every action is an appended row and the newest action of a key counts, so
concurrent runs never rewrite each other's state. An action has two times: ``at``, when it was
appended and its output could be read, and ``seen``, when its run began to read. A source that changed
after ``seen`` is not in the output, even if it changed before ``at``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obslake.schemas import JOURNAL, LEDGER
from obslake.session import settle
from obslake.sources import versions
from obslake.sources.readers import read_table
from obslake.sources.sinks import append_rows

DONE, FORGOTTEN = "done", "forgotten"
JOURNAL_RUNS = 20


def run_id(prefix: str = "run") -> str:
    return f"{prefix}-{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    found = read_table(spark, path)
    return spark.createDataFrame([], LEDGER) if found is None else with_seen(found)


def with_seen(ledger: DataFrame) -> DataFrame:
    """Rows without a start of their run count as read when they were appended."""
    seen = F.coalesce("seen", "at") if "seen" in ledger.columns else F.col("at")
    return ledger.withColumn("seen", seen)


def now() -> datetime:
    return datetime.now(timezone.utc)


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    found = read_table(spark, path)
    return spark.createDataFrame([], JOURNAL) if found is None else found


def clean_keys(keys: DataFrame) -> DataFrame:
    """Keys as text, each once, without blank ones."""
    text = keys.select(F.col("key").cast("string").alias("key"))
    return text.where(F.trim("key") != "").distinct()


def _log(
    spark: SparkSession, path: str, stage: str, keys: DataFrame, action: str, run: str,
    seen: datetime | None = None,
) -> None:
    rows = clean_keys(keys).select(
        F.lit(stage).alias("stage"), "key", F.lit(action).alias("action"),
        F.current_timestamp().alias("at"), F.lit(run).alias("run_id"),
        F.coalesce(F.lit(seen).cast("timestamp"), F.current_timestamp()).alias("seen"),
    )
    append_rows(rows, path)


def mark(
    spark: SparkSession, path: str, stage: str, keys: DataFrame, run: str | None = None,
    seen: datetime | None = None,
) -> None:
    """Marks many keys done in one write; ``seen`` is when their run began to read."""
    _log(spark, path, stage, keys, DONE, run or run_id(stage), seen)


def forget(spark: SparkSession, path: str, stage: str, keys: DataFrame) -> None:
    """Makes keys pending again."""
    _log(spark, path, stage, keys, FORGOTTEN, run_id(stage))


def reset(spark: SparkSession, path: str, stage: str) -> None:
    """Makes every key of a stage pending again."""
    forget(spark, path, stage, settle(done_keys(read_ledger(spark, path), stage)))


def state(ledger: DataFrame) -> DataFrame:
    """Newest action of each key."""
    return _newest(ledger).drop("seen")


def _newest(ledger: DataFrame) -> DataFrame:
    newest = F.max(F.struct("at", "action", "run_id", "seen"))
    latest = with_seen(ledger).groupBy("stage", "key").agg(newest.alias("s"))
    return latest.select("stage", "key", "s.action", "s.at", "s.run_id", "s.seen")


def _done(ledger: DataFrame, stage: str | None) -> DataFrame:
    rows = ledger if stage is None else ledger.where(F.col("stage") == stage)
    return _newest(rows).where(F.col("action") == DONE)


def done_keys(ledger: DataFrame, stage: str | None = None) -> DataFrame:
    return _done(ledger, stage).drop("seen")


def compacted(ledger: DataFrame) -> DataFrame:
    """The ledger with the newest action of each key only; its state is the same."""
    return _newest(ledger).select(*LEDGER.fieldNames())


def compact(spark: SparkSession, path: str, most: int = 1) -> int:
    """Rewrites a versioned ledger of more than ``most`` commits as its state; returns the commits replaced."""
    return versions.compact(spark, path, most=most, transform=compacted)


def is_done(ledger: DataFrame, stage: str, key: str) -> bool:
    return not done_keys(ledger, stage).where(F.col("key") == key).isEmpty()


def pending(
    keys: DataFrame, ledger: DataFrame, stage: str, changed_at: DataFrame | None = None
) -> DataFrame:
    """Keys without a ledger row, or whose source changed after that row's run began to read."""
    done = _done(ledger, stage).select("key", "seen")
    if changed_at is not None:
        fresh = done.join(changed_at, "key", "left")
        done = fresh.where(F.col("changed_at").isNull() | (F.col("changed_at") <= F.col("seen")))
    return keys.join(done.select("key"), "key", "left_anti")


def changes(ledger: DataFrame, stage: str) -> DataFrame:
    """When each key of a stage was last done: what its next stage has to follow."""
    return done_keys(ledger, stage).select("key", F.col("at").alias("changed_at"))


def feed_changes(ledger: DataFrame) -> DataFrame:
    """When an hour (``year/month/day/hour``) of each year last arrived from the live feed."""
    hours = changes(ledger, "stream").withColumn("key", F.regexp_extract("key", r"^(\d{4})/", 1))
    return hours.where("key <> ''").groupBy("key").agg(F.max("changed_at").alias("changed_at"))


def work_key(table: str, partition: Column) -> Column:
    """Key of a partition within a table."""
    return F.concat_ws(":", F.lit(table), partition.cast("string"))


def record_run(
    spark: SparkSession, path: str, stage: str, run: str, status: str, counters: dict[str, int]
) -> None:
    known = {k: int(v) for k, v in counters.items() if v is not None}
    row = [(stage, run, status, datetime.now(timezone.utc), known)]
    append_rows(spark.createDataFrame(row, JOURNAL), path)


@contextmanager
def journaled(spark: SparkSession, path: str | None, stage: str) -> Iterator[dict[str, int]]:
    """Records the run of a job, failed or not, with the counters that it fills in."""
    run, counters = run_id(stage), {}
    try:
        yield counters
    except BaseException:
        if path:
            record_run(spark, path, stage, run, "failed", counters)
        raise
    if path:
        record_run(spark, path, stage, run, "success", counters)


def recent_runs(journal: DataFrame, runs: int = JOURNAL_RUNS) -> DataFrame:
    """The newest runs of each stage; Spark prunes the rest before the shuffle."""
    newest = Window.partitionBy("stage").orderBy(F.desc("at"), F.desc("run_id"))
    return journal.withColumn("n", F.row_number().over(newest)).where(F.col("n") <= runs).drop("n")


def summary(ledger: DataFrame, journal: DataFrame) -> DataFrame:
    """Units done, last run, its status and the number of kept runs of each stage."""
    units = done_keys(ledger).groupBy("stage").agg(
        F.count("key").alias("done"), F.max("at").alias("marked_at")
    )
    last = F.max_by(F.struct("run_id", "status"), F.struct("at", "run_id"))
    runs = journal.groupBy("stage").agg(
        last.alias("r"), F.max("at").alias("ran_at"), F.count(F.lit(1)).alias("n_runs")
    )
    return units.join(runs, "stage", "full_outer").select(
        "stage",
        F.coalesce("done", F.lit(0)).alias("done"),
        F.coalesce("r.run_id", F.lit("-")).alias("last_run"),
        F.coalesce("r.status", F.lit("-")).alias("last_status"),
        F.least(F.coalesce("n_runs", F.lit(0)), F.lit(JOURNAL_RUNS)).alias("runs"),
        F.greatest("marked_at", "ran_at").alias("updated_at"),
    )


def summary_lines(stages: DataFrame) -> DataFrame:
    """The summary as aligned text lines."""
    # Column widths of the text report.
    line = F.format_string(
        "%-20s %7d %-22s %-10s %s", "stage", "done", "last_run", "last_status",
        F.coalesce(F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ssXXX"), F.lit("-")),
    )
    return stages.select("stage", line.alias("line"))


def import_legacy(ledger: DataFrame, legacy: DataFrame, stage: str = "bronze") -> DataFrame:
    """Rows to append from an old ``{"batches": [...]}`` document when the stage has none."""
    keys = legacy.select(F.explode("batches").alias("key"))
    known = ledger.where(F.col("stage") == stage).agg(F.count(F.lit(1)).alias("n"))
    return clean_keys(keys).where(known.scalar() == 0).select(
        F.lit(stage).alias("stage"), "key", F.lit(DONE).alias("action"),
        F.current_timestamp().alias("at"), F.lit("import").alias("run_id"),
        F.current_timestamp().alias("seen"),
    )
