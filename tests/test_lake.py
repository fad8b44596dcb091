"""Versioned tables and the runs that files drive."""

import os
import random

import pytest
from pyspark.sql import functions as F

from obslake.operators import aggregates
from obslake.plans import gold, gold_increment, increment, ledger, reach, reports, silver
from obslake.schemas import ARCHIVE_REQUIRED, INDICATORS, OBSERVATION_COLUMNS
from obslake.session import scratch_path, shared_dir
from obslake.sources import readers, versions

HEADER = ";".join(ARCHIVE_REQUIRED) + "\n"


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def names(spark, root):
    return sorted(n for n in os.listdir(f"{root}/_pointer") if n.isdigit())


@pytest.fixture
def root(spark):
    return versions.create_root(spark, scratch_path(spark, "lake"))


def days(spark, *pairs):
    return spark.createDataFrame(list(pairs), "year int, v int")


def test_partitions_are_replaced_in_one_step(spark, root):
    assert versions.read_version(spark, f"{root}/t") is None and readers.read_table(spark, f"{root}/t") is None
    with versions.Change(spark, root) as change:
        change.replace("t", days(spark, (1, 1), (2, 2), (3, 3)), ["year"])
        change.append("log", days(spark, (0, 0)))
    old = readers.read_table(spark, f"{root}/t")
    with versions.Change(spark, root) as change:
        change.replace("t", days(spark, (2, 20), (4, 40)), ["year"], gone=["year=3"])
        change.append("log", days(spark, (0, 1)))
    assert rows_of(readers.read_table(spark, f"{root}/t").select("year", "v")) == ["(1, 1)", "(2, 20)", "(4, 40)"]
    assert readers.read_table(spark, f"{root}/log").count() == 2
    assert rows_of(old.select("year", "v")) == ["(1, 1)", "(2, 2)", "(3, 3)"]  # a reader keeps what it began with
    assert rows_of(versions.read_version(spark, f"{root}/t", {"year=4"}).select("v", "year")) == ["(40, 4)"]


def test_a_failed_change_leaves_nothing(spark, root):
    with versions.Change(spark, root) as change:
        change.append("t", days(spark, (1, 1)))
    before = names(spark, root)
    with pytest.raises(ZeroDivisionError), versions.Change(spark, root) as change:
        change.append("t", days(spark, (1, 2)))
        raise ZeroDivisionError
    assert names(spark, root) == before and len(os.listdir(f"{root}/t")) == 1
    assert rows_of(readers.read_table(spark, f"{root}/t")) == ["(1, 1)"]


def test_writers_that_meet(spark, root):
    """Appends of both stay; two replacements of one partition are a conflict."""
    with versions.Change(spark, root) as first:
        first.append("t", days(spark, (1, 1)))
        with versions.Change(spark, root) as second:
            second.append("t", days(spark, (1, 2)))
    assert readers.read_table(spark, f"{root}/t").count() == 2
    for other in ((5, 5), (6, 6)):
        if other[0] == 5:
            with pytest.raises(versions.Conflict), versions.Change(spark, root) as first:
                first.replace("p", days(spark, (5, 1)), ["year"])
                with versions.Change(spark, root) as second:
                    second.replace("p", days(spark, other), ["year"])
        else:
            with versions.Change(spark, root) as first:
                first.replace("p", days(spark, (5, 1)), ["year"])
                with versions.Change(spark, root) as second:
                    second.replace("p", days(spark, other), ["year"])
    assert rows_of(readers.read_table(spark, f"{root}/p").select("year", "v")) == ["(5, 1)", "(6, 6)"]


def test_a_numbered_writer_writes_once(spark, root):
    for number in (0, 1, 1, 0):
        with versions.Change(spark, root, "stream", number) as change:
            change.append("t", days(spark, (number, number)))
            change.append("u", days(spark, (number, number)))
    assert rows_of(readers.read_table(spark, f"{root}/t")) == rows_of(readers.read_table(spark, f"{root}/u")) == ["(0, 0)", "(1, 1)"]


def test_compaction_and_expiry(spark, root):
    path = f"{root}/t"
    for number in range(6):
        with versions.Change(spark, root) as change:
            change.append("t", days(spark, (number % 2, number)))
    want = rows_of(readers.read_table(spark, path))
    during = readers.read_table(spark, path)
    assert versions.compact(spark, path) == 6 and len(versions.live_folders(spark, path)) == 1
    assert rows_of(during) == rows_of(readers.read_table(spark, path)) == want
    assert versions.compact(spark, path) == 0
    assert versions.expire(spark, root, keep=1) == 6
    assert len(os.listdir(path)) == len(names(spark, root)) == 1
    assert rows_of(readers.read_table(spark, path)) == want


def test_ledger_in_a_versioned_root(spark, root):
    book = f"{root}/ledger"
    keys = spark.range(10).selectExpr("cast(id AS string) AS key")
    ledger.mark(spark, book, "s", keys)
    ledger.forget(spark, book, "s", keys.where("key < '3'"))
    ledger.mark(spark, book, "s", keys.where("key < '1'"))
    want = rows_of(ledger.done_keys(ledger.read_ledger(spark, book)))
    assert len(want) == 8 and ledger.compact(spark, book) == 3
    assert rows_of(ledger.done_keys(ledger.read_ledger(spark, book))) == want


class Files:
    """Archives and feed files of a few stations, written as text."""

    def __init__(self, folder):
        self.folder = folder
        (folder / "batch").mkdir()
        (folder / "stream").mkdir()

    def archive(self, name, rows):
        text = "".join(f"{station};S{station};48;2;9;{day};1;{low};{low + 10}\n" for station, day, low in rows)
        (self.folder / "batch" / name).write_text(HEADER + text)

    def feed(self, name, rows):
        line = '{{"city": "{}", "latitude": 1.0, "longitude": 2.0, "timestamp": "{}", "temperature": {}, "windspeed": 3.0, "precipitation": 0.5}}\n'
        (self.folder / "stream" / name).write_text("".join(line.format(*row) for row in rows))

    @property
    def paths(self):
        return f"{self.folder}/batch/*.csv", f"{self.folder}/stream"


def full(spark, files):
    frames = silver.read_inputs(spark, *files.paths)
    built = silver.build_silver([f for f in frames if f is not None])
    return rows_of(built.withColumn("year", F.year("dt")))


def found(spark, root):
    return rows_of(increment.read_silver(spark, root).select(*OBSERVATION_COLUMNS, *INDICATORS, "year"))


def test_runs_equal_a_full_build(spark, tmp_path):
    """Files that come, change, go, share rows and reach over gaps of years."""
    rng = random.Random(7)
    files, root, book = Files(tmp_path), scratch_path(spark, "lake"), scratch_path(spark, "ledger")

    def rows(count):
        years = rng.sample([2018, 2019, 2020, 2023, 2024, 2025], 3)
        return [(rng.choice([1, 2, 3]), f"{rng.choice(years)}01{rng.randint(1, 28):02d}", rng.randint(-9, 20)) for _ in range(count)]

    files.feed("f0", [("Lyon", f"2024-01-0{d}T10:00", d) for d in range(1, 9)])
    for step in range(6):
        for number in rng.sample(range(4), 2):
            path = tmp_path / "batch" / f"{number}.csv"
            if path.exists() and rng.random() < 0.4:
                path.unlink()
            else:
                files.archive(path.name, [*rows(rng.randint(0, 25)), ("", "20230101", 3)])
                os.utime(path, (1_700_000_000 + 10 * step, 1_700_000_000 + 10 * step))
        if step == 3:
            files.feed("f1", [("Lyon", "2025-02-01T00:00", 7), ("Lyon", "2024-01-01T10:00", 1), ("Nice", "never", 3)])
        increment.refresh_silver(spark, *files.paths, root, book)
        assert found(spark, root) == full(spark, files), step
        unnamed = sum((tmp_path / "batch" / f"{n}.csv").exists() for n in range(4))
        assert readers.read_table(spark, f"{root}/quarantine").count() == unnamed


def test_unchanged_archives_are_not_opened(spark, tmp_path):
    files, root, book = Files(tmp_path), scratch_path(spark, "lake"), scratch_path(spark, "ledger")
    files.archive("a.csv", [(1, f"202301{d:02d}", d) for d in range(1, 20)] + [(2, "20230105", 4)])
    files.archive("b.csv", [(1, f"202302{d:02d}", d) for d in range(1, 10)])
    assert increment.refresh_silver(spark, *files.paths, root, book) == [2023]
    pointers, scratch = names(spark, root), set(os.listdir(shared_dir(spark).removeprefix("file:")))
    assert increment.refresh_silver(spark, *files.paths, root, book) == []
    assert names(spark, root) == pointers and set(os.listdir(shared_dir(spark).removeprefix("file:"))) == scratch  # nothing staged
    files.archive("c.csv", [(1, "20230119", 99), (1, "20240101", 5), (2, "20230105", 4)])
    want = full(spark, files)
    unchanged = tmp_path / "batch" / "a.csv"
    state = unchanged.stat()
    unchanged.write_text("x" * state.st_size)
    os.utime(unchanged, ns=(state.st_atime_ns, state.st_mtime_ns))
    assert increment.refresh_silver(spark, *files.paths, root, book) == [2023, 2024]
    assert found(spark, root) == want  # although a.csv has no readable row any more
    done = ledger.done_keys(ledger.read_ledger(spark, book), "silver")
    assert {r["key"] for r in done.collect()} == {"2023", "2024"}


def test_years_in_reach(spark):
    rows = [("a", 2000, 4), ("a", 2003, 2), ("a", 2004, 9), ("a", 2005, 1), ("b", 2001, 1), ("b", 2010, 1), ("c", 2004, 3)]
    counts = spark.createDataFrame(rows, "station_id string, year int, n long")
    assert {r["year"] for r in reach.years_behind(counts, [2000]).collect()} == {2001, 2003, 2004, 2010}
    assert {r["year"] for r in reach.years_behind(counts, [2000, 2003]).collect()} == {2001, 2004, 2010}
    before = {tuple(r) for r in reach.years_before(counts, [2004, 2010]).collect()}
    assert before == {("a", 2003), ("a", 2000), ("b", 2001)}


@pytest.mark.parametrize("week_year", ["calendar", "iso"])
def test_derived_tables_merge(spark, tmp_path, week_year):
    """Archives to derived tables in several runs; years that did not change are not readable any more meanwhile."""
    rng = random.Random(11)
    files, root, book = Files(tmp_path), scratch_path(spark, "lake"), scratch_path(spark, "ledger")

    def rows(year, count=40):
        days = [f"{year}{m:02d}{d:02d}" for m, d in ((1, 1), (1, 2), (1, 3), (6, 5), (6, 6), (12, 28), (12, 29), (12, 30), (12, 31))]
        return [(rng.choice([1, 2]), rng.choice(days), rng.randint(-9, 20)) for _ in range(count)]

    def check():
        days = aggregates.daily_aggregates(increment.read_silver(spark, root)).withColumn("year", F.year("dt"))
        want = {
            gold.DAILY: days, gold.WEEKLY: aggregates.weekly_trends(days.drop("year"), week_year),
            gold.CLIMATE: aggregates.climate_profile(days.drop("year")),
        }
        for name, expected in want.items():
            found = readers.read_table(spark, f"{root}/{name}").select(*expected.columns)
            figures = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in expected.dtypes]
            assert rows_of(found.select(*figures)) == rows_of(expected.select(*figures)), name

    for year in (2018, 2019, 2020, 2024):
        files.archive(f"{year}.csv", rows(year))
    increment.refresh_silver(spark, *files.paths, root, book)
    assert gold_increment.refresh_gold(spark, root, book, week_year=week_year) == [2018, 2019, 2020, 2024]
    check()
    assert gold_increment.refresh_gold(spark, root, book, week_year=week_year) == []
    files.archive("2020.csv", rows(2020, 3))
    os.utime(tmp_path / "batch" / "2020.csv", (1_700_000_000, 1_700_000_000))
    assert 2020 in increment.refresh_silver(spark, *files.paths, root, book)
    days = f"{root}/{gold.DAILY}"
    hidden = [f"{days}/{folder}" for folder in versions.live_folders(spark, days) if folder.endswith(("=2018", "=2019"))]
    for folder in hidden:
        os.rename(folder, folder + ".hidden")
    gold_increment.refresh_gold(spark, root, book, week_year=week_year)
    for folder in hidden:
        os.rename(folder + ".hidden", folder)
    check()
    (tmp_path / "batch" / "2019.csv").unlink()
    increment.refresh_silver(spark, *files.paths, root, book)
    gold_increment.refresh_gold(spark, root, book, week_year=week_year)
    check()


def test_a_bulletin_run_that_dies_before_it_marks_is_repeated_once(spark, root, monkeypatch):
    daily = spark.createDataFrame([("2025-01-01", "Paris", "X"), ("2025-01-02", "Paris", "X")], "dt string, city string, source string")
    daily = aggregates.daily_aggregates(daily.select(
        F.col("dt").cast("date").alias("dt"), "city", "source", *[F.lit(5.0).alias(c) for c in ("temperature", "precipitation", "wind_speed", "snow")]
    ))
    events = aggregates.extreme_event_rows(daily, {"heatwave": 1.0, "heavy_rain": 1.0, "strong_wind": 1.0, "cold_snap": -9.0})
    forecasts = spark.createDataFrame([], "dt string, location string, city string, source string, temp_actual double, temp_predicted double, error_abs double, model_version int, confidence double")
    path, book = f"{root}/bulletins", scratch_path(spark, "ledger")

    def run():
        reports.write_bulletins(spark, daily, events, forecasts, path, book)

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "mark", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            run()
    written = readers.read_table(spark, path)
    want = rows_of(written.select("dt", "part", "bulletin"))
    assert len(want) == 2
    run()
    run()
    assert rows_of(readers.read_table(spark, path).select("dt", "part", "bulletin")) == want


def test_a_bulletin_run_with_every_day_done_makes_no_line(spark, monkeypatch):
    daily = spark.createDataFrame([("2025-01-01", "Paris"), ("2025-01-02", "Paris")], "dt string, city string")
    daily = daily.select(F.col("dt").cast("date").alias("dt"), "city", *[F.lit(5.0).alias(c) for c in ("temp_avg", "temp_min", "temp_max", "precip_sum", "wind_avg")])
    events = spark.createDataFrame([], "dt date, city string, event_type string, severity string, detail string")
    forecasts = spark.createDataFrame([("2025-01-02", None, 3.25, None)], "dt string, city string, temp_predicted double, confidence double")
    path, book = scratch_path(spark, "bulletins"), scratch_path(spark, "ledger")
    reports.write_bulletins(spark, daily, events, forecasts, path, book)
    text = readers.latest_document(spark.read.parquet(path)).first()["bulletin"]
    assert "  • ? : température prévue 3.3 °C (confiance N/A)." in text.split("\n")
    before = spark.read.parquet(path).count(), ledger.read_ledger(spark, book).count()

    def made(*_):
        raise AssertionError("lines of days that are done")

    monkeypatch.setattr(reports, "documents", made)
    reports.write_bulletins(spark, daily, events, forecasts, path, book)
    assert (spark.read.parquet(path).count(), ledger.read_ledger(spark, book).count()) == before


def test_parts_of_a_report_are_cut_after_ranges_without_a_sort_by_day(spark):
    lines = spark.range(500).selectExpr("date'2025-01-01' + CAST(id % 2 AS INT) AS report_dt", "CAST(id % 3 AS INT) AS section", "'' AS place", "concat('line ', id % 200) AS line")
    texts = reports.documents(lines, part_lines=7)
    found = {(r["dt"], r["part"]): r["text"].split("\n") for r in texts.collect()}
    for day in range(2):
        want = [x[1] for x in sorted((i % 3, f"line {i % 200}") for i in range(500) if i % 2 == day)]
        assert [line for part in range(-(-len(want) // 7)) for line in found[f"2025-01-0{1 + day}", part]] == want
    plan = texts._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan  # which would sort and send all lines once more
