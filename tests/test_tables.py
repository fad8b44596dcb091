"""Properties of the observation and derived tables on small frames."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from obslake.operators import aggregates, dedup, filters, joins, views, windows
from obslake.plans import forecast, gold, ledger, reports, silver, snapshot
from obslake.registry import QUERIES
from obslake.schemas import ARCHIVE_REQUIRED, OBSERVATION
from obslake.session import scratch_path
from obslake.sources import readers, sinks, storage


def archive_rows(days=365):
    start, out = dt.date(2025, 1, 1), []
    for number, name, base in (("75114001", "PARIS-MONTSOURIS", 12.0), ("69029001", "LYON-BRON", 13.0)):
        for i in range(days):
            wave = 10 * math.sin(2 * math.pi * (i - 105) / 365)
            low, high = round(base + wave - 4, 1), round(base + wave + 4, 1)
            day = (start + dt.timedelta(days=i)).strftime("%Y%m%d")
            rain = "" if i % 10 == 0 else f"{(i * 7 % 40) / 10:.1f}".replace(".", ",")
            out.append((number, name, "48.8", "2,3", "77", day, rain, str(low), str(high), "", "3.5"))
    return out


COLUMNS = ", ".join(f"{c} string" for c in [*ARCHIVE_REQUIRED, "TM", "FFM"])


@pytest.fixture(scope="module")
def year(spark):
    return silver.normalise_archive(spark.createDataFrame(archive_rows(), COLUMNS)).cache()


@pytest.fixture(scope="module")
def year_silver(year):
    return silver.build_silver([year]).cache()


def same(a, b):
    names = a.columns
    return sorted(map(str, a.select(*names).collect())) == sorted(map(str, b.select(*names).collect()))


def test_archive_contract(spark, year):
    assert year.schema.simpleString() == OBSERVATION.simpleString()
    assert year.count() == 730
    assert {r[0] for r in year.select("city").distinct().collect()} == {"Paris", "Lyon"}
    assert year.where("snow IS NOT NULL").isEmpty()
    with pytest.raises(ValueError, match="RR"):
        silver.normalise_archive(spark.createDataFrame([("1",)], "NUM_POSTE string"))


def test_feed_contract(spark):
    rows = [("Paris", 48.8, 2.3, "2026-08-27T14:00", 22.5, 12.3, 0.0), ("Lyon", 45.7, 4.8, "bad", 20.0, None, None)]
    feed = silver.normalise_feed(spark.createDataFrame(rows, "city string, latitude double, longitude double, timestamp string, temperature double, windspeed double, precipitation double"))
    assert feed.schema.simpleString() == OBSERVATION.simpleString()
    first, second = feed.orderBy("city").collect()[::-1]
    assert first["station_id"] == "OPENMETEO_PARIS" and first["timestamp"] == dt.datetime(2026, 8, 27, 14)
    assert second["timestamp"] is None
    assert silver.build_silver([None, feed]).count() == 1
    assert silver.build_silver([None, None]) is None


def test_silver_properties(year, year_silver):
    assert year_silver.count() == 730
    rows = year_silver.where("city = 'Paris'").orderBy("timestamp").collect()
    temps = [r["temperature"] for r in rows]
    assert rows[0]["temp_ma3"] == temps[0] and rows[0]["temp_anomaly"] == 0
    assert rows[6]["temp_ma7"] == pytest.approx(sum(temps[:7]) / 7)
    assert rows[6]["temp_std7"] == pytest.approx(statistics.stdev(temps[:7]))


def test_silver_does_not_depend_on_copies_or_order(year, year_silver):
    doubled = silver.build_silver([year, year.orderBy(F.rand(3)).repartition(5)])
    assert same(year_silver, doubled)


def test_silver_range_keeps_history(year, year_silver):
    part = silver.build_silver([year], "2025-03-01", "2025-03-31")
    assert part.count() == 62
    assert same(part, year_silver.where("dt BETWEEN '2025-03-01' AND '2025-03-31'"))


@pytest.mark.parametrize("days", [0.5, 3, 10_000])
def test_bucket_size_does_not_change_rows(year, year_silver, days):
    assert same(year_silver, silver.build_silver([year], days=days))


def test_one_station_spans_several_tasks(spark, year):
    """A station's series is spread by calendar bucket, and no task holds the whole of it."""
    one = year.where(F.col("station_id") == year.select(F.min("station_id")).scalar())
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        tasks = windows.trailing_indicators(one, days=8).withColumn("task", F.spark_partition_id())
        assert tasks.select("task").distinct().count() > 1
    finally:
        spark.conf.set(merge, before)


def test_a_dense_day_of_one_key_spans_many_ranges(spark):
    """Ranges are bounded by rows: a third of all rows in one hour of one key, the rest in quiet series of years."""
    from obslake.operators.skew import with_row_ranges

    hot = spark.range(10_000).selectExpr("'hot' AS k", "timestamp_micros(1735689600000000 + id * 360000) AS ts")
    quiet = spark.range(20_000).selectExpr("concat('k', id % 50) AS k", "timestamp_micros(id * 60000000000) AS ts")
    rows = hot.unionAll(quiet).cache()
    found = with_row_ranges(rows, "k", "ts", parts=60).withColumnRenamed("_bucket", "r").groupBy("k", "r").count().collect()
    assert max(r["count"] for r in found) <= 2 * 30_000 / 60
    assert sum(r["k"] == "hot" for r in found) >= 18
    assert sum(r["k"] != "hot" for r in found) <= 50 + 2 * 60  # quiet keys are hardly cut
    assert {r["r"] for r in found} <= set(range(60))


def test_dedup_prefers_full_rows(spark):
    at = dt.datetime(2025, 1, 1)
    rows = [("A", at, None, 1.0), ("A", at, 5.0, 1.0), ("B", at, 2.0, None), ("C", at, 1.0, 1.0), ("C", at, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "station_id string, timestamp timestamp, temperature double, precipitation double")
    df = df.withColumn("source", F.lit("X"))
    got = {r["station_id"]: r["temperature"] for r in dedup.dedup_observations(df).collect()}
    assert got == {"A": 5.0, "B": 2.0, "C": 0.0}


def brute_windows(values, key, before, after):
    return [values[max(0, i - before): i + after + 1] for i in range(len(values))]


@pytest.mark.parametrize("cut", [{"days": 0.001}, {"days": 30}, {"parts": 2}, {"parts": 7}, {"parts": 400}, {}])
def test_cut_windows_match_brute_force(spark, cut):
    """Random gaps, ties in time, NULL keys and times; frames reach over several ranges."""
    from obslake.operators.skew import over_key

    rng = random.Random(7)
    rows = []
    for key, size in (("hot", 300), ("warm", 60), (None, 90), ("cold", 5)):
        at = 0
        for i in range(size):
            at += rng.choice([0, 1, 1, 2, 50, 100000])
            time = dt.datetime(2025, 1, 1) + dt.timedelta(seconds=at)
            rows.append((key, None if key == "warm" and i < 20 else time, i, float(rng.randint(0, 99))))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, ts timestamp, i int, v double")

    def build(frame, window):
        return frame.withColumns(
            {
                "seen": F.collect_list("v").over(window.rowsBetween(-7, 3)),
                "lag7": F.lag("v", 7).over(window),
                "lead3": F.lead("v", 3).over(window),
            }
        )

    out = over_key(df, "k", "ts", ["i"], build, before=7, after=3, **cut)
    got = {(r["k"], r["i"]): (r["seen"], r["lag7"], r["lead3"]) for r in out.collect()}
    assert len(got) == len(rows) == out.count()
    for key in ("hot", "warm", None, "cold"):
        series = sorted((r for r in rows if r[0] == key), key=lambda r: r[2])
        values = [r[3] for r in series]
        for i, frame in enumerate(brute_windows(values, key, 7, 3)):
            lag = values[i - 7] if i >= 7 else None
            lead = values[i + 3] if i + 3 < len(values) else None
            assert got[(key, i)] == (frame, lag, lead), (key, i)


def test_full_frames_need_every_value(spark):
    rows = [("a", dt.datetime(2025, 1, 1 + i), None if i == 4 else float(i), 1.0, 1.0) for i in range(12)]
    df = spark.createDataFrame(rows, "location string, timestamp timestamp, temperature double, precipitation double, wind_speed double")
    causal = windows.series_features(df).orderBy("timestamp").collect()
    assert [r["temp_ma3"] for r in causal[:6]] == [None, None, 1.0, 2.0, None, None]
    assert [r["temp_ma7"] is None for r in causal] == [True] * 11 + [False]
    centered = windows.series_features(df, centered=True).orderBy("timestamp").collect()
    assert [r["temp_ma3"] for r in centered[:4]] == [None, 1.0, 2.0, None]
    assert centered[8]["temp_ma7"] == 8.0 and centered[9]["temp_ma7"] is None
    assert causal[2]["precip_sum3"] == 3.0 and causal[6]["wind_ma7"] == 1.0
    assert [r["target"] for r in causal][-1] is None and causal[0]["temp_lag1"] is None


def test_daily_and_climate(year_silver):
    daily = aggregates.daily_aggregates(year_silver).cache()
    assert daily.count() == 730 and daily.where("n_obs <> 1").isEmpty()
    climate = aggregates.climate_profile(daily).collect()
    assert len(climate) == 24
    assert all(0 <= r["rain_day_ratio"] <= 1 for r in climate)
    assert sum(r["n_days"] for r in climate) == 730
    normal = {r["month"]: r["temp_normal"] for r in climate if r["city"] == "Paris"}
    assert normal[7] > normal[1]


def weekly_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "dt date, city string, source string, temp_avg double")
    df = df.withColumns({c: F.col("temp_avg") for c in ("temp_min", "temp_max", "precip_sum")})
    return aggregates.weekly_trends(df, **options).orderBy("year", "week", "city").collect()


def test_weekly_slope(spark):
    monday = dt.date(2025, 3, 3)
    rows = [(monday + dt.timedelta(days=i), "Paris", "S", 1.0 + 2 * i) for i in range(4)]
    rows += [(monday + dt.timedelta(days=7), "Paris", "S", 3.0)]
    first, second = weekly_of(spark, rows)
    assert first["trend_slope"] == pytest.approx(2.0) and second["trend_slope"] == 0.0
    assert first["temp_vs_prev_week"] is None and second["temp_vs_prev_week"] == pytest.approx(3.0 - 4.0)


def test_weekly_slope_with_missing_values(spark):
    """Rows count all days in n and x; pairs count only days with a mean."""
    monday = dt.date(2025, 3, 3)
    ys = [1.0, None, 5.0, 7.0]
    rows = [(monday + dt.timedelta(days=i), "Paris", "S", y) for i, y in enumerate(ys)]
    known = [(x, y) for x, y in enumerate(ys) if y is not None]
    n, sx, sxx = 4, sum(range(4)), sum(x * x for x in range(4))
    sy, sxy = sum(y for _, y in known), sum(x * y for x, y in known)
    want = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    assert weekly_of(spark, rows)[0]["trend_slope"] == pytest.approx(want)
    assert weekly_of(spark, rows, slope="pairs")[0]["trend_slope"] == pytest.approx(2.0)
    nameless = [(d, None, s, y) for d, _, s, y in rows]
    assert weekly_of(spark, nameless)[0]["trend_slope"] == 0.0


def test_week_of_two_years(spark):
    rows = [(dt.date(2024, 1, 1), "P", "S", 1.0), (dt.date(2024, 12, 30), "P", "S", 365.0)]
    one = weekly_of(spark, rows)
    assert len(one) == 1 and one[0]["trend_slope"] == pytest.approx(1.0)
    assert [r["year"] for r in weekly_of(spark, rows, week_year="iso")] == [2024, 2025]


def daily_frame(spark, rows):
    return spark.createDataFrame(rows, "dt date, city string, source string, temp_avg double, precip_sum double, n_obs long")


def test_kpi(spark):
    day = dt.date(2025, 1, 2)
    rows = [(day, "Paris", "A", 20.0, 1.0, 3), (day, "Lyon", "A", None, 3.0, 2), (dt.date(2025, 1, 1), "Nice", "A", 1.0, 9.0, 5)]
    got = aggregates.kpi_summary(daily_frame(spark, rows)).first()
    assert tuple(got) == (2, 10, 20.0, 4.0, "2025-01-02")
    assert tuple(aggregates.kpi_summary(daily_frame(spark, [])).first()) == (0, 0, None, None, None)


def test_markers(spark):
    catalog = spark.createDataFrame([("Nice", 43.7, 7.2)], "city string, lat double, lon double")
    day = dt.date(2025, 1, 2)
    rows = [(day, c, "A", t, 0.0, 1) for c, t in (("Paris", None), ("Nice", 9.0), ("Nowhere", 1.0), ("", 2.0))]
    points = {r["city"]: tuple(r)[1:] for r in views.map_points(daily_frame(spark, rows), catalog).collect()}
    assert points == {"Paris": (48.8566, 2.3522, None), "Nice": (43.7, 7.2, 9.0)}
    assert [r["city"] for r in views.search_points(catalog, "NI").collect()] == ["Nice"]


def test_histogram_and_range(spark):
    df = spark.createDataFrame([(float(i),) for i in range(61)] + [(None,)], "v double")
    got = {r["bin"]: r["n"] for r in aggregates.histogram(df, "v").collect()}
    assert sum(got.values()) == 61 and set(got) == set(range(30)) and got[29] == 3
    same_value = aggregates.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v").collect()
    assert [tuple(r) for r in same_value] == [(0, 2)]
    assert tuple(aggregates.value_range(df.where("v > 99"), "v").first()) == (0.0, 1.0)


def test_plan_and_resume(spark):
    departments = spark.createDataFrame([("75",), ("13",)], "department string")
    periods = spark.createDataFrame([(storage.PERIOD_PREVIOUS,), (storage.PERIOD_LATEST,)], "period string")
    keys = spark.createDataFrame([(f"75:{storage.PERIOD_LATEST}",)], "key string")
    none = keys.where("false")
    plan = joins.batch_plan(departments, periods, none)
    assert plan.count() == 4
    assert joins.batch_plan(departments, periods, keys).count() == 3
    assert joins.batch_plan(departments, periods, plan.select("key")).count() == 0


def test_ledger(spark):
    book, runs = scratch_path(spark, "ledger"), scratch_path(spark, "journal")
    units = spark.createDataFrame([(f"u{i}",) for i in range(10)], "key string")
    ledger.mark(spark, book, "silver", units.where("key < 'u7'"))
    left = ledger.pending(units, ledger.read_ledger(spark, book), "silver")
    assert sorted(r[0] for r in left.collect()) == ["u7", "u8", "u9"]
    assert ledger.is_done(ledger.read_ledger(spark, book), "silver", "u3")
    ledger.forget(spark, book, "silver", units.where("key = 'u3'"))
    assert not ledger.is_done(ledger.read_ledger(spark, book), "silver", "u3")
    for i in range(3):
        ledger.record_run(spark, runs, "silver", f"run-{i}", "success", {"rows": i, "none": None})
    seen = ledger.summary(ledger.read_ledger(spark, book), ledger.read_journal(spark, runs)).first()
    assert (seen["done"], seen["last_run"], seen["last_status"], seen["runs"]) == (6, "run-2", "success", 3)
    assert ledger.summary_lines(spark.createDataFrame([seen])).first()["line"].startswith("silver ")
    ledger.reset(spark, book, "silver")
    assert ledger.done_keys(ledger.read_ledger(spark, book)).isEmpty()


def test_incremental_silver_refreshes_changed_years(spark, year):
    path, book = scratch_path(spark, "silver"), scratch_path(spark, "ledger")
    january = year.where("month(dt) = 1")
    silver.write_silver(spark, [january], path, book)
    assert readers.read_table(spark, path).count() == 62
    # the file landed while the run was under way: after its start, before its mark
    later = ledger.read_ledger(spark, book).first()["seen"] + dt.timedelta(milliseconds=1)
    changed = spark.createDataFrame([("2025", later)], "key string, changed_at timestamp")
    silver.write_silver(spark, [year], path, book, only_new=True, changed_at=changed)
    assert readers.read_table(spark, path).count() == 730


def test_live_hours_bring_their_year_back(spark, year):
    path, book = scratch_path(spark, "silver"), scratch_path(spark, "ledger")
    silver.write_silver(spark, [year.where("month(dt) = 1")], path, book)
    ledger.mark(spark, book, "stream", spark.createDataFrame([("2025/03/01/07",)], "key string"))
    silver.write_silver(spark, [year], path, book, only_new=True)
    assert readers.read_table(spark, path).count() == 730
    written = silver.write_silver(spark, [year], path, book, only_new=True)
    assert written.isEmpty()


def test_bounds_choose_whole_years(spark, year):
    path, book = scratch_path(spark, "silver"), scratch_path(spark, "ledger")
    for bounds in ({"end": "2025-06-30"}, {"start": "2025-12-01"}):
        silver.write_silver(spark, [year], path, book, **bounds)
        assert readers.read_table(spark, path).count() == 730
    assert silver.write_silver(spark, [year], path, book, start="2026-01-01").isEmpty()
    assert readers.read_table(spark, path).count() == 730


def test_indicators_of_the_next_years_are_refreshed(spark, year):
    """Years whose windows look back into a refreshed one follow it, also over a gap."""
    later = year.withColumn("timestamp", F.expr("timestamp + INTERVAL 1096 DAY")).withColumn("dt", F.col("timestamp").cast("date"))
    before = year.withColumn("temperature", F.col("temperature") + 7)
    path, book = scratch_path(spark, "silver"), scratch_path(spark, "ledger")
    silver.write_silver(spark, [before.unionByName(later)], path, book)
    changed = spark.createDataFrame([("2025", dt.datetime.now() + dt.timedelta(hours=1))], "key string, changed_at timestamp")
    silver.write_silver(spark, [year.unionByName(later)], path, book, only_new=True, changed_at=changed)
    whole = scratch_path(spark, "silver")
    silver.write_silver(spark, [year.unionByName(later)], whole, scratch_path(spark, "ledger"))
    assert same(readers.read_table(spark, path), readers.read_table(spark, whole))


def test_unknown_stations_go_to_quarantine(spark, year):
    path, aside, book = (scratch_path(spark, n) for n in ("silver", "aside", "ledger"))
    unknown = year.limit(3).withColumn("station_id", F.when(F.col("temperature") > 0, ""))
    silver.write_silver(spark, [year.unionByName(unknown)], path, book, quarantine_path=aside)
    assert readers.read_table(spark, path).count() == 730
    rows = readers.read_table(spark, aside).collect()
    assert len(rows) == 3 and {r["reason"] for r in rows} == {"station unknown"}


def test_jobs_record_their_runs(spark, year):
    path, book, runs = (scratch_path(spark, n) for n in ("silver", "ledger", "journal"))
    silver.write_silver(spark, [year], path, book, journal_path=runs)
    broken = year.withColumn("temperature", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        silver.write_silver(spark, [broken], path, book, journal_path=runs)
    found = [(r["stage"], r["status"], r["counters"].get("years")) for r in ledger.read_journal(spark, runs).orderBy("at").collect()]
    assert found == [("silver", "success", 1), ("silver", "failed", None)]
    state = ledger.state(ledger.read_ledger(spark, book))
    assert same(state, ledger.state(ledger.compacted(ledger.read_ledger(spark, book))))


def test_kafka_options():
    from obslake.streaming.feed import kafka_options

    plain = kafka_options("b:9092", "t")
    assert plain["failOnDataLoss"] == "true" and plain["startingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in plain
    chosen = kafka_options("b:9092", "t", from_earliest=True, per_trigger=20_000, allow_loss=True)
    assert (chosen["startingOffsets"], chosen["maxOffsetsPerTrigger"], chosen["failOnDataLoss"]) == ("earliest", "20000", "false")


def test_markers_are_found_at_any_depth(spark, tmp_path):
    deep = tmp_path / "a" / "b" / "c" / "d" / "e" / "f"
    deep.mkdir(parents=True)
    assert not storage.has_marker(spark, str(tmp_path))
    (deep / "_SUCCESS").write_bytes(b"")
    assert storage.has_marker(spark, str(tmp_path)) and not storage.has_marker(spark, str(tmp_path / "none"))


def test_only_an_empty_folder_counts_as_absent(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not a table")
    assert readers.read_table(spark, str(tmp_path / "empty")) is None
    with pytest.raises(Exception):
        readers.read_table(spark, str(tmp_path / "broken")).count()


def test_gold_weeks_see_the_year_before(spark, year):
    """An incremental run gives the same tables as one full run."""
    more = year.withColumns({c: F.col(c) + F.expr("INTERVAL 365 DAY") for c in ("timestamp",)}).withColumn("dt", F.col("timestamp").cast("date"))
    both = year.unionByName(more)
    full = gold.write_gold(spark, both, scratch_path(spark, "g"), scratch_path(spark, "l"))
    root, book = scratch_path(spark, "g"), scratch_path(spark, "l")
    gold.write_gold(spark, year, root, book)
    parts = gold.write_gold(spark, both, root, book, only_new=True)
    for name in (gold.DAILY, gold.WEEKLY, gold.EVENTS, gold.CLIMATE):
        a, b = readers.read_table(spark, full[name]), readers.read_table(spark, parts[name])
        assert (a is None and b is None) or same(a, b), name


def test_storage(spark, tmp_path):
    home = tmp_path / "bronze" / "year=2026" / "month=03"
    home.mkdir(parents=True)
    (home / "Q_75_latest-2025-2026_RR-T-Vent.csv.gz").write_bytes(b"12345")
    (home / "_SUCCESS").write_bytes(b"")
    root = str(tmp_path / "bronze")
    assert storage.storage_size(spark, [root, root + "x"]).collect()[0]["bytes"] == 5
    entry = storage.manifest(storage.files(spark, root), "https://data.example").first()
    assert (entry["department"], entry["bytes"], entry["partition"]) == ("75", 5, "year=2026/month=03")
    marks = storage.complete_partitions(spark, f"{root}/year=2026", "month")
    assert [r[0] for r in marks.collect()] == ["03"]
    assert storage.complete_partitions(spark, root + "x", "month").isEmpty()
    quota = spark.range(1).select(
        storage.quota_reached(F.lit(5), 5), storage.quota_reached(F.lit(4), 5), storage.quota_reached(F.lit(9), 0)
    )
    assert tuple(quota.first()) == (True, False, False)


def test_archive_scan(spark, tmp_path):
    import gzip

    text = "NUM_POSTE;NOM_USUEL;LAT;LON;ALTI;AAAAMMJJ;RR;TN;TX\n7511;LE HAVRE;49,5;0.1;3;20250115;;5;15\n"
    with gzip.open(tmp_path / "Q_76.csv.gz", "wt") as file:
        file.write(text)
    rows = silver.build_silver(silver.read_inputs(spark, f"{tmp_path}/*.csv.gz", f"{tmp_path}/none")).collect()
    assert [(r["station_id"], r["city"], r["temperature"], r["precipitation"]) for r in rows] == [
        ("MF_00007511", "Le Havre", 10.0, None)
    ]


def test_read_gold(spark):
    path = scratch_path(spark, "t")
    rows = spark.createDataFrame([("2025-01-01", 1), ("2025-02-01", 2), ("n/a", 3)], "dt string, v int")
    sinks.write_table(rows, path)
    assert readers.read_gold(spark, path).count() == 3
    assert [r["v"] for r in readers.read_gold(spark, path, date_from="2025-01-15").collect()] == [2]
    assert readers.read_gold(spark, path + "x") is None
    assert readers.recent_table(spark, path, 10).count() == 0
    assert readers.latest_document(rows.where("v < 3")).first()["v"] == 2


def test_compaction_refuses_an_existing_target(spark):
    path, target = scratch_path(spark, "a"), scratch_path(spark, "b")
    sinks.write_partitions(spark.range(10).withColumn("p", F.col("id") % 2), path, ["p"])
    sizes = sinks.compact_table(spark, path, target, ["p"]).first()
    assert sizes["bytes_before"] > 0 and sizes["bytes_after"] > 0
    with pytest.raises(ValueError):
        sinks.compact_table(spark, path, target, ["p"])


def test_time_split(spark):
    days = [(dt.date(2025, 1, 1) + dt.timedelta(days=i), i) for i in range(100)]
    df = spark.createDataFrame(days, "dt date, v int")
    counts = {r["split"]: r["n"] for r in aggregates.count_by(forecast.with_split(df), "split").collect()}
    assert counts == {"train": 70, "val": 15, "test": 15}
    with pytest.raises(ValueError):
        forecast.with_split(df.limit(2))


def test_encoding(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("b",)], "season string")
    new = spark.createDataFrame([("a",), ("c",), ("z",), (None,)], "season string")
    coded = forecast.apply_encoders(new, forecast.encoders(train))
    assert sorted(r[0] for r in coded.collect()) == [-1, -1, 0, 2]


def test_forecast_is_skipped_without_a_model(spark, year):
    assert forecast.needs_training(spark, scratch_path(spark, "models"))
    assert forecast.run_forecast(spark, year, scratch_path(spark, "models"), scratch_path(spark, "out")) is None


def test_bulletins(spark):
    d1, d2, d4 = dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 4)
    shape = "dt date, city string, source string, temp_avg double, temp_min double, temp_max double, precip_sum double, wind_avg double, snow_sum double"
    daily = spark.createDataFrame([(d1, "Paris", "A", 1.0, 0.0, 2.0, None, 3.0, None), (d2, "Lyon", "A", 5.0, 4.0, 6.0, 0.0, 1.0, None)], shape)
    events = spark.createDataFrame([(d1, "Paris", "A", "canicule", "alerte", 36.0, 35.0, "chaud")], "dt date, city string, source string, event_type string, severity string, value double, threshold double, detail string")
    nothing = spark.createDataFrame([], "dt string, city string, source string, temp_predicted double, confidence double, temp_actual double")
    days = spark.createDataFrame([(d1,), (d2,), (d4,), (dt.date(2025, 1, 3),)], "report_dt date")
    texts = {r["dt"]: r["text"] for r in reports.documents(reports.bulletin_lines(daily, events, nothing, days)).collect()}
    assert texts["2025-01-02"].split("\n") == [
        "Bulletin automatique (fallback)", "", "Bulletin météo du 2025-01-02 :", "- Conditions observées :",
        "  • Lyon : 5.0 °C en moyenne (min 4.0 / max 6.0), précipitations 0.0 mm, vent moyen 1.0 km/h.",
        "- Événements notables :", "  • canicule (alerte) à Paris : chaud",
        "- Prévisions 24h : aucune prédiction ML disponible.", "",
        "(Bulletin généré automatiquement sans modèle de langage.)",
    ]
    assert "Lyon" in texts["2025-01-03"] and "précipitations N/A mm" in texts["2025-01-01"]
    assert "- Données d'agrégat indisponibles pour cette date." in texts["2025-01-04"]
    context = {r["dt"]: r["text"] for r in reports.documents(reports.context_lines(daily, events, nothing, days)).collect()}
    assert "2025-01-01 | Paris | 1.00 | 0.00 | 2.00 | NaN | 3.00 | NaN" in context["2025-01-02"]
    assert "(aucune prédiction ML disponible)" in context["2025-01-02"]


def test_empty_export_fails(spark):
    counts = aggregates.table_counts({"a": spark.range(0), "b": spark.range(0)})
    with pytest.raises(ValueError):
        snapshot.require_rows(counts)
    assert snapshot.require_rows(counts, allow_empty=True) is counts
    assert [r["city"] for r in snapshot.known_stations(None, spark).orderBy("city").collect()][0] == "Bordeaux"
    line = snapshot.json_rows(spark.createDataFrame([(1.23456, None)], "a double, b string")).first()["json"]
    assert line == '{"a":1.235,"b":null}'


def test_filters(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, i), f"c{i}") for i in range(1, 11)], "dt date, city string")
    assert filters.last_days(df, 3).count() == 4
    assert [r["city"] for r in filters.newest_day(df).collect()] == ["c10"]
    assert filters.day_and_before(df, "2025-01-05").count() == 2
    assert filters.date_range(df, "2025-01-03", None).count() == 8
    assert filters.missing_columns(["a"], ["b", "a", "c"]) == ["b", "c"]


def test_changed_archives_reach_gold(spark, tmp_path):
    """A rewritten file makes its year pending again, in both stages."""
    header = ";".join(ARCHIVE_REQUIRED) + "\n"
    line = "75114001;PARIS-MONTSOURIS;48.8;2.3;77;2025010{};0;5;15\n"
    file = tmp_path / "Q_75.csv"
    path, root, book = (scratch_path(spark, n) for n in ("silver", "gold", "ledger"))

    def run():
        frames = silver.read_inputs(spark, f"{tmp_path}/*.csv", None)
        changed = readers.archive_changes(spark, f"{tmp_path}/*.csv")
        silver.write_silver(spark, frames, path, book, only_new=True, changed_at=changed)
        paths = gold.write_gold(spark, readers.read_table(spark, path), root, book, only_new=True)
        return readers.read_table(spark, paths[gold.DAILY]).count()

    file.write_text(header + line.format(1))
    assert run() == 1
    assert run() == 1
    file.write_text(header + line.format(1) + line.format(2))
    assert run() == 2


def test_sizes_beyond_a_long(spark, tmp_path):
    """Keys of large tables give products that no long holds."""
    rows = spark.createDataFrame([(1_200_000, 7), (20, 1)], "l_partkey long, l_linenumber int")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["f17_byte_size"].run(spark, str(tmp_path)).collect()
    assert sorted((r["bytes"] or 0, r["size"]) for r in found) == [(0, "3300374373.8 To"), (2_400_000, "2.3 Mo")]


def test_empty_columns_are_looked_for_once(spark, year_silver, monkeypatch):
    """Training reads written features; it does not build them again for each of their columns."""
    looked = []

    def empty(df, find=forecast._empty_columns):
        looked.append(all("features-" in file for file in df.inputFiles()))
        return find(df)

    def stop(*_):
        raise InterruptedError

    monkeypatch.setattr(forecast, "_empty_columns", empty)
    monkeypatch.setattr(forecast, "search_grid", stop)
    with pytest.raises(InterruptedError):
        forecast.train_model(forecast.build_features(year_silver))
    assert looked == [True]


def test_one_row_group_is_spread(spark, tmp_path):
    path = f"{tmp_path}/rows.parquet"
    spark.range(300_000).selectExpr("id", "uuid() AS text").coalesce(1).write.parquet(path)
    assert spark.read.parquet(path).repartition(1).count() == readers.read_spread(spark, path, "id").count()
    assert readers.read_spread(spark, path, "id").rdd.getNumPartitions() >= 8
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/few.parquet")
    assert readers.read_spread(spark, f"{tmp_path}/few.parquet", "id").rdd.getNumPartitions() == 1


def test_rows_after_the_last_day_go_before_the_windows(year):
    """Only rows up to the last day are cut into series; the result has the days asked for."""
    built = silver.build_silver([year], "2025-03-01", "2025-03-31")
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Window"):]
    assert "2025-03-31" in below or "20178" in below
