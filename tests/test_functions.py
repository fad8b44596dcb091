"""Case tables of the column functions."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from obslake.functions import calendar, formats, text, weather
from obslake.operators import filters
from obslake.sources import storage


def apply(spark, values, schema, *columns):
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    out = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    return [r[1] if len(columns) == 1 else tuple(r[1:]) for r in out]


def test_parse_number(spark):
    given = ["12.4", "12,4", "-3", " 7 ", "\t8\n", "", "   ", None, "n/a", "NaN", "1e3", "12.4d", "1.2.3", "+4", ".5"]
    want = [12.4, 12.4, -3.0, 7.0, 8.0, None, None, None, None, None, 1000.0, None, None, 4.0, 0.5]
    assert apply(spark, given, "v string", text.parse_number(F.col("v"))) == want
    assert apply(spark, [-3.0, float("nan"), None], "v double", text.parse_number(F.col("v"))) == [-3.0, None, None]


def test_parse_date(spark):
    given = ["20250115", "2025-01-15", "", None, "2025", "20251315", "20250231", "20250132", "2025/01/15", " 20250115 ", "2025-0115"]
    day = dt.date(2025, 1, 15)
    assert apply(spark, given, "v string", text.parse_date(F.col("v"))) == [
        day, day, None, None, None, None, None, None, None, day, None,
    ]


def test_station_id(spark):
    given = ["75114001", "7511", "", None, "  ", "123456789", "2A004"]
    assert apply(spark, given, "v string", text.station_id(F.col("v"))) == [
        "MF_75114001", "MF_00007511", "", "", "", "MF_123456789", "MF_2A004",
    ]


def test_city_name(spark):
    cases = {
        "PARIS-MONTSOURIS": "Paris", "LYON-BRON": "Lyon", "BORDEAUX-MERIGNAC": "Bordeaux",
        "LILLE LESQUIN": "Lille", "NICE": "Nice", "SAINT-BRIEUC": "Saint-Brieuc", "LE HAVRE": "Le Havre",
        "": "", "  ": "", "saint-jean de luz": "Saint-Jean", "STE MARIE-PLAGE": "Ste Marie",
        "LES  SABLES OLONNE": "Les Sables", "LA ROCHELLE-ILE": "La Rochelle", "SAINT": "Saint",
        "LE LA LES X Y": "Le La Les X", "ÉVREUX-HUEST": "Évreux",
    }
    assert apply(spark, list(cases), "v string", text.city_name(F.col("v"))) == list(cases.values())
    assert apply(spark, [None], "v string", text.city_name(F.col("v"))) == [""]


def test_mean_temperature(spark):
    given = [(9.9, 5.0, 15.0), (None, 5.0, 15.0), (None, 5.0, None), (None, None, 15.0), (None, None, None)]
    mean = weather.mean_temperature(*[F.col(c) for c in "abc"])
    assert apply(spark, given, "a double, b double, c double", mean) == [9.9, 10.0, 5.0, 15.0, None]


def test_season(spark):
    given = ["12", "1", "4", "7", "10", "0", None, "juillet"]
    season = calendar.season_of_month(F.col("v"))
    assert apply(spark, given, "v string", season) == [
        "hiver", "hiver", "printemps", "ete", "automne", "", "", "",
    ]
    accent = calendar.season_of_month(F.col("v"), "été")
    assert apply(spark, [7, 8, 1], "v int", accent) == ["été", "été", "hiver"]


def test_rain_ratio(spark):
    given = [(9, 30), (0, 30), (30, 30), (1, 0), (1, -5), (None, 5), (40, 30)]
    ratio = weather.rain_day_ratio(F.col("a"), F.col("b"))
    assert apply(spark, given, "a int, b int", ratio) == [0.3, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]


def test_bounds(spark):
    rows = [("-9999",), ("999",), ("NaN",), ("n/a",), (None,), ("-95",), ("65",), ("0.0",)]
    got = apply(spark, rows, "v string", weather.bounded(F.col("v"), *weather.BOUNDS["temperature_2m"]))
    assert got == [None, None, None, None, None, "-95", "65", "0.0"]
    df = spark.createDataFrame([(5000.0, -10.0, 99999.0, "x")], "windspeed double, winddirection double, precipitation double, other string")
    checked = filters.within_bounds(df, weather.FEED_BOUNDS).first()
    assert tuple(checked) == (None, None, None, "x")


def test_usable(spark):
    rows = [(None, None, None), (0.0, None, None), (None, 0.0, None), (None, None, 0.0)]
    df = spark.createDataFrame(rows, "temperature double, windspeed double, precipitation double")
    assert filters.usable(df).count() == 3


def test_extreme_events(spark):
    rows = [
        (1, 37.2, 10.0, 0.0, 0.0), (2, 45.0, 10.0, 0.0, 0.0), (3, 20.0, 10.0, 25.0, 0.0),
        (4, 20.0, 10.0, 0.0, 22.0), (5, 5.0, -11.0, 0.0, 0.0), (6, 5.0, -13.0, 0.0, 0.0),
        (7, 20.0, 10.0, 1.0, 3.0), (8, None, None, None, None), (9, 45.0, -13.0, 30.0, 30.0),
    ]
    df = spark.createDataFrame(rows, "i int, temp_max double, temp_min double, precip_sum double, wind_avg double")
    df = df.withColumns({"city": F.lit("Paris"), "dt": F.lit("2026-07-01").cast("date")})
    limits = weather.thresholds()
    got = {}
    for r in df.select("i", F.inline(weather.extreme_events(limits))).collect():
        got.setdefault(r["i"], []).append((r["event_type"], r["severity"]))
    assert got == {
        1: [("canicule", "alerte")], 2: [("canicule", "extreme")], 3: [("fortes_pluies", "extreme")],
        4: [("vents_violents", "alerte")], 5: [("vague_de_froid", "alerte")], 6: [("vague_de_froid", "extreme")],
        9: [("canicule", "extreme"), ("fortes_pluies", "extreme"), ("vents_violents", "extreme"), ("vague_de_froid", "extreme")],
    }
    detail = df.where("i = 1").select(F.inline(weather.extreme_events(limits))).first()["detail"]
    assert detail == "Paris : 37.2°C le 2026-07-01"


def test_thresholds(spark, monkeypatch):
    assert weather.thresholds() == {"heatwave": 35.0, "heavy_rain": 20.0, "strong_wind": 20.0, "cold_snap": -10.0}
    monkeypatch.setenv("THRESHOLD_HEATWAVE_C", "30")
    assert weather.thresholds()["heatwave"] == 30.0
    assert weather.thresholds_frame(spark).first()["heatwave"] == 30.0


def test_department_and_periods(spark):
    got = apply(spark, ["1", "75", "2a", " 971 "], "v string", text.department_code(F.col("v")))
    assert got == ["01", "75", "2A", "971"]
    with pytest.raises(PySparkException):
        apply(spark, [" "], "v string", text.department_code(F.col("v")))
    periods = storage.periods_for_years(F.col("a"), F.col("b"))
    both = [storage.PERIOD_PREVIOUS, storage.PERIOD_LATEST]
    assert apply(spark, [(2022, 2024), (2025, 2026), (2022, 2026)], "a int, b int", periods) == [both[:1], both[1:], both]
    with pytest.raises(PySparkException):
        apply(spark, [(2026, 2022)], "a int, b int", periods)


def test_path_value(spark):
    given = [("hdfs://x/dt=2025-01-15/_SUCCESS",), ("a/dt=/b",), ("a/b",), (None,)]
    assert apply(spark, given, "v string", text.path_value(F.col("v"), "dt")) == ["2025-01-15", None, None, None]
    assert apply(spark, [("x/month=7",)], "v string", text.path_value(F.col("v"), "month")) == ["7"]


def test_clean_values(spark):
    rows = [(float("nan"),), (float("inf"),), (None,), (0.0,), (3.14159,)]
    df = spark.createDataFrame(rows, "v double")
    assert [r[0] for r in formats.clean_values(df).collect()] == [None, None, None, 0.0, 3.142]


def test_number_text(spark):
    got = apply(spark, [12.34, None, float("nan"), -0.04], "v double", formats.number_text(F.col("v")))
    assert got == ["12.3", "N/A", "N/A", "-0.0"]


def test_byte_size(spark):
    given = [0, 512, 1536, 3 * 1024**2, 5 * 1024**3, None, 3000 * 1024**4]
    assert apply(spark, given, "v long", formats.byte_size(F.col("v"))) == [
        "0 o", "512 o", "1.5 Ko", "3.0 Mo", "5.0 Go", "-", "3000.0 To",
    ]


def test_weather_icon(spark):
    given = [(1.0, 9.0, 0.0, 10.0), (0.0, 5.0, 0.0, 10.0), (None, 0.1, 30.0, 10.0), (0.0, 0.0, 20.0, 35.0),
             (0.0, 0.0, 0.0, 30.0), (0.0, 0.0, 0.0, 2.0), (None, None, None, None)]
    icon = weather.weather_icon(*[F.col(c) for c in "abcd"])
    assert apply(spark, given, "a double, b double, c double, d double", icon) == [
        "snow", "rain", "showers", "wind", "sun", "cold", "cloud",
    ]


def test_event_words(spark):
    given = ["canicule", "vague_de_froid", "neige", "Tempete", "inondation", "brouillard"]
    assert apply(spark, given, "v string", weather.event_group(F.col("v"))) == [
        "Chaleur", "Froid", "Neige", "Vent", "Pluie", "brouillard",
    ]
    assert apply(spark, ["canicule", "fortes_pluies", "vents", "froid", "x"], "v string", weather.event_symbol(F.col("v"))) == [
        "hot", "rain", "wind", "cold", "cloud",
    ]


def test_bands_and_symbols(spark):
    got = apply(spark, [None, -0.1, 0.0, 8.0, 14.0, 20.0, 26.0, 32.0], "v double", weather.temperature_band(F.col("v")))
    assert got == ["unknown", "below_0", "0_8", "8_14", "14_20", "20_26", "26_32", "32_up"]
    given = [(30.0, 6.0), (None, None), (28.0, 5.0), (20.0, None), (0.0, 0.0), (10.0, 0.0)]
    symbol = weather.day_symbol(F.col("a"), F.col("b"))
    assert apply(spark, given, "a double, b double", symbol) == ["rain", "cloud", "hot", "sun", "cold", "cloud"]


def test_confidence(spark):
    error = weather.absolute_error(F.col("a"), F.col("b"))
    given = [(10.0, 12.0), (10.0, 30.0), (None, 5.0)]
    score = weather.confidence(error, F.lit(2.0))
    assert apply(spark, given, "a double, b double", error, score) == [(2.0, 0.8), (20.0, 0.0), (None, 0.8)]


def test_calendar(spark):
    days = [dt.date(2024, 12, 30), dt.date(2024, 1, 7)]
    parts = calendar.calendar_parts(F.col("v"))
    got = apply(spark, days, "v date", *[parts[n] for n in ("year", "week", "dayofweek", "is_weekend")], calendar.iso_year(F.col("v")))
    assert got == [(2024, 1, 0, 0, 2025), (2024, 1, 6, 1, 2024)]
    assert apply(spark, ["2026-08-27 14"], "v string", calendar.hour_dir(F.col("v"), "/live")) == [
        "/live/year=2026/month=08/day=27/hour=14"
    ]
    assert apply(spark, [dt.date(2024, 2, 3), None], "v date", calendar.french_date(F.col("v"))) == ["03 févr. 2024", "-"]


def test_same_text(spark):
    given = [(" Paris", "PARIS "), ("Lyon", "Lille")]
    assert apply(spark, given, "a string, b string", text.same_text(F.col("a"), F.col("b"))) == [True, False]


def random_texts(letters, size, seed, most):
    import random

    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, most))) for _ in range(size)]


def test_parse_number_against_python(spark):
    texts = random_texts("0123456789.,-+eE \tx", 3000, 1, 6) + random_texts("0123456789,", 1000, 2, 8)

    def expected(text):
        try:
            return float(text.strip().replace(",", "."))
        except ValueError:
            return None

    assert apply(spark, texts, "v string", text.parse_number(F.col("v"))) == [expected(t) for t in texts]


def test_parse_date_against_python(spark):
    texts = random_texts("0123", 4000, 3, 8) + [f"2024{m:02d}{d:02d}" for m in range(14) for d in range(33)]
    texts += [f"{y}-02-{d:02d}" for y in (1999, 2000, 2100) for d in range(27, 31)]

    def expected(text):
        digits = text.replace("-", "") if len(text) == 10 else text
        try:
            return dt.date(int(digits[:4]), int(digits[4:6]), int(digits[6:])) if len(digits) == 8 else None
        except ValueError:
            return None

    assert apply(spark, texts, "v string", text.parse_date(F.col("v"))) == [expected(t) for t in texts]


def test_city_name_against_python(spark):
    import random

    rng = random.Random(5)
    words = ["SAINT", "LE", "LA", "LES", "STE", "ST", "BRIEUC", "havre", "Lys", "SUR", "É"]
    names = ["".join(rng.choice(words) + rng.choice(["-", " ", "  "]) for _ in range(rng.randint(1, 5))) for _ in range(500)]

    def expected(name):
        rest, out = " ".join(name.split()).upper(), ""
        while True:
            cut = min([i for i in (rest.find("-"), rest.find(" ")) if i >= 0], default=len(rest))
            word = rest[:cut]
            out += word.capitalize()
            if word not in text.PLACE_PREFIXES or cut == len(rest):
                return out
            out, rest = out + rest[cut], rest[cut + 1:]

    assert apply(spark, names, "v string", text.city_name(F.col("v"))) == [expected(n) for n in names]
