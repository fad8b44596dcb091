"""Daily text reports.

Reports exist first as lines, one row each with their place in the document,
so that any number of days is one distributed job. ``documents`` then joins
the lines of each day; a day holds a line per city and source, so its size is
bounded by the network, not by the history.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obslake.functions.formats import number_text
from obslake.plans import ledger
from obslake.session import settle
from obslake.sources import versions
from obslake.sources.sinks import append_rows

# The sections of the context text and the sentences around them.
CONTEXT_OPENING = [
    "Tu es un présentateur météo professionnel francophone.",
    "Rédige un bulletin météo en français, clair et structuré, à partir des données ci-dessous.",
    "",
]
CONTEXT_SECTIONS = [
    ("### CONDITIONS OBSERVÉES (2 derniers jours) ###", "(aucune donnée d'agrégat disponible)"),
    ("### ÉVÉNEMENTS NOTABLES (2 derniers jours) ###", "Aucun événement notable."),
    ("### PRÉVISIONS 24H (modèle ML) ###", "(aucune prédiction ML disponible)"),
]
CONTEXT_CLOSING = [
    "Consignes de rédaction :",
    "- Résume les conditions par ville : température, précipitations, vent.",
    "- Mentionne les événements notables s'il y en a.",
    "- Donne la tendance des 24 prochaines heures à partir des prédictions ML.",
    "- Ton professionnel, phrases complètes, sans inventer de chiffres.",
]
CONTEXT_COLUMNS = [
    ("dt", "city", "temp_avg", "temp_min", "temp_max", "precip_sum", "wind_avg", "snow_sum"),
    ("dt", "city", "event_type", "severity", "value", "threshold", "detail"),
    ("dt", "city", "temp_predicted", "confidence", "temp_actual"),
]
# The sentences of the rule-based bulletin.
BULLETIN_TITLE = "Bulletin automatique (fallback)"
BULLETIN_OPENING = "Bulletin météo du %s :"
BULLETIN_SECTIONS = [
    ("- Conditions observées :", "- Données d'agrégat indisponibles pour cette date."),
    ("- Événements notables :", "- Aucun événement météo notable signalé."),
    ("- Prévisions 24h (modèle ML) :", "- Prévisions 24h : aucune prédiction ML disponible."),
]
OBSERVED_LINE = (
    "  • %s : %s °C en moyenne (min %s / max %s), précipitations %s mm, vent moyen %s km/h."
)
EVENT_LINE = "  • %s (%s) à %s : %s"
FORECAST_LINE = "  • %s : température prévue %s °C (confiance %s)."
BULLETIN_CLOSING = "(Bulletin généré automatiquement sans modèle de langage.)"


#: lines of a part of a report
PART_LINES = 1000


def _day(column: str = "dt") -> Column:
    return F.col(column).cast("date")


def two_days(df: DataFrame) -> DataFrame:
    """Each row under its own day and under the next: ``report_dt``, ``own``."""
    spread = F.explode(
        F.array(
            F.struct(_day().alias("report_dt"), F.lit(True).alias("own")),
            F.struct(F.date_add(_day(), 1).alias("report_dt"), F.lit(False).alias("own")),
        )
    )
    return df.withColumn("_at", spread).select("*", "_at.*").drop("_at")


def report_days(daily: DataFrame) -> DataFrame:
    return daily.select(_day().alias("report_dt")).where(F.col("report_dt").isNotNull()).distinct()


def day_context(daily: DataFrame, events: DataFrame, forecasts: DataFrame) -> DataFrame:
    """How many observed rows, events and forecasts each day has."""

    def per_day(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(_day().alias("dt")).agg(F.count(F.lit(1)).alias(name))

    joined = per_day(daily, "n_observed").join(per_day(events, "n_events"), "dt", "full_outer")
    counts = joined.join(per_day(forecasts, "n_forecasts"), "dt", "full_outer")
    return counts.fillna(0)


def _filled(template: str, *cells: Column) -> Column:
    """The template with a cell in place of each ``%s``."""
    texts = template.split("%s")
    return F.concat(F.lit(texts[0]), *[x for cell, text in zip(cells, texts[1:], strict=True) for x in (cell, F.lit(text))])


def _lines(df: DataFrame, section: int, text: Column, by_day: bool = True) -> DataFrame:
    """One line per row, placed by its day and then by its own text."""
    place = F.coalesce(_day().cast("string"), F.lit("")) if by_day else F.lit("")
    return df.select("report_dt", F.lit(section).alias("section"), place.alias("place"), text.alias("line"))


def _framed(body: DataFrame, days: DataFrame, frame: Callable[[list[Column]], list[tuple]]) -> DataFrame:
    """The rows of ``body`` on the given days together with their framing lines.

    ``frame`` gets, for each of the three sections, whether the day has rows
    in it, and returns (section, lines) pairs. There is one day per row here,
    so both joins are with a lookup that the calendar bounds.
    """
    counts = body.groupBy("report_dt").agg(
        *[F.count_if(F.col("section") == 100 * i + 10).alias(f"_n{i}") for i in (1, 2, 3)]
    )
    filled = [F.coalesce(f"_n{i}", F.lit(0)) > 0 for i in (1, 2, 3)]
    lines = []
    for section, texts in frame(filled):
        for i, text in enumerate(texts):
            line = F.lit(text) if isinstance(text, str) else text
            lines.append(
                F.struct(
                    F.lit(section).alias("section"), F.lit(f"{i:03d}").alias("place"), line.alias("line")
                )
            )
    fixed = days.join(counts, "report_dt", "left").select("report_dt", F.inline(F.array(*lines)))
    kept = body.join(F.broadcast(days), "report_dt", "left_semi")
    return fixed.where(F.col("line").isNotNull()).unionByName(kept)


def _preferred_rows(daily: DataFrame) -> DataFrame:
    """The day's own rows where it has some, else those of the day before."""
    rows = two_days(daily)
    own = F.broadcast(report_days(daily))
    return rows.where("own").unionByName(rows.where("NOT own").join(own, "report_dt", "left_anti"))


def bulletin_lines(
    daily: DataFrame, events: DataFrame, forecasts: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """Lines of the rule-based bulletin of every day."""
    days = report_days(daily) if days is None else days
    name = F.coalesce("city", F.lit("?"))
    figures = [number_text(F.col(c)) for c in ("temp_avg", "temp_min", "temp_max", "precip_sum", "wind_avg")]
    event = _filled(
        EVENT_LINE, F.coalesce("event_type", F.lit("événement")), F.coalesce("severity", F.lit("?")),
        name, F.coalesce("detail", F.lit("")),
    )
    forecast = _filled(
        FORECAST_LINE, name, number_text(F.col("temp_predicted")), number_text(F.col("confidence"), 2)
    )
    observed = _filled(OBSERVED_LINE, name, *figures)
    body = [
        _lines(_preferred_rows(daily), 110, observed, by_day=False),
        # texts are made before a row is given to two days
        _lines(two_days(events.select("dt", F.rtrim(event).alias("text"))), 210, F.col("text")),
        _lines(two_days(forecasts.select("dt", forecast.alias("text"))), 310, F.col("text")),
    ]

    def frame(filled: list[Column]) -> list[tuple]:
        opening = F.format_string(BULLETIN_OPENING, F.date_format("report_dt", "yyyy-MM-dd"))
        heads = [
            (100 * i, [F.when(has, head).otherwise(missing)])
            for i, (has, (head, missing)) in enumerate(zip(filled, BULLETIN_SECTIONS), start=1)
        ]
        return [(0, [BULLETIN_TITLE, "", opening]), *heads, (900, ["", BULLETIN_CLOSING])]

    return _framed(reduce(DataFrame.unionByName, body), days, frame)


def context_lines(
    daily: DataFrame, events: DataFrame, forecasts: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """Lines of the context text of every day: figures with two, confidence with three decimals."""
    days = report_days(daily) if days is None else days
    body, titles = [], []
    for number, (df, names) in enumerate(zip((daily, events, forecasts), CONTEXT_COLUMNS), start=1):
        shown = [c for c in names if c in df.columns]
        titles.append(" | ".join(shown))
        cells = F.concat_ws(" | ", *[_cell(df, c) for c in shown])
        body.append(_lines(two_days(df.select("dt", cells.alias("text"))), 100 * number + 10, F.col("text")))

    def frame(filled: list[Column]) -> list[tuple]:
        out = [(0, CONTEXT_OPENING)]
        for i, (has, title) in enumerate(zip(filled, titles), start=1):
            head, missing = CONTEXT_SECTIONS[i - 1]
            out += [(100 * i, [head, F.when(has, title).otherwise(missing)]), (100 * i + 90, [""])]
        return [*out, (900, CONTEXT_CLOSING)]

    return _framed(reduce(DataFrame.unionByName, body), days, frame)


def _cell(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    if kind == "double":
        digits = 3 if name == "confidence" else 2
        return number_text(F.col(name), digits, "NaN")
    return F.coalesce(F.col(name).cast("string"), F.lit("None"))


def documents(lines: DataFrame, part_lines: int = PART_LINES) -> DataFrame:
    """The text of each day in ordered parts of at most ``part_lines`` lines: ``dt``, ``part``, ``text``.

    The lines of all days are brought into one order by ranges, and counted by range, so a day with many
    lines spans many tasks and none holds more than a part's lines as one text. A line's number within its range is
    the place it was written at, so only the ranges' counts are joined; each day has a share in few of them.
    """
    order = ["report_dt", "section", "place", "line"]
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    # fixed, so that the counts and the rows see the same ranges
    placed = settle(ordered.select("report_dt", "line", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at")))
    counts = placed.groupBy("report_dt", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("report_dt").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "report_dt", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_before")
    )
    numbered = placed.join(F.broadcast(starts), ["report_dt", "_range"]).withColumn("_row", F.col("_before") + F.col("_at"))
    part = F.floor(F.col("_row") / part_lines).cast("int").alias("part")
    ordered = F.array_sort(F.collect_list(F.struct("_row", "line")))
    text = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    return numbered.groupBy("report_dt", part).agg(text.alias("text")).select(
        F.date_format("report_dt", "yyyy-MM-dd").alias("dt"), "part", "text"
    )


def bulletin_records(texts: DataFrame, model: str = "fallback", source: str = "rules") -> DataFrame:
    """The stored form of the bulletins."""
    return texts.select(
        "dt", "part", F.col("text").alias("bulletin"), F.lit(model).alias("model"), F.lit(source).alias("source"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at"),
    )


def write_bulletins(
    spark: SparkSession,
    daily: DataFrame,
    events: DataFrame,
    forecasts: DataFrame,
    path: str,
    ledger_path: str,
    force: bool = False,
) -> None:
    """Adds the bulletins of the days not done yet, or of all days when forced.

    Below a versioned root a day's bulletin is replaced, so a run that died before it marked its days and is
    repeated leaves one bulletin a day. A run that finds every day done makes no line.
    """
    keys = report_days(daily).withColumn("key", F.date_format("report_dt", "yyyy-MM-dd"))
    if not force:
        keys = ledger.pending(keys, ledger.read_ledger(spark, ledger_path), "bulletin")
    keys = settle(keys)
    if keys.isEmpty():
        return
    lines = bulletin_lines(daily, events, forecasts, keys.select("report_dt"))
    records = bulletin_records(documents(lines))
    if versions.is_versioned(spark, path):
        root, table = versions.split(path)
        with versions.Change(spark, root) as change:
            change.replace(table, records.withColumn("day", F.col("dt")), ["day"])
    else:
        append_rows(records, path)
    ledger.mark(spark, ledger_path, "bulletin", keys)
