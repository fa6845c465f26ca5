"""Service alerts: newest state, type, delay, summaries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A label and its phrases a line; the first line with a phrase in the text decides.
PHRASES = """
disabled_vehicle: disabled bus | disabled train | disabled trolley | train being removed from service | train being taken out of service | train that was disabled
signal_problem: signal department | signal issue | signal maintenance | signal problem | signal repair | signal work
switch_problem: itch issue | itch problem | switching issue
brake_problem: brake issue | brake problem | brakes activated | brakes applied | brakes holding
power_problem: catenary wires | electrical problem | overhead catenary | overhead wire | overheard wires | overhear wires | power department work | power issue | power problem | repairs to the wire | the overhead | third rail wiring | wire inspection | wire maintenance | wire problem | wire repair
door_problem: door issue | door problem
track_issue: broken rail | cracked rail | track issue | track problem
medical_emergency: ill passenger | medical assistance | medical attention | medical emergency | sick passenger
flooding: flooding
police_activity: police
fire: burning | fire | smoke
mechanical_problem: air pressure problem | issue with the heating system | mechanical issue | mechanical problem | motor problem | pantograph issue | pantograph problem
track_work: maintenance work | overnight maintenance | overnight work | personnel performed maintenance | single track | track maintenance | track repair | track work
car_traffic: accident blocking the tracks | auto accident | auto blocking the track | auto that was blocking | auto was removed from the track | automobile accident | car accident | car blocking the track area | car blocking the tracks | car in the track area | car on the tracks | disabled vehicle on the tracks | due to traffic | unauthorized vehicle on the tracks | vehicle blocking the tracks
"""
KEYWORDS = tuple((label, tuple(x.strip() for x in rest.split("|"))) for label, _, rest in (line.partition(":") for line in PHRASES.split("\n") if line))
KEYWORDS = tuple((label, tuple("witch " + w[5:] if w.startswith("itch ") else w for w in words)) for label, words in KEYWORDS)
CAUSES = dict(
    pair.split("=") for pair in "TECHNICAL_PROBLEM=mechanical_problem ACCIDENT=car_traffic MAINTENANCE=track_work CONSTRUCTION=track_work POLICE_ACTIVITY=police_activity MEDICAL_EMERGENCY=medical_emergency WEATHER=weather STRIKE=strike DEMONSTRATION=demonstration".split()
)
TYPES = (*(label for label, _ in KEYWORDS), "weather", "strike", "demonstration", "other")
DELAY_EFFECTS, UNCLEAR_EFFECTS = ("SIGNIFICANT_DELAYS", "REDUCED_SERVICE"), ("", "UNKNOWN_EFFECT", "OTHER_EFFECT")
MINUTES = (
    r"delays of (?:about|up to) \d+ minutes",
    r"(?:\d+\s*-\s*)?\d+ minutes (?:late|behind schedule)",
)
SEVERITY = ("SEVERE", "WARNING", "INFO")


def alert_type(cause: Column, text: Column) -> Column:
    """a cause that is set decides, one without a label of its own as other; else the first phrase in the text, else other."""
    low = F.lower(F.coalesce(text, F.lit("")))
    by_text = F.lit(None).cast("string")
    for name, words in KEYWORDS:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        by_text = F.coalesce(by_text, F.when(hit, name))
    labels = F.create_map(*[F.lit(x) for pair in CAUSES.items() for x in pair])
    known = ~F.coalesce(cause, F.lit("")).isin("", "UNKNOWN_CAUSE")
    return F.when(known, F.coalesce(F.element_at(labels, cause), F.lit("other"))).otherwise(F.coalesce(by_text, F.lit("other")))


def is_delay(effect: Column, text: Column) -> Column:
    """an effect that is clear decides; else the words of the text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    has = lambda w: F.contains(low, F.lit(w))
    words = (has("delays") & has("minutes")) | has("minutes late") | has("behind schedule")
    effect = F.coalesce(effect, F.lit(""))
    return F.when(effect.isin(*DELAY_EFFECTS), True).when(~effect.isin(*UNCLEAR_EFFECTS), False).otherwise(words)


def delay_minutes(text: Column) -> Column:
    """the largest number in any phrase of minutes; null without one."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = F.concat(*[F.regexp_extract_all(low, F.lit(p), F.lit(0)) for p in MINUTES])
    numbers = F.flatten(F.transform(found, lambda m: F.regexp_extract_all(m, F.lit(r"\d+"), F.lit(0))))
    return F.array_max(F.transform(numbers, lambda x: x.try_cast("int")))


def pick_translation(translations: Column, lang: str = "en", silver: bool = False) -> Column:
    """the exact language, then (not in silver) a variant of it, then the first; none gives '' or, in silver, null."""
    exact = F.filter(translations, lambda t: t["language"] == lang)
    first = [F.get(exact, F.lit(0))["text"]]
    if not silver:
        first.append(F.get(F.filter(translations, lambda t: F.lower(t["language"]).rlike(f"^{lang}[-_]")), F.lit(0))["text"])
    first.append(F.get(translations, F.lit(0))["text"])
    return F.coalesce(*first) if silver else F.coalesce(*first, F.lit(""))


def latest(polls: DataFrame, body: list[str]) -> DataFrame:
    """The newest body of each alert, when it was first and last seen, and in how many polls."""
    newest = F.max_by(F.struct(*body), F.struct("fetched_at", "ord")).alias("__b")
    rows = polls.groupBy("alert_id").agg(newest, F.min("fetched_at").alias("first_seen"), F.max("fetched_at").alias("last_seen"), F.count(F.lit(1)).alias("poll_count"))
    return rows.select("alert_id", "__b.*", "first_seen", "last_seen", "poll_count")


def summary(alerts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Alerts and delay minutes of each type, zero where there are none."""
    keys = keys or []
    spark = alerts.sparkSession
    labels = spark.createDataFrame([(t,) for t in TYPES], "type string")
    grid = alerts.select(*keys).distinct().crossJoin(F.broadcast(labels)) if keys else labels
    got = alerts.groupBy(*keys, "type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("minutes", F.lit(0))).alias("m"))
    rows = grid.join(got, [*keys, "type"], "left")
    return rows.select(*keys, "type", F.coalesce("n", F.lit(0)).cast("long").alias("alert_count"), F.coalesce("m", F.lit(0)).cast("long").alias("delay_minutes"))


def dense_daily(rows: DataFrame, day: str, first: str, last: str, values: list[str], most: int = 62) -> DataFrame:
    """A10: a row for every day of the range, zeros where there is none. An error if its ends are over `most` days apart."""
    if (date.fromisoformat(last) - date.fromisoformat(first)).days > most:
        raise ValueError(f"Range too wide; max {most} days")
    spark = rows.sparkSession
    days = spark.sql(f"SELECT explode(sequence(date'{first}', date'{last}')) AS {day}")
    sums = rows.groupBy(day).agg(*[F.sum(v).alias(v) for v in values])
    return days.join(sums, day, "left").fillna(0, values)


def fan_out(alerts: DataFrame) -> DataFrame:
    """A row for each informed entity; none for an alert without."""
    return alerts.withColumn("entity", F.explode("informed_entity"))


def of_route(alerts: DataFrame, route: str) -> DataFrame:
    """P21."""
    return alerts.filter(F.exists("informed_entity", lambda e: e["route_id"] == route))


def ranked(alerts: DataFrame, n: int = 50) -> DataFrame:
    """The n most severe, newest first; any other severity ranks like none."""
    rank = F.lit(len(SEVERITY))
    for i, name in enumerate(SEVERITY):
        rank = F.when(F.col("severity") == name, i).otherwise(rank)
    return alerts.orderBy(rank, F.desc("last_seen"), "alert_id").limit(n)
