"""Dates, leads, valid times, month weights, and dates in path templates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def init_dates(spark: SparkSession, start: str, end: str, spacing_days: int = 1, excluded: DataFrame | None = None) -> DataFrame:
    """``init_date`` from start to end, both included (G1); without the excluded ones (P10)."""
    step = F.make_dt_interval(days=F.lit(spacing_days))
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"), step)).alias("init_date"))
    return days if excluded is None else days.join(excluded.select("init_date"), "init_date", "left_anti")


def leads(spark: SparkSession, days: int, step_hours: int) -> DataFrame:
    """``lead`` in hours from 0 to 24 * days."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(24 * days), F.lit(step_hours)).cast("array<int>")).alias("lead"))


def valid_time(init_date: Column, lead: Column) -> Column:
    return init_date + F.make_dt_interval(hours=lead)


def valid_times(dates: DataFrame, lead_table: DataFrame) -> DataFrame:
    """Distinct valid times of all dates and leads (G3, A25). Both tables hold one row a key, so they stay small."""
    every = dates.withColumn("leads", F.lit(1)).join(lead_table.withColumn("leads", F.lit(1)), "leads")
    return every.select(valid_time(F.col("init_date"), F.col("lead")).alias("valid_time")).distinct()


def month_weights(time: Column) -> dict[str, Column]:
    """Months m1, m2 and weights w1, w2 with which monthly means blend at a time.

    A monthly mean stands at the middle of its month; weights fall with the distance. Exactly there both are one half.
    """
    days = F.day(F.last_day(time)).cast("double")
    at = F.day(time) - 1 + F.hour(time) / F.lit(24.0)
    centre = days / 2
    month = F.month(time)
    last = F.day(F.last_day(F.add_months(time, -1))) / F.lit(2.0)
    following = F.day(F.last_day(F.add_months(time, 1))) / F.lit(2.0)
    early, late = at < centre, at > centre
    back, on = centre - at, at - centre
    return {
        "m1": F.when(early, F.pmod(month - 2, F.lit(12)) + 1).otherwise(month).cast("int"),
        "w1": F.when(early, back / (back + at + last)).when(late, 1 - on / (on + following + days - at)).otherwise(F.lit(0.5)),
        "m2": F.when(late, F.pmod(month, F.lit(12)) + 1).otherwise(month).cast("int"),
        "w2": F.when(early, 1 - back / (back + at + last)).when(late, on / (on + following + days - at)).otherwise(F.lit(0.5)),
    }


_TAG = re.compile(r"\{(init|valid)_(YYYYMMDDHH|YYYYMMDD|YYYY|MM|DD|HH)(?:,shift=(-?[0-9]+)([hd]?))?\}")
_FORMAT = {"YYYYMMDDHH": "yyyyMMddHH", "YYYYMMDD": "yyyyMMdd", "YYYY": "yyyy", "MM": "MM", "DD": "dd", "HH": "HH"}


def template_path(template: str, init_date: Column, valid: Column) -> Column:
    """A path template with its date tags filled in (S2, F11); a shift moves the date by hours or days first."""
    parts, end = [], 0
    for m in _TAG.finditer(template):
        parts.append(F.lit(template[end : m.start()]))
        time = init_date if m[1] == "init" else valid
        if m[3]:
            if m[2] == "YYYYMMDDHH":
                raise ValueError(f"{m[0]}: YYYYMMDDHH takes no shift")
            hours = int(m[3]) * (24 if m[4] == "d" else 1)
            time = time + F.make_dt_interval(hours=F.lit(hours))
        parts.append(F.date_format(time, _FORMAT[m[2]]))
        end = m.end()
    return F.concat(*parts, F.lit(template[end:]))


_SIGNS = {"*": "[^/]*", "?": "[^/]"}


def _tag_times(template: str, init_date: Column, valid: Column) -> list[tuple[re.Match, Column]]:
    """The date tags of a template with the time that each writes."""
    if bad := [m[0] for m in _TAG.finditer(template) if m[3] and m[2] == "YYYYMMDDHH"]:
        raise ValueError(f"{bad[0]}: YYYYMMDDHH takes no shift")
    return [(m, (init_date if m[1] == "init" else valid) + F.make_dt_interval(hours=F.lit(int(m[3] or 0) * (24 if m[4] == "d" else 1)))) for m in _TAG.finditer(template)]


def template_pattern(template: str) -> str:
    """A regular expression that whole paths of a template match, with a group for the digits of every date tag."""
    out, end = "^", 0
    literal = lambda text: "".join(_SIGNS.get(c, c if c.isalnum() or c in "/_" else "\\" + c) for c in text)
    for m in _TAG.finditer(template):
        out += literal(template[end : m.start()]) + f"([0-9]{{{len(_FORMAT[m[2]])}}})"
        end = m.end()
    return out + literal(template[end:]) + "$"


def one_reading(template: str) -> bool:
    """Whether a path can be read by a template in one way only: no date tag stands between two stars of one folder's name."""
    for part in _TAG.sub("\0", template).split("/"):
        stars = [k for k, c in enumerate(part) if c == "*"]
        if len(stars) > 1 and "\0" in part[stars[0] : stars[-1]]:
            return False
    return True


def written_stamp(template: str, init_date: Column, valid: Column) -> Column:
    """The digits that a template writes for a date, tag by tag."""
    parts = [F.date_format(time, _FORMAT[m[2]]) for m, time in _tag_times(template, init_date, valid)]
    return F.concat_ws(" ", *parts) if parts else F.lit("")


def read_stamp(template: str, path: Column) -> Column:
    """The digits that a path has in the places of a template's tags; null if it is no path of the template."""
    pattern = template_pattern(template)
    parts = [F.regexp_extract(path, pattern, k + 1) for k in range(len(_TAG.findall(template)))]
    return F.when(path.rlike(pattern), F.concat_ws(" ", *parts) if parts else F.lit(""))


def read_time(template: str, path: Column, which: str) -> Column:
    """The ``init`` or ``valid`` time that a path of a template is of, shifts undone; null if its tags do not tell the day."""
    pattern, digits = template_pattern(template), {}
    for k, m in enumerate(_TAG.finditer(template)):
        if m[1] == which:
            hours = int(m[3] or 0) * (24 if m[4] == "d" else 1)
            text = F.regexp_extract(path, pattern, k + 1)
            for name, at, size in (("YYYY", 1, 4), ("MM", 5, 2), ("DD", 7, 2), ("HH", 9, 2)):
                if m[2] == name:
                    digits.setdefault(hours, {})[name] = text
                elif len(m[2]) > 4 and len(m[2]) >= at + size - 1:
                    digits.setdefault(hours, {})[name] = F.substring(text, at, size)
    for hours, found in digits.items():
        if {"YYYY", "MM", "DD"} <= found.keys():
            time = F.try_to_timestamp(F.concat(found["YYYY"], found["MM"], found["DD"], found.get("HH", F.lit("00"))), F.lit("yyyyMMddHH"))
            return F.when(path.rlike(pattern), time - F.make_dt_interval(hours=F.lit(hours)))
    return F.lit(None).cast("timestamp")


def split_templates(text: str) -> list[str]:
    """Templates of a comma list; commas within braces do not split (S3)."""
    return [t.strip() for t in re.split(r",(?![^{]*\})", text) if t.strip()]


def uses_valid_time(templates: list[str]) -> bool:
    """Whether files hold one lead each (S6); a mixture within a collection is an error."""
    found = {"{valid_" in t for t in templates}
    if len(found) > 1:
        raise ValueError("a collection mixes files of one lead and of several")
    return found == {True}


def parse_time(text: Column) -> Column:
    """A time written in one of several ways (F13); null if in none."""
    formats = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyyMMddHH", "yyyyMMdd", "yyyy-MM-dd")
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats))


def date_labels(time: Column) -> dict[str, Column]:
    """Labels of a date on files and scorecards."""
    return {"day": F.date_format(time, "yyyyMMdd"), "file": F.concat(F.date_format(time, "yyyyMMdd_HH"), F.lit("z")), "hour": F.date_format(time, "yyyyMMddHH")}


def forecast_day(lead: Column) -> Column:
    """Lead in days."""
    return lead / F.lit(24.0)
