"""Rooms and students: four reports.

Students are reduced to one row per room before they meet the rooms, so a
room with very many students costs no more than any other in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from millrace.functions.dates import whole_years
from millrace.operators.joins import child_counts
from millrace.plans.registry import job
from millrace.plans.roles import AS_OF, Roles
from millrace.session import scratch_dir

# SQL steps the checks share: students with their room's name and age.
_AGES = f"""ages as (select room, sex, name, extract(year from age(date '{AS_OF}', birthday)) as years
    from v_students, v_rooms where room = v_rooms.id)"""


def room_summary(students: DataFrame, as_of: str) -> DataFrame:
    """One row per room with everything the reports need.

    A report that uses a part of it scans and aggregates only that part.
    """
    years = whole_years(F.lit(as_of).cast("date"), F.col("birthday"))
    ages = students.select("room", "sex", years.alias("years"))
    return ages.groupBy("room").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("years").alias("years"),
        F.min("years").alias("youngest"),
        F.max("years").alias("oldest"),
        F.min("sex").alias("low_sex"),
        F.max("sex").alias("high_sex"),
    )


def student_counts(rooms: DataFrame, summary: DataFrame) -> DataFrame:
    """Students per room, empty rooms included; rooms of one name stay apart."""
    joined = rooms.join(summary, rooms["id"] == summary["room"], "left")
    return joined.select("name", F.coalesce("n", F.lit(0)).alias("student_count"))


def _by_name(rooms: DataFrame, summary: DataFrame) -> GroupedData:
    return rooms.join(summary, rooms["id"] == summary["room"]).groupBy("name")


def smallest_mean_ages(rooms: DataFrame, summary: DataFrame, k: int = 5) -> DataFrame:
    """Rooms by name with the smallest mean age, floored before the sort."""
    mean = F.floor(F.sum("years") / F.sum("n")).cast("bigint")
    return _by_name(rooms, summary).agg(mean.alias("avg_age")).orderBy("avg_age", "name").limit(k)


def largest_age_gaps(rooms: DataFrame, summary: DataFrame, k: int = 5) -> DataFrame:
    gap = (F.max("oldest") - F.min("youngest")).cast("bigint")
    gaps = _by_name(rooms, summary).agg(gap.alias("age_dif"))
    return gaps.orderBy(F.desc("age_dif"), "name").limit(k)


def mixed_sex_rooms(rooms: DataFrame, summary: DataFrame) -> DataFrame:
    mixed = F.min("low_sex") < F.max("high_sex")
    return _by_name(rooms, summary).agg(mixed.alias("mixed")).where("mixed").select("name")


def room_reports(rooms: DataFrame, students: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """The four reports by name, none of them run yet.

    They share the room summary. It is written once to the shared scratch
    folder, so the students are scanned once and not by each report.
    """
    path = scratch_dir(rooms.sparkSession, "room-summary")
    room_summary(students, as_of).write.parquet(path)
    summary = rooms.sparkSession.read.parquet(path)
    return {
        "rooms_student_count": student_counts(rooms, summary),
        "smallest_avg_age_5": smallest_mean_ages(rooms, summary),
        "largest_age_dif_5": largest_age_gaps(rooms, summary),
        "dif_sex_rooms": mixed_sex_rooms(rooms, summary),
    }


COUNT_SQL = """select name, coalesce(n, 0) as student_count from v_rooms
    left join (select room as id, count(*) as n from v_students group by room) using (id)"""
YOUNG_SQL = f"""with {_AGES}
    select name, cast(floor(avg(years)) as bigint) as avg_age from ages group by name order by avg_age, name limit 5"""
GAP_SQL = f"""with {_AGES}
    select name, max(years) - min(years) as age_dif from ages group by name order by age_dif desc, name limit 5"""
MIXED_SQL = f"""with {_AGES} select name from ages group by name having count(distinct sex) > 1"""
ALL_REPORTS_SQL = f"""with counted as ({COUNT_SQL}), young as ({YOUNG_SQL}), gaps as ({GAP_SQL}),
    mixed as ({MIXED_SQL}),
    reports as (
    select 'rooms_student_count' as report, name, student_count as value from counted
    union all select 'smallest_avg_age_5', name, avg_age from young
    union all select 'largest_age_dif_5', name, age_dif from gaps
    union all select 'dif_sex_rooms', name, null from mixed)"""


@job(COUNT_SQL)
def rooms_student_count(t: Roles) -> DataFrame:
    return student_counts(t.rooms, room_summary(t.students, AS_OF))


@job(COUNT_SQL)
def join_left_zero(t: Roles) -> DataFrame:
    """The general operator: children counted per key before the outer join."""
    return child_counts(t.rooms, "id", t.students, "room", "student_count").select("name", "student_count")


@job(YOUNG_SQL)
def smallest_avg_age_5(t: Roles) -> DataFrame:
    return smallest_mean_ages(t.rooms, room_summary(t.students, AS_OF))


@job(GAP_SQL)
def largest_age_dif_5(t: Roles) -> DataFrame:
    return largest_age_gaps(t.rooms, room_summary(t.students, AS_OF))


@job(MIXED_SQL)
def dif_sex_rooms(t: Roles) -> DataFrame:
    return mixed_sex_rooms(t.rooms, room_summary(t.students, AS_OF))


@job(ALL_REPORTS_SQL + " select report, count(*) as row_count from reports group by report")
def report_bundle(t: Roles) -> DataFrame:
    """The bundle as one frame: rows per report."""
    rows = None
    for name, report in room_reports(t.rooms, t.students, AS_OF).items():
        sized = report.agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("row_count"))
        rows = sized if rows is None else rows.unionAll(sized)
    return rows
