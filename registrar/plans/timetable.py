"""The live timetable of every pupil."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrar.functions.semantics import WEEK_COLOURS, WEEKDAYS, YEAR_GROUPS, ifelse, in_domain, matches
from registrar.operators.joins import (
    inner_join,
    left_join,
    left_join_many,
    left_join_where,
    same_where_met,
    with_hash_key,
)
from registrar.plans.students import student_details
from registrar.sources.catalog import SchoolCatalog

# Fixed values.
OPEN_DAY = "OPEN"
CLASS_ROOMS = {"HRB": "HRB", "HOM": "HOME", "EAL": "EAL"}  # class name holds -> room
SUBJECT_ROOMS = {"AC": ["Ac", "Al"], "AP": ["Ap"]}  # room -> subject codes
ROOM_NOISE = [r"c\(", r"\)", '"', r"\\"]
LESSON_CODES = [
    f"{colour[0]}{day[:3]}:{period}"
    for colour in WEEK_COLOURS
    for day in WEEKDAYS
    for period in range(1, 6)
]

_SLOT = ["upn", "lesson_id"]
_PUPIL_KEY = ["__pupil", "__no_pupil"]
_PLACE = ["period_id", "class_id", "room_number"]

COLUMNS = [
    "staff_code", "week_colour", "day", "lesson_id", "period", "room", "department",
    "subject_name", "subject_code", "year_group", "class", "lesson_start", "lesson_end", "upn",
    "gfsid", "surname_forename_reg", "surname_forename_id", "surname", "forename", "reg",
    "gender", "ethnicity", "eal", "fsm", "fsm6", "pp", "wbr_pp", "hml_band", "sen",
]


def _open_days(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    return (
        cat.rows("calendar", academic_year)
        .filter(F.col("day_type_code") == OPEN_DAY)
        .select("date", "week", F.date_format("date", "EEEE").alias("day"))
    )


def _periods(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    return cat.rows("periods", academic_year).select(
        "period_id", F.col("name").alias("lesson_id"), F.col("display_name").alias("period"),
        F.col("day_of_week").alias("day"), "week", F.col("start").alias("lesson_start"),
        F.col("end").alias("lesson_end"),
    )


def _slot_dates(open_days: DataFrame, periods: DataFrame) -> DataFrame:
    """The dates that can tell rows of a lesson apart: (period, date).

    A lesson meets on every open day of its week and weekday, with the same
    rows each time. From the second day on, the room carried in from the day
    before no longer changes, so two days stand for all of them. A lesson
    name used for several weekdays keeps all its days.
    """
    ranked = open_days.select("week", "day", "date").distinct().withColumn(
        "nth", F.row_number().over(Window.partitionBy("week", "day").orderBy("date"))
    )
    meetings = periods.groupBy("lesson_id").agg(
        F.count_distinct(F.struct("week", "day")).alias("meetings")
    )
    slots = inner_join(periods.select("period_id", "lesson_id", "week", "day"), meetings, ["lesson_id"])
    dated = inner_join(slots, ranked, ["week", "day"])
    return dated.filter((F.col("nth") <= 2) | (F.col("meetings") > 1)).select(
        "period_id", "lesson_id", "date"
    ).distinct()


def _first_room() -> Column:
    """Room by rule where the class has none."""
    room = F.col("room")
    for part, name in CLASS_ROOMS.items():
        held = matches(F.col("class"), part, ignore_case=False)
        room = F.when(room.isNull() & held, F.lit(name)).otherwise(room)
    for name, codes in SUBJECT_ROOMS.items():
        held = F.coalesce(F.col("subject_code").isin(codes), F.lit(False))
        room = F.when(room.isNull() & held, F.lit(name)).otherwise(room)
    return room


def _classes(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    """One row per class, room and teacher; a class keeps its row without them."""
    classes = cat.rows("classes", academic_year).select(
        F.col("id").alias("class_id"), "period_id", "teacher_ids", "year_group", "subject_code",
        F.col("group_code").alias("class"), F.posexplode_outer("rooms").alias("room_number", "room"),
    )
    return classes.withColumn("room", _first_room()).select(
        "*", F.explode_outer("teacher_ids").alias("teacher_id")
    ).drop("teacher_ids")


def _slots(rows: DataFrame, slot_dates: DataFrame) -> DataFrame:
    """Rows of a pupil's lesson with the room carried forward to them and the
    latest start among the lesson's live enrolments.

    The rows are put by pupil and lesson once, before their dates multiply
    them, and all the rest happens there. Rows that tie in the order are of
    one place and have one room. A row with a room of its own has it on every
    date, and is given for the first one only.
    """
    live_start = F.when(F.col("live"), F.col("student_start"))
    put = rows.repartition(*_SLOT)
    lesson = Window.partitionBy("period_id", "lesson_id")
    slot_dates = slot_dates.withColumn("again", F.col("date") > F.min("date").over(lesson))
    dated = inner_join(put, slot_dates, ["period_id", "lesson_id"])
    slot = Window.partitionBy(*_SLOT)
    so_far = slot.orderBy(
        *[F.col(c).asc_nulls_last() for c in ("date", "class_id", "room_number", "room")]
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    unknown = F.count_if(F.col("live") & F.col("student_start").isNull())
    slots = dated.select(
        *rows.columns,
        "again",
        F.last("room", ignorenulls=True).over(so_far).alias("carried"),
        # A missing start makes the latest start unknown.
        F.when(unknown.over(slot) == 0, F.max(live_start).over(slot)).alias("latest"),
    )
    return slots.filter(F.col("room").isNull() | ~F.col("again")).drop("again")


def _room_text(room: Column) -> Column:
    for noise in ROOM_NOISE:
        room = F.regexp_replace(room, noise, "")
    return room


def timetable(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    """Latest live timetable row of every pupil and lesson.

    Rooms come from the class, from rules on class and subject, and from the
    room last used in the pupil's lesson. Ended enrolments are dropped and
    the latest start per pupil and lesson is kept.
    """
    open_days = _open_days(cat, academic_year)
    periods = _periods(cat, academic_year)
    slot_dates = _slot_dates(open_days, periods)
    last_day = open_days.select(F.max("date")).scalar()

    enrolments = cat.rows("student_classes", academic_year).select(
        "class_id", "student_id", F.col("start").alias("student_start"), F.col("end").alias("student_end")
    )
    teachers = cat.rows("teachers", academic_year).select(
        F.col("id").alias("teacher_id"), F.col("code").alias("staff_code")
    )
    groups = cat.rows("teaching_groups", academic_year).select(
        F.col("name").alias("class"), "subject_id"
    )
    subject_names = cat.rows("teaching_subjects", academic_year).select(
        F.col("id").alias("subject_id"), F.col("name").alias("subject_name"),
        F.col("code").alias("subject_code"), "year_group", "department_id",
    )
    departments = cat.rows("departments", academic_year).select(
        F.col("id").alias("department_id"), F.col("name").alias("department")
    )
    details = (
        student_details(cat, academic_year)
        .withColumnRenamed("gfsid", "student_id")
        .select("student_id", "upn", *COLUMNS[COLUMNS.index("surname_forename_reg"):])
        .distinct()
    )

    # Lessons that never meet, and meetings without a class, end up dropped:
    # inner joins. What tells places apart goes with the enrolments; the wide
    # class columns are joined to the rows that remain.
    lessons = inner_join(
        periods.select("period_id", "lesson_id"), slot_dates.select("period_id").distinct(), ["period_id"]
    )
    classes = _classes(cat, academic_year)
    sites = classes.select(*_PLACE, "room", F.col("class").isNotNull().alias("named")).distinct()
    sites = inner_join(sites, lessons.distinct(), ["period_id"])
    rows = left_join_many(sites, enrolments, ["class_id"])
    rows = left_join(rows, details.select("student_id", "upn").distinct(), ["student_id"])
    rows = rows.withColumn(
        "live",
        F.col("named")
        & F.col("lesson_id").isNotNull()
        & (F.col("student_end").isNull() | (F.col("student_end") > last_day)),
    ).drop("student_end", "named")

    latest = _slots(rows, slot_dates).filter(F.col("live") & (F.col("student_start") == F.col("latest")))
    latest = latest.select(*_SLOT, *_PLACE, "room", "student_id", "carried")
    taught = left_join(classes.filter(F.col("class").isNotNull()), teachers, ["teacher_id"])
    taught = left_join(taught, groups, ["class"])
    taught = left_join(taught, subject_names, ["subject_id", "subject_code", "year_group"])
    taught = left_join(taught, departments, ["department_id"])
    taught = taught.select(
        *_PLACE, "room", "staff_code", "department", "subject_name", "subject_code", "year_group", "class"
    )
    latest = inner_join(latest, taught, [*_PLACE, "room"]).drop("class_id", "room_number", "room")
    # Put by pupil once: there they get the lesson's columns, are made distinct and meet the details.
    latest = with_hash_key(latest, "student_id", *_PUPIL_KEY).repartition(*_PUPIL_KEY)
    latest = inner_join(latest, periods, ["period_id", "lesson_id"])
    colour = ifelse(
        F.col("week") == 1,
        WEEK_COLOURS[0],
        F.when(F.col("week") == 2, F.lit(WEEK_COLOURS[1])),
    )
    shaped = latest.select(
        "staff_code",
        colour.alias("week_colour"),
        in_domain(F.col("day"), WEEKDAYS).alias("day"),
        in_domain(F.col("lesson_id"), LESSON_CODES).alias("lesson_id"),
        "period",
        F.col("carried").alias("room"),
        "department",
        "subject_name",
        "subject_code",
        in_domain(F.col("year_group"), YEAR_GROUPS).alias("year_group"),
        "class",
        "lesson_start",
        "lesson_end",
        "upn",
        *_PUPIL_KEY,
    ).distinct()
    # Distinct rows joined to distinct details stay distinct. The room text is
    # tidied last, as two spellings of a room stay two rows.
    details = with_hash_key(details, "student_id", *_PUPIL_KEY).withColumnRenamed("upn", "details_upn")
    same_upn = same_where_met(F.col("upn"), F.col("details_upn"))
    df = left_join_where(shaped, details, _PUPIL_KEY, same_upn, never_null=True)
    value, missing = _PUPIL_KEY
    df = df.withColumn("room", _room_text(F.col("room")))
    return df.withColumn("gfsid", F.when(~F.col(missing), F.col(value))).select(*COLUMNS)
