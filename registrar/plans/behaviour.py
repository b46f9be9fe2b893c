"""Behaviour events, exclusions and detentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrar.functions.semantics import (
    PUPIL_DEFAULTS,
    SPECIAL_SUBJECT_CODES,
    YEAR_GROUPS,
    all_text,
    ifelse,
    in_domain,
    matches,
    na_cells_to_null,
    na_text,
)
from registrar.operators.collapse import repeated_list_text
from registrar.operators.joins import inner_join, left_join, left_join_many, natural_left_join
from registrar.operators.running import running_total
from registrar.plans.attendance import attendance_session_range
from registrar.plans.common import (
    GENERAL_FULL,
    SENSITIVE_FULL,
    group_members,
    join_pupils,
    pupil_dim,
    pupil_texts,
    subjects,
)
from registrar.plans.students import DETAIL_COLUMNS, student_details
from registrar.sources.catalog import SchoolCatalog

# Fixed values.
EXCLUSION_MARK = "E"
DETENTION_PATTERN = "detention"

EVENT_COLUMNS = [
    "event_id", "staff", "email_staff", "year_group", "subject", "class", "room", "upn", "gfsid",
    "surname_forename_reg", "surname_forename_id", "surname", "forename", "reg", "gender", "date",
    "timestamp", "school_week", "day_type", "event_code", "event_name", "event_classification",
    "action_immediate", "action_followup", "polarity", "score", "school_notes",
]
DEMOGRAPHIC_COLUMNS = DETAIL_COLUMNS[DETAIL_COLUMNS.index("ethnicity"):]

_GROUP = ["event_id", "student_id"]


def _event_rows(
    cat: SchoolCatalog, academic_year: int, dates: tuple[str, str], classified: str | None = None
) -> DataFrame:
    """Events with everything that hangs on them except pupil and class.

    One row per event and pupil, with the set of its (immediate action,
    follow-up) pairs in ``actions``: at most as many as the school's two
    action lists have combinations. They are grouped on the event's own
    columns; the small lists (types, staff, calendar) come after the shuffle.
    With ``classified`` only events of which some row's classification matches
    the pattern are read any further.
    """
    events = cat.rows("behaviour_events", academic_year, dates=dates).select(
        F.col("id").alias("event_id"), "event_type_id", "event_action_ids",
        "event_followup_type_ids", F.col("student_ids").alias("student_id"), "created_by",
        "subject_code", "group_name", "event_date", "created_timestamp", "room_name",
        "school_notes",
    )
    types = cat.rows("behaviour_event_types", academic_year).select(
        F.col("id").alias("event_type_id"), F.col("name").alias("event_name"),
        F.col("code").alias("event_code"), "significance", "score", "event_classification_id",
    )
    classification = cat.rows("behaviour_classification", academic_year).select(
        F.col("id").alias("event_classification_id"), F.col("name").alias("event_classification")
    )
    types = left_join(types, classification, ["event_classification_id"]).distinct()
    if classified is not None:
        named = types.filter(matches(F.col("event_classification"), classified))
        found = inner_join(events.select(*_GROUP, "event_type_id"), named.select("event_type_id").distinct(), ["event_type_id"])
        events = inner_join(events, found.select(*_GROUP).distinct(), _GROUP)
    immediate = cat.rows("behaviour_immediate", academic_year).select(
        F.col("id").alias("event_action_ids"), F.col("name").alias("immediate"),
        F.col("type").alias("immediate_type"),
    )
    followup = cat.rows("behaviour_followup", academic_year).select(
        F.col("id").alias("event_followup_type_ids"), F.col("name").alias("followup"),
        F.col("type").alias("followup_type"),
    )
    staff = cat.rows("staff").select(
        F.col("id").alias("created_by"), F.col("display_name").alias("staff"), "email_address"
    )
    calendar = cat.rows("calendar", academic_year).select(
        F.col("date").alias("event_date"), F.col("week").alias("school_week"),
        F.col("day_type_code").alias("day_type"),
    )
    df = left_join(events, immediate, ["event_action_ids"])
    df = left_join(df, followup, ["event_followup_type_ids"])
    pair = ["immediate", "immediate_type", "followup", "followup_type"]
    own = [c for c in df.columns if c not in (*pair, "event_action_ids", "event_followup_type_ids")]
    df = df.groupBy(*own).agg(F.collect_set(F.struct(*pair)).alias("actions"))
    # The lists are distinct, so the rows stay so.
    df = left_join(df, types, ["event_type_id"])
    df = left_join(df, staff.distinct(), ["created_by"])
    return left_join(df, calendar.distinct(), ["event_date"])


def _class_lookup(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    """Distinct (subject code, pupil, class); special subjects are their own class."""
    groups = cat.rows("teaching_groups", academic_year).select(
        F.col("id").alias("group_id"), F.col("name").alias("class"), "subject_id"
    )
    groups = left_join(groups, subjects(cat, academic_year), ["subject_id"])
    groups = groups.select("group_id", "class", "subject_code").distinct()
    special = F.col("subject_code").isin(SPECIAL_SUBJECT_CODES)
    return (
        left_join_many(groups, group_members(cat, academic_year), ["group_id"])
        .select("class", "subject_code", "student_id")
        # A null code is neither special nor not: its class is missing.
        .withColumn("class", ifelse(special, F.col("subject_code"), F.col("class")))
        .distinct()
    )


def _action_lists(events: DataFrame, distinct_actions: bool) -> DataFrame:
    """Immediate and follow-up actions of each event and pupil, as text.

    ``events`` has a column ``copies``: how often the event's row repeats once
    class and pupil details are attached, which the lists count. Immediate
    actions are listed over all pairs; follow-ups over the pairs that are
    left once the immediate names no longer tell them apart.
    """
    immediate = F.transform("actions", lambda a: _entry("immediate", a["immediate"]))
    narrowed = F.array_distinct(
        F.transform("actions", lambda a: F.struct(a["immediate_type"], a["followup"], a["followup_type"]))
    )
    followup = F.transform(narrowed, lambda a: _entry("followup", a["followup"]))
    entries = events.select(*_GROUP, "copies", F.inline(F.concat(immediate, followup)))
    # Hot groups shrink to one counter per action name before they meet.
    counts = entries.groupBy(*_GROUP, "list", "name").agg(F.sum("copies").alias("copies"))

    def text(which: str, output: str) -> Column:
        entry = F.struct("name", "copies")
        collected = F.collect_list(F.when(F.col("list") == which, entry))
        return repeated_list_text(collected, distinct_actions).alias(output)

    return counts.groupBy(*_GROUP).agg(
        text("immediate", "action_immediate"), text("followup", "action_followup")
    )


def _entry(which: str, name: Column) -> Column:
    return F.struct(F.lit(which).alias("list"), na_text(name).alias("name"))


def behaviour_events_range(
    cat: SchoolCatalog,
    academic_year: int,
    date_start: str,
    date_end: str,
    distinct_actions: bool = False,
) -> DataFrame:
    """Behaviour events of a date range, a row per event, pupil and class.

    Actions are comma lists. By default a name repeats once for each row it
    stood on, as immediate actions and follow-ups multiply each other;
    ``distinct_actions`` lists each once.
    """
    return _behaviour(cat, academic_year, (date_start, date_end), distinct_actions)


def _behaviour(
    cat: SchoolCatalog,
    academic_year: int,
    dates: tuple[str, str],
    distinct_actions: bool = False,
    classified: str | None = None,
) -> DataFrame:
    events = _event_rows(cat, academic_year, dates, classified)
    lookup = _class_lookup(cat, academic_year)
    identity = ["upn", "national_curriculum_year", "registration_group"]
    # An attribute row more or less does not change how often a pupil stands on roll and details.
    narrow = pupil_dim(cat, academic_year, identity)
    lists = _action_lists(_with_copies(events, lookup, narrow), distinct_actions)
    df = _facts(events, lookup, lists)
    if classified is not None:
        df = df.filter(matches(F.col("event_classification"), classified))
    pupils = pupil_dim(cat, academic_year, identity, GENERAL_FULL, SENSITIVE_FULL)
    # Distinct before the wide pupil columns, which are distinct themselves.
    df = join_pupils(cat, df, _pupil_columns(pupils))
    df = df.withColumns(pupil_texts()).withColumnRenamed("student_id", "gfsid")
    return df.select(*EVENT_COLUMNS, *DEMOGRAPHIC_COLUMNS)


def _facts(events: DataFrame, lookup: DataFrame, lists: DataFrame | None) -> DataFrame:
    """Distinct rows of event, class and pupil id, as text, with the action lists if given.

    Only events without a class of their own look one up; the lookup is
    distinct, so a pupil's subject has at most as many rows as classes.
    """
    wanted = F.when(F.col("group_name").isNull(), F.lit(True)).otherwise(F.lit(False))
    if lists is not None:
        # True of every row. It reads ``actions`` here as well, so that this branch and that of
        # the lists ask for one and the same aggregate, whose exchange is then run once.
        events = events.filter(F.size("actions") > 0)
    df = left_join(
        events.drop("actions").withColumn("looked_up", wanted),
        lookup.withColumn("looked_up", F.lit(True)),
        ["subject_code", "student_id", "looked_up"],
    )
    actions = []
    if lists is not None:
        df = left_join(df, lists, _GROUP)
        actions = ["action_immediate", "action_followup"]
    df = df.select(
        "event_id",
        "staff",
        F.lower("email_address").alias("email_staff"),
        F.col("subject_code").alias("subject"),
        F.coalesce("group_name", "class").alias("class"),
        F.col("room_name").alias("room"),
        "student_id",
        F.col("event_date").alias("date"),
        F.col("created_timestamp").alias("timestamp"),
        "school_week",
        "day_type",
        "event_code",
        "event_name",
        "event_classification",
        *actions,
        F.col("significance").alias("polarity"),
        "score",
        "school_notes",
    )
    return na_cells_to_null(all_text(df)).distinct()


def _with_copies(events: DataFrame, lookup: DataFrame, pupils: DataFrame) -> DataFrame:
    """How often each event's row repeats once class and pupil details are
    attached: worked out from counts, without attaching anything wide."""
    class_key = ["subject_code", "student_id"]
    class_count = lookup.groupBy(*class_key).agg(F.count("*").alias("classes"))
    pupil_count = pupils.groupBy("student_id").agg(F.count("*").alias("details"))
    df = left_join(
        events.select(*_GROUP, "subject_code", "group_name", "actions"), class_count, class_key
    )
    df = left_join(df, pupil_count, ["student_id"])
    classes = F.when(F.col("group_name").isNull(), F.coalesce("classes", F.lit(1))).otherwise(1)
    return df.withColumn("copies", classes * F.coalesce("details", F.lit(1)))


def _pupil_columns(pupils: DataFrame) -> DataFrame:
    """Identity and demographics as the events show them.

    Demographics belong to pupils on the roll, with gaps filled there.
    """
    filled = {c: F.coalesce(c, F.lit(v)) for c, v in PUPIL_DEFAULTS.items()}
    demographics = [
        F.when(F.col("on_roll"), filled.get(c, F.col(c))).alias(c) for c in DEMOGRAPHIC_COLUMNS
    ]
    identity = {
        "year_group": "national_curriculum_year",
        "upn": "upn",
        "surname": "preferred_last_name",
        "forename": "preferred_first_name",
        "reg": "registration_group",
        "gender": "sex",
    }
    return pupils.select(
        "student_id",
        "surname_forename_reg",
        "surname_forename_id",
        *[F.nullif(F.col(c), F.lit("NA")).alias(n) for n, c in identity.items()],
        *demographics,
    )


def exclusions(
    cat: SchoolCatalog, academic_year: int, date_start: str, date_end: str
) -> DataFrame:
    """Excluded sessions with pupil details, joined on every shared column."""
    year_group = in_domain(F.col("year_group"), YEAR_GROUPS)
    marks = attendance_session_range(cat, academic_year, date_start, date_end)
    excluded = marks.filter(F.col("session_mark") == EXCLUSION_MARK)
    details = student_details(cat, academic_year)
    return natural_left_join(
        excluded.withColumn("year_group", year_group), details.withColumn("year_group", year_group)
    )


def exclusions_cumulative(
    cat: SchoolCatalog, academic_year: int, date_start: str, date_end: str
) -> DataFrame:
    """Excluded sessions per pupil and day, with a running total per year group."""
    marks = attendance_session_range(cat, academic_year, date_start, date_end)
    counts = (
        marks.filter(F.col("session_mark") == EXCLUSION_MARK)
        .select(
            in_domain(F.col("year_group"), YEAR_GROUPS).alias("year_group"),
            F.to_date("date").alias("date"),
            "upn",
            "surname_forename_id",
        )
        .groupBy("year_group", "date", "upn", "surname_forename_id")
        .agg(F.count("*").alias("n"))
    )
    return running_total(
        counts, ["year_group"], ["date", "upn", "surname_forename_id"], "n", "cum_sum"
    )


def detentions(
    cat: SchoolCatalog, academic_year: int, date_start: str, date_end: str
) -> DataFrame:
    """Behaviour events classified as any kind of detention."""
    found = _behaviour(
        cat, academic_year, (date_start, date_end), classified=DETENTION_PATTERN
    )
    return found.withColumns(
        {
            "year_group": in_domain(F.col("year_group"), YEAR_GROUPS),
            "date": F.to_date("date"),
        }
    )


def detentions_cumulative(
    cat: SchoolCatalog, academic_year: int, date_start: str, date_end: str
) -> DataFrame:
    """Detentions per year group and day, with a running total.

    Counted first, on rows without the action lists and the pupil attributes,
    which have one value each for an event and pupil: the window then holds one row
    per day of the range for each year group, however many events there are.
    """
    events = _event_rows(cat, academic_year, (date_start, date_end), DETENTION_PATTERN)
    facts = _facts(events, _class_lookup(cat, academic_year), None)
    facts = facts.filter(matches(F.col("event_classification"), DETENTION_PATTERN))
    pupils = pupil_dim(
        cat, academic_year, ["upn", "national_curriculum_year", "registration_group"]
    ).select("student_id", F.nullif("national_curriculum_year", F.lit("NA")).alias("year_group"))
    counts = (
        join_pupils(cat, facts.select("student_id", "date"), pupils)
        .groupBy(in_domain(F.col("year_group"), YEAR_GROUPS).alias("year_group"), F.to_date("date").alias("date"))
        .agg(F.count("*").alias("n"))
    )
    window = (
        Window.partitionBy("year_group")
        .orderBy(F.col("date").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return counts.withColumn("cum_sum", F.sum("n").over(window))
