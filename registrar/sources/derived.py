"""School tables derived from the order/customer/event test tables.

The derivation is one set of SELECT statements, kept in SQL that Spark and
DuckDB both run, so the checked queries and their SQL twins start from the
same rows. Hard cases are made on purpose: missing attributes and pupils,
null codes that must match null codes, out-of-domain year groups, empty and
multi-valued arrays, unreadable grades, ties.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from registrar.sources.catalog import SchoolCatalog

YEAR = 2023  # the academic year the event table falls in
BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
]


@dataclass(frozen=True)
class Dialect:
    """The few spellings on which the two engines differ."""

    array: str
    empty_array: str
    weekday: str  # 0 = Monday
    quote: str
    sorted_set: str

    def name(self, identifier: str) -> str:
        return f"{self.quote}{identifier}{self.quote}"


SPARK = Dialect(
    array="array({0})",
    empty_array="CAST(array() AS ARRAY<STRING>)",
    weekday="weekday({0})",
    quote="`",
    sorted_set="array_sort(collect_set({0}))",
)
DUCKDB = Dialect(
    array="[{0}]",
    empty_array="CAST([] AS VARCHAR[])",
    weekday="(isodow({0}) - 1)",
    quote='"',
    sorted_set="list_sort(list(DISTINCT {0}))",
)

_BRAND = "CAST(substr(p_brand, 7) AS INT)"
_DAY = "CAST(ts AS DATE)"
_K = "CAST(substr(props, 7, length(props) - 7) AS INT)"


def _subject_code(number: str, otherwise: str) -> str:
    return (
        f"CASE {number} WHEN 1 THEN 'Ac' WHEN 2 THEN 'Al' WHEN 3 THEN 'Ap' WHEN 4 THEN 'Ea' "
        f"WHEN 5 THEN NULL ELSE {otherwise} END"
    )


def _class_name() -> str:
    return (
        "CASE p_size WHEN 2 THEN 'HRB ' || p_partkey WHEN 3 THEN 'HOM ' || p_partkey "
        "WHEN 4 THEN 'EAL ' || p_partkey ELSE p_name || ' ' || p_partkey END"
    )


def _literal_rows(columns: str, rows: list[tuple]) -> str:
    cell = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'"
    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


def _periods(d: Dialect) -> str:
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
    rows = []
    for week, colour in ((1, "R"), (2, "B")):
        for day in days:
            for period in range(1, 6):
                rows.append(
                    (
                        str(len(rows)), f"{colour}{day[:3]}:{period}", f"P{period}", day, week,
                        f"{8 + period:02d}:00", f"{9 + period:02d}:00",
                    )
                )
    rows.append((str(len(rows)), "RMon:6", "P6", "Monday", 1, "15:00", "16:00"))
    return _literal_rows(
        f"period_id, name, display_name, day_of_week, week, {d.name('start')}, {d.name('end')}", rows
    )


def derived_sql(d: Dialect) -> dict[str, str]:
    """SELECT statement for each source table; ``{customer}`` etc. are the inputs."""
    arr = d.array.format
    # One row per pupil taught, with the part that stands for the class.
    lines = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey"
    lines_parts = f"{lines} JOIN {{part}} ON l_partkey = p_partkey"
    student_columns = (
        "CAST(c_custkey AS STRING) AS id, "
        "CASE WHEN c_custkey % 211 = 5 THEN 'NA' ELSE 's' || substr(c_name, 10) END "
        "AS preferred_last_name, "
        "CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_mktsegment END AS preferred_first_name, "
        "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex"
    )
    curriculum_year = "CASE WHEN c_acctbal >= -900 THEN CAST(7 + c_custkey % 6 AS STRING) END"
    behaviour = (
        "CAST(event_id AS STRING) AS id, event_type AS event_type_id, {action} AS event_action_ids, "
        f"CASE WHEN {_K} % 3 = 0 THEN NULL ELSE CAST({_K} % 3 AS STRING) END "
        "AS event_followup_type_ids, CAST(user_id AS STRING) AS student_ids, "
        "CAST(event_id % 12 AS STRING) AS created_by, "
        + _subject_code("(1 + event_id % 25)", "'Brand#' || (1 + event_id % 25)")
        + f" AS subject_code, CASE WHEN {_K} % 2 = 0 THEN NULL ELSE 'G' || {_K} END AS group_name, "
        f"{_DAY} AS event_date, CAST(ts AS STRING) AS created_timestamp, "
        "CASE WHEN event_id % 5 = 0 THEN 'NA' ELSE 'R' || (event_id % 9) END AS room_name, "
        "CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'note ' || (event_id % 6) END AS school_notes"
    )
    marks = (
        "CASE event_type WHEN 'view' THEN '1' WHEN 'click' THEN '2' WHEN 'signup' THEN '3' "
        "WHEN 'purchase' THEN '4' ELSE '5' END"
    )
    mark_date = f"CASE WHEN event_id % 211 = 0 THEN NULL ELSE {_DAY} END"
    late = "CASE WHEN event_type = 'signup' THEN CAST(floor(value) AS INT) END"
    notes = "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'note ' || (event_id % 7) END"
    count_if = lambda c: f"CAST(SUM(CASE WHEN {c} THEN 1 ELSE 0 END) AS INT)"

    return {
        "school": (
            f"SELECT 'Northfield School' AS name, {d.sorted_set.format('y')} AS academic_years, "
            f"{YEAR} AS current_academic_year FROM ("
            "SELECT CAST(year(o_orderdate) AS INT) AS y FROM {orders} UNION ALL "
            "SELECT CAST(max(year(o_orderdate)) + 1 AS INT) FROM {orders} UNION ALL "
            f"SELECT {YEAR}) AS years"
        ),
        "students": f"SELECT {YEAR} AS academic_year, {student_columns} FROM {{customer}}",
        # Pupils of earlier years: one row per year in which the customer ordered.
        "students_past": (
            f"SELECT academic_year, {student_columns} FROM (SELECT DISTINCT "
            "CAST(year(o_orderdate) AS INT) AS academic_year, o_custkey FROM {orders}) AS past "
            "JOIN {customer} ON o_custkey = c_custkey"
        ),
        # Below -900 the details are empty, as for a pupil without a record.
        "student_edu_details": (
            f"SELECT {YEAR} AS academic_year, CAST(c_custkey AS STRING) AS student_id, "
            "CASE WHEN c_acctbal < -900 OR c_acctbal BETWEEN 0 AND 200 THEN NULL "
            "ELSE 'U' || c_custkey END AS upn, "
            f"{curriculum_year} AS national_curriculum_year, {curriculum_year} AS year_group, "
            "CASE WHEN c_acctbal < -900 OR n_nationkey = 17 THEN NULL ELSE n_name END "
            "AS registration_group FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"
        ),
        "student_general": (
            f"SELECT {YEAR} AS academic_year, student_id, "
            "CASE name WHEN 'uci' THEN 'UCI' WHEN 'hml' THEN 'HML Band' "
            "WHEN 'sen' THEN '3.  SEN Code' WHEN 'notes' THEN '4. SEN Notes' "
            "WHEN 'keyworker' THEN '5. Keyworker Name' WHEN 'number' THEN 'Admission number' "
            "WHEN 'admitted' THEN 'Admission date' ELSE '1. Reading Age' END AS name, value, "
            "name IN ('uci', 'number') AS is_system, '' AS remark FROM ("
            "SELECT CAST(c_custkey AS STRING) AS student_id, 'UCI' || c_custkey AS uci, "
            "CASE WHEN c_acctbal < 1000 THEN NULL WHEN c_acctbal < 4000 THEN 'Low' "
            "WHEN c_acctbal < 7000 THEN 'Middle' ELSE 'High' END AS hml, "
            "CASE c_custkey % 4 WHEN 0 THEN 'K' WHEN 1 THEN 'E' END AS sen, "
            "CASE c_custkey % 6 WHEN 0 THEN 'Extra time 25%' WHEN 1 THEN 'Uses Irlen overlay' "
            "WHEN 2 THEN 'extra time and irlen' WHEN 3 THEN 'Reader' END AS notes, "
            "CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE 'KW ' || c_nationkey END AS keyworker, "
            "'A' || c_custkey AS number, '2019-09-0' || (1 + c_custkey % 9) AS admitted, "
            "CAST(8 + c_custkey % 6 AS STRING) AS reading FROM {customer}) AS wide "
            "UNPIVOT (value FOR name IN (uci, hml, sen, notes, keyworker, number, admitted, reading)) AS long "
            # A second value of one attribute, for the duplicate rule.
            f"UNION ALL SELECT {YEAR}, CAST(c_custkey AS STRING), 'HML Band', 'Exceptional', false, '' "
            "FROM {customer} WHERE c_acctbal > 9900"
        ),
        "student_sensitive": (
            f"SELECT {YEAR} AS academic_year, student_id, "
            "CASE name WHEN 'lac' THEN 'Looked after' WHEN 'ethnicity' THEN 'Ethnicity' "
            "WHEN 'eal' THEN 'EAL' WHEN 'fsm' THEN 'FSM' WHEN 'fsm6' THEN 'FSMEver6' "
            "ELSE 'Pupil Premium Indicator' END AS name, value FROM ("
            "SELECT CAST(c_custkey AS STRING) AS student_id, "
            "CASE WHEN c_custkey % 50 = 0 THEN 'True' ELSE 'False' END AS lac, "
            "CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'White - English' "
            "WHEN 2 THEN 'White - Scottish' WHEN 3 THEN 'white welsh' ELSE r_name END AS ethnicity, "
            "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'True' ELSE 'False' END AS eal, "
            "CASE WHEN c_custkey % 3 = 0 THEN 'True' ELSE 'False' END AS fsm, "
            "CASE WHEN c_custkey % 3 < 2 THEN 'True' ELSE 'False' END AS fsm6, "
            "CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'True' WHEN 2 THEN 'True' "
            "ELSE 'False' END AS pp "
            "FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey "
            "JOIN {region} ON n_regionkey = r_regionkey) AS wide "
            "UNPIVOT (value FOR name IN (lac, ethnicity, eal, fsm, fsm6, pp)) AS long"
        ),
        "departments": (
            f"SELECT {YEAR} AS academic_year, 'd' || r_regionkey AS id, r_name AS name FROM {{region}}"
        ),
        "teaching_subjects": (
            f"SELECT {YEAR} AS academic_year, p_brand AS id, "
            "CASE n WHEN 6 THEN 'Combined Science 9-1' ELSE 'Subject ' || n END AS name, "
            f"{_subject_code('n', 'p_brand')} AS code, CAST(7 + n % 5 AS STRING) AS year_group, "
            "CASE n WHEN 7 THEN NULL ELSE 'd' || (n % 5) END AS department_id, "
            "CASE n % 2 WHEN 0 THEN 'GCSE ' || n ELSE 'BTEC ' || n END AS qualification_title "
            f"FROM (SELECT DISTINCT p_brand, {_BRAND} AS n FROM {{part}}) AS brands"
        ),
        "teaching_groups": (
            f"SELECT {YEAR} AS academic_year, CAST(p_partkey AS STRING) AS id, {_class_name()} AS name, "
            "p_brand AS subject_id, p_type AS code FROM {part}"
        ),
        "teaching_groups_students": (
            f"SELECT {YEAR} AS academic_year, CAST(l_partkey AS STRING) AS group_id, "
            f"CAST(o_custkey AS STRING) AS student_ids FROM {lines}"
        ),
        "teaching_groups_teachers": (
            f"SELECT {YEAR} AS academic_year, CAST(p_partkey AS STRING) AS group_id, "
            "CASE WHEN p_size <> 50 THEN CAST(p_partkey % 10 AS STRING) END AS teacher_ids FROM {part} "
            f"UNION ALL SELECT {YEAR}, CAST(p_partkey AS STRING), "
            "CAST((p_partkey + 1) % 10 AS STRING) FROM {part} WHERE p_size = 1"
        ),
        "teachers": (
            f"SELECT {YEAR} AS academic_year, CAST(s_suppkey AS STRING) AS id, "
            "'T' || s_suppkey AS code, CASE s_suppkey % 3 WHEN 0 THEN 'Mr' WHEN 1 THEN 'Ms' END AS title, "
            "s_name AS preferred_last_name, 'F' || s_nationkey AS preferred_first_name FROM {supplier}"
        ),
        "staff": (
            "SELECT CAST(s_suppkey AS STRING) AS id, 'Staff ' || s_suppkey AS display_name, "
            "'Staff.' || s_suppkey || '@School.Example' AS email_address FROM {supplier}"
        ),
        "attainment_grade_types": _literal_rows(
            "academic_year, year_group, id, name",
            [
                (YEAR, str(year_group), str(i + 1), name)
                for year_group in range(7, 13)
                for i, name in enumerate(
                    ["Target", "Autumn", "Spring", "Summer", "Mock", "Effort", "Predicted"]
                )
            ],
        ),
        "attainment_grades": (
            f"SELECT {YEAR} AS academic_year, CAST(o_custkey AS STRING) AS student_id, "
            "p_brand AS subject_id, CAST(l_linenumber AS STRING) AS grade_type_id, "
            f"CASE WHEN {_BRAND} <> 6 THEN CAST(1 + g % 9 AS STRING) "
            "WHEN g % 11 = 0 THEN CAST(1 + g % 9 AS STRING) WHEN g % 11 = 1 THEN 'x/' || (g % 9) "
            "ELSE (1 + g % 9) || '/' || (1 + (g + p_size % 2) % 9) END AS grade, "
            "CAST(7 + o_custkey % 6 AS STRING) AS year_group FROM (SELECT *, "
            f"CAST(l_quantity AS INT) AS g FROM {lines_parts}) AS graded"
        ),
        "exam_results": (
            f"SELECT {YEAR} AS academic_year, CAST(o_custkey AS STRING) AS student_id, "
            "p_brand AS subject_id, CASE l_returnflag WHEN 'R' THEN 'GCSE ' || p_brand "
            "WHEN 'A' THEN 'BTEC ' || p_brand ELSE NULL END AS qualification_title, "
            "CAST(1 + CAST(l_quantity AS INT) % 9 AS STRING) AS grade, "
            f"CAST(7 + o_custkey % 6 AS STRING) AS year_group FROM {lines_parts}"
        ),
        "markbooks": (
            f"SELECT {YEAR} AS academic_year, p_brand AS subject_id, 'Markbook ' || p_type AS markbook_name, "
            "CAST(p_partkey AS STRING) AS column_id, p_name AS strand_name FROM {part}"
        ),
        "marks": (
            f"SELECT {YEAR} AS academic_year, CAST(l_partkey AS STRING) AS column_id, "
            "CAST(o_custkey AS STRING) AS student_id, CAST(CAST(l_quantity AS INT) AS STRING) AS mark, "
            f"l_returnflag AS grade, '50' AS max FROM {lines}"
        ),
        "attendance_codes": (
            f"SELECT {YEAR} AS academic_year, id, CASE id WHEN 1 THEN '/' WHEN 2 THEN chr(92) "
            "WHEN 3 THEN 'L' WHEN 4 THEN 'N' ELSE 'E' END AS code, label FROM ("
            + _literal_rows(
                "id, label",
                [(1, "Present AM"), (2, "Present PM"), (3, "Late"), (4, "No reason yet"), (5, "Excluded")],
            )
            + ") AS codes"
        ),
        "session_marks": (
            f"SELECT {YEAR} AS academic_year, CAST(user_id AS STRING) AS student_id, "
            f"{marks} AS session_mark_id, {mark_date} AS date, "
            "CASE WHEN hour(ts) < 12 THEN 'AM' ELSE 'PM' END AS session, "
            f"{late} AS session_minutes_late, {notes} AS session_notes FROM {{events}}"
        ),
        "lesson_marks": (
            f"SELECT {YEAR} AS academic_year, CAST(user_id AS STRING) AS student_id, "
            "CAST(event_id % 2100 AS STRING) AS class_id, "
            f"{marks} AS lesson_mark_id, {mark_date} AS date, "
            f"{late} AS lesson_minutes_late, {notes} AS lesson_notes FROM {{events}}"
        ),
        "attendance_summary": (
            f"SELECT {YEAR} AS academic_year, CAST(user_id AS STRING) AS student_id, "
            "CAST(COUNT(*) AS INT) AS possible_sessions, "
            + ", ".join(
                f"{count_if(c)} AS {n}"
                for n, c in {
                    "present": "event_type IN ('view', 'click', 'signup')",
                    "approved_educational_activity": "event_type = 'view' AND value > 300",
                    "late": "event_type = 'signup'",
                    "authorised_absence": "event_type = 'error'",
                    "unauthorised_absence": "event_type = 'purchase'",
                    "attendance_not_required": "value < 1",
                    "missing_mark": "event_id % 211 = 0",
                }.items()
            )
            + " FROM {events} GROUP BY user_id"
        ),
        "behaviour_events": (
            f"SELECT {YEAR} AS academic_year, "
            + behaviour.format(
                action=f"CASE WHEN {_K} % 4 = 0 THEN NULL ELSE CAST({_K} % 4 AS STRING) END"
            )
            + " FROM {events} UNION ALL "
            # A second immediate action for some events.
            + f"SELECT {YEAR}, "
            + behaviour.format(action=f"CAST(4 - {_K} % 2 AS STRING)")
            + f" FROM {{events}} WHERE {_K} >= 90"
        ),
        "behaviour_immediate": _literal_rows(
            "academic_year, id, name, type",
            [(YEAR, "1", "Warning", "verbal"), (YEAR, "2", "Moved seat", "room"),
             (YEAR, "3", "Phone call", "home"), (YEAR, "4", "Warning", "written")],
        ),
        "behaviour_followup": _literal_rows(
            "academic_year, id, name, type",
            [(YEAR, "1", "Letter home", "home"), (YEAR, "2", "Report card", "school"),
             (YEAR, "3", "Meeting", "home")],
        ),
        "behaviour_event_types": _literal_rows(
            "academic_year, id, name, code, significance, score, event_classification_id",
            [(YEAR, "view", "Good work", "GW", "Positive", 1, "2"),
             (YEAR, "signup", "Helpful", "HE", "Positive", 2, "2"),
             (YEAR, "click", "Late to lesson", "LL", "Negative", -1, "1"),
             (YEAR, "error", "Disruption", "DI", "Negative", -2, "3"),
             (YEAR, "purchase", "Uniform", "UN", None, 0, None)],
        ),
        "behaviour_classification": _literal_rows(
            "academic_year, id, name",
            [(YEAR, "1", "Detention (lunch)"), (YEAR, "2", "Praise"), (YEAR, "3", "After-school DETENTION")],
        ),
        "calendar": (
            f"SELECT {YEAR} AS academic_year, date, CAST(1 + weekofyear(date) % 2 AS INT) AS week, "
            f"CASE WHEN {d.weekday.format('date')} >= 5 OR date = DATE '2024-01-01' THEN 'CLOSED' "
            "ELSE 'OPEN' END AS day_type_code, 't1' AS timetable_id "
            f"FROM (SELECT DISTINCT {_DAY} AS date FROM {{events}}) AS days"
        ),
        "periods": f"SELECT {YEAR} AS academic_year, p.* FROM ({_periods(d)}) AS p",
        "classes": (
            f"SELECT {YEAR} AS academic_year, CAST(p_partkey AS STRING) AS id, "
            "CAST(p_partkey % 51 AS STRING) AS period_id, "
            f"CASE p_size WHEN 50 THEN {d.empty_array} WHEN 1 THEN "
            + arr("CAST(p_partkey % 10 AS STRING), CAST((p_partkey + 1) % 10 AS STRING)")
            + " ELSE " + arr("CAST(p_partkey % 10 AS STRING)") + " END AS teacher_ids, "
            f"CASE WHEN p_size % 5 = 0 THEN {d.empty_array} "
            "WHEN p_size % 11 = 0 OR p_size IN (2, 3, 4) THEN NULL "
            "WHEN p_size = 13 THEN " + arr("'c(' || chr(34) || 'L' || p_partkey || chr(34) || ')'")
            + " WHEN p_size % 7 = 0 THEN " + arr("'R' || (p_partkey % 90), 'R' || (p_partkey % 90 + 1)")
            + " ELSE " + arr("'R' || (p_partkey % 90)") + " END AS rooms, "
            f"CASE WHEN p_size = 9 THEN '12' ELSE CAST(7 + {_BRAND} % 5 AS STRING) END AS year_group, "
            f"{_subject_code(_BRAND, 'p_brand')} AS subject_code, "
            f"CASE WHEN p_size = 8 THEN NULL ELSE {_class_name()} END AS group_code FROM {{part}}"
        ),
        "student_classes": (
            f"SELECT {YEAR} AS academic_year, CAST(l_partkey AS STRING) AS class_id, "
            "CAST(o_custkey AS STRING) AS student_id, "
            "CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN NULL "
            f"ELSE CAST(o_orderdate AS DATE) END AS {d.name('start')}, "
            "CASE l_returnflag WHEN 'A' THEN NULL WHEN 'R' THEN DATE '2023-12-15' "
            f"ELSE DATE '2024-08-31' END AS {d.name('end')} FROM {lines}"
        ),
        "documents": "SELECT CAST(doc_id AS STRING) AS doc_id, text, lang, source FROM {documents}",
    }


class DerivedSchool(SchoolCatalog):
    """Catalog over a directory of the test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark)
        self._sf_dir = sf_dir
        self._sql = derived_sql(SPARK)
        self._base: dict[str, DataFrame] = {}

    def _input(self, table: str) -> DataFrame:
        if table not in self._base:
            self._base[table] = self.spark.read.parquet(f"{self._sf_dir}/{table}.parquet")
        return self._base[table]

    def _select(self, name: str) -> DataFrame:
        statement = self._sql[name]
        inputs = {t: self._input(t) for t in BASE_TABLES if f"{{{t}}}" in statement}
        return self.spark.sql(statement, **inputs)

    def _read(self, name: str, academic_year: int | None) -> DataFrame:
        if name == "students" and academic_year != YEAR:
            past = self._select("students_past")
            return past if academic_year is not None else past.unionByName(self._select("students"))
        return self._select(name)
