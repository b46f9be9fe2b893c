"""Declared columns of the source tables.

Every table except ``staff`` also has a partition column ``academic_year INT``;
fact tables are best partitioned by ``date`` as well, and grade tables by
``year_group``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_DDL = {
    "school": "name STRING, academic_years ARRAY<INT>, current_academic_year INT",
    "students": "id STRING, preferred_last_name STRING, preferred_first_name STRING, sex STRING",
    "student_general": "student_id STRING, name STRING, value STRING, is_system BOOLEAN",
    "student_edu_details": "student_id STRING, upn STRING, national_curriculum_year STRING, "
    "year_group STRING, registration_group STRING",
    "student_sensitive": "student_id STRING, name STRING, value STRING",
    "student_classes": "class_id STRING, student_id STRING, start DATE, end DATE",
    "exam_results": "student_id STRING, subject_id STRING, qualification_title STRING, "
    "grade STRING, year_group STRING",
    "attainment_grades": "student_id STRING, subject_id STRING, grade_type_id STRING, "
    "grade STRING, year_group STRING",
    "attainment_grade_types": "id STRING, name STRING, year_group STRING",
    "markbooks": "subject_id STRING, markbook_name STRING, column_id STRING, strand_name STRING",
    "marks": "column_id STRING, student_id STRING, mark STRING, grade STRING, max STRING",
    "teaching_subjects": "id STRING, name STRING, code STRING, year_group STRING, "
    "department_id STRING, qualification_title STRING",
    "teaching_groups": "id STRING, name STRING, subject_id STRING, code STRING",
    "teaching_groups_students": "group_id STRING, student_ids STRING",
    "teaching_groups_teachers": "group_id STRING, teacher_ids STRING",
    "teachers": "id STRING, code STRING, title STRING, preferred_last_name STRING, "
    "preferred_first_name STRING",
    "departments": "id STRING, name STRING",
    "attendance_codes": "id INT, code STRING, label STRING",
    "session_marks": "student_id STRING, session_mark_id STRING, date DATE, session STRING, "
    "session_minutes_late INT, session_notes STRING",
    "lesson_marks": "student_id STRING, class_id STRING, lesson_mark_id STRING, date DATE, "
    "lesson_minutes_late INT, lesson_notes STRING",
    "attendance_summary": "student_id STRING, possible_sessions INT, present INT, "
    "approved_educational_activity INT, late INT, authorised_absence INT, "
    "unauthorised_absence INT, attendance_not_required INT, missing_mark INT",
    "behaviour_events": "id STRING, event_type_id STRING, event_action_ids STRING, "
    "event_followup_type_ids STRING, student_ids STRING, created_by STRING, subject_code STRING, "
    "group_name STRING, event_date DATE, created_timestamp STRING, room_name STRING, "
    "school_notes STRING",
    "behaviour_followup": "id STRING, name STRING, type STRING",
    "behaviour_immediate": "id STRING, name STRING, type STRING",
    "behaviour_event_types": "id STRING, name STRING, code STRING, significance STRING, "
    "score INT, event_classification_id STRING",
    "behaviour_classification": "id STRING, name STRING",
    "staff": "id STRING, display_name STRING, email_address STRING",
    "calendar": "date DATE, week INT, day_type_code STRING, timetable_id STRING",
    "classes": "id STRING, period_id STRING, teacher_ids ARRAY<STRING>, rooms ARRAY<STRING>, "
    "year_group STRING, subject_code STRING, group_code STRING",
    "periods": "period_id STRING, name STRING, display_name STRING, day_of_week STRING, "
    "week INT, start STRING, end STRING",
    "documents": "doc_id STRING, text STRING",
}

WITHOUT_YEAR = {"school", "staff", "documents"}

# Date column of the fact tables, used for range predicates.
DATE_COLUMN = {
    "session_marks": "date",
    "lesson_marks": "date",
    "behaviour_events": "event_date",
}


def _schema(ddl: str) -> T.StructType:
    fields = T.StructType()
    depth, start, parts = 0, 0, []
    for i, ch in enumerate(ddl):
        depth += {"<": 1, ">": -1}.get(ch, 0)
        if ch == "," and depth == 0:
            parts.append(ddl[start:i])
            start = i + 1
    for part in [*parts, ddl[start:]]:
        name, type_name = part.split()
        fields.add(name, _TYPES[type_name])
    return fields


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "DATE": T.DateType(),
    "BOOLEAN": T.BooleanType(),
    "ARRAY<INT>": T.ArrayType(T.IntegerType()),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
}

SOURCES: dict[str, T.StructType] = {name: _schema(ddl) for name, ddl in _DDL.items()}
