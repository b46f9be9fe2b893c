SELECT * REPLACE (CASE WHEN lesson_mark = chr(92) THEN '/' ELSE lesson_mark END AS lesson_mark)
FROM (
  SELECT DISTINCT k.lesson_id, k.lesson,
    coalesce(k.title, 'NA') || ' ' || coalesce(k.last_name, 'NA') AS teacher, k.room,
    e.upn, s.id AS gfsid,
    coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
      || ' (' || coalesce(e.registration_group, 'NA') || ')' AS surname_forename_reg,
    coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
      || ' (' || coalesce(s.id, 'NA') || ')' AS surname_forename_id,
    s.preferred_last_name AS surname, s.preferred_first_name AS forename, s.sex AS gender,
    k.year_group, e.registration_group AS reg, CAST(m.date AS VARCHAR) AS date,
    k.subject_code AS subject, k.group_code AS class,
    c.code AS lesson_mark, c.label AS lesson_label,
    CAST(m.lesson_minutes_late AS VARCHAR) AS lesson_late_minutes, m.lesson_notes
  FROM src_students AS s
  LEFT JOIN (
    SELECT * FROM src_lesson_marks WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
  ) AS m ON s.id IS NOT DISTINCT FROM m.student_id
  LEFT JOIN src_attendance_codes AS c ON m.lesson_mark_id IS NOT DISTINCT FROM CAST(c.id AS VARCHAR)
  LEFT JOIN src_student_edu_details AS e ON s.id IS NOT DISTINCT FROM e.student_id
  LEFT JOIN (
    SELECT x.id, x.year_group, x.subject_code, x.group_code,
      nullif(array_to_string(x.rooms, ', '), '') AS room, p.name AS lesson_id,
      p.display_name AS lesson, t.title, t.preferred_last_name AS last_name
    FROM (
      SELECT *, unnest(CASE WHEN coalesce(len(teacher_ids), 0) = 0 THEN [NULL] ELSE teacher_ids END)
        AS teacher_id
      FROM src_classes
    ) AS x
    LEFT JOIN src_periods AS p ON x.period_id IS NOT DISTINCT FROM p.period_id
    LEFT JOIN src_teachers AS t ON x.teacher_id IS NOT DISTINCT FROM t.id
  ) AS k ON m.class_id IS NOT DISTINCT FROM k.id
  WHERE m.date IS NOT NULL
) AS marks
ORDER BY date, lesson NULLS LAST, lesson_id NULLS LAST
