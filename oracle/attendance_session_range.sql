SELECT * REPLACE (CASE WHEN session_mark = chr(92) THEN '/' ELSE session_mark END AS session_mark)
FROM (
  SELECT DISTINCT e.upn, s.id AS gfsid,
    coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
      || ' (' || coalesce(e.registration_group, 'NA') || ')' AS surname_forename_reg,
    coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
      || ' (' || coalesce(s.id, 'NA') || ')' AS surname_forename_id,
    s.preferred_last_name AS surname, s.preferred_first_name AS forename,
    e.national_curriculum_year AS year_group, e.registration_group AS reg, s.sex AS gender,
    CAST(m.date AS VARCHAR) AS date, m.session, c.code AS session_mark, c.label AS session_label,
    CAST(m.session_minutes_late AS VARCHAR) AS session_late_minutes, m.session_notes
  FROM src_students AS s
  LEFT JOIN (
    SELECT * FROM src_session_marks WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
  ) AS m ON s.id IS NOT DISTINCT FROM m.student_id
  LEFT JOIN src_attendance_codes AS c ON m.session_mark_id IS NOT DISTINCT FROM CAST(c.id AS VARCHAR)
  LEFT JOIN src_student_edu_details AS e ON s.id IS NOT DISTINCT FROM e.student_id
  WHERE m.date IS NOT NULL
) AS marks
