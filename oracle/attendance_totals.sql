SELECT m.student_id, CAST(count(*) AS INT) AS possible_sessions,
  CAST(count(*) FILTER (WHERE c.code IN ('/', chr(92), 'L')) AS INT) AS present,
  CAST(count(*) FILTER (WHERE c.code IN ('B', 'P', 'V', 'W')) AS INT) AS approved_educational_activity,
  CAST(count(*) FILTER (WHERE c.code = 'L') AS INT) AS late,
  CAST(count(*) FILTER (WHERE c.code IN ('C', 'E', 'H', 'I', 'M', 'R', 'S', 'T')) AS INT)
    AS authorised_absence,
  CAST(count(*) FILTER (WHERE c.code IN ('G', 'N', 'O', 'U')) AS INT) AS unauthorised_absence,
  CAST(count(*) FILTER (WHERE c.code IN ('X', 'Y', 'Z', '#')) AS INT) AS attendance_not_required,
  CAST(count(*) FILTER (WHERE c.code IS NULL) AS INT) AS missing_mark
FROM src_session_marks AS m
LEFT JOIN src_attendance_codes AS c ON m.session_mark_id IS NOT DISTINCT FROM CAST(c.id AS VARCHAR)
WHERE m.date IS NOT NULL
GROUP BY m.student_id
