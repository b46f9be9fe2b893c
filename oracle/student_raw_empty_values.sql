SELECT e.upn, e.student_id AS gfsid, g.name AS key
FROM src_student_edu_details AS e
LEFT JOIN src_student_general AS g ON e.student_id IS NOT DISTINCT FROM g.student_id
