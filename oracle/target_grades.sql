SELECT DISTINCT a.student_id, j.name AS subject, a.grade AS target
FROM (
  SELECT DISTINCT student_id, subject_id, grade_type_id, grade FROM src_attainment_grades
  WHERE CAST(year_group AS INT) BETWEEN 7 AND 11
) AS a
LEFT JOIN (
  SELECT DISTINCT id, name FROM src_attainment_grade_types
  WHERE CAST(year_group AS INT) BETWEEN 7 AND 11
) AS t ON a.grade_type_id IS NOT DISTINCT FROM t.id
LEFT JOIN src_teaching_subjects AS j ON a.subject_id IS NOT DISTINCT FROM j.id
WHERE t.name = 'Target'
