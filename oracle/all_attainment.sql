SELECT DISTINCT a.requested, c.staff_code, e.year_group, j.name AS subject, c.class, e.upn,
  a.student_id AS gfsid,
  coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
    || ' (' || coalesce(e.registration_group, 'NA') || ')' AS surname_forename_reg,
  coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
    || ' (' || coalesce(a.student_id, 'NA') || ')' AS surname_forename_id,
  s.preferred_last_name AS surname, s.preferred_first_name AS forename,
  e.registration_group AS reg, s.sex AS gender, t.name AS grade_type, a.grade
FROM (
  SELECT DISTINCT student_id, subject_id, grade_type_id, grade, year_group AS requested
  FROM src_attainment_grades
) AS a
LEFT JOIN (
  SELECT DISTINCT id, name FROM src_attainment_grade_types
) AS t ON a.grade_type_id IS NOT DISTINCT FROM t.id
LEFT JOIN src_teaching_subjects AS j ON a.subject_id IS NOT DISTINCT FROM j.id
LEFT JOIN src_students AS s ON a.student_id IS NOT DISTINCT FROM s.id
LEFT JOIN src_student_edu_details AS e ON a.student_id IS NOT DISTINCT FROM e.student_id
LEFT JOIN class_staff AS c ON a.student_id IS NOT DISTINCT FROM c.student_ids
  AND j.code IS NOT DISTINCT FROM c.subject_code
