SELECT staff_code, year_group, qualification_title, subject, class, upn, gfsid, surname_forename_reg,
  surname_forename_id, surname, forename, reg, gender, pp,
  coalesce(hml_band, 'Unknown.HML') AS hml_band, grade_type, grade
FROM (
  SELECT DISTINCT c.staff_code, e.year_group, r.qualification_title, j.name AS subject, c.class, e.upn,
    r.student_id AS gfsid,
    coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
      || ' (' || coalesce(e.registration_group, 'NA') || ')' AS surname_forename_reg,
    coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
      || ' (' || coalesce(r.student_id, 'NA') || ')' AS surname_forename_id,
    s.preferred_last_name AS surname, s.preferred_first_name AS forename,
    e.registration_group AS reg, s.sex AS gender, v.pp, g.hml_band,
    'External examination' AS grade_type, r.grade
  FROM src_exam_results AS r
  LEFT JOIN src_teaching_subjects AS j ON r.subject_id IS NOT DISTINCT FROM j.id
  LEFT JOIN src_students AS s ON r.student_id IS NOT DISTINCT FROM s.id
  LEFT JOIN src_student_edu_details AS e ON r.student_id IS NOT DISTINCT FROM e.student_id
  LEFT JOIN general_wide AS g ON r.student_id IS NOT DISTINCT FROM g.student_id
  LEFT JOIN sensitive_wide AS v ON r.student_id IS NOT DISTINCT FROM v.student_id
  LEFT JOIN class_staff AS c ON r.student_id IS NOT DISTINCT FROM c.student_ids
    AND j.code IS NOT DISTINCT FROM c.subject_code
  WHERE r.year_group = '11'
) AS wide
