SELECT staff_code, year_group, reg, subject, class, upn, gfsid, uci, surname_forename_reg,
  surname_forename_id, surname, forename, gender, lac,
  coalesce(ethnicity, 'Unknown.Ethnicity') AS ethnicity, coalesce(eal, 'False') AS eal, fsm, pp,
  wbr_pp, coalesce(hml_band, 'Unknown.HML') AS hml_band, target, sen, sen_notes, keyworker
FROM (
  SELECT DISTINCT t.code AS staff_code, e.year_group, e.registration_group AS reg, j.name AS subject,
    g.name AS class, e.upn, m.student_ids AS gfsid, w.uci,
    coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
      || ' (' || coalesce(e.registration_group, 'NA') || ')' AS surname_forename_reg,
    coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
      || ' (' || coalesce(m.student_ids, 'NA') || ')' AS surname_forename_id,
    s.preferred_last_name AS surname, s.preferred_first_name AS forename, s.sex AS gender, v.lac,
    v.ethnicity, v.eal, v.fsm, v.pp,
    CASE WHEN v.ethnicity IS NULL OR NOT regexp_matches(lower(v.ethnicity), 'english|scottish|welsh')
         THEN 'False'
         WHEN v.pp IS NULL THEN NULL
         WHEN v.pp = 'True' THEN 'True' ELSE 'False' END AS wbr_pp,
    w.hml_band, a.target, w.sen, w.sen_notes, w.keyworker
  FROM src_teaching_groups AS g
  LEFT JOIN src_teaching_groups_students AS m ON g.id IS NOT DISTINCT FROM m.group_id
  LEFT JOIN src_students AS s ON m.student_ids IS NOT DISTINCT FROM s.id
  LEFT JOIN src_teaching_groups_teachers AS gt ON g.id IS NOT DISTINCT FROM gt.group_id
  LEFT JOIN src_teachers AS t ON gt.teacher_ids IS NOT DISTINCT FROM t.id
  LEFT JOIN src_teaching_subjects AS j ON g.subject_id IS NOT DISTINCT FROM j.id
  LEFT JOIN src_student_edu_details AS e ON m.student_ids IS NOT DISTINCT FROM e.student_id
  LEFT JOIN sensitive_wide AS v ON m.student_ids IS NOT DISTINCT FROM v.student_id
  LEFT JOIN general_wide AS w ON m.student_ids IS NOT DISTINCT FROM w.student_id
  LEFT JOIN target_grades AS a ON m.student_ids IS NOT DISTINCT FROM a.student_id
    AND j.name IS NOT DISTINCT FROM a.subject
) AS wide
