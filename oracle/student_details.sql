SELECT year_group, upn, gfsid, surname_forename_reg, surname_forename_id, surname, forename, reg,
  gender, coalesce(ethnicity, 'Unknown.Ethnicity') AS ethnicity, coalesce(eal, 'False') AS eal,
  fsm, fsm6, pp, wbr_pp, coalesce(hml_band, 'Unknown.HML') AS hml_band, ad_no, uci, sen, sen_notes,
  keyworker, lac, date_admission
FROM (
  SELECT DISTINCT e.national_curriculum_year AS year_group, e.upn, s.id AS gfsid,
    coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
      || ' (' || coalesce(e.registration_group, 'NA') || ')' AS surname_forename_reg,
    coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
      || ' (' || coalesce(s.id, 'NA') || ')' AS surname_forename_id,
    s.preferred_last_name AS surname, s.preferred_first_name AS forename,
    e.registration_group AS reg, s.sex AS gender, v.ethnicity, v.eal, v.fsm, v.fsm6, v.pp,
    CASE WHEN v.ethnicity IS NULL OR NOT regexp_matches(lower(v.ethnicity), 'english|scottish|welsh')
         THEN 'False'
         WHEN v.pp IS NULL THEN NULL
         WHEN v.pp = 'True' THEN 'True' ELSE 'False' END AS wbr_pp,
    g.hml_band, g.ad_no, g.uci, g.sen, g.sen_notes, g.keyworker, v.lac, g.date_admission
  FROM src_students AS s
  LEFT JOIN src_student_edu_details AS e ON s.id IS NOT DISTINCT FROM e.student_id
  LEFT JOIN general_wide AS g ON s.id IS NOT DISTINCT FROM g.student_id
  LEFT JOIN sensitive_wide AS v ON s.id IS NOT DISTINCT FROM v.student_id
) AS wide
