SELECT DISTINCT staff_code,
  CASE year_group WHEN '11' THEN 'c' || 2023 WHEN '10' THEN 'c' || 2024 WHEN '9' THEN 'c' || 2025
    WHEN '8' THEN 'c' || 2026 WHEN '7' THEN 'c' || 2027 END AS ac_year,
  CASE WHEN year_group IN ('7', '8', '9', '10', '11') THEN year_group END AS year_group,
  subject, class, upn, gfsid, surname_forename_reg, surname_forename_id, gender, reg, ethnicity, pp,
  wbr_pp, hml_band, sen, sen_notes, target
FROM class_list_teacher
