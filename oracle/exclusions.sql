SELECT m.* EXCLUDE (year_group_checked) REPLACE (m.year_group_checked AS year_group),
  d.ethnicity, d.eal, d.fsm, d.fsm6, d.pp, d.wbr_pp, d.hml_band, d.ad_no, d.uci, d.sen, d.sen_notes,
  d.keyworker, d.lac, d.date_admission
FROM (
  SELECT *, CASE WHEN year_group IN ('7', '8', '9', '10', '11') THEN year_group END
    AS year_group_checked
  FROM attendance_session_range WHERE session_mark = 'E'
) AS m
LEFT JOIN (
  SELECT *, CASE WHEN year_group IN ('7', '8', '9', '10', '11') THEN year_group END AS year_group_checked
  FROM student_details
) AS d ON m.year_group_checked IS NOT DISTINCT FROM d.year_group_checked
  AND m.upn IS NOT DISTINCT FROM d.upn AND m.gfsid IS NOT DISTINCT FROM d.gfsid
  AND m.surname_forename_reg IS NOT DISTINCT FROM d.surname_forename_reg
  AND m.surname_forename_id IS NOT DISTINCT FROM d.surname_forename_id
  AND m.surname IS NOT DISTINCT FROM d.surname AND m.forename IS NOT DISTINCT FROM d.forename
  AND m.reg IS NOT DISTINCT FROM d.reg AND m.gender IS NOT DISTINCT FROM d.gender
