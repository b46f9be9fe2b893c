SELECT year_group, upn, gfsid, surname_forename_reg, surname_forename_id, gender, eal, fsm, fsm6, pp,
  wbr_pp, hml_band, uci, sen, sen_notes, keyworker, lac
FROM student_details
WHERE regexp_matches(lower(sen_notes), 'extra time')
ORDER BY TRY_CAST(year_group AS DOUBLE) NULLS LAST
