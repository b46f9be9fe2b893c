SELECT DISTINCT upn, gfsid, uci, surname_forename_reg, surname_forename_id, surname, forename, gender,
  lac, ethnicity, eal, fsm, pp, wbr_pp, hml_band, sen, sen_notes, keyworker, year_group, reg, subject,
  class, staff_code
FROM class_list_teacher
WHERE regexp_matches(lower(surname_forename_reg), lower('nation_1|NA building'))
