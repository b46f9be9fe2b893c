SELECT DISTINCT e.upn, s.id AS gfsid,
  coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
    || ' (' || coalesce(e.registration_group, 'NA') || ')' AS surname_forename_reg,
  coalesce(upper(s.preferred_last_name), 'NA') || ' ' || coalesce(s.preferred_first_name, 'NA')
    || ' (' || coalesce(s.id, 'NA') || ')' AS surname_forename_id,
  s.preferred_last_name AS surname, s.preferred_first_name AS forename, s.sex AS gender,
  e.national_curriculum_year AS year_group, e.registration_group AS reg,
  CAST(a.possible_sessions AS VARCHAR) AS possible_session, CAST(a.present AS VARCHAR) AS present,
  CAST(a.approved_educational_activity AS VARCHAR) AS approved_ea, CAST(a.late AS VARCHAR) AS late,
  CAST(a.authorised_absence AS VARCHAR) AS authorised_absence,
  CAST(a.unauthorised_absence AS VARCHAR) AS unauthorised_absence,
  CAST(a.attendance_not_required AS VARCHAR) AS attendance_no_required,
  CAST(a.missing_mark AS VARCHAR) AS missing_mark
FROM src_students AS s
LEFT JOIN src_attendance_summary AS a ON s.id IS NOT DISTINCT FROM a.student_id
LEFT JOIN src_student_edu_details AS e ON s.id IS NOT DISTINCT FROM e.student_id
