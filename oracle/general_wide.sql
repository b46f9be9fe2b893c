SELECT student_id,
  min(value) FILTER (WHERE name = 'Admission number') AS ad_no,
  min(value) FILTER (WHERE name = 'UCI') AS uci,
  min(value) FILTER (WHERE name = 'HML Band') AS hml_band,
  min(value) FILTER (WHERE name = '3.  SEN Code') AS sen,
  min(value) FILTER (WHERE name = '4. SEN Notes') AS sen_notes,
  min(value) FILTER (WHERE name = '5. Keyworker Name') AS keyworker,
  min(value) FILTER (WHERE name = 'Admission date') AS date_admission
FROM src_student_general GROUP BY student_id
