SELECT student_id,
  min(value) FILTER (WHERE name = 'Looked after') AS lac,
  min(value) FILTER (WHERE name = 'Ethnicity') AS ethnicity,
  min(value) FILTER (WHERE name = 'EAL') AS eal,
  min(value) FILTER (WHERE name = 'FSM') AS fsm,
  min(value) FILTER (WHERE name = 'FSMEver6') AS fsm6,
  min(value) FILTER (WHERE name = 'Pupil Premium Indicator') AS pp
FROM src_student_sensitive GROUP BY student_id
