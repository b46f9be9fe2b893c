WITH lookup AS (
  SELECT DISTINCT g.name AS class, s.code AS subject_code, m.student_ids
  FROM src_teaching_groups AS g
  LEFT JOIN src_teaching_groups_students AS m ON g.id IS NOT DISTINCT FROM m.group_id
  LEFT JOIN src_teaching_subjects AS s ON g.subject_id IS NOT DISTINCT FROM s.id
), renamed AS (
  SELECT subject_code, student_ids,
    CASE WHEN subject_code IS NULL THEN NULL
         WHEN subject_code IN ('Ac', 'Al', 'Ap', 'Ea') THEN subject_code ELSE class END AS class
  FROM lookup
), joined AS (
  SELECT DISTINCT b.id, b.event_type_id, b.student_ids, b.created_by, b.subject_code, b.group_name,
    b.event_date, b.created_timestamp, b.room_name, b.school_notes,
    t.name AS event_name, t.code AS event_code, t.significance, t.score, t.event_classification_id,
    i.name AS immediate, i.type AS immediate_type, f.name AS followup, f.type AS followup_type,
    c.name AS classification,
    s.preferred_last_name, s.preferred_first_name, s.sex,
    e.upn, e.national_curriculum_year, e.registration_group,
    u.display_name, u.email_address,
    CASE WHEN b.group_name IS NULL THEN r.class ELSE b.group_name END AS class,
    k.week, k.day_type_code
  FROM src_behaviour_events AS b
  LEFT JOIN src_behaviour_event_types AS t ON b.event_type_id IS NOT DISTINCT FROM t.id
  LEFT JOIN src_behaviour_immediate AS i ON b.event_action_ids IS NOT DISTINCT FROM i.id
  LEFT JOIN src_behaviour_followup AS f ON b.event_followup_type_ids IS NOT DISTINCT FROM f.id
  LEFT JOIN src_behaviour_classification AS c ON t.event_classification_id IS NOT DISTINCT FROM c.id
  LEFT JOIN src_students AS s ON b.student_ids IS NOT DISTINCT FROM s.id
  LEFT JOIN src_student_edu_details AS e ON b.student_ids IS NOT DISTINCT FROM e.student_id
  LEFT JOIN src_staff AS u ON b.created_by IS NOT DISTINCT FROM u.id
  LEFT JOIN renamed AS r ON b.subject_code IS NOT DISTINCT FROM r.subject_code
    AND b.student_ids IS NOT DISTINCT FROM r.student_ids
  LEFT JOIN src_calendar AS k ON b.event_date IS NOT DISTINCT FROM k.date
  WHERE b.event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
), immediate_listed AS (
  SELECT DISTINCT * REPLACE (string_agg(coalesce(immediate, 'NA'), ', ' ORDER BY coalesce(immediate, 'NA'))
    OVER (PARTITION BY id, student_ids ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS immediate)
  FROM joined
), both_listed AS (
  SELECT DISTINCT * REPLACE (string_agg(coalesce(followup, 'NA'), ', ' ORDER BY coalesce(followup, 'NA'))
    OVER (PARTITION BY id, student_ids ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS followup)
  FROM immediate_listed
), shaped AS (
  SELECT DISTINCT nullif(id, 'NA') AS event_id, nullif(display_name, 'NA') AS staff,
    nullif(lower(email_address), 'NA') AS email_staff,
    nullif(national_curriculum_year, 'NA') AS year_group, nullif(subject_code, 'NA') AS subject,
    nullif(class, 'NA') AS class, nullif(room_name, 'NA') AS room, nullif(upn, 'NA') AS upn,
    nullif(student_ids, 'NA') AS gfsid,
    coalesce(upper(preferred_last_name), 'NA') || ' ' || coalesce(preferred_first_name, 'NA')
      || ' (' || coalesce(registration_group, 'NA') || ')' AS surname_forename_reg,
    coalesce(upper(preferred_last_name), 'NA') || ' ' || coalesce(preferred_first_name, 'NA')
      || ' (' || coalesce(student_ids, 'NA') || ')' AS surname_forename_id,
    nullif(preferred_last_name, 'NA') AS surname, nullif(preferred_first_name, 'NA') AS forename,
    nullif(registration_group, 'NA') AS reg, nullif(sex, 'NA') AS gender,
    CAST(event_date AS VARCHAR) AS date, created_timestamp AS timestamp,
    CAST(week AS VARCHAR) AS school_week, nullif(day_type_code, 'NA') AS day_type,
    nullif(event_code, 'NA') AS event_code, nullif(event_name, 'NA') AS event_name,
    nullif(classification, 'NA') AS event_classification,
    nullif(immediate, 'NA') AS action_immediate, nullif(followup, 'NA') AS action_followup,
    nullif(significance, 'NA') AS polarity, CAST(score AS VARCHAR) AS score,
    nullif(school_notes, 'NA') AS school_notes
  FROM both_listed
)
SELECT DISTINCT x.*, d.ethnicity, d.eal, d.fsm, d.fsm6, d.pp, d.wbr_pp, d.hml_band, d.ad_no, d.uci,
  d.sen, d.sen_notes, d.keyworker, d.lac, d.date_admission
FROM shaped AS x
LEFT JOIN student_details AS d ON x.gfsid IS NOT DISTINCT FROM d.gfsid
