SELECT * REPLACE (
  CASE WHEN year_group IN ('7', '8', '9', '10', '11') THEN year_group END AS year_group,
  CAST(date AS DATE) AS date)
FROM behaviour_events WHERE regexp_matches(lower(event_classification), 'detention')
