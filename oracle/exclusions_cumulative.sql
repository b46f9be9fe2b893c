SELECT *, CAST(sum(n) OVER (PARTITION BY year_group
    ORDER BY date NULLS LAST, upn NULLS LAST, surname_forename_id NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_sum
FROM (
  SELECT CASE WHEN year_group IN ('7', '8', '9', '10', '11') THEN year_group END AS year_group,
    CAST(date AS DATE) AS date, upn, surname_forename_id, count(*) AS n
  FROM attendance_session_range WHERE session_mark = 'E'
  GROUP BY 1, 2, 3, 4
) AS counts
