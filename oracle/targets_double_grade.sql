SELECT DISTINCT * EXCLUDE (a, b) REPLACE (
  CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN
    CASE WHEN (a + b) % 2 = 0 THEN CAST((a + b) // 2 AS VARCHAR)
         ELSE CAST((a + b) // 2 AS VARCHAR) || '.5' END
  END AS target
)
FROM (
  SELECT *, TRY_CAST(split_part(target, '/', 1) AS INT) AS a,
    TRY_CAST(nullif(split_part(target, '/', 2), '') AS INT) AS b
  FROM targets_all WHERE subject = 'Combined Science 9-1'
) AS pairs
