SELECT DISTINCT * EXCLUDE (requested) FROM all_attainment
WHERE CAST(requested AS INT) BETWEEN 7 AND 11
