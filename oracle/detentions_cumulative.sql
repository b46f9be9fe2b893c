SELECT *, CAST(sum(n) OVER (PARTITION BY year_group ORDER BY date NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_sum
FROM (SELECT year_group, date, count(*) AS n FROM detentions GROUP BY year_group, date) AS counts
