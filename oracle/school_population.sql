SELECT y.academic_year, count(s.id) AS n
FROM (SELECT unnest(academic_years) AS academic_year FROM src_school) AS y
LEFT JOIN (
  SELECT academic_year, id FROM src_students
  UNION ALL SELECT academic_year, id FROM src_students_past
) AS s ON s.academic_year = y.academic_year
GROUP BY y.academic_year
