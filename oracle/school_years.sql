SELECT name, unnest(academic_years) AS academic_year, current_academic_year FROM src_school
