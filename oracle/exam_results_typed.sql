SELECT * FROM exam_results_year WHERE regexp_matches(lower(qualification_title), 'gcse|btec')
