SELECT * FROM exam_results_year
