SELECT * FROM attendance_lesson_range WHERE date = '2024-01-15' ORDER BY lesson NULLS LAST
