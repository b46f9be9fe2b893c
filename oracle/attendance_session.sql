SELECT * FROM attendance_session_range WHERE date = '2024-01-15' AND session = 'AM'
