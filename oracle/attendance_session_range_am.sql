SELECT * FROM attendance_session_range WHERE session = 'AM'
