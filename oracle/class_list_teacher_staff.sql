SELECT * FROM class_list_teacher WHERE staff_code IN ('T3', 'T7')
