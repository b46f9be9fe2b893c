SELECT DISTINCT g.name AS class, m.student_ids, s.code AS subject_code, t.code AS staff_code
FROM src_teaching_groups AS g
LEFT JOIN src_teaching_groups_students AS m ON g.id IS NOT DISTINCT FROM m.group_id
LEFT JOIN src_teaching_subjects AS s ON g.subject_id IS NOT DISTINCT FROM s.id
LEFT JOIN src_teaching_groups_teachers AS gt ON g.id IS NOT DISTINCT FROM gt.group_id
LEFT JOIN src_teachers AS t ON gt.teacher_ids IS NOT DISTINCT FROM t.id
