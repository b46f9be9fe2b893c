SELECT l.*, k.markbook, k.strand, k.mark, k.max, k.grade
FROM (SELECT DISTINCT * FROM class_list_teacher) AS l
LEFT JOIN (
  SELECT DISTINCT m.student_id, g.name AS class, b.markbook_name AS markbook, b.strand_name AS strand,
    m.mark, m.max, m.grade
  FROM src_marks AS m
  LEFT JOIN src_markbooks AS b ON m.column_id IS NOT DISTINCT FROM b.column_id
  LEFT JOIN (SELECT DISTINCT name, subject_id FROM src_teaching_groups) AS g
    ON b.subject_id IS NOT DISTINCT FROM g.subject_id
) AS k ON l.class IS NOT DISTINCT FROM k.class AND l.gfsid IS NOT DISTINCT FROM k.student_id
