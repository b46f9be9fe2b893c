WITH open_days AS (
  SELECT date, week, dayname(date) AS day FROM src_calendar WHERE day_type_code = 'OPEN'
), class_rooms AS (
  SELECT c.id, c.period_id, c.year_group, c.subject_code, c.group_code AS class, r.room_number,
    CASE WHEN c.rooms IS NULL OR len(c.rooms) = 0 THEN NULL ELSE c.rooms[r.room_number] END AS room,
    c.teacher_ids
  FROM src_classes AS c
  JOIN (SELECT unnest([1, 2]) AS room_number) AS r
    ON r.room_number <= greatest(coalesce(len(c.rooms), 0), 1)
), imputed AS (
  SELECT id, period_id, year_group, subject_code, class, room_number,
    CASE WHEN room IS NOT NULL THEN room
         WHEN contains(class, 'HRB') THEN 'HRB' WHEN contains(class, 'HOM') THEN 'HOME'
         WHEN contains(class, 'EAL') THEN 'EAL' WHEN subject_code IN ('Ac', 'Al') THEN 'AC'
         WHEN subject_code = 'Ap' THEN 'AP' END AS room,
    unnest(CASE WHEN len(teacher_ids) = 0 THEN [NULL] ELSE teacher_ids END) AS teacher_id
  FROM class_rooms
), merged AS (
  SELECT o.date, o.week, o.day, p.name AS lesson_id, p.display_name AS period,
    p."start" AS lesson_start, p."end" AS lesson_end,
    c.id AS class_id, c.room_number, c.room, c.year_group, c.subject_code, c.class,
    e.student_id, e."start" AS student_start, e."end" AS student_end, t.code AS staff_code,
    j.name AS subject_name, d.name AS department,
    s.upn, s.surname_forename_reg, s.surname_forename_id, s.surname, s.forename, s.reg, s.gender,
    s.ethnicity, s.eal, s.fsm, s.fsm6, s.pp, s.wbr_pp, s.hml_band, s.sen
  FROM open_days AS o
  LEFT JOIN src_periods AS p ON o.week = p.week AND o.day = p.day_of_week
  LEFT JOIN imputed AS c ON p.period_id = c.period_id
  LEFT JOIN src_student_classes AS e ON c.id = e.class_id
  LEFT JOIN src_teachers AS t ON c.teacher_id IS NOT DISTINCT FROM t.id
  LEFT JOIN src_teaching_groups AS g ON c.class IS NOT DISTINCT FROM g.name
  LEFT JOIN src_teaching_subjects AS j ON g.subject_id IS NOT DISTINCT FROM j.id
    AND c.subject_code IS NOT DISTINCT FROM j.code AND c.year_group IS NOT DISTINCT FROM j.year_group
  LEFT JOIN src_departments AS d ON j.department_id IS NOT DISTINCT FROM d.id
  LEFT JOIN student_details AS s ON e.student_id IS NOT DISTINCT FROM s.gfsid
), filled AS (
  SELECT * REPLACE (last_value(room IGNORE NULLS) OVER (PARTITION BY upn, lesson_id
    ORDER BY date, class_id NULLS LAST, room_number NULLS LAST, room NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS room)
  FROM merged
), live AS (
  SELECT DISTINCT * EXCLUDE (date, student_end)
  FROM filled
  WHERE (student_end IS NULL OR student_end > (SELECT max(date) FROM open_days))
    AND class IS NOT NULL AND lesson_id IS NOT NULL
), latest AS (
  SELECT upn, lesson_id, max(student_start) AS student_start FROM live
  GROUP BY upn, lesson_id HAVING count(*) = count(student_start)
), shaped AS (
  SELECT DISTINCT l.staff_code, CASE l.week WHEN 1 THEN 'Red' WHEN 2 THEN 'Blue' END AS week_colour,
    CASE WHEN l.day IN ('Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday') THEN l.day END AS day,
    CASE WHEN regexp_full_match(l.lesson_id, '[RB](Mon|Tue|Wed|Thu|Fri):[1-5]') THEN l.lesson_id END
      AS lesson_id,
    l.period, l.room, l.department, l.subject_name, l.subject_code,
    CASE WHEN l.year_group IN ('7', '8', '9', '10', '11') THEN l.year_group END AS year_group,
    l.class, l.lesson_start, l.lesson_end, l.upn, l.student_id AS gfsid, l.surname_forename_reg,
    l.surname_forename_id, l.surname, l.forename, l.reg, l.gender, l.ethnicity, l.eal, l.fsm, l.fsm6,
    l.pp, l.wbr_pp, l.hml_band, l.sen
  FROM live AS l JOIN latest AS a ON l.upn IS NOT DISTINCT FROM a.upn
    AND l.lesson_id = a.lesson_id AND l.student_start = a.student_start
)
SELECT * REPLACE (replace(replace(replace(replace(room, 'c(', ''), ')', ''), chr(34), ''), chr(92), '') AS room)
FROM shaped
