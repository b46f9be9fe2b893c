-- Fixed values: limits, ages and notes of the bands.
SELECT doc_id AS text, CAST(types AS INT) AS types, CAST(tokens AS INT) AS tokens,
  CAST(words AS INT) AS words, CAST(sentences AS INT) AS sentences,
  mean_words_ps, mean_syllables_pw, flesch,
  CASE WHEN flesch > 100 OR flesch < 0 THEN NULL WHEN flesch >= 90 THEN '10-11'
    WHEN flesch >= 80 THEN '11-12' WHEN flesch >= 70 THEN '12-13' WHEN flesch >= 60 THEN '13-15'
    WHEN flesch >= 50 THEN '15-18' WHEN flesch >= 30 THEN 'Undergraduate'
    WHEN flesch >= 10 THEN 'Graduate' WHEN flesch >= 0 THEN 'Professional' END AS age,
  CASE WHEN flesch > 100 OR flesch < 0 THEN NULL
    WHEN flesch >= 90 THEN 'Very easy to read. Easily understood by an average 11-year-old student.'
    WHEN flesch >= 80 THEN 'Easy to read. Conversational English for consumers.'
    WHEN flesch >= 70 THEN 'Fairly easy to read.'
    WHEN flesch >= 60 THEN 'Plain English. Easily understood by 13- to 15-year-old students.'
    WHEN flesch >= 50 THEN 'Fairly difficult to read.'
    WHEN flesch >= 30 THEN 'Difficult to read.'
    WHEN flesch >= 10 THEN 'Very difficult to read. Best understood by university graduates.'
    WHEN flesch >= 0 THEN 'Extremely difficult to read. Best understood by university graduates.'
  END AS notes
FROM (
  SELECT *, round_even(CAST(words AS DOUBLE) / sentences, 1) AS mean_words_ps,
    round_even(CAST(syllables AS DOUBLE) / nullif(words, 0), 1) AS mean_syllables_pw,
    round_even(CAST(206.835 AS DOUBLE) - CAST(1.015 AS DOUBLE) * (CAST(words AS DOUBLE) / sentences)
      - CAST(84.6 AS DOUBLE) * (CAST(syllables AS DOUBLE) / nullif(words, 0)), 0)
      + 0.0 AS flesch  -- no negative zero
  FROM text_counts
) AS scored
