SELECT lang, source, documents, tokens, words, sentences, syllables,
  round_even(CAST(words AS DOUBLE) / sentences, 1) AS mean_words_ps,
  round_even(CAST(syllables AS DOUBLE) / nullif(words, 0), 1) AS mean_syllables_pw
FROM (
  SELECT lang, source, count(*) AS documents, CAST(sum(tokens) AS BIGINT) AS tokens,
    CAST(sum(words) AS BIGINT) AS words, CAST(sum(sentences) AS BIGINT) AS sentences,
    CAST(sum(syllables) AS BIGINT) AS syllables
  FROM text_counts GROUP BY lang, source
) AS sums
