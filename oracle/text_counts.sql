SELECT doc_id, lang, source, len(list_distinct(tokens)) AS types, len(tokens) AS tokens,
  len(words) AS words,
  greatest(len(regexp_extract_all(text, '[.!?]+(?:[ \t\n\r\f]|\z)')), 1) AS sentences,
  coalesce(list_sum(list_transform(words,
    lambda w: greatest(len(regexp_extract_all(w, '[AEIOUYaeiouy]+')), 1))), 0) AS syllables
FROM (
  SELECT doc_id, lang, source, text,
    regexp_extract_all(text, '[\p{L}\p{N}]+(?:[''’-][\p{L}\p{N}]+)*|[\p{P}\p{S}]') AS tokens,
    regexp_extract_all(text, '[\p{L}\p{N}]+(?:[''’-][\p{L}\p{N}]+)*') AS words
  FROM src_documents
) AS split
