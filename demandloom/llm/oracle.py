"""SQL equivalents of the queries that SQL can express."""

from __future__ import annotations

#: The 20 best integer inner products, over vectors without null or non-finite components.
TOPK = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20
"""

#: Bucket gains of single words, Gumbel values from sha256, and the drawn ranks. CRC-32 goes
#: through its table of 256 remainders, one byte of a word at a time.
RESAMPLING = """
WITH remainders AS (
  SELECT list(list_reduce(list_prepend(byte, range(8)),
    lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY byte) AS remainder
  FROM range(256) t(byte)
), docs AS (
  SELECT doc_id, text FROM documents WHERE doc_id IS NOT NULL
), found AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+') AS words FROM docs
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+') FROM benchmark
), tokens AS (
  SELECT side, id, unnest(words) AS word FROM found
), distinct_words AS (
  SELECT DISTINCT word, hex(encode(word)) AS digits FROM tokens
), byte_lists AS (
  SELECT word, list_transform(range(1, length(digits), 2), lambda i: ('0x' || substr(digits, i, 2))::BIGINT) AS bytes FROM distinct_words
), buckets AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
    lambda c, b: xor(c // 256, remainder[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
  FROM byte_lists, remainders
), counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM tokens JOIN buckets USING (word) GROUP BY bucket
), sums AS (
  SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM counts
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain FROM counts, sums
), weights AS (
  SELECT id AS doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight
  FROM tokens JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS drawn
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

#: Phrases of 2 to 4 words by direct counting of every stretch; HUGEINT keeps products exact.
COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), stretches AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3), (4)) sizes(k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS a, string_split(phrase, ' ') AS w FROM stretches GROUP BY ALL
), sizes AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM f WHERE k >= 2 AND a >= 30
), inside AS (
  SELECT DISTINCT c.lang, c.phrase FROM (
    SELECT lang, a, k, unnest(list_concat(
      list_transform(range(1, k), lambda i: array_to_string(w[i : i + 1], ' ')),
      CASE WHEN k = 4 THEN list_transform(range(1, 3), lambda i: array_to_string(w[i : i + 2], ' ')) ELSE [] END)) AS part
    FROM candidates WHERE k > 2
  ) longer JOIN candidates c ON c.lang = longer.lang AND c.phrase = longer.part AND 100 * longer.a >= 80 * c.a
), cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, array_to_string(c.w[1 : cut], ' ') AS head, array_to_string(c.w[cut + 1 : c.k], ' ') AS tail
  FROM candidates c, (VALUES (1), (2), (3)) places(cut)
  WHERE cut < c.k AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase)
), scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cut, x.a AS l, y.a AS r, (2000000 * cuts.a) // (x.a + y.a) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail
), lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored) WHERE place = 1
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
) JOIN sizes USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {"op13_collocations": COLLOCATIONS, "op2_topk_search": TOPK, "op11_resampling": RESAMPLING}
