"""The registered queries of this subpackage and their SQL where there is one."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keeprule.llm import (
    collocations,
    decontaminate,
    jaccard_join,
    language_id,
    line_dedup,
    quality_classifier,
    quality_rules,
    ranked_search,
    secrets,
    sentencepiece_codec,
    sharding,
    toxicity,
    training_order,
)
from keeprule.llm.common import id_remainder, table

#: Folder of the public vocabulary files, their names, and the cutting pattern of the byte-level one.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
PIECES, RANKS = "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ORDER_KEY = 20240229


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = training_order.load_ranks(f"{TOKENIZERS}/{RANKS}")
    return training_order.written_order(table(spark, sf_dir, "documents"), ranks, PATTERN, ORDER_KEY)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality_classifier.score(documents, quality_classifier.fit(documents)[1])


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    grammar = toxicity.fit(documents, table(spark, sf_dir, "labels"), id_remainder(4) != 2)
    scored = toxicity.score(documents, grammar)
    return scored.select("doc_id", (id_remainder(4) == 2).alias("held_out"), "score", "predicted")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = sentencepiece_codec.Vocabulary.load(f"{TOKENIZERS}/{PIECES}")
    coded = sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"), vocabulary)
    return coded.select("doc_id", "n_ids", "ids", F.sha2("text", 256).alias("decoded_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base = F.lit(quality_rules.mask(quality_rules.POLICIES[1])).cast("long")
    return quality_rules.apply_policy(entries, 2).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(base) != 0).alias("base_failed"), "kept",
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    trees = language_id.fit(documents, id_remainder(3) != 1)
    found = language_id.identify(documents, trees)
    return found.select("doc_id", (id_remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.ledger(table(spark, sf_dir, "documents"))
    grown = F.lit(None).cast("int").alias("grown_shard")
    return dealt.select("doc_id", "size", "text_crc32", "law", "shard", "slot", grown)


def _sharding_sql() -> str:
    """Numbers by a window, then one half round of the network a step until a pass ends inside; the checksum by hand."""
    keys = ", ".join(
        f"({2 * i}, {m}, {u}), ({2 * i + 1}, {m}, {v})" for i, (m, u, v) in enumerate(sharding.round_keys(sharding.KEY))
    )
    halves, prime = 2 * sharding.ROUNDS, sharding.PRIME

    def scrambled(value: str) -> str:
        mixed = f"({value} % {prime} * m + o) % {prime}"
        return f"(({mixed}) * ({mixed}) % {prime} * m + o) % {prime}"

    # The checksum is linear: every bit of a text adds a value that follows from its distance to the end.
    weights = ", ".join(f"max(c) FILTER (j = {j}) AS b{j}" for j in range(8))
    bits = "0"
    for j in range(8):
        bits = f"xor({bits}, ((x >> {j}) & 1) * b{j})"
    return f"""
WITH RECURSIVE crc_steps AS (
  SELECT v AS entry, v AS c, 0 AS step FROM (SELECT unnest(range(256)) AS v)
  UNION ALL
  SELECT entry, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM crc_steps WHERE step < 8),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY entry) AS t FROM crc_steps WHERE step = 8),
coded AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, octet_length(encode(coalesce(text, ''))) AS len,
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes
  FROM documents),
longest AS MATERIALIZED (SELECT max(len) AS most FROM coded),
shifted AS MATERIALIZED (
  SELECT j, 0 AS k, CASE WHEN j = 8 THEN 4294967295 ELSE t[(1 << j) + 1] END AS c FROM (SELECT CAST(unnest(range(9)) AS INTEGER) AS j), crc_table
  UNION ALL
  SELECT j, k + 1, xor(c >> 8, t[(c & 255) + 1]) FROM shifted, crc_table, longest WHERE k < most),
weights AS (SELECT k, {weights}, max(c) FILTER (j = 8) AS start FROM shifted GROUP BY k),
placed AS (
  SELECT rid, CAST('0x' || unnest(bytes) AS BIGINT) AS x, len - 1 - unnest(range(len)) AS k FROM coded),
sums AS (SELECT rid, bit_xor({bits}) AS c FROM placed JOIN weights USING (k) GROUP BY rid),
texts AS (
  SELECT doc_id, len + 8 AS size, xor(xor(coalesce(c, 0), start), 4294967295) AS text_crc32
  FROM coded JOIN weights ON k = len LEFT JOIN sums USING (rid)),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS number FROM texts),
root AS (SELECT CAST(floor(sqrt(greatest(count(*), 1))) AS BIGINT) AS s, count(*) AS n FROM texts),
sides AS MATERIALIZED (
  SELECT a, (n + a - 1) // a AS b, n
  FROM (SELECT unnest(range(s, least(s + {sharding.PAIRS}, 2 * s + 1))) AS a, n FROM root)
  ORDER BY a * ((n + a - 1) // a), a LIMIT 1),
keys AS MATERIALIZED (SELECT * FROM (VALUES {keys}) AS v(i, m, o)),
walk AS (
  SELECT number, number // b AS l, number % b AS r, 0 AS step FROM numbered, sides
  UNION ALL
  SELECT number, CASE step % 2 WHEN 0 THEN (l + {scrambled("r")}) % a ELSE l END,
    CASE step % 2 WHEN 1 THEN (r + {scrambled("l")}) % b ELSE r END, step + 1
  FROM walk, sides, keys
  WHERE i = step % {halves} AND NOT (step > 0 AND step % {halves} = 0 AND l * b + r < n))
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST((l * b + r) % {sharding.SHARDS} AS INTEGER) AS shard,
  (l * b + r) // {sharding.SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM walk JOIN numbered USING (number), sides
WHERE step > 0 AND step % {halves} = 0 AND l * b + r < sides.n"""


QUERIES = {
    query.__name__: query
    for query in (
        op1_training_order,
        op2_line_dedup,
        op3_quality_classifier,
        op4_decontamination,
        op5_toxicity,
        op6_secret_scan,
        op7_sentencepiece,
        op8_quality_rules,
        op9_language_id,
        op10_jaccard_join,
        op11_collocations,
        op12_ranked_search,
        op13_sharding,
    )
}

ORACLE = {
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS MATERIALIZED (
  SELECT lang, w FROM (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM pieces)
  WHERE len(w) > 0),
counts AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, array_to_string(list_slice(w, i + 1, i + k), ' ') AS phrase FROM (
      SELECT lang, w, k, unnest(range(len(w) - k + 1)) AS i FROM worded, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k))
  GROUP BY lang, k, phrase HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang),
candidates AS (SELECT lang, phrase, k AS size, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS head, array_to_string(list_slice(w, k + 1, size), ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
scores AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, c.k,
    (1000 * CAST(c.a AS HUGEINT) * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
    JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM scores) WHERE pick = 1),
inner_phrases AS (
  SELECT DISTINCT lang, a, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates))),
kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM inner_phrases p WHERE p.lang = s.lang AND p.phrase = s.phrase AND 100 * p.a >= 100 * s.a))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000""",
    "op12_ranked_search": r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
counts AS MATERIALIZED (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM texts) GROUP BY rid, term),
lengths AS (SELECT rid, doc_id, len(terms) AS n FROM texts WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, sum(n) AS words FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals),
asked AS (
  SELECT item, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item, item_id, term),
scores AS (
  SELECT item, item_id, rid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (rid), totals
  GROUP BY item, item_id, rid, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10""",
    "op13_sharding": _sharding_sql(),
    "op2_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, t.pos, t.line,
    translate(regexp_replace(t.line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)) t),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, pos, line, s.key IS NOT NULL AND doc_id <> s.keeper AS gone
  FROM lines LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op8_quality_rules": r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS n_capitals,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM texts),
windows AS (
  SELECT doc_id, unnest(range(len(w) - 4)) AS i, w FROM words WHERE len(w) >= 5),
keyed AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS key FROM windows),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, key) AS n FROM keyed) WHERE n > 1),
covered AS (
  SELECT doc_id, sum(least(5, coalesce(next_i - i, 5))) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next_i FROM repeated) GROUP BY doc_id),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, word_chars, n_symbols, n_capitals,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words
    OR 10 * n_dup_lines > 3 * n_lines OR 2 * n_capitals > word_chars OR word_chars > 20 * n_words) AS kept
FROM counts""",
}
