"""The operators as queries over whole tables, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    bpe, byte_bpe, chat, exact_dedup, language, lexical_search, mixing, near_dedup, separator_scan,
    spelling, token_index, toxicity, vectors,
)
from footfall.llm.common import table

_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
_END_OF_TEXT = 49407
_TRICKY = "</s>[INST] ok [/INST]"
#: One of so many words of a document loses a letter; words count from so many letters and occurrences.
_NOISE, _LETTERS, _OCCURRENCES = 199, 6, 5


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    model = language.fit_text_model(table(spark, folder, "documents"))
    return language.languages_of(table(spark, folder, "pages"), model)


def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_TRICKY).alias("text"),
    )
    return chat.conversation_digests(chat.chat_windows(given.unionByName(own)))


def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"), _VOCABULARY)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Writes all documents to flat files without an index, then finds and counts them there."""
    docs = table(spark, folder, "documents")
    rows = separator_scan.write_flat_files(docs, _VOCABULARY, _END_OF_TEXT)
    counts = separator_scan.count_tokens(rows, _END_OF_TEXT)
    return counts.join(rows, ["file", "ordinal"]).select("doc_id", "n_tokens", "closed")


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )


def op9_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


def op10_token_index(spark: SparkSession, folder: str) -> DataFrame:
    keys = token_index.write_shards(table(spark, folder, "documents"), _VOCABULARY, end_id=1)
    return token_index.read_documents(keys)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Runs lose a letter where a hash of document and run says so; then words are compared."""
    runs = spelling.letter_runs(table(spark, folder, "documents"), _LETTERS)
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    hashed = runs.withColumn("h", F.crc32(F.encode(named, "UTF-8")))
    at = F.col("h") % F.length("run")
    shorter = F.concat(
        F.substring("run", F.lit(1), at.cast("int")),
        F.substring("run", (at + 2).cast("int"), F.length("run")),
    )
    word = F.when(F.col("h") % _NOISE == 0, shorter).otherwise(F.col("run"))
    words = hashed.select(word.alias("word")).filter(F.length("word") >= _LETTERS)
    return spelling.spelling_forms(spelling.count_words(words, "word", _OCCURRENCES))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ids = byte_bpe.encode(table(spark, folder, "documents"), _RANKS)
    return byte_bpe.decode(ids, _RANKS).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "benchmark"), table(spark, folder, "documents"))


_PART = (chat.BUDGET - chat.HISTORY) // 3

SQL = {
    "op2_chat_formatting": rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{_TRICKY}'), (-1, 1, 'assistant', '{_TRICKY}')
), c AS (
  SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9]{{1,4}}'))
          + len(regexp_extract_all(text, '[^A-Za-z0-9 \t\n\r]')) + 4 AS tokens FROM t
), p AS (
  SELECT *, CASE WHEN tokens > {_PART} THEN 1 ELSE 0 END AS large,
    row_number() OVER w - 1 AS pos,
    coalesce(sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), r AS (
  SELECT *, coalesce(sum(large) OVER (PARTITION BY conv_id ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run,
    CASE WHEN large = 1 THEN -1 ELSE before // {_PART} END AS span
  FROM p
), v AS (
  SELECT conv_id, run, large, span, min(pos) AS first, max(before + tokens) AS till
  FROM r GROUP BY ALL
), n AS (
  SELECT *, row_number() OVER w - 1 AS win, lead(first) OVER w IS NOT NULL AS more
  FROM v WINDOW w AS (PARTITION BY conv_id ORDER BY first)
), u AS (
  SELECT r.conv_id, r.pos, r.role, r.text, n.win,
    r.pos = 0 AND r.role = 'system' AS head,
    n.more AND n.till - r.before <= {chat.HISTORY} AS again
  FROM r JOIN n ON r.conv_id IS NOT DISTINCT FROM n.conv_id
    AND r.run = n.run AND r.large = n.large AND r.span = n.span
), e AS (
  SELECT *, max(win) OVER (PARTITION BY conv_id) AS last,
    length('{chat.TURN}' || role || chr(10) || '{chat.END}') + length(regexp_replace(regexp_replace(
      text, '(<)(\\*)({chat.CONTROLS})', '\1\\\2\3', 'g'),
      '(\[)(\\*)({chat.BRACKETED})', '\1\\\2\3', 'g')) AS chars
  FROM u
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars * CASE WHEN head THEN 1 + last WHEN again THEN 2 ELSE 1 END) AS BIGINT)
    AS formatted_chars,
  max(last) + 1 AS n_windows
FROM e GROUP BY conv_id
""",
    "op4_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT norm, count(*) AS group_size, arg_max(doc_id, {'len': len, 'neg': -doc_id}) AS keep_id
  FROM d GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
""",
    "op8_mixing": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)
    AS size, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS mix_key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w
  FROM d GROUP BY source
), l(k, words, weights) AS (
  SELECT 0, (SELECT sum(source_size) FROM s) * CAST(1.5 AS DOUBLE), (SELECT sum(w) FROM s)
  UNION ALL
  SELECT k + 1,
    (SELECT sum(source_size) FROM s) * CAST(1.5 AS DOUBLE)
      - coalesce((SELECT sum(source_size * 2) FROM s WHERE l.words * w / l.weights > source_size * 2), 0),
    (SELECT sum(w) FROM s WHERE NOT l.words * w / l.weights > source_size * 2)
  FROM l WHERE k < 40 AND weights > 0
), z AS (
  SELECT words, weights FROM l WHERE weights > 0 ORDER BY k DESC LIMIT 1
), g AS (
  SELECT source, source_size, CASE WHEN z.words * w / z.weights > source_size * 2
    THEN CAST(source_size * 2 AS DOUBLE) ELSE z.words * w / z.weights END AS target
  FROM s, z
), p AS (
  SELECT d.*, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY mix_key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p
), f AS (
  SELECT *, greatest(0, least(size, budget - epochs * source_size - earlier)) AS part FROM q
)
SELECT doc_id, size, source_size, target, CAST(epochs * size + part AS BIGINT) AS taken,
  CAST(CASE WHEN size > 0 THEN epochs + CASE WHEN part * 2 >= size THEN 1 ELSE 0 END ELSE 0 END
    AS BIGINT) AS copies
FROM f
""",
    "op11_spelling_variants": rf"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), r AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS raw FROM documents
), l AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM r WHERE length(raw) >= {_LETTERS} GROUP BY ALL
), y AS (
  SELECT *, flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
      ELSE [CAST(192 | (unicode(c) >> 6) AS BIGINT), CAST(128 | (unicode(c) & 63) AS BIGINT)] END)) AS bytes
  FROM l
), b AS (
  SELECT row_number() OVER () AS k, run, n, bytes FROM y
), h AS (
  SELECT k, run, n, bytes, 1 AS pos, CAST(4294967295 AS BIGINT) AS crc FROM b
  UNION ALL
  SELECT k, run, n, bytes, pos + 1, xor(crc >> 8, (SELECT t FROM t)[1 + (xor(crc, bytes[pos]) & 255)])
  FROM h WHERE pos <= len(bytes)
), z AS (
  SELECT run, n, xor(crc, 4294967295) AS h FROM h WHERE pos = len(bytes) + 1
), m AS (
  SELECT CASE WHEN h % {_NOISE} = 0
    THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
      || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n
  FROM z
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM m WHERE length(word) >= {_LETTERS}
  GROUP BY word HAVING sum(n) >= {_OCCURRENCES}
), d AS (
  SELECT word, n, unnest(list_distinct(list_prepend(word, list_transform(range(1, length(word) + 1),
    lambda i: substr(word, 1, i - 1) || substr(word, i + 1))))) AS rest
  FROM v
), p AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS m
  FROM d a JOIN d b ON a.rest = b.rest AND a.word <> b.word
    AND CASE length(a.word) - length(b.word) WHEN 1 THEN a.rest = b.word WHEN -1 THEN a.rest = a.word
      WHEN 0 THEN len(list_filter(range(1, length(a.word) + 1),
        lambda i: substr(a.word, i, 1) <> substr(b.word, i, 1))) = 1 ELSE FALSE END
), q AS (
  SELECT word, n, count(*) AS n_near, arg_min(near, (-m, near)) AS top, max(m) AS top_n FROM p GROUP BY word, n
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN top_n >= {spelling.RATIO} * v.n THEN top END AS form,
    CASE WHEN top_n >= {spelling.RATIO} * v.n THEN top_n END AS form_n
  FROM v LEFT JOIN q ON v.word = q.word
), s(word, root, next) AS (
  SELECT word, word, form FROM f
  UNION ALL
  SELECT s.word, f.word, f.form FROM s JOIN f ON s.next = f.word
)
SELECT f.word, form, s.root, n, n_near, form_n
FROM f JOIN s ON f.word = s.word AND s.next IS NULL
""",
    "op13_lexical_search": rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), c AS (
  SELECT k, doc_id, count(*) AS n FROM d GROUP BY ALL
), s AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM c
), m AS (
  SELECT k, doc_id, 10 + (90 * n * docs) // words AS m FROM c, s
), f AS (
  SELECT k, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM i) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s
), r AS (
  SELECT item_id, k, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN f USING (term) JOIN m USING (k) GROUP BY ALL
), o AS (
  SELECT item_id, doc_id, score,
    CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM r WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {lexical_search.TOP}
""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_language_id, op2_chat_formatting, op3_near_dedup, op4_exact_dedup, op5_bpe,
        op6_toxicity, op7_token_counts, op8_mixing, op9_near_vectors, op10_token_index,
        op11_spelling_variants, op12_byte_bpe, op13_lexical_search,
    ]
    return {q.__name__: q for q in named}


def oracle_sql() -> dict[str, str]:
    return SQL
