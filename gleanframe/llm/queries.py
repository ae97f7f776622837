"""The queries of this package: each operator over its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanframe.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: DuckDB SQL of those that SQL can express; the others have brute-force tests.
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from gleanframe.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanframe.llm import licenses

    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanframe.llm import sharding

    return sharding.shard(table(spark, sf_dir, "documents")).drop("stratum")


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanframe.llm import grades

    docs = table(spark, sf_dir, "documents")
    model = grades.fit(docs, grades.ratings_of(table(spark, sf_dir, "labels")))
    return grades.grade(docs, model)


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanframe.llm import rules

    docs = table(spark, sf_dir, "documents")
    return rules.judge(docs, rules.fit(docs, table(spark, sf_dir, "labels")))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanframe.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanframe.llm import decontaminate

    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


@query
def op9_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanframe.llm import suffix_tree

    docs = table(spark, sf_dir, "documents")
    return suffix_tree.score(docs, *suffix_tree.fit(docs))


@query
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanframe.llm import partenum

    return partenum.groups(table(spark, sf_dir, "documents")).drop("text_key", "node")


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from gleanframe.llm import token_counts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", token_counts.sample_edits().alias("edits"))
    return token_counts.counts(docs, path("byte_bpe_50k.json"))


@query
def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanframe.llm import near_vectors

    return near_vectors.dedup(table(spark, sf_dir, "embeddings"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanframe.llm import collocations

    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE["op12_collocations"] = r"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
grams AS (
  SELECT lang, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
often AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS f FROM grams GROUP BY lang, array_to_string(g, ' ')
  HAVING count(*) >= 100),
shorter AS (
  SELECT lang, f, array_to_string(list_slice(g, s, s + m - 1), ' ') AS phrase
  FROM (SELECT lang, f, g, m, unnest(range(1, len(g) - m + 2)) AS s
        FROM (SELECT lang, f, g, unnest(range(2, len(g))) AS m FROM often WHERE len(g) > 2))),
kept AS (
  SELECT * FROM often c WHERE len(g) > 1 AND NOT EXISTS (
    SELECT 1 FROM shorter s WHERE s.lang = c.lang AND s.phrase = c.phrase AND 100 * s.f >= 100 * c.f)),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(list_slice(g, 1, k), ' ') AS p, array_to_string(list_slice(g, k + 1, len(g)), ' ') AS q
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM kept)),
scored AS (
  SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, n, k, (1000::HUGEINT * a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN often x ON x.lang = c.lang AND x.phrase = c.p JOIN often y ON y.lang = c.lang AND y.phrase = c.q
  JOIN totals t ON t.lang = c.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed WHERE rank <= 2000
"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanframe.llm import spellings

    return spellings.variants(table(spark, sf_dir, "documents"))


ORACLE["op13_spelling_variants"] = r"""
WITH RECURSIVE bits AS (
  SELECT range AS b, range::BIGINT AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-zÀ-ÿ]+')) AS run FROM documents),
keyed AS (SELECT run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs
          WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2),
      lambda i: ('0x' || substr(x, i, 2))::BIGINT)), lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)), 4294967295) AS h
  FROM keyed, crc),
spelled AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
skips AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word AS a, b.word AS b FROM skips a JOIN skips b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT s.word, w.word FROM skips s JOIN words w ON w.word = s.rest
  UNION SELECT w.word, s.word FROM skips s JOIN words w ON w.word = s.rest),
best AS (
  SELECT a, count(*) AS n_near, min(struct_pack(o := -n, form := word)) AS m FROM near JOIN words ON word = b GROUP BY a),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -m.o >= 10 * n THEN m.form END AS form, CASE WHEN -m.o >= 10 * n THEN -m.o END AS form_n
  FROM words LEFT JOIN best ON a = word),
chain AS (
  SELECT word, word AS last, 0 AS k FROM formed
  UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(last, k) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op3_ngram_jaccard"] = rf"""
WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) END)) AS s
  FROM worded),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, p.b FROM reach r JOIN pairs p ON p.a = r.other),
classes AS (SELECT s, min(doc_id) AS class_id FROM sets WHERE len(s) > 0 GROUP BY s),
joined AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, component_id, coalesce(class_id, doc_id) AS class_id
FROM sets JOIN joined USING (doc_id) LEFT JOIN classes ON classes.s = sets.s
"""

ORACLE["op10_decontamination"] = rf"""
WITH item_words AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, p.n, item FROM places p JOIN windows v ON v.n = p.n AND v.g = p.g),
covered AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
