"""DuckDB SQL for each query, written from the definitions and not from the Spark code."""

from __future__ import annotations

from checks.testbed import DOC_SPEC, ERROR_KINDS, ERROR_RATES, RUNS
from gleanframe.operators.synth import JOB_POOLS as P

SEED = 42


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + v.replace("'", "''") + "'"


def lits(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def u(seed: int, key: str, draw: str | int, start: int = 1) -> str:
    return (f"(('0x' || substr(md5('{seed}:' || ({key}) || ':{draw}'), {start}, 8))::BIGINT"
            " / 4294967296.0::DOUBLE)")


# --- stand-in gold records and answers ----------------------------------------------------

def jstr(x: str) -> str:
    return f"coalesce(to_json({x})::VARCHAR, 'null')"


def jnum(x: str) -> str:
    return f"coalesce(({x})::BIGINT::VARCHAR, 'null')"


def jlist(x: str) -> str:
    return f"('[' || array_to_string(list_transform({x}, lambda w: to_json(w)::VARCHAR), ', ') || ']')"


GOLD = f"""
words AS (
  SELECT d.doc_id AS row_id, d.text AS posting, d.lang, d.source, d.n_chars, l.quality, l.toxic,
         CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS band,
         list_reverse_sort(list_distinct(string_split(d.text, ' '))) AS terms
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
gold AS (
  SELECT row_id, posting, lang, source, n_chars, quality, toxic, band,
         terms[1:4] AS last_terms, terms[5:4 + (n_chars % 3)] AS more_terms
  FROM words),
gold_text AS (
  SELECT *, {jstr('lang')} AS j_lang, {jstr('source')} AS j_source, {jnum('n_chars')} AS j_n_chars,
         {jnum('quality')} AS j_quality, {jnum('toxic')} AS j_toxic, {jstr('band')} AS j_band,
         {jlist('last_terms')} AS j_last_terms, {jlist('more_terms')} AS j_more_terms
  FROM gold),
answers AS (
  SELECT *, '{{"lang": ' || j_lang || ', "source": ' || j_source || ', "n_chars": ' || j_n_chars
         || ', "quality": ' || j_quality || ', "toxic": ' || j_toxic || ', "band": ' || j_band
         || ', "last_terms": ' || j_last_terms || ', "more_terms": ' || j_more_terms || '}}' AS answer
  FROM gold_text)"""

RUN_ROWS = ", ".join("(" + ", ".join(lit(v) for v in (*r, ERROR_RATES[r[0]])) + ")" for r in RUNS)
RUN_TABLE = f"""
runs AS (SELECT * FROM (VALUES {RUN_ROWS})
  AS t(run, comparison, model, prompt, train_rows, source, epochs, rate))"""

KEY = "run || ':' || row_id"
PREDS = f"""
asked AS (
  SELECT g.*, r.run,
         CASE WHEN {u(7, KEY, 'err')} < r.rate
              THEN {lits(ERROR_KINDS)}[1 + floor({u(7, KEY, 'kind')} * {len(ERROR_KINDS)})::INT]
              WHEN {u(7, KEY, 'fence')} < 0.3 THEN 'fenced' ELSE 'plain' END AS kind
  FROM gold_text g, (SELECT run, rate FROM runs) r
  WHERE r.run <> 'src_hand' OR g.quality IS NOT NULL),
bodies AS (
  SELECT run, row_id, kind, '{{' || concat_ws(', ',
    '"lang": ' || CASE kind WHEN 'changed' THEN '"xx"' WHEN 'null_required' THEN 'null' ELSE j_lang END,
    '"source": ' || j_source,
    CASE WHEN kind = 'missing' THEN NULL
         WHEN kind = 'number_text' THEN '"n_chars": "' || j_n_chars || '"'
         ELSE '"n_chars": ' || j_n_chars END,
    '"quality": ' || CASE WHEN kind = 'bool_number'
                          THEN CASE WHEN quality = 0 THEN 'false' ELSE 'true' END ELSE j_quality END,
    '"toxic": ' || j_toxic,
    '"band": ' || j_band,
    '"last_terms": ' || CASE kind
        WHEN 'recased' THEN {jlist('list_transform(last_terms, lambda w: lower(w))')}
        WHEN 'dropped_item' THEN {jlist('last_terms[2:]')}
        WHEN 'list_as_text' THEN to_json(array_to_string(last_terms, ' '))::VARCHAR
        ELSE j_last_terms END,
    '"more_terms": ' || j_more_terms,
    CASE WHEN kind = 'extra' THEN '"note": "x"' END) || '}}' AS body
  FROM asked),
preds AS (
  SELECT run, row_id, CASE kind
    WHEN 'fenced' THEN '```json' || chr(10) || body || chr(10) || '```'
    WHEN 'prose' THEN 'Here it is: ' || body || ' Done.'
    WHEN 'truncated' THEN substr(body, 1, length(body) - 5)
    WHEN 'single_quotes' THEN replace(body, '"', '''')
    WHEN 'trailing' THEN body || ' {{"lang": "en"}}'
    WHEN 'no_text' THEN NULL
    ELSE body END AS raw_text
  FROM bodies)"""


def sliced(text: str) -> str:
    return (f"CASE WHEN contains({text}, '{{') AND contains({text}, '}}') "
            f"THEN regexp_extract({text}, '\\{{.*\\}}', 0, 's') END")


PARSED = f"""
pieces AS (SELECT run, row_id, {sliced('raw_text')} AS piece FROM preds),
parsed AS (
  SELECT run, row_id, coalesce(json_valid(piece), false) AS json_valid,
         CASE WHEN json_valid(piece) THEN piece END AS obj
  FROM pieces)"""

STRINGS = [f.name for f in DOC_SPEC.scalars if f.kind == "string"]
NUMBERS = [f.name for f in DOC_SPEC.scalars if f.kind == "number"]
SCALARS = [f.name for f in DOC_SPEC.scalars]
LISTS = [f.name for f in DOC_SPEC.lists]


def ok_string(f: str) -> str:
    return f"""CASE WHEN NOT p.json_valid THEN false
      WHEN coalesce(json_type(p.obj, '$.{f}'), 'NULL') = 'NULL' THEN g.{f} IS NULL
      WHEN json_type(p.obj, '$.{f}') = 'VARCHAR'
        THEN coalesce(json_extract_string(p.obj, '$.{f}') = g.{f}, false)
      ELSE false END AS ok_{f}"""


def ok_number(f: str) -> str:
    return f"""CASE WHEN NOT p.json_valid THEN false
      WHEN coalesce(json_type(p.obj, '$.{f}'), 'NULL') = 'NULL' THEN g.{f} IS NULL
      WHEN json_type(p.obj, '$.{f}') IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT')
        THEN coalesce(json_extract_string(p.obj, '$.{f}')::DOUBLE = g.{f}, false)
      WHEN json_type(p.obj, '$.{f}') = 'BOOLEAN'
        THEN coalesce((json_extract_string(p.obj, '$.{f}') = 'true')::INT = g.{f}, false)
      ELSE false END AS ok_{f}"""


def lower_set(x: str) -> str:
    return f"list_distinct(list_transform({x}, lambda w: lower(w)))"


def predicted_set(f: str) -> str:
    return (f"CASE WHEN json_type(p.obj, '$.{f}') = 'ARRAY' "
            f"THEN {lower_set(f'''json_extract(p.obj, '$.{f}')::VARCHAR[]''')} ELSE [] END AS s_{f}")


COMPARED = f"""
paired AS (
  SELECT p.run, p.row_id, p.json_valid, p.obj,
    {", ".join(ok_string(f) for f in STRINGS)},
    {", ".join(ok_number(f) for f in NUMBERS)},
    {", ".join(predicted_set(f) for f in LISTS)},
    {", ".join(f"{lower_set('g.' + f)} AS gs_{f}" for f in LISTS)},
    {", ".join(f"g.j_{f}" for f in SCALARS + LISTS)}
  FROM parsed p JOIN gold_text g ON p.row_id = g.row_id),
compared AS (
  SELECT *, {", ".join(
      f'''CASE WHEN NOT json_valid THEN 0.0::DOUBLE
            WHEN len(s_{f}) = 0 AND len(gs_{f}) = 0 THEN 1.0::DOUBLE
            WHEN len(s_{f}) = 0 OR len(gs_{f}) = 0 THEN 0.0::DOUBLE
            ELSE 2.0::DOUBLE * len(list_intersect(s_{f}, gs_{f})) / (len(s_{f}) + len(gs_{f})) END AS f1_{f}'''
      for f in LISTS)}
  FROM paired)"""

SCORED = f"""
scored AS (
  SELECT r.run, g.row_id,
         coalesce(c.json_valid::INT, 0) AS json_valid,
         coalesce({" + ".join(f"c.ok_{f}::INT" for f in SCALARS)}, 0) AS scalar_correct,
         {len(SCALARS)} AS scalar_total,
         coalesce({" + ".join(f"c.f1_{f}" for f in LISTS)}, 0.0) AS list_f1_sum,
         {len(LISTS)} AS list_count
  FROM runs r CROSS JOIN gold g LEFT JOIN compared c ON c.run = r.run AND c.row_id = g.row_id)"""

METRICS = """
metrics AS (
  SELECT run, count(*) AS n_rows, sum(json_valid)::BIGINT AS valid_rows,
         sum(scalar_correct)::BIGINT AS scalar_correct, sum(scalar_total)::BIGINT AS scalar_total,
         sum(list_count)::BIGINT AS list_count, sum(list_f1_sum) AS list_f1_sum,
         sum(json_valid) / count(*)::DOUBLE AS json_valid,
         sum(scalar_correct) / sum(scalar_total)::DOUBLE AS field_acc,
         sum(list_f1_sum) / sum(list_count)::DOUBLE AS skills_f1
  FROM scored GROUP BY run)"""

_PREDS = "WITH" + GOLD + "," + RUN_TABLE + "," + PREDS
_PARSED = _PREDS + "," + PARSED
_COMPARED = _PARSED + "," + COMPARED
_METRICS = _COMPARED + "," + SCORED + "," + METRICS

METRIC_NAMES = ("json_valid", "field_acc", "skills_f1")


def r6(*names: str, alias: str = "") -> str:
    return ", ".join(f"round({alias}{n}, 6) AS {n}" for n in names)


ORACLE: dict[str, str] = {}

# --- A -------------------------------------------------------------------------------------

ORACLE["a1_read_records"] = "WITH" + GOLD + """
SELECT md5(posting) AS posting_md5, lang, source, n_chars::DOUBLE AS n_chars,
       quality::DOUBLE AS quality, toxic::DOUBLE AS toxic, band,
       array_to_string(last_terms, '|') AS last_terms, array_to_string(more_terms, '|') AS more_terms
FROM gold"""

ORACLE["a2_write_records"] = "WITH" + GOLD + """,
lines AS (SELECT '{"posting": ' || to_json(posting)::VARCHAR || ', "labels": ' || answer || '}' AS line
          FROM answers)
SELECT md5(line) AS line_md5, length(line)::INT AS n_chars FROM lines"""


def placed(table: str, key: str) -> str:
    return f"""
placed AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || {key})) AS place FROM {table}),
parts AS (SELECT *, CASE WHEN place <= 30 THEN 'test' WHEN place <= 50 THEN 'val' ELSE 'train' END AS split
          FROM placed)"""


ORACLE["a3_write_splits"] = "WITH" + GOLD + "," + placed("gold", "row_id") + """
SELECT split, md5(posting) AS posting_md5, n_chars::DOUBLE AS n_chars FROM parts"""

ORACLE["a4_read_predictions"] = _PREDS + """
SELECT run, row_id, md5(raw_text) AS text_md5 FROM preds"""

ORACLE["a5_export_chat"] = "WITH" + GOLD + "," + placed("answers", "row_id") + """
SELECT split, row_id, 3 AS n_turns, md5(answer) AS answer_md5 FROM parts WHERE split <> 'test'"""

# --- B -------------------------------------------------------------------------------------

ORACLE["b1_split_exact"] = "WITH" + placed("documents", "doc_id") + """
SELECT doc_id, split FROM parts"""

ORACLE["b2_split_fraction"] = f"""
WITH drawn AS (SELECT doc_id, {u(SEED, 'doc_id', 'split')} AS x FROM documents)
SELECT doc_id, CASE WHEN x < 0.15 THEN 'test' WHEN x < 0.3 THEN 'val' ELSE 'train' END AS split
FROM drawn"""

ORACLE["b4_prefix_subsets"] = "WITH" + placed("documents", "doc_id") + """
SELECT s.train_size, p.doc_id
FROM placed p JOIN (VALUES (5::BIGINT), (100), (700), (1000000000)) AS s(train_size) ON p.place <= s.train_size"""

ORACLE["b5_demos"] = "WITH" + placed("documents", "doc_id") + """
SELECT (place - 50)::INT AS rank, doc_id FROM parts WHERE split = 'train' AND place <= 53"""

KEYED = r"md5(trim(regexp_replace(lower(text), '[ \t\n\r]+', ' ', 'g')))"

ORIGIN = f"""
origin AS (SELECT doc_id AS row_id, text,
    CASE WHEN regexp_extract(source, '([0-9]+)$', 1)::INT < 10 THEN 'hand' ELSE 'synthetic' END AS source
  FROM documents),
hand AS (SELECT * FROM origin WHERE source = 'hand')"""

ORACLE["b7_eval_purity"] = "WITH" + ORIGIN + "," + placed("hand", "row_id") + f""",
evaluated AS (SELECT {KEYED} AS text_key FROM parts WHERE split <> 'train'),
made AS (SELECT row_id, {KEYED} AS text_key FROM origin WHERE source = 'synthetic')
SELECT row_id, text_key FROM made WHERE text_key IN (SELECT text_key FROM evaluated)"""

def filled(group: str, n_test: int, n_val: int) -> str:
    """Group by group in seeded order: taken if it fits, else passed over; the smallest one if rows are left."""
    def fill(part: str, source: str, size: int) -> str:
        return f"""
{part}_order AS (SELECT g, n, row_number() OVER (ORDER BY g) AS i FROM {source}),
{part}_walk AS (
  SELECT 0::BIGINT AS i, ''::VARCHAR AS g, {size}::BIGINT AS room, false AS taken
  UNION ALL SELECT o.i, o.g, CASE WHEN o.n <= w.room THEN w.room - o.n ELSE w.room END, o.n <= w.room
  FROM {part}_walk w JOIN {part}_order o ON o.i = w.i + 1),
{part}_fit AS (SELECT g FROM {part}_walk WHERE taken),
{part}_extra AS (SELECT g FROM {source} WHERE g NOT IN (SELECT g FROM {part}_fit) AND (SELECT min(room) FROM {part}_walk) > 0 ORDER BY n, g LIMIT 1),
{part}_groups AS (SELECT g FROM {part}_fit UNION ALL SELECT g FROM {part}_extra)"""

    return f"""
WITH RECURSIVE keyed AS (SELECT doc_id, md5('{SEED}:' || {group}) AS g FROM documents),
sized AS (SELECT g, count(*) AS n FROM keyed GROUP BY g),{fill("test", "sized", n_test)},
others AS (SELECT g, n FROM sized WHERE g NOT IN (SELECT g FROM test_groups)),{fill("val", "others", n_val)}
SELECT doc_id, CASE WHEN g IN (SELECT g FROM test_groups) THEN 'test' WHEN g IN (SELECT g FROM val_groups) THEN 'val' ELSE 'train' END AS split
FROM keyed"""


ORACLE["b3_split_grouped"] = filled(KEYED, 30, 20)
ORACLE["b3_split_by_source"] = filled("coalesce('=' || source, '')", 60, 40)

ORACLE["b6_leakage_audit"] = f"""
WITH drawn AS (SELECT {KEYED} AS text_key, {u(SEED, 'doc_id', 'split')} AS x FROM documents),
parts AS (SELECT text_key, CASE WHEN x < 0.15 THEN 'test' WHEN x < 0.3 THEN 'val' ELSE 'train' END AS split FROM drawn)
SELECT text_key, string_agg(DISTINCT split, ',' ORDER BY split) AS splits, count(*) AS n_rows
FROM parts GROUP BY text_key HAVING count(DISTINCT split) > 1"""

GRAMS = r"""
WITH worded AS (
  SELECT 'text' AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\r]+'), lambda w: w <> '') AS w FROM documents
  UNION ALL
  SELECT 'item', item_id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\r]+'), lambda w: w <> '') FROM benchmark),
grams AS (SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS g
          FROM (SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM worded)),
index AS (SELECT id AS item, g FROM grams WHERE kind = 'item'),
own AS (SELECT id AS text_id, g FROM grams WHERE kind = 'text')"""

ORACLE["b8_contaminated_texts"] = GRAMS + """,
counted AS (SELECT text_id, count(*) AS n_grams, count(*) FILTER (g IN (SELECT g FROM index)) AS n_shared FROM own GROUP BY text_id)
SELECT doc_id AS text_id, coalesce(n_grams, 0) AS n_grams, coalesce(n_shared, 0) AS n_shared, round(n_shared / n_grams::DOUBLE, 6) AS shared_share
FROM documents LEFT JOIN counted ON text_id = doc_id"""

ORACLE["b8_contamination"] = GRAMS + """,
held AS (SELECT item, i.g, text_id FROM index i JOIN own o ON i.g = o.g),
sizes AS (SELECT item, count(*) AS n_grams FROM index GROUP BY item),
per_gram AS (SELECT item, g, count(DISTINCT text_id) AS texts FROM held GROUP BY item, g),
found AS (SELECT item, count(*) AS n_found, max(texts) AS most_texts FROM per_gram GROUP BY item),
holding AS (SELECT item, count(DISTINCT text_id) AS n_texts FROM held GROUP BY item)
SELECT item_id AS item, coalesce(n_grams, 0) AS n_grams, coalesce(n_found, 0) AS n_found,
       round(coalesce(n_found, 0) / n_grams::DOUBLE, 6) AS found_share, coalesce(n_texts, 0) AS n_texts, coalesce(most_texts, 0) AS most_texts
FROM (SELECT DISTINCT item_id FROM benchmark) b LEFT JOIN sizes s ON s.item = item_id LEFT JOIN found f ON f.item = item_id
LEFT JOIN holding h ON h.item = item_id"""

# --- C -------------------------------------------------------------------------------------

SYSTEM = lit(DOC_SPEC.system_prompt())
TURNS = f"""
turns AS (SELECT row_id, 0 AS turn, 'system' AS role, {SYSTEM} AS content FROM answers
          UNION ALL SELECT row_id, 1, 'user', posting FROM answers
          UNION ALL SELECT row_id, 2, 'assistant', answer FROM answers)"""

ORACLE["c1_to_chat"] = "WITH" + GOLD + "," + TURNS + """
SELECT row_id, turn, role, content FROM turns"""

DEMOS = placed("answers", "row_id") + """,
demos AS (SELECT place - 51 AS n, posting, answer FROM parts WHERE place BETWEEN 51 AND 53)"""

ORACLE["c2_demo_block"] = "WITH" + GOLD + "," + DEMOS + """
SELECT (2 * n)::INT AS turn, 'user' AS role, posting AS content FROM demos
UNION ALL SELECT (2 * n + 1)::INT, 'assistant', answer FROM demos"""

ORACLE["c3_prompts"] = "WITH" + GOLD + "," + DEMOS + f""",
block AS (SELECT string_agg('user>' || posting || chr(10) || 'assistant>' || answer, chr(10) ORDER BY n) AS b
          FROM demos)
SELECT row_id, 8 AS n_turns,
       md5('system>' || {SYSTEM} || chr(10) || b || chr(10) || 'user>' || posting) AS prompt_md5
FROM answers, block"""

ORACLE["c3_prompts_zero_shot"] = """
SELECT doc_id AS row_id, 2 AS n_turns, text AS question FROM documents"""

ORACLE["c4_loss_targets"] = "WITH" + GOLD + "," + TURNS + """
SELECT row_id, turn, role, role = 'assistant' AS is_target, length(content)::INT AS n_chars FROM turns"""

ORACLE["c4_loss_spans"] = "WITH" + GOLD + "," + TURNS + """
SELECT row_id, sum(length(content))::BIGINT AS n_chars,
       sum(CASE WHEN role = 'assistant' THEN length(content) END)::BIGINT AS target_chars,
       round(sum(CASE WHEN role = 'assistant' THEN length(content) END) / sum(length(content))::DOUBLE, 6) AS target_share
FROM turns GROUP BY row_id"""


def n_words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^ \\t\\n\\r]+'))"


LENGTHS = "WITH" + GOLD + "," + DEMOS + f""",
block AS (SELECT sum({n_words('posting')} + {n_words('answer')}) AS n FROM demos),
lengths AS (SELECT 'zero' AS prompt, {n_words(SYSTEM)} + {n_words('posting')} AS n FROM answers
            UNION ALL SELECT 'few', {n_words(SYSTEM)} + {n_words('posting')} + block.n FROM answers, block)"""

ORACLE["c5_length_budget"] = LENGTHS + """
SELECT prompt, count(*) AS n_rows, count(*) FILTER (n > 1024) AS n_over, round(avg(n), 6) AS mean_words,
       round(quantile_cont(n::DOUBLE, 0.95), 6) AS p95_words, max(n)::BIGINT AS max_words
FROM lengths GROUP BY prompt"""

ORACLE["c5_length_sketches"] = LENGTHS + """
SELECT prompt, count(*) AS n_rows, count(*) FILTER (n > 1024) AS n_over, round(avg(n), 6) AS mean_words,
       max(n)::BIGINT AS max_words, true AS p95_is_near
FROM lengths GROUP BY prompt"""

# --- D -------------------------------------------------------------------------------------

ORACLE["d1_slice_json"] = _PREDS + f"""
SELECT run, row_id, {sliced('raw_text')} AS json_text FROM preds"""

ORACLE["d1_slice_pages"] = f"""
WITH pieces AS (SELECT page_id, {sliced('html')} AS piece FROM pages)
SELECT page_id, length(piece)::INT AS n_chars, md5(piece) AS slice_md5 FROM pieces"""

ORACLE["d2_parse_object"] = _PARSED + f"""
SELECT run, row_id, json_valid, {", ".join(
    f"json_extract_string(obj, '$.{f}') AS {f}" for f in SCALARS)} FROM parsed"""

ORACLE["d2_parse_events"] = f"""
WITH pieces AS (SELECT event_id, {sliced('props')} AS piece FROM events)
SELECT event_id, coalesce(json_valid(piece), false) AS json_valid,
       CASE WHEN json_valid(piece) THEN json_extract_string(piece, '$.k')::DOUBLE END AS k
FROM pieces"""

ORACLE["d2_parse_documents"] = f"""
WITH pieces AS (SELECT doc_id, {sliced('text')} AS piece FROM documents)
SELECT doc_id, coalesce(json_valid(piece), false) AS json_valid FROM pieces"""

_TYPES = {"string": "('VARCHAR')", "number": "('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT')",
          "list": "('ARRAY')"}


def breaches(f) -> list[str]:
    t = f"json_type(obj, '$.{f.name}')"
    head = f"SELECT run, row_id, '{f.name}' AS field,"
    found = [f"{head} 'missing' AS violation FROM parsed WHERE json_valid AND {t} IS NULL",
             f"{head} 'type' FROM parsed WHERE json_valid AND {t} <> 'NULL' AND {t} NOT IN {_TYPES[f.kind]}"]
    if not f.nullable:
        found.append(f"{head} 'null' FROM parsed WHERE json_valid AND {t} = 'NULL'")
    if f.domain:
        found.append(f"{head} 'enum' FROM parsed WHERE json_valid AND {t} = 'VARCHAR' AND "
                     f"json_extract_string(obj, '$.{f.name}') NOT IN ({', '.join(lit(v) for v in f.domain)})")
    return found


ORACLE["d3_validate_schema"] = _PARSED + f""",
names AS (SELECT run, row_id, unnest(json_keys(obj)) AS field FROM parsed WHERE json_valid)
SELECT run, row_id, '' AS field, 'not_json' AS violation FROM parsed WHERE NOT json_valid
UNION ALL SELECT run, row_id, field, 'extra' FROM names
  WHERE field NOT IN ({", ".join(lit(f.name) for f in DOC_SPEC.fields)})
UNION ALL {" UNION ALL ".join(b for f in DOC_SPEC.fields for b in breaches(f))}"""

# Faults by the text's length, as the query sets them.
FAULTS = """
faulty AS (
  SELECT row_id, n_chars % 11 = 0 AS no_text, n_chars % 13 = 0 AS no_labels, n_chars % 7 = 0 AS bad_lang,
         n_chars % 7 = 1 AS no_lang, n_chars % 5 = 0 AS bad_band, n_chars % 3 = 0 AS null_term, n_chars % 2 = 0 AS extra
  FROM gold)"""

ORACLE["d4_validate_gold"] = "WITH" + GOLD + "," + FAULTS + """
SELECT row_id, 'posting' AS field, 'null' AS violation FROM faulty WHERE no_text
UNION ALL SELECT row_id, 'labels', 'no_labels' FROM faulty WHERE no_labels
UNION ALL SELECT row_id, 'lang', 'enum' FROM faulty WHERE bad_lang AND NOT no_labels
UNION ALL SELECT row_id, 'lang', 'null' FROM faulty WHERE no_lang AND NOT no_labels
UNION ALL SELECT row_id, 'band', 'enum' FROM faulty WHERE bad_band AND NOT no_labels
UNION ALL SELECT row_id, 'more_terms', 'null' FROM faulty WHERE null_term AND NOT no_labels"""

# Lines broken as a whole (n % 23 from 1 to 4), blank (5), or with faults of their own two members.
LINES = """,
lines AS (
  SELECT f.*, g.n_chars AS n, g.lang,
         CASE WHEN g.n_chars % 13 = 0 THEN NULL WHEN bad_lang THEN 'xx' WHEN no_lang THEN NULL ELSE g.lang END AS said,
         g.n_chars % 23 BETWEEN 1 AND 4 AS broken
  FROM faulty f JOIN gold g USING (row_id) WHERE g.n_chars % 23 <> 5),
found AS (
  SELECT row_id, '' AS field, 'not_json' AS violation FROM lines WHERE broken
  UNION ALL SELECT row_id, 'posting', CASE n % 17 WHEN 0 THEN 'null' WHEN 1 THEN 'type' ELSE 'missing' END FROM lines WHERE NOT broken AND n % 17 < 3
  UNION ALL SELECT row_id, 'labels', CASE WHEN n % 26 = 0 THEN 'null' ELSE 'type' END FROM lines WHERE NOT broken AND no_labels
  UNION ALL SELECT row_id, 'id', 'extra' FROM lines WHERE NOT broken AND n % 19 = 3
  UNION ALL SELECT row_id, 'lang', 'enum' FROM lines WHERE NOT broken AND bad_lang AND NOT no_labels
  UNION ALL SELECT row_id, 'lang', 'null' FROM lines WHERE NOT broken AND no_lang AND NOT no_labels
  UNION ALL SELECT row_id, 'band', 'enum' FROM lines WHERE NOT broken AND bad_band AND NOT no_labels
  UNION ALL SELECT row_id, 'more_terms', 'type' FROM lines WHERE NOT broken AND null_term AND NOT no_labels
  UNION ALL SELECT row_id, 'note', 'extra' FROM lines WHERE NOT broken AND extra AND NOT no_labels)"""

ORACLE["d4_validate_lines"] = "WITH" + GOLD + "," + FAULTS + LINES + """
SELECT field, violation, count(*) AS n_rows FROM found GROUP BY field, violation"""

ORACLE["d4_records_of_lines"] = "WITH" + GOLD + "," + FAULTS + LINES + """
SELECT row_id, row_id NOT IN (SELECT row_id FROM found) AS is_record,
       CASE WHEN NOT broken THEN said END AS lang, CASE WHEN NOT broken AND NOT no_labels THEN n::DOUBLE END AS n_chars FROM lines"""

# --- E -------------------------------------------------------------------------------------

ORACLE["e1_scalar_match"] = _COMPARED + f"""
SELECT run, row_id, {", ".join(f"ok_{f}" for f in SCALARS)} FROM compared"""

ORACLE["e2_list_f1"] = _COMPARED + f"""
SELECT run, row_id, {r6(*[f"f1_{f}" for f in LISTS])} FROM compared"""

ORACLE["e3_score_rows"] = _COMPARED + "," + SCORED + """
SELECT run, row_id, json_valid, scalar_correct, scalar_total, round(list_f1_sum, 6) AS list_f1_sum,
       list_count FROM scored"""

ORACLE["e3_score_stored_rows"] = ORACLE["e3_score_rows"]

ORACLE["e4_run_metrics"] = _METRICS + f"""
SELECT run, n_rows, valid_rows, scalar_correct, scalar_total, list_count, {r6(*METRIC_NAMES)}
FROM metrics"""

ORACLE["e4_answer_check"] = _PREDS + """,
twice AS (SELECT run, row_id FROM preds UNION ALL SELECT run, row_id FROM preds WHERE row_id % 10 = 3)
SELECT t.run, count(*) AS n_answers, count(*) - count(DISTINCT t.row_id) AS repeated_answers,
       count(*) FILTER (g.lang = 'de') AS stray_answers
FROM twice t JOIN gold g USING (row_id) GROUP BY t.run"""

ORACLE["e5_metrics_report"] = _METRICS + """
SELECT run, valid_rows AS json_valid_rows, n_rows,
       round_even(100 * json_valid, 0)::INT AS json_valid_pct,
       scalar_correct AS fields_correct, scalar_total AS fields_total,
       round_even(100 * field_acc, 0)::INT AS field_acc_pct,
       printf('%.2f', skills_f1)::DOUBLE AS skills_f1 FROM metrics"""

ORACLE["e6_compare_runs"] = _METRICS + f"""
SELECT prompt, {", ".join(
    f"round(max(CASE WHEN model = '{m}' THEN {k} END), 6) AS {m}_{k}"
    for m in ("base", "tuned") for k in METRIC_NAMES)}
FROM metrics JOIN runs USING (run) WHERE comparison = 'prompting' GROUP BY prompt"""

ORACLE["e7_win_condition"] = _METRICS + ",\nlong AS (" + " UNION ALL ".join(
    f"SELECT run, '{k}' AS metric, {k} AS v FROM metrics" for k in METRIC_NAMES) + """)
SELECT t.metric, round(t.v, 6) AS tuned, round(b.v, 6) AS base, round(t.v - b.v, 6) AS delta,
       t.v >= b.v AS met
FROM long t JOIN long b ON t.metric = b.metric AND t.run = 'tuned_zero' AND b.run = 'base_few'"""

ORACLE["e8_ablation_table"] = _METRICS + f"""
SELECT train_rows, {r6(*METRIC_NAMES)},
       round(field_acc - lag(field_acc) OVER (ORDER BY train_rows), 6) AS field_acc_gain
FROM metrics JOIN runs USING (run) WHERE comparison = 'size'"""

ORACLE["e9_source_table"] = _METRICS + "," + ORIGIN + f""",
counts AS (SELECT source, count(*) AS n FROM origin GROUP BY source
           UNION ALL SELECT 'mixed', count(*) FROM origin)
SELECT r.source, c.n AS train_rows, {r6(*METRIC_NAMES, alias='m.')}
FROM metrics m JOIN runs r ON m.run = r.run JOIN counts c ON c.source = r.source
WHERE r.comparison = 'source'"""

ORACLE["e10_field_accuracy"] = _COMPARED + ",\nhits AS (" + " UNION ALL ".join(
    [f"SELECT run, '{f.name}' AS field, '{f.kind}' AS kind, sum(ok_{f.name}::INT) AS h FROM compared GROUP BY run"
     for f in DOC_SPEC.scalars] +
    [f"SELECT run, '{f.name}', '{f.kind}', sum(f1_{f.name}) FROM compared GROUP BY run"
     for f in DOC_SPEC.lists]) + """)
SELECT run, field, kind, round(h::DOUBLE / (SELECT count(*) FROM gold), 6) AS accuracy FROM hits"""

FAILED = ",\nfailed AS (" + " UNION ALL ".join(
    [f"SELECT run, row_id, '{f}' AS field, json_extract(obj, '$.{f}')::VARCHAR AS predicted, j_{f} AS gold "
     f"FROM compared WHERE json_valid AND NOT ok_{f}" for f in SCALARS] +
    [f"SELECT run, row_id, '{f}', json_extract(obj, '$.{f}')::VARCHAR, j_{f} "
     f"FROM compared WHERE json_valid AND f1_{f} < 1" for f in LISTS] +
    ["SELECT run, row_id, '', NULL, NULL FROM compared WHERE NOT json_valid"]) + ")"

ORACLE["e11_failures"] = _COMPARED + FAILED + """
SELECT run, row_id, field, predicted, gold FROM failed"""

ORACLE["e11_top_failures"] = _COMPARED + FAILED + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY run, field ORDER BY row_id)::INT AS place FROM failed)
SELECT run, field, place, row_id, predicted, gold FROM ranked WHERE place <= 5"""

ORACLE["e12_resolution"] = _METRICS + """,
gaps AS (SELECT *, max(scalar_correct) OVER (PARTITION BY comparison) - scalar_correct AS fields,
                max(list_f1_sum) OVER (PARTITION BY comparison) - list_f1_sum AS slots
         FROM metrics JOIN runs USING (run))
SELECT run, comparison, round(1.0 / scalar_total, 9) AS field_step, round(1.0 / list_count, 9) AS slot_step,
       fields AS fields_behind, round(slots, 6) AS slots_behind,
       CASE WHEN fields = 0 AND slots = 0 THEN NULL ELSE fields <= 1 AND slots <= 1 END AS below_noise
FROM gaps"""

KNOBS = ("model", "prompt", "train_rows", "source", "epochs")
ORACLE["e13_confound_check"] = _METRICS + f""",
varied AS (
  SELECT comparison, count(*) AS n_runs, max(field_acc) - min(field_acc) AS spread, {", ".join(
      f"count(DISTINCT coalesce({k}::VARCHAR, '-')) > 1 AS d_{k}" for k in KNOBS)}
  FROM metrics JOIN runs USING (run) GROUP BY comparison)
SELECT comparison, n_runs, round(spread, 6) AS field_acc_spread,
       concat_ws(',', {", ".join(f"CASE WHEN d_{k} THEN '{k}' END" for k in KNOBS)}) AS differing_knobs,
       {" + ".join(f"d_{k}::INT" for k in KNOBS)} > 1 AS confounded
FROM varied"""

_DIFFER = ", ".join(f"CASE WHEN a.{k} IS DISTINCT FROM b.{k} THEN '{k}' END" for k in KNOBS)
_N_DIFFER = " + ".join(f"(a.{k} IS DISTINCT FROM b.{k})::INT" for k in KNOBS)
ORACLE["e13_confound_pairs"] = _METRICS + f""",
known AS (SELECT r.*, m.field_acc FROM runs r JOIN metrics m USING (run))
SELECT a.run AS run_a, b.run AS run_b,
       CASE WHEN a.comparison = b.comparison THEN a.comparison ELSE least(a.comparison, b.comparison) || ',' || greatest(a.comparison, b.comparison) END AS comparisons,
       concat_ws(',', {_DIFFER}) AS differing_knobs, {_N_DIFFER} AS n_differing,
       round(b.field_acc - a.field_acc, 6) AS field_acc_delta, {_N_DIFFER} > 1 AS confounded
FROM known a JOIN known b ON a.run < b.run"""

# --- F -------------------------------------------------------------------------------------

def pick(x: str, values) -> str:
    return f"{lits(values)}[1 + floor({x} * {len(values)})::INT]"


def pick_weighted(x: str, weighted) -> str:
    total, upto, cases = sum(w for _, w in weighted), 0, []
    for value, weight in weighted:
        upto += weight
        if weight:
            cases.append(f"WHEN {x} < {upto}.0::DOUBLE / {total} THEN {lit(value)}")
    return "CASE " + " ".join(cases) + " END"


def numbers(x: str, cases) -> str:
    return "CASE period " + " ".join(
        f"WHEN '{p}' THEN {low} + {step} * floor({x} * {n})" for p, (low, step, n) in cases.items()) + " END"


def sampler(ids: str, seed: int = SEED, tag: str = "") -> str:
    def d(name):
        return u(seed, "row_id", name)

    titles = list(P.roles)
    pools = "[" + ", ".join(lits(s) for s in P.roles.values()) + "]"
    years = "CASE seniority " + " ".join(
        f"WHEN '{s}' THEN {pick(d('years'), v)}" for s, v in P.years.items()) + " END"
    prefix = "CASE seniority " + " ".join(
        f"WHEN '{s}' THEN '{t}'" for s, t in P.seniority_titles.items()) + " END"
    return f"""
ids{tag} AS ({ids}),
drawn{tag} AS (
  SELECT row_id, 1 + floor({d('role')} * {len(titles)})::INT AS role,
         {pick_weighted(d('seniority'), P.seniority_weights.items())} AS seniority,
         {pick_weighted(d('employment'), P.employment_weights.items())} AS hired_as,
         {pick_weighted(d('workplace'), P.workplace_weights)} AS workplace_type,
         {pick_weighted(d('period'), P.period_weights.items())} AS period,
         {pick(d('city'), P.cities)} AS city, {pick(d('company'), P.companies)} AS company,
         {pick(d('currency'), P.currencies)} AS currency,
         {pick(d('education'), P.education)} AS education,
         {d('paid')} < 0.7 AS paid,
         2 + floor({d('required')} * 4)::INT AS n_req, floor({d('preferred')} * 4)::INT AS n_pref
  FROM ids{tag}),
shaped{tag} AS (
  SELECT *, {numbers(d('low'), P.salary_low)} AS low, {numbers(d('gap'), P.salary_gap)} AS gap,
         {prefix} AS prefix, {years} AS years,
         md5('{seed}:' || row_id || ':order:0') || md5('{seed}:' || row_id || ':order:1') AS hex,
         list_transform(list_sort(list_transform({pools}[role],
             lambda s, i: {{'d': substr(hex, 1 + 6 * (i - 1), 6), 's': s}})), lambda t: t.s) AS skills
  FROM drawn{tag}),
sampled{tag} AS (
  SELECT row_id,
    CASE WHEN seniority IN ('manager', 'executive') THEN prefix
         ELSE trim(prefix || ' ' || {lits(titles)}[role]) END AS title,
    company,
    CASE WHEN workplace_type IS NULL AND {d('location')} < 0.4 THEN NULL ELSE city END AS location,
    workplace_type,
    CASE WHEN seniority = 'intern' THEN 'internship' ELSE hired_as END AS employment_type,
    seniority,
    CASE WHEN paid AND NOT {d('no_min')} < 0.1 THEN low END::DOUBLE AS salary_min,
    CASE WHEN paid AND NOT {d('no_max')} < 0.15 THEN low + gap END::DOUBLE AS salary_max,
    CASE WHEN paid THEN currency END AS salary_currency,
    CASE WHEN paid THEN period END AS salary_period,
    skills[1:n_req] AS required_skills, skills[n_req + 1:n_req + n_pref] AS preferred_skills,
    years::DOUBLE AS min_years_experience, education
  FROM shaped{tag})"""


_SAMPLED = "WITH" + sampler("SELECT doc_id AS row_id FROM documents")

ORACLE["f1_uniform"] = f"SELECT doc_id, round({u(SEED, 'doc_id', 'x')}, 9) AS u FROM documents"
ORACLE["f2_choose"] = f"""
SELECT doc_id, {pick(u(SEED, 'doc_id', 'education'), P.education)} AS education FROM documents"""
ORACLE["f3_choose_weighted"] = f"""
SELECT doc_id, {pick_weighted(u(SEED, 'doc_id', 'seniority'), P.seniority_weights.items())} AS seniority
FROM documents"""
ORACLE["f4_conditional_fields"] = _SAMPLED + """
SELECT row_id, seniority, title, employment_type, min_years_experience FROM sampled"""
ORACLE["f5_null_masks"] = _SAMPLED + f"""
SELECT row_id, {", ".join(f"{c} IS NULL AS no_{c}" for c in (
    'workplace_type', 'location', 'salary_currency', 'salary_min', 'salary_max'))} FROM sampled"""
ORACLE["f6_number_grids"] = _SAMPLED + """
SELECT row_id, salary_period, salary_min, salary_max FROM sampled"""
ORACLE["f7_shuffled_prefix"] = _SAMPLED + """
SELECT row_id, array_to_string(required_skills, '|') AS required_skills,
       array_to_string(preferred_skills, '|') AS preferred_skills FROM sampled"""
ORACLE["f8_sample_labels"] = "WITH" + sampler("SELECT o_orderkey AS row_id FROM orders") + """
SELECT * REPLACE (array_to_string(required_skills, '|') AS required_skills,
                  array_to_string(preferred_skills, '|') AS preferred_skills) FROM sampled"""


def fact(name: str) -> str:
    if name in ("required_skills", "preferred_skills"):
        return jlist(name)
    if name in ("salary_min", "salary_max", "min_years_experience"):
        return jnum(name)
    return jstr(name)


_JOB_FIELDS = ("title", "company", "location", "workplace_type", "employment_type", "seniority",
               "salary_min", "salary_max", "salary_currency", "salary_period", "required_skills",
               "preferred_skills", "min_years_experience", "education")
ORACLE["f8_teacher_requests"] = _SAMPLED + """
SELECT row_id, 'Write one posting for these facts.' AS system, '{' || """ + " || ', ' || ".join(
    f"""'"{n}": ' || {fact(n)}""" for n in _JOB_FIELDS) + """ || '}' AS facts FROM sampled"""
ORACLE["f8_attach_postings"] = _SAMPLED + r"""
SELECT s.row_id, s.title,
       CASE WHEN s.row_id % 5 IN (1, 2) THEN NULL ELSE md5(regexp_replace(d.text, '^\s+|\s+$', '', 'g')) END AS posting_md5,
       CASE s.row_id % 5 WHEN 1 THEN 'missing' WHEN 2 THEN 'several' ELSE 'ok' END AS status
FROM sampled s JOIN documents d ON s.row_id = d.doc_id"""

# The closed fields and their values, as the schema states them.
CLOSED = {
    "workplace_type": ("remote", "hybrid", "onsite"),
    "employment_type": ("full_time", "part_time", "contract", "internship", "temporary"),
    "seniority": ("intern", "junior", "mid", "senior", "lead", "manager", "executive"),
    "salary_period": ("year", "month", "week", "day", "hour"),
}
ORACLE["f9_coverage_audit"] = _SAMPLED + " " + " UNION ALL ".join(
    f"SELECT '{f}' AS field, {lit(v)}::VARCHAR AS value, count(*) FILTER ({f} IS NOT DISTINCT FROM {lit(v)}) AS n_rows FROM sampled"
    for f, values in CLOSED.items() for v in (*values, None))


def _values(f: str) -> str:
    if f in ("required_skills", "preferred_skills"):
        return f"coalesce({f}, [])"
    return f"CASE WHEN {f} IS NULL THEN [] ELSE [{f + '::BIGINT' if f.startswith(('salary_m', 'min_')) else f}::VARCHAR] END"


ORACLE["f9_field_profile"] = _SAMPLED + ",\nlisted AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS field, {_values(f)} AS items FROM sampled" for f in _JOB_FIELDS) + """),
sizes AS (SELECT field, count(*) AS n_rows, count(*) FILTER (len(items) = 0) AS n_null FROM listed GROUP BY field),
counted AS (SELECT field, v, count(*) AS n, row_number() OVER (PARTITION BY field ORDER BY count(*) DESC, v) AS place
            FROM (SELECT field, unnest(items) AS v FROM listed) GROUP BY field, v),
tops AS (SELECT field, count(*) AS n_distinct, string_agg(v || ':' || n, '|' ORDER BY place) FILTER (place <= 5) AS top FROM counted GROUP BY field)
SELECT field, n_rows, n_null, round(n_null / n_rows::DOUBLE, 6) AS null_share, coalesce(n_distinct, 0) AS n_distinct, coalesce(top, '') AS top
FROM sizes LEFT JOIN tops USING (field)"""


def phrase_of(x: str) -> str:
    """A value or text as its tokens between blanks; numbers without grouping commas and trailing zeros."""
    found = rf"regexp_extract_all(lower({x}), '[0-9]+(?:[.,][0-9]+)+|[\p{{L}}\p{{N}}+#]+')"
    plain = rf"list_transform({found}, lambda t: CASE WHEN regexp_matches(t, '^[0-9]{{1,3}}(,[0-9]{{3}})+([.][0-9]+)?$') THEN replace(t, ',', '') ELSE t END)"
    short = rf"list_transform({plain}, lambda t: CASE WHEN regexp_matches(t, '^[0-9]+[.][0-9]+$') THEN regexp_replace(t, '[.]?0+$', '') ELSE t END)"
    return f"' ' || array_to_string({short}, ' ') || ' '"


def grounded(table: str, fields: dict[str, tuple[list[str], bool]]) -> str:
    """The audit of F10 over `table` (row_id, posting and a column for each field): the values that a null field
    could have had, and whether the field is a list."""
    parts = []
    for f, (asked, is_list) in fields.items():
        items = f"coalesce({f}, [])" if is_list else f"CASE WHEN {f} IS NULL THEN [] ELSE [{f}::VARCHAR] END"
        stated = f"list_distinct(list_transform({items}, lambda v: {phrase_of('v')}))"
        null = f"len(coalesce({f}, [])) = 0" if is_list else f"{f} IS NULL"
        mentioned = f"len(list_filter({lits(asked)}::VARCHAR[], lambda v: contains(line, {phrase_of('v')})))"
        parts.append(f"SELECT '{f}' AS field, len({stated}) AS stated, len(list_filter({stated}, lambda v: trim(v) <> '' AND contains(line, v))) AS found, "
                     f"{mentioned} > 0 AS mentioned FROM lined WHERE len({stated}) > 0 OR ({null} AND {bool(asked)})")
    return f""",
lined AS (SELECT *, {phrase_of("coalesce(posting, '')")} AS line FROM {table}),
long AS ({" UNION ALL ".join(parts)})
SELECT field, count(*) FILTER (stated > 0) AS n_rows, sum(stated)::BIGINT AS n_stated, sum(found)::BIGINT AS n_found,
       count(*) FILTER (stated = 0) AS n_null, count(*) FILTER (stated = 0 AND mentioned) AS n_null_mentioned,
       round(sum(found) / nullif(sum(stated), 0)::DOUBLE, 6) AS found_share,
       round(count(*) FILTER (stated = 0 AND NOT mentioned) / nullif(count(*) FILTER (stated = 0), 0)::DOUBLE, 6) AS clean_share
FROM long GROUP BY field"""


ORACLE["f10_grounding_audit"] = "WITH" + GOLD + grounded("gold", {
    **{f: ([], False) for f in ("lang", "source", "n_chars", "toxic")}, "quality": (["0", "1"], False), "band": (["good", "poor"], False),
    "last_terms": ([], True), "more_terms": (["the", "of the"], True)})

ORACLE["f10_grounding_postings"] = _SAMPLED + ",\nposted AS (SELECT s.*, d.text AS posting FROM sampled s JOIN documents d ON d.doc_id = s.row_id)" + grounded(
    "(SELECT * REPLACE (salary_min::BIGINT AS salary_min, salary_max::BIGINT AS salary_max, min_years_experience::BIGINT AS min_years_experience) FROM posted)",
    {**{f: ([], False) for f in ("title", "company", "salary_min", "salary_max", "min_years_experience", "education")},
     "location": (list(P.cities), False), "salary_currency": (list(P.currencies), False),
     **{f: (list(v), False) for f, v in CLOSED.items()}, "required_skills": ([], True), "preferred_skills": (["Go", "R", "SQL"], True)})

_ORDERS = "SELECT o_orderkey AS row_id FROM orders"
_JOB_LISTS = ("required_skills", "preferred_skills")
_JOB_SCALARS = [n for n in _JOB_FIELDS if n not in _JOB_LISTS]


def _job_f1(f: str) -> str:
    a, b = lower_set(f"a.{f}"), lower_set(f"g.{f}")
    return (f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE "
            f"2.0::DOUBLE * len(list_intersect({a}, {b})) / (len({a}) + len({b})) END")


ORACLE["e4_job_postings"] = "WITH" + sampler(_ORDERS) + "," + sampler(_ORDERS, 43, "2") + f""",
answered AS (SELECT 'same' AS run, * FROM sampled UNION ALL SELECT 'other', * FROM sampled2),
rows AS (
  SELECT a.run, {" + ".join(f"(a.{f} IS NOT DISTINCT FROM g.{f})::INT" for f in _JOB_SCALARS)} AS correct,
         {" + ".join(_job_f1(f) for f in _JOB_LISTS)} AS f1
  FROM answered a JOIN sampled g ON a.row_id = g.row_id)
SELECT run, count(*) AS n_rows, count(*) AS valid_rows, sum(correct)::BIGINT AS scalar_correct,
       round(sum(correct) / (12 * count(*))::DOUBLE, 6) AS field_acc,
       round(sum(f1) / (2 * count(*))::DOUBLE, 6) AS skills_f1
FROM rows GROUP BY run"""

ORACLE["f11_mix"] = "WITH" + ORIGIN + " SELECT row_id, source FROM origin"
ORACLE["f12_mix_table"] = "WITH" + ORIGIN + """
SELECT source AS mode, source, row_id FROM origin UNION ALL SELECT 'mixed', source, row_id FROM origin"""
