"""DuckDB SQL that gives the same rows as each registered query."""

from __future__ import annotations

BLOGS = r"""
blogs AS (
  SELECT doc_id,
    CASE WHEN doc_id % 17 = 0 THEN '' WHEN doc_id % 19 = 0 THEN NULL ELSE text END AS text,
    CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN ''
         ELSE split_part(text, chr(10), 1) END AS title
  FROM documents
),
filtered AS (
  SELECT * FROM blogs WHERE text IS NOT NULL AND text <> '' AND title IS NOT NULL AND title <> ''
),
deduped AS (SELECT min(doc_id) AS doc_id, text, title FROM filtered GROUP BY text, title)
"""

TITLE_PROMPT = r"""
  'The following is the text of a blog post. Create a title for the provided blog post.'
  || chr(10) || '### Blog:' || chr(10) || text || chr(10) || '### Title:' || chr(10)
"""

IFT = (
    BLOGS
    + f""",
pairs AS (
  SELECT doc_id AS row_key, text, {TITLE_PROMPT} AS prompt, title AS response FROM deduped
),
ift AS (
  SELECT *,
    CASE WHEN ('0x' || substr(md5(concat_ws('|', '42', prompt, response)), 1, 15))::BIGINT
              < 1037629354146162304 THEN 'train' ELSE 'eval' END AS split
  FROM pairs
)"""
)

LLM_OUT = (
    IFT
    + """,
llm_out AS (
  SELECT row_key, prompt, response,
    array_to_string(string_split(text, ' ')[1:100], ' ') AS llm_response
  FROM ift WHERE split = 'eval'
)"""
)

# Titles for the first two evaluation rows only.
PARTLY_OUT = (
    IFT
    + """,
eval_side AS (
  SELECT *, row_number() OVER (ORDER BY row_key) AS n FROM ift WHERE split = 'eval'
),
llm_out AS (
  SELECT row_key, prompt, response,
    CASE WHEN n <= 2 THEN array_to_string(string_split(text, ' ')[1:100], ' ') END AS llm_response
  FROM eval_side
)"""
)

CODE = r"""
raw AS (
  SELECT doc_id,
    CASE doc_id % 3 WHEN 0 THEN 'function' WHEN 1 THEN 'class' ELSE 'method' END AS element_type,
    CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'a' || (doc_id % 5) END AS args,
    text || CASE WHEN doc_id % 2 = 0
      THEN chr(10) || 'Parameters' || chr(10) || '----------' || chr(10) ELSE chr(10) END AS body
  FROM documents
),
code_elements AS (
  SELECT doc_id, element_type, args,
    CASE WHEN doc_id % 7 = 0 THEN NULL ELSE body END AS doc_string,
    'def f' || doc_id || '(' || coalesce(args, '') || '):' || chr(10) || '    '
      || repeat('"', 3) || body || repeat('"', 3) || chr(10) || '    return 1' || chr(10) AS source
  FROM raw
),
documented AS (
  SELECT *, split_part(source, repeat('"', 3), 1) AS fn_def
  FROM code_elements
  WHERE doc_string IS NOT NULL AND element_type = 'function' AND args IS NOT NULL
    AND length(args) > 0 AND contains(doc_string, 'Parameters')
)
"""

CODE_PROMPT = r"""
  'The following is a pyspark function definition. '
  || 'Write a numpy style docstring for the provided function definition.'
  || chr(10) || '### Function definition' || chr(10) || fn_def || chr(10)
  || '### Numpy style docstring' || chr(10)
"""

BATCHES = """
counted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn, text) - 1 AS copy,
    greatest(1, ceil(count(*) OVER () / 64.0))::BIGINT AS n_buckets
  FROM conversations
),
placed AS (
  SELECT conv_id, turn, text, copy,
    ('0x' || substr(md5(concat_ws('|', '42', conv_id, turn, text, copy // 64)), 1, 15))::BIGINT
      % n_buckets AS bucket
  FROM counted
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY conv_id, turn, text, copy) - 1 AS n
  FROM placed
)
"""


MARKED = """marked AS (
  SELECT * REPLACE (
    CASE WHEN conv_id % 50 = 7 AND turn = 0 THEN '[broken] ' || text ELSE text END AS text)
  FROM conversations
),
counted AS"""


def _request(prompts: str) -> str:
    return (
        f"to_json({{'inputs': {{'prompt': {prompts}}}, "
        "'params': {'max_tokens': 100, 'temperature': 1.0::DOUBLE}})::VARCHAR"
    )


def _decoded(text: str) -> str:
    entities = [
        ("&lt;?", "'<'"),
        ("&gt;?", "'>'"),
        ("&quot;?", "chr(34)"),
        ("&#39;?", "chr(39)"),
        ("&apos;", "chr(39)"),
        ("&nbsp;?", "chr(160)"),
        ("&copy;?", "'©'"),
        ("&middot;?", "'·'"),
        ("&amp;?", "'&'"),
    ]
    for pattern, char in entities:
        text = f"regexp_replace({text}, '{pattern}', {char}, 'g')"
    return text


HTML = f"""
WITH bodies AS (
  SELECT page_id, url,
    regexp_extract(html, '(?is)<article(?:\\s[^>]*)?>(.*?)</article\\s*>', 1) AS body
  FROM pages
),
marked AS (
  SELECT page_id, url, regexp_replace(body,
    '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>'
    || '|<template\\b.*?</template\\s*>|<[^>]*>', chr(1), 'g') AS text
  FROM bodies
),
nodes AS (
  SELECT page_id, url, list_filter(
    list_transform(string_split({_decoded('text')}, chr(1)), lambda node:
      trim(node, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160))),
    lambda node: node <> '') AS texts
  FROM marked
)
SELECT page_id, url,
  replace(replace(replace(array_to_string(texts, ' '),
    chr(92) || '''', ''''), ' ,', ','), ' .', '.') AS article
FROM nodes
"""


WORD = r"[^ \n\t\r]+"


def _count(col: str, pattern: str) -> str:
    return f"len(regexp_extract_all({col}, '{pattern}', 0))::BIGINT"


# Over the counts ``w s y c`` made by _counts.
TEXT_SCORES = """
  token_count,
  0.39::DOUBLE * w / s + 11.8::DOUBLE * y / w - 15.59::DOUBLE AS flesch_kincaid_grade,
  4.71::DOUBLE * c / w + 0.5::DOUBLE * w / s - 21.43::DOUBLE AS ari_grade"""
ROUNDED = """* REPLACE (
  round(flesch_kincaid_grade, 6) AS flesch_kincaid_grade, round(ari_grade, 6) AS ari_grade)"""


def _counts(col: str) -> str:
    end, vowels = "[.!?]+", "[aeiouyAEIOUY]+"

    def at_least_1(pattern: str) -> str:
        return f"CASE WHEN {col} IS NOT NULL THEN greatest(1, {_count(col, pattern)})::DOUBLE END"

    return f"""
  {_count(col, WORD)} AS token_count,
  {at_least_1(WORD)} AS w,
  {at_least_1(end)} AS s,
  {at_least_1(vowels)} AS y,
  length(regexp_replace({col}, '[ \\n\\t\\r]', '', 'g'))::DOUBLE AS c"""


def _tokens(col: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({col}), '{WORD}', 0))"


_JUDGED = f""",
token_sets AS (
  SELECT *, {_tokens('llm_response')} AS p, {_tokens('response')} AS t FROM llm_out
),
sizes AS (
  SELECT *, len(list_intersect(p, t)) AS i, len(list_distinct(list_concat(p, t))) AS u, len(t) AS n
  FROM token_sets
),
judged AS (
  SELECT *,
    CASE WHEN u > 0 THEN 1 + (4 * i) // u END::INTEGER AS answer_similarity,
    CASE WHEN n > 0 THEN 1 + (4 * i) // n END::INTEGER AS answer_correctness
  FROM sizes
)"""
JUDGED = LLM_OUT + _JUDGED

_SCORES = f""",
measured AS (SELECT *, {_counts('llm_response')} FROM judged),
scores AS (
  SELECT row_key, {TEXT_SCORES}, labels.toxic AS toxicity,
    answer_similarity, answer_correctness
  FROM measured LEFT JOIN labels ON labels.doc_id = row_key
)"""
SCORES = JUDGED + _SCORES

_SUMMARY = """,
long AS (
  UNPIVOT (
    SELECT token_count::DOUBLE AS token_count, flesch_kincaid_grade, ari_grade,
      toxicity::DOUBLE AS toxicity, answer_similarity::DOUBLE AS answer_similarity,
      answer_correctness::DOUBLE AS answer_correctness
    FROM scores
  ) ON * INTO NAME metric VALUE score
),
summary AS (
  SELECT metric, 'mean' AS stat, round(avg(score), 6) AS value FROM long GROUP BY metric
  UNION ALL SELECT metric, 'variance', round(var_pop(score), 6) FROM long GROUP BY metric
  UNION ALL SELECT metric, 'p90', round(quantile_cont(score, 0.9), 6) FROM long GROUP BY metric
  UNION ALL SELECT metric, 'ratio', round(avg(CASE WHEN score > 0.5 THEN 1.0 ELSE 0.0 END), 6)
    FROM long WHERE metric = 'toxicity' GROUP BY metric
)"""
SUMMARY = SCORES + _SUMMARY

PROFILE = (
    IFT
    + f""",
profile AS (
  SELECT split, count(*) AS n_rows,
    sum({_count('prompt', WORD)} + {_count('response', WORD)})::BIGINT AS n_tokens
  FROM ift GROUP BY split
)"""
)

REFUSED = """
  CASE WHEN row_key % 50 <> 7
    THEN array_to_string(string_split(prompt, ' ')[1:100], ' ') END AS llm_response,
  CASE WHEN row_key % 50 = 7 THEN 'prompt holds [broken]' END AS error
"""

DATASET_CHECKS = {
    "filter_null_or_empty": f"WITH {BLOGS} SELECT doc_id, text, title FROM filtered",
    "filter_report": f"""WITH {BLOGS}
        SELECT (SELECT count(*) FROM blogs) AS rows_in,
          (SELECT count(*) FROM blogs) - (SELECT count(*) FROM filtered) AS rows_dropped,
          (SELECT count(*) FROM filtered) AS rows_kept""",
    "dedup_exact": f"WITH {BLOGS} SELECT doc_id, text, title FROM deduped",
    "dedup_whole_rows": """SELECT * FROM documents
        WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)""",
    "ift_pairs_blog": f"WITH {IFT} SELECT prompt, response FROM ift",
    "documented_functions": f"""WITH {CODE}
        SELECT doc_id, element_type, args, doc_string, source, fn_def FROM documented""",
    "ift_pairs_code": f"""WITH {CODE}
        SELECT {CODE_PROMPT} AS prompt, doc_string AS response FROM documented""",
    "extract_docstring": f"""WITH {CODE}
        SELECT doc_id,
          CASE WHEN doc_id % 4 <> 0 THEN string_split(source, repeat('"', 3))[2] END AS docstring
        FROM code_elements""",
    "sample_prompt": f"WITH {IFT} SELECT row_key, prompt FROM ift ORDER BY row_key LIMIT 1",
    "head_k": f"""WITH {IFT}
        SELECT row_key, prompt FROM ift WHERE split = 'eval' ORDER BY row_key LIMIT 2""",
    "row_count": f"WITH {BLOGS} SELECT count(*) AS n_rows FROM deduped",
    "column_counts": f"""WITH {BLOGS}
        SELECT 'doc_id' AS column_name, count(doc_id) AS n_values FROM blogs
        UNION ALL SELECT 'text', count(text) FROM blogs
        UNION ALL SELECT 'title', count(title) FROM blogs""",
    "split_counts": f"WITH {IFT} SELECT split, count(*) AS n_rows FROM ift GROUP BY split",
    "random_split": f"WITH {IFT} SELECT row_key, prompt, response FROM ift",
    "exact_split": f"""WITH {BLOGS}, slots AS (
          SELECT doc_id AS row_key, ('0x' || substr(md5('42|' || doc_id), 1, 15))::BIGINT AS slot FROM deduped)
        SELECT row_key, CASE WHEN row_number() OVER (ORDER BY slot) <= round_even(0.9 * count(*) OVER (), 0)
            THEN 'train' ELSE 'eval' END AS split
        FROM slots""",
    "hash_split": f"WITH {IFT} SELECT row_key, split FROM ift",
    "clean_text": r"""
        SELECT doc_id, replace(replace(replace(
            replace(replace(text, ',', ' ,'), '.', ' .') || ' it' || chr(92) || '''s',
            chr(92) || '''', ''''), ' ,', ','), ' .', '.') AS cleaned
        FROM documents""",
    "html_article": HTML,
    "html_article_nested": HTML,
    "html_article_parsed": HTML,
    "validate_ift": f"""WITH {IFT},
        sides AS (SELECT prompt, response,
            bool_or(split = 'train') AND bool_or(split = 'eval') AS shared FROM ift GROUP BY ALL),
        prompts AS (SELECT prompt, bool_or(split = 'train') AND bool_or(split = 'eval') AS shared
            FROM ift GROUP BY prompt)
        SELECT count(*) FILTER (split = 'train') AS train_rows,
          count(*) FILTER (split = 'eval') AS eval_rows,
          count(*) FILTER (split = 'train' AND (prompt = '' OR response = '')) AS train_unfit,
          count(*) FILTER (split = 'eval' AND (prompt = '' OR response = '')) AS eval_unfit,
          (SELECT count(*) FILTER (shared) FROM sides) AS shared_pairs,
          (SELECT count(*) FILTER (shared) FROM prompts) AS shared_prompts
        FROM ift""",
    "training_profile": f"WITH {PROFILE} SELECT *, n_tokens * 3 AS total_tokens FROM profile",
    "run_record": f"""WITH {PROFILE}
        SELECT split || '_n_rows' AS key, n_rows::VARCHAR AS value FROM profile
        UNION ALL SELECT split || '_n_tokens', n_tokens::VARCHAR FROM profile
        UNION ALL SELECT 'epochs', '3'
        UNION ALL SELECT 'total_tokens', (n_tokens * 3)::VARCHAR FROM profile WHERE split = 'train'""",
}

STORAGE_CHECKS = {
    "scan_dir": "SELECT doc_id, text, lang FROM documents",
    "scan_table": "SELECT doc_id, text, lang FROM documents",
    "register_table": "SELECT * FROM documents",
    "save_table": f"WITH {IFT} SELECT row_key, prompt, response, split FROM ift",
    "save_splits": f"""WITH {IFT}
        SELECT row_key, prompt, response, split FROM ift""",
    "replace_table": """SELECT doc_id, lang, length(text)::BIGINT AS n_characters
        FROM documents WHERE lang <> 'fr'""",
    "jsonl_checked": f"WITH {IFT}" + """, lines AS (
          SELECT *, CASE WHEN row_key % 7 = 0 THEN 'not one object' WHEN row_key % 11 = 0 THEN 'not one object'
              WHEN row_key % 13 = 0 THEN 'wrong type' WHEN row_key % 17 = 0 THEN 'no prompt'
              WHEN row_key % 19 = 0 THEN 'not one object' END AS reason,
            '{"row_key":' || row_key AS start
          FROM ift)
        SELECT CASE WHEN reason IS NULL THEN row_key END AS row_key, CASE WHEN reason IS NULL THEN prompt END AS prompt,
          CASE WHEN reason IS NULL THEN response END AS response, reason,
          CASE WHEN reason IS NULL THEN NULL WHEN row_key % 7 = 0 THEN start || ',"prompt":"cut'
            WHEN row_key % 11 = 0 THEN start || ',"prompt":"p"}{"prompt":"q"}'
            WHEN row_key % 13 = 0 THEN '{"row_key":"n' || row_key || '","prompt":"p"}'
            WHEN row_key % 17 = 0 THEN start || ',"prompt":null}'
            ELSE '[' || row_key || ']' END AS line
        FROM lines""",
    "jsonl_roundtrip": f"""WITH {IFT}
        SELECT prompt, CASE WHEN row_key % 5 <> 0 THEN response END AS response FROM ift""",
    "export_single_jsonl": f"WITH {IFT} SELECT prompt, response FROM ift WHERE split = 'train'",
    "table_to_jsonl": f"WITH {IFT} SELECT prompt, response FROM ift",
    "from_rows": f"""WITH {IFT}, plan(split, epochs) AS (VALUES ('train', 3), ('eval', 1))
        SELECT split, epochs, count(*) AS n_rows, count(*) * epochs AS rows_seen
        FROM ift JOIN plan USING (split) GROUP BY split, epochs""",
    "namespace_ddl": "SELECT true AS exists, true AS entered, count(*) AS n_rows FROM documents",
    "drop_table": """SELECT count(*) AS n_source, count(*) AS n_saved,
        true AS exists_before, false AS exists_after FROM documents""",
}

GENERATION_CHECKS = {
    "request_payload": f"WITH {IFT} SELECT row_key, {_request('[prompt]')} AS request FROM ift",
    "response_text": f"""WITH {LLM_OUT}
        SELECT row_key, CASE WHEN row_key % 10 <> 0 THEN llm_response END AS llm_response
        FROM llm_out""",
    "batch_requests": f"""WITH {BATCHES}
        SELECT bucket, n // 8 AS batch, count(*) AS n_prompts,
          {_request('list(text ORDER BY n)')} AS request
        FROM numbered GROUP BY bucket, n // 8""",
    "unbatch_responses": f"""WITH {BATCHES}
        SELECT conv_id, turn, n % 8 AS pos,
          array_to_string(string_split(text, ' ')[1:100], ' ') AS llm_response FROM numbered""",
    "infer_batches": f"""WITH {BATCHES.replace('FROM conversations', 'FROM marked').replace('counted AS', MARKED, 1)}
        SELECT bucket, n // 8 AS batch,
          CASE WHEN NOT bool_or(contains(text, '[broken]')) THEN to_json({{'predictions':
            list({{'candidates': [{{'text': array_to_string(string_split(text, ' ')[1:100], ' ')}}]}}
              ORDER BY n)}})::VARCHAR END AS answer,
          CASE WHEN bool_or(contains(text, '[broken]')) THEN 'prompt holds [broken]' END AS error
        FROM numbered GROUP BY bucket, n // 8""",
    "batch_infer": f"WITH {LLM_OUT} SELECT row_key, prompt, response, llm_response FROM llm_out",
    "resumed_infer": f"""WITH {IFT}
        SELECT row_key, array_to_string(string_split(prompt, ' ')[1:100], ' ') AS llm_response,
          CASE WHEN row_key % 2 = 0 THEN 1 ELSE 2 END::INTEGER AS run
        FROM ift""",
    "infer_errors": f"WITH {IFT} SELECT row_key, {REFUSED} FROM ift",
    "infer_one": f"""WITH {IFT}
        SELECT row_key, prompt,
          array_to_string(string_split(prompt, ' ')[1:100], ' ') AS llm_response
        FROM ift ORDER BY row_key LIMIT 1""",
    "payload_log": f"""WITH {IFT}, tried AS (
          SELECT row_key, CASE WHEN row_key % 50 = 7 THEN '[broken] ' || prompt ELSE prompt END AS prompt,
            {REFUSED} FROM ift)
        SELECT row_key AS request_id, {_request('[prompt]')} AS request,
          CASE WHEN error IS NULL
            THEN to_json({{'predictions': [{{'candidates': [{{'text': llm_response}}]}}]}})::VARCHAR
            ELSE to_json({{'error': error}})::VARCHAR END AS response,
          CASE WHEN error IS NULL THEN 200 ELSE 400 END::INTEGER AS status, 'lead' AS model
        FROM tried""",
    "attach_predictions": f"""WITH {IFT},
        eval_side AS (
          SELECT *, row_number() OVER (ORDER BY row_key) AS n FROM ift WHERE split = 'eval')
        SELECT row_key, prompt AS inputs, response AS ground_truth,
          CASE WHEN n <= 2 THEN array_to_string(string_split(text, ' ')[1:100], ' ') END
            AS generated_title
        FROM eval_side""",
}

SCORING_CHECKS = {
    "eval_frame": f"""WITH {LLM_OUT}
        SELECT row_key, prompt AS inputs, response AS ground_truth, llm_response FROM llm_out""",
    "text_metrics": f"""WITH measured AS (SELECT doc_id, {_counts('text')} FROM documents),
        scores AS (SELECT doc_id, {TEXT_SCORES} FROM measured)
        SELECT {ROUNDED} FROM scores""",
    "toxicity_ratio": """
        SELECT count(*) AS n_rows, count(toxic) AS n_scored,
          round(avg(CASE WHEN toxic > 0.5 THEN 1.0 WHEN toxic IS NOT NULL THEN 0.0 END), 6)
            AS toxicity_ratio
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "judge_similarity": f"WITH {JUDGED} SELECT row_key, answer_similarity FROM judged",
    "judge_correctness": f"WITH {JUDGED} SELECT row_key, answer_correctness FROM judged",
    "evaluate_plugged": f"WITH {SCORES} SELECT row_key, answer_similarity, answer_correctness FROM scores",
    "evaluate_rows": f"WITH {SCORES} SELECT {ROUNDED} FROM scores",
    "metric_summary": f"WITH {SUMMARY} SELECT * FROM summary",
    "partial_summary": f"WITH {PARTLY_OUT + _JUDGED + _SCORES + _SUMMARY} SELECT * FROM summary",
    "metrics_json": f"""WITH {SUMMARY}
        SELECT '{{' || string_agg('"' || metric || '/' || stat || '":' || value, ','
            ORDER BY metric || '/' || stat) || '}}' AS metrics
        FROM summary""",
    "run_metrics": f"WITH {SUMMARY} SELECT 'run-1' AS run_id, * FROM summary",
}

CHECKS = {**STORAGE_CHECKS, **DATASET_CHECKS, **GENERATION_CHECKS, **SCORING_CHECKS}
