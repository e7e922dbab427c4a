"""The same queries as plain SQL for DuckDB, written without the engine's code."""

from __future__ import annotations

BREAK = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"
BLANKS = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"
STRIP = rf"^[{BLANKS}]+|[{BLANKS}]+$"

CODE = r"""concat('def check_', o_orderkey::varchar, E'(x):\n    y = x\n    if x > ', floor(o_totalprice)::bigint::varchar,
 E':\n        y = 1\n    elif x < 0:\n        y = 2\n    if y == ', (o_custkey % 7)::varchar, E':\n        return "',
 o_orderstatus, E'"\n    return y')"""
MIXED = rf"CASE WHEN o_custkey % 3 = 0 THEN concat('x = ', o_orderkey::varchar, E'\ny = ''if''') ELSE {CODE} END"


def draw(text: str, word: int = 0) -> str:
    return f"cast('0x' || substr(md5({text}), {1 + 8 * word}, 8) as bigint)"


def lines(text: str) -> str:
    parts = f"regexp_split_to_array({text}, '{BREAK}')"
    return f"CASE WHEN {parts}[-1] = '' THEN {parts}[:-2] ELSE {parts} END"


def nonblank(text: str) -> str:
    return f"len(list_filter(regexp_split_to_array({text}, '{BREAK}'), lambda x: regexp_matches(x, '[^{BLANKS}]')))"


REASON = f"""CASE WHEN n_chars % 97 = 0 THEN 'invalid' WHEN {nonblank('text')} < 3 THEN 'short'
 WHEN {nonblank('text')} > 100 THEN 'long' WHEN regexp_replace(text, '{STRIP}', '', 'g') = '' THEN 'empty' END"""

COUNTERS = f"""
 WITH f AS (SELECT text, {REASON} AS reason FROM documents),
 c AS (SELECT count(*) AS functions_raw,
   count(*) FILTER (WHERE reason = 'short') AS short_functions, count(*) FILTER (WHERE reason = 'long') AS long_functions,
   count(*) FILTER (WHERE reason = 'empty') AS empty_functions, count(*) FILTER (WHERE reason = 'invalid') AS invalid_lines,
   count(DISTINCT text) FILTER (WHERE reason IS NULL) AS functions_written FROM f),
 s AS (SELECT count(*) AS files_scanned, count(*) FILTER (WHERE o_orderstatus <> 'P') AS files_parsed,
   count(*) FILTER (WHERE o_orderstatus = 'P') AS files_syntax_error, 0::bigint AS files_other_error FROM orders)
 SELECT s.*, c.*, functions_raw - functions_written - short_functions - long_functions - empty_functions - invalid_lines
   AS duplicates FROM s, c"""

# The report's rows, in order, with their titles.
REPORT = [
    ("files_scanned", "Total Python files scanned"),
    ("files_parsed", "Total Python files successfully parsed (AST)"),
    ("files_syntax_error", "Files skipped due to SyntaxError"),
    ("files_other_error", "Files skipped due to other errors"),
    ("functions_raw", "Total functions initially extracted (before cleaning)"),
    ("short_functions", "Too short (<3 lines of actual code)"),
    ("long_functions", "Too long (>100 lines of actual code)"),
    ("empty_functions", "Empty (after stripping whitespace)"),
    ("invalid_lines", "Invalid line numbers/structure"),
    ("duplicates", "Duplicates (based on code hash)"),
    ("functions_written", "Total unique, cleaned functions written"),
]


def statements(source: str, text: str, keep: str = "o_orderkey") -> str:
    """Lines of each text and the lines that hold a statement, by regex on the line."""
    return f"""
 src AS (SELECT {keep}, {text} AS code FROM {source}),
 numbered AS (SELECT *, {lines('code')} AS ls FROM src),
 hits AS (SELECT *, list_filter(list_transform(range(len(ls)), lambda i:
   {{'line': i, 'text': regexp_extract(ls[i + 1], '^[{BLANKS}]*(if.*?:)', 1)}}), lambda h: h.text <> '') AS hs FROM numbered)"""


def masked(source: str, text: str, keep: str = "o_orderkey") -> str:
    pick = "hs[(" + draw("'42:' || o_orderkey") + " % len(hs) + 1)::int]"
    return f"""{statements(source, text, keep)},
 picked AS (SELECT *, CASE WHEN len(hs) > 0 THEN {pick} END AS hit FROM hits),
 masked AS (SELECT *, hit.text AS target_text, hit IS NOT NULL AS has_if, CASE WHEN hit IS NULL THEN code ELSE
   array_to_string(list_transform(range(len(ls)), lambda i: CASE WHEN i = hit.line
     THEN regexp_replace(ls[i + 1], 'if.*?:', '<if_mask>') ELSE ls[i + 1] END), chr(10)) END AS input_text FROM picked)"""


MASKED_CODE = masked("orders", CODE)

SPLIT = """ranked AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) AS rn,
   count(*) OVER () AS total FROM orders),
 sized AS (SELECT *, ceil(total * 0.2::double)::bigint AS rest FROM ranked),
 split AS (SELECT o_orderkey, CASE WHEN rn <= total - rest THEN 'train'
   WHEN rn <= total - rest + (rest - ceil(rest * 0.5::double)::bigint) THEN 'val' ELSE 'test' END AS split FROM sized)"""

SHARE = "cast('0x' || substr(md5('42:' || o_orderkey), 1, 8) as bigint) % 10"
PARTS = f"""parts AS (SELECT *, CASE WHEN {SHARE} < 8 THEN 'train' WHEN {SHARE} < 9 THEN 'val' ELSE 'test' END AS split
   FROM masked)"""


def squeezed(text: str) -> str:
    return f"trim(regexp_replace({text}, '[{BLANKS}]+', ' ', 'g'))"


def with_context(source: str) -> str:
    return f"""ctx_l AS (SELECT *, {lines('input_text')} AS mls FROM {source}),
 ctx_i AS (SELECT *, list_position(list_transform(mls, lambda x: contains(x, '<if_mask>')), true) AS pos FROM ctx_l),
 ctx AS (SELECT *, CASE WHEN pos > 1 THEN {squeezed('mls[pos - 1]')} ELSE '' END AS prev_line,
   CASE WHEN pos < len(mls) THEN {squeezed('mls[pos + 1]')} ELSE '' END AS next_line FROM ctx_i)"""


def fitted(rows: str) -> str:
    return f"""model AS (
   SELECT 0 AS level, prev_line, next_line, target_text AS target, count(*) AS n FROM {rows} GROUP BY ALL
   UNION ALL SELECT 1, prev_line, NULL, target_text, count(*) FROM {rows} GROUP BY prev_line, target_text
   UNION ALL SELECT 2, NULL, NULL, target_text, count(*) FROM {rows} GROUP BY target_text)"""


def answered(k: int) -> str:
    """The k leading targets of the longest known context, from ``model`` and ``test``."""
    return f"""
 ranked AS (SELECT *, row_number() OVER (PARTITION BY level, prev_line, next_line ORDER BY n DESC, target) AS rank FROM model),
 firsts AS (SELECT * FROM ranked WHERE rank <= {k}),
 joined AS (
   SELECT t.o_orderkey, t.target_text, l.* FROM test t JOIN firsts l ON l.level = 0 AND l.prev_line = t.prev_line AND l.next_line = t.next_line
   UNION ALL SELECT t.o_orderkey, t.target_text, l.* FROM test t JOIN firsts l ON l.level = 1 AND l.prev_line = t.prev_line
   UNION ALL SELECT t.o_orderkey, t.target_text, l.* FROM test t JOIN firsts l ON l.level = 2),
 answers AS (SELECT *, min(level) OVER (PARTITION BY o_orderkey) AS used FROM joined)"""


def predicted(k: int) -> str:
    return f"""{MASKED_CODE}, {PARTS}, {with_context('parts')},
 fit AS (SELECT * FROM ctx WHERE split = 'train'), test AS (SELECT * FROM ctx WHERE split = 'test'),
 {fitted('fit')}, {answered(k)}"""


TOKENS = "regexp_extract_all(target_text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ ]')"


def bigrams(source: str, keep: str) -> str:
    return f"""SELECT {keep} unnest(list_prepend('<s>', {TOKENS})[:-2]) AS prev, unnest({TOKENS}) AS cur FROM {source}"""


PERPLEXITY = f"""grams AS (SELECT prev, cur, count(*) AS n FROM ({bigrams('fit', '')}) GROUP BY prev, cur),
 before AS (SELECT prev, sum(n) AS np FROM grams GROUP BY prev), v AS (SELECT count(DISTINCT cur) AS v FROM grams),
 tokens AS ({bigrams('test', 'o_orderkey,')}),
 ppl AS (SELECT o_orderkey, exp(-avg(ln((coalesce(n, 0) + 1)::double / (coalesce(np, 0) + v)::double))) AS perplexity
   FROM tokens LEFT JOIN grams USING (prev, cur) LEFT JOIN before USING (prev), v GROUP BY o_orderkey)"""


WORDS = rf"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{BLANKS}\p{{L}}\p{{N}}\x{{E000}}]+|[{BLANKS}]+"""

ROUND_TRIP = f"""WITH {MASKED_CODE} SELECT count(*) AS texts, count(*) AS with_def_token, count(*) AS with_if_token,
   count(*) AS with_mask_token, count(*) AS round_trips FROM masked"""

PRETRAIN_ROWS = """rows AS (SELECT o_orderkey, o_custkey % 7 AS kind FROM orders),
 bad AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_number, CASE kind WHEN 1 THEN 'list_text'
   WHEN 2 THEN 'list_text' WHEN 3 THEN 'length,nothing_masked' WHEN 4 THEN 'nothing_masked' WHEN 5 THEN 'list_text'
   ELSE '' END AS errors FROM rows)"""

SCORED = """rows AS (SELECT event_id, event_type AS target_text, props AS predicted_if, value,
   CASE WHEN event_type = 'error' THEN 0.0 ELSE regexp_extract(props, '([0-9]+)', 1)::double END AS score
   FROM events WHERE event_type <> 'view')"""

DOC_FUNCTIONS = f"""docs AS (SELECT source AS path, doc_id AS seq, text, lang, n_chars, {REASON} AS reject_reason FROM documents)"""

NAMED_FILES = """files AS (SELECT 'p' || page_id AS id, split(url, '/')[5] AS repo_name FROM pages
   UNION ALL SELECT 'd' || doc_id, source FROM documents)"""

SQL = {
    "nonblank_lines": f"SELECT doc_id, {nonblank('text')}::bigint AS lines FROM documents",
    "code_tokens": f"SELECT doc_id, {squeezed('text')} AS tokens FROM documents",
    "clean_reject_reason": f"SELECT doc_id AS seq, {REASON} AS reject_reason FROM documents",
    "collection_counters": COUNTERS,
    "description_report": "WITH counted AS (" + COUNTERS + ") "
    + " UNION ALL ".join(
        f"SELECT {i} AS line_no, '{title}' AS metric, {name}::bigint AS value FROM counted" for i, (name, title) in enumerate(REPORT)
    ),
    "dedup_exact": """SELECT path, seq, n_chars FROM (SELECT source AS path, doc_id AS seq, n_chars,
   row_number() OVER (PARTITION BY text ORDER BY source, doc_id) AS rn FROM documents) WHERE rn = 1""",
    "append_new_anti": """SELECT path, seq FROM (SELECT source AS path, doc_id AS seq, text,
   row_number() OVER (PARTITION BY text ORDER BY source, doc_id) AS rn FROM documents) WHERE rn = 1
   AND text NOT IN (SELECT text FROM documents WHERE lang = 'en')""",
    "cap_after_clean": f"""WITH {DOC_FUNCTIONS},
 firsts AS (SELECT path, seq, row_number() OVER (PARTITION BY text ORDER BY path, seq) AS rn FROM docs WHERE reject_reason IS NULL),
 kept AS (SELECT path, seq, row_number() OVER (ORDER BY path, seq) AS place FROM firsts WHERE rn = 1),
 cut AS (SELECT path AS cp, seq AS cs FROM kept WHERE place = 100)
 SELECT path, seq, reject_reason FROM docs, cut WHERE path < cp OR (path = cp AND seq <= cs)""",
    "head_cap": "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 150",
    "first_matching": f"""SELECT o_orderkey, {MIXED} AS code FROM orders WHERE o_custkey % 3 <> 0 ORDER BY o_orderkey LIMIT 1000""",
    "repo_urls": "SELECT DISTINCT 'https://github.com/' || source AS url FROM documents",
    "repo_name_first_wins": """SELECT repo_name, min(page_id) AS line_no, arg_min(url, page_id) AS url FROM
   (SELECT replace(split(url, '/')[-1], '.git', '') AS repo_name, page_id, url FROM pages) GROUP BY repo_name""",
    "path_parts": """SELECT page_id, split(url, '/')[1] AS repo, array_to_string(split(url, '/')[2:], '/') AS rest,
   replace(split(url, '/')[-1], '.git', '') AS local_name FROM pages""",
    "repo_url_lookup": f"""WITH {NAMED_FILES},
 found AS (SELECT repo_name, arg_min(url, page_id) AS url FROM (SELECT DISTINCT repo_name FROM files) n
   JOIN pages ON contains(url, repo_name) GROUP BY repo_name)
 SELECT id, repo_name, coalesce(url, 'https://github.com/unknown/unknown') AS repo_url FROM files LEFT JOIN found USING (repo_name)""",
    "repo_url_exact": f"""WITH {NAMED_FILES},
 found AS (SELECT replace(split(url, '/')[-1], '.git', '') AS repo_name, arg_min(url, page_id) AS url FROM pages GROUP BY 1)
 SELECT id, repo_name, coalesce(url, 'https://github.com/unknown/unknown') AS repo_url FROM files LEFT JOIN found USING (repo_name)""",
    "signature_end_line": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'async ' ELSE '' END
   || 'def check_' || o_orderkey || '(...)' AS signature, 9::bigint AS end_line FROM orders""",
    "extract_functions": rf"""WITH ok AS (SELECT *, {CODE} AS code FROM orders WHERE o_orderstatus <> 'P')
 SELECT 0 AS seq, o_orderpriority AS repo_name, 'src/f' || o_orderkey || '.py' AS file_path, 'check_' || o_orderkey AS function_name,
   1 AS start_line, 9 AS end_line, 'def check_' || o_orderkey || '(...)' AS signature, code AS original_code FROM ok
 UNION ALL SELECT 1, o_orderpriority, 'src/f' || o_orderkey || '.py', 'ping_' || o_orderkey, 13, 14,
   'async def ping_' || o_orderkey || '(...)', 'async def ping_' || o_orderkey || E'(z):\n        return z' FROM ok""",
    "file_status": """SELECT o_orderpriority || '/src/f' || o_orderkey || '.py' AS path,
   CASE WHEN o_orderstatus = 'P' THEN 'syntax_error' ELSE 'parsed' END AS status FROM orders""",
    "find_statements": f"""WITH {statements('orders', CODE)}
 SELECT o_orderkey, h.text AS statement, h.line::bigint AS line_index FROM (SELECT o_orderkey, unnest(hs) AS h FROM hits)""",
    "mask_drop": f"WITH {masked('orders', MIXED)} SELECT o_orderkey, input_text, target_text FROM masked WHERE has_if",
    "mask_keep": f"WITH {masked('orders', MIXED)} SELECT o_orderkey, input_text, target_text, has_if FROM masked",
    "skipped_no_match": f"""WITH {statements('orders', MIXED)} SELECT count(*) FILTER (WHERE len(hs) > 0) AS with_statement,
   count(*) FILTER (WHERE len(hs) = 0) AS skipped_no_match, count(*) FILTER (WHERE code IS NULL) AS missing_code FROM hits""",
    "split_exact": f"WITH {SPLIT} SELECT o_orderkey, split FROM split",
    "split_sizes": f"WITH {SPLIT} SELECT split, count(*) AS rows FROM split GROUP BY split",
    "split_hashed": f"""SELECT o_orderkey, CASE WHEN {SHARE} < 8 THEN 'train' WHEN {SHARE} < 9 THEN 'val' ELSE 'test' END AS split
   FROM orders""",
    "mask_tokens": f"""WITH ids AS (SELECT doc_id, list_transform(regexp_split_to_array(text, '[ \\n]+'), lambda w:
   CASE WHEN len(w) < 2 THEN len(w) ELSE 6 + {draw('w')} % 994 END) AS ids FROM documents),
 drawn AS (SELECT doc_id, list_transform(range(len(ids)), lambda i: {{'id': ids[i + 1],
   'chosen': ids[i + 1] > 4 AND {draw("'42:' || doc_id || ':' || i")} / 4294967296.0::double < 0.15::double,
   'kind': {draw("'42:' || doc_id || ':' || i", 1)} / 4294967296.0::double,
   'other': {draw("'42:' || doc_id || ':' || i", 2)} % 1000}}) AS ds FROM ids)
 SELECT doc_id, array_to_string(list_transform(ds, lambda d: CASE WHEN NOT d.chosen OR d.kind >= 0.9::double THEN d.id
     WHEN d.kind < 0.8::double THEN 4 ELSE d.other END), ',') AS ids,
   array_to_string(list_transform(ds, lambda d: CASE WHEN d.chosen THEN d.id ELSE -100 END), ',') AS labels FROM drawn""",
    "validate_pretrain": f"""WITH {PRETRAIN_ROWS} SELECT count(*) AS rows, count(*) FILTER (WHERE errors <> '') AS bad_rows,
   count(*) FILTER (WHERE errors = 'list_text') AS list_text, count(*) FILTER (WHERE contains(errors, 'length')) AS length,
   count(*) FILTER (WHERE contains(errors, 'nothing')) AS nothing_masked, count(*) FILTER (WHERE errors <> '') = 0 AS passed FROM bad""",
    "error_examples": f"""WITH {PRETRAIN_ROWS} SELECT row_number, o_orderkey, errors FROM bad WHERE errors <> ''
   ORDER BY o_orderkey LIMIT 5""",
    "word_frequencies": f"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(
   regexp_replace(text, '([{BLANKS}])([{BLANKS}][^{BLANKS}])', concat('\\1', chr(57344), '\\2'), 'g'),
   '{WORDS.replace("'", "''")}')) AS word FROM documents) GROUP BY word""",
    "pair_counts": r"""WITH words AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[ \n]+')) AS word
   FROM documents) GROUP BY word),
 pairs AS (SELECT unnest(list_transform(range(1, len(word)), lambda i: {'l': word[i], 'r': word[i + 1]})) AS p, n FROM words)
 SELECT p.l AS "left", p.r AS "right", sum(n)::bigint AS n FROM pairs GROUP BY ALL""",
    "encode_decode": "SELECT doc_id, text AS decoded FROM documents",
    "prepare_pairs": f"""WITH {MASKED_CODE} SELECT o_orderkey, 512::bigint AS input_len, 64::bigint AS label_len, true AS masked,
   input_text AS input_decoded, target_text AS target_decoded FROM masked""",
    "validate_tokenizer": ROUND_TRIP,
    "pretrain_table": f"""SELECT o_orderkey, 512::bigint AS ids, 512::bigint AS labels, {CODE} AS original_code_snippet,
   {CODE} AS restored FROM orders""",
    "append_mask": "SELECT doc_id, text || ' <mask>' AS text FROM documents",
    "confidence": """SELECT event_id, round(exp(-value / 10) / (exp(-value / 10) + 1e-8::double) * 100, 4) AS confidence FROM events""",
    "finetune_table": f"""WITH {MASKED_CODE}, capped AS (SELECT * FROM masked),
 {SPLIT.replace('FROM orders', 'FROM capped')}
 SELECT o_orderkey, input_text, target_text, split FROM capped JOIN split USING (o_orderkey)""",
    "statement_model": f"""WITH {MASKED_CODE}, {with_context('masked')}, {fitted('ctx')} SELECT * FROM model""",
    "predict_topk": f"""WITH {predicted(5)} SELECT o_orderkey, level, rank::int AS rank, target AS predicted_if, n FROM answers
   WHERE level = used""",
    "token_perplexity": f"""WITH {MASKED_CODE}, {PARTS}, fit AS (SELECT * FROM parts WHERE split = 'train'),
 test AS (SELECT * FROM parts WHERE split = 'test'), {PERPLEXITY}
 SELECT o_orderkey, round(perplexity, 4) AS perplexity FROM ppl""",
    "evaluation_totals": f"""WITH {predicted(1)}, {PERPLEXITY}
 SELECT (SELECT count(*) FROM test) AS rows,
   (SELECT round(avg(CASE WHEN target = target_text THEN 1.0 ELSE 0.0 END::double) * 100, 4) FROM answers WHERE level = used) AS accuracy,
   (SELECT round(avg(perplexity), 4) FROM ppl) AS mean_perplexity""",
    "benchmark_predictions": f"""WITH fit AS (WITH {MASKED_CODE}, {PARTS}, {with_context('parts')} SELECT * FROM ctx WHERE split = 'train'),
 test AS (WITH {masked('orders', MIXED)}, {with_context('masked')} SELECT * FROM ctx),
 {fitted('fit')}, {answered(1)}, {PERPLEXITY}
 SELECT t.o_orderkey, t.code, t.input_text, t.target_text, t.has_if, a.target AS predicted_if, round(p.perplexity, 4) AS perplexity
 FROM test t JOIN answers a ON a.o_orderkey = t.o_orderkey AND a.level = a.used LEFT JOIN ppl p ON p.o_orderkey = t.o_orderkey""",
    "exact_match_accuracy": f"""WITH {predicted(1)} SELECT count(*) AS rows,
   round(avg(CASE WHEN target = target_text THEN 1.0 ELSE 0.0 END::double) * 100, 4) AS accuracy FROM answers WHERE level = used""",
    "score_batches": """SELECT doc_id, split(text, ' ')[1] AS predicted_if, -len(split(text, ' ')[1])::double AS score FROM documents""",
    "generated_set": """WITH s AS (SELECT doc_id, split(text || ' <mask>', ' ')[1] AS p FROM documents)
 SELECT doc_id, p AS predicted_if, round(exp(-len(p)::double) / (exp(-len(p)::double) + 1e-8::double) * 100, 4) AS confidence FROM s""",
    "map_batches": "SELECT doc_id, (len(text) - len(replace(text, ' ', '')) + 1)::bigint AS words FROM documents",
    "map_values": "SELECT doc_id, upper(lang) AS lang FROM documents",
    "to_numeric_mean": f"WITH {SCORED} SELECT count(*) AS rows, round(avg(score), 4) AS mean_score FROM rows",
    "worst_best_topk": f"""WITH {SCORED} SELECT 'worst' AS side, * FROM (SELECT event_id, target_text, predicted_if, value FROM rows
   ORDER BY value, event_id LIMIT 10) UNION ALL SELECT 'best' AS side, * FROM (SELECT event_id, target_text, predicted_if, value
   FROM rows ORDER BY value DESC, event_id LIMIT 10)""",
    "score_histogram": """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
 b AS (SELECT least(floor((value - lo) / (hi - lo) * 20), 19)::bigint AS bin, lo AS a, (hi - lo) / 20 AS w FROM events, e)
 SELECT bin, round(a + bin * w, 4) AS lo, round(a + (bin + 1) * w, 4) AS hi, count(*) AS n FROM b GROUP BY bin, a, w""",
    "loss_history": """WITH t AS (SELECT * FROM events WHERE event_type <> 'purchase'),
 v AS (SELECT * FROM events WHERE event_type = 'purchase')
 SELECT (SELECT count(*) FROM t) AS entries, (SELECT arg_min(value, event_id) FROM t) AS first_loss,
   (SELECT arg_max(value, event_id) FROM t) AS last_loss, (SELECT min(value) FROM t) AS least_loss,
   (SELECT event_id FROM v ORDER BY value, event_id LIMIT 1) AS best_step, (SELECT min(value) FROM v) AS best_eval_loss,
   (SELECT max(event_id) FROM v) AS newest_step""",
    "loss_by_epoch": """SELECT floor(event_id / 1000.0::double * 10)::bigint AS bucket, count(*) AS entries,
   round(avg(value), 4) AS mean_loss FROM events GROUP BY 1""",
    "csv_round_trip": f"""SELECT source AS repo_name, '' AS repo_url, doc_id::varchar AS file_path, 'NA' AS function_name,
   1 AS start_line, (len(text) - len(replace(text, chr(10), '')) + 1)::int AS end_line, 'a "b", c' AS signature,
   text AS original_code, CASE WHEN lang = 'en' THEN {squeezed('text')} END AS code_tokens FROM documents""",
    "corpus_text": """SELECT line, count(*) AS n FROM (SELECT unnest(CASE WHEN text LIKE '%' || chr(10) THEN split(text, chr(10))[:-2]
   ELSE split(text, chr(10)) END || CASE WHEN text LIKE '%' || chr(10) THEN [''] ELSE []::varchar[] END) AS line FROM documents)
   GROUP BY line""",
    "pretrain_csv": f"""SELECT o_orderkey::int AS id, (o_custkey % 7)::int AS label, {CODE} AS original_code_snippet FROM orders""",
    "splits_written": f"""WITH {MASKED_CODE}, {SPLIT} SELECT o_orderkey, target_text, split FROM masked JOIN split USING (o_orderkey)""",
    "repo_lists": """SELECT DISTINCT 'https://github.com/' || lower(c_mktsegment) || '/tool-' || c_custkey % 97 AS url FROM customer""",
    "collect_flow": """WITH files AS (SELECT page_id AS n, page_id % 5 = 0 OR page_id % 11 <> 2 AS py,
   page_id % 5 <> 0 AND page_id % 7 = 1 AS broken, page_id % 5 = 0 AS blank FROM pages),
 c AS (SELECT count(*) AS scanned, count(*) FILTER (WHERE broken) AS bad, count(*) FILTER (WHERE NOT broken AND NOT blank) AS raw,
   count(DISTINCT n % 50) FILTER (WHERE NOT broken AND NOT blank) AS kept FROM files WHERE py),
 counted AS (SELECT scanned AS files_scanned, scanned - bad AS files_parsed, bad AS files_syntax_error, 0 AS files_other_error, raw AS functions_raw,
   0 AS short_functions, 0 AS long_functions, 0 AS empty_functions, 0 AS invalid_lines, raw - kept AS duplicates, kept AS functions_written FROM c)
 """ + " UNION ALL ".join(f"SELECT '{title}: ' || {name}::varchar AS line FROM counted" for name, title in REPORT)
    + " UNION ALL SELECT 'rows: ' || functions_written::varchar AS line FROM counted",
    "scored_report": f"""WITH {SCORED}, e AS (SELECT min(score) AS lo, max(score) AS hi FROM rows),
 b AS (SELECT least(floor((score - lo) / (hi - lo) * 20), 19)::int AS bin, lo AS a, (hi - lo) / 20 AS w FROM rows, e)
 SELECT 'mean' AS part, '' AS name, count(*) AS n, round(avg(score), 4) AS score FROM rows
 UNION ALL SELECT 'worst', predicted_if, 1::bigint, score FROM (SELECT * FROM rows ORDER BY score, event_id LIMIT 10)
 UNION ALL SELECT 'best', predicted_if, 1::bigint, score FROM (SELECT * FROM rows ORDER BY score DESC, event_id LIMIT 10)
 UNION ALL SELECT 'histogram', bin::varchar, count(*), round(a + bin * w, 4) FROM b GROUP BY bin, a, w""",
}

# the same log, through state files and the reader
SQL["loss_history_file"] = SQL["loss_history"]
