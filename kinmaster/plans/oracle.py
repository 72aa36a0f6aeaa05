"""DuckDB SQL stating each query's answer in the plainest way.

Pairs are found by brute force, clusters by recursion, numbers by one global
window: independent of how the Spark operators work.
"""

from __future__ import annotations

from kinmaster.functions.text import WHITESPACE, ascii_tables
from kinmaster.plans import roles
from kinmaster.plans.queries import BETA, REVIEW_QUEUE, RUN_TIME, SAMPLE
from kinmaster.schema import (
    ADDRESS_CUT,
    ADJUSTED_SCORE,
    DEDUPE_THRESHOLD,
    LABEL_NEITHER,
    LABEL_OTHER,
    LABEL_RELIABLE,
    LABEL_SAME_ADDRESS,
    LABEL_SAME_NAME,
    LINK_THRESHOLD,
    NAME_CUT,
    REVIEW_THRESHOLD,
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _ascii(x: str) -> str:
    letters, plain, several = ascii_tables()
    x = f"translate({x}, {_text(letters)}, {_text(plain)})"
    for letter, replacement in several.items():
        x = f"replace({x}, {_text(letter)}, {_text(replacement)})"
    return x


def _strip(x: str, chars: str = WHITESPACE) -> str:
    return f"trim({x}, {_text(chars)})"


def _strip_quotes_lower(x: str) -> str:
    x = _strip(_strip(_strip(x), '"'), "'")
    return _strip(f"lower({x})")


def _normalise_text(x: str) -> str:
    x = f"regexp_replace({_ascii(x)}, '  +', ' ', 'g')"
    x = f"replace({x}, {_text(chr(10))}, ' ')"
    return f"nullif({_strip_quotes_lower(x)}, '')"


def _normalise_link(x: str, comma: str = " ") -> str:
    x = f"regexp_replace({_ascii(x)}, '[\\n\\-./:]', ' ', 'g')"
    x = f"replace(replace({x}, '''', ''), ',', {_text(comma)})"
    x = f"regexp_replace({x}, '  +', ' ', 'g')"
    return f"coalesce({_strip_quotes_lower(x)}, '')"


def _key(x: str, mode: str = "compat") -> str:
    x = f"upper({_strip(x)})"
    return f"coalesce({x}, 'NAN')" if mode == "compat" else f"nullif({x}, '')"


def _pending(x: str) -> str:
    return f"({x} IS NULL OR {x} = '' OR contains({x}, 'pending'))"


def _new_id(n: str) -> str:
    return f"('EMUSHCO' || CASE WHEN length(({n})::VARCHAR) < 7 THEN lpad(({n})::VARCHAR, 7, '0') ELSE ({n})::VARCHAR END)"


# --- roles ----------------------------------------------------------------------

EXTRACT = """extract AS (
  SELECT o_orderkey AS ordinal,
         CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') THEN ' c' || o_custkey || ' ' END AS q_id,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS source,
         'Account ' || o_custkey AS ship_to,
         o_custkey::VARCHAR AS ship_to_code
  FROM orders)"""

MASTER = """master AS (
  SELECT event_id AS ordinal,
         CASE WHEN NOT (event_type = 'signup' AND value < 5) THEN 'C' || user_id END AS q_id,
         CASE WHEN event_type = 'view' THEN '1-URGENT' WHEN event_type <> 'click' THEN event_type END AS source,
         CASE WHEN event_type = 'error' THEN 'Not Found' ELSE 'Found' END AS final_status
  FROM events)"""

CLUSTERED = """clustered AS (
  SELECT o_orderkey AS record_number, o_custkey AS cluster_id,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
              THEN 'EMUSHCO' || lpad((o_custkey * 2 + (o_totalprice > 250000)::INT + 1)::VARCHAR, 7, '0')
              WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'pending review'
              WHEN o_orderpriority = '5-LOW' THEN '' END AS final_id,
         o_custkey::VARCHAR AS ship_to_code
  FROM orders)"""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS record_number,
         CASE WHEN c_acctbal >= 0 THEN c_name END AS name,
         CASE WHEN c_acctbal > 9000 THEN 'Unknown ? ' || c_custkey
              WHEN c_mktsegment = 'BUILDING' THEN 'No number'
              ELSE c_nationkey || ' Main/St.' END AS address,
         CASE WHEN c_acctbal < 0 THEN ''
              WHEN c_mktsegment = 'BUILDING' THEN c_custkey || '-' || c_nationkey
              WHEN c_mktsegment <> 'MACHINERY' THEN (c_custkey * 1001)::VARCHAR END AS zip,
         ' ' || lower(c_mktsegment) || ' ' AS record_type
  FROM customer)"""

REVIEW = """review AS (
  SELECT l_orderkey AS cluster_id, o_totalprice / 500000 AS link_score, l_linenumber AS source_file,
         l_suppkey AS ordinal, l_partkey AS id, l_extendedprice AS amount, p_name AS name, p_type AS address,
         p_brand AS city, l_returnflag AS state, CASE WHEN p_size > 5 THEN p_size::VARCHAR END AS zip,
         'Q' || l_suppkey AS q_id, o_orderpriority AS source
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)"""

# --- intake ---------------------------------------------------------------------


def _keyed(mode: str = "compat") -> str:
    return f"""{EXTRACT}, {MASTER},
keyed AS (SELECT * REPLACE ({_key('q_id', mode)} AS q_id) FROM extract),
known AS (SELECT * REPLACE ({_key('q_id', mode)} AS q_id) FROM master)"""


IS_NEW = "NOT EXISTS (SELECT 1 FROM known m WHERE m.q_id = k.q_id)"
IS_NOT_FOUND = "EXISTS (SELECT 1 FROM known m WHERE m.q_id = k.q_id AND m.final_status = 'Not Found')"

ORACLE: dict[str, str] = {
    "scan_select": "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
    "head": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
    "run_stats": "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem",
    "source_split": f"""WITH {EXTRACT}
SELECT *, CASE WHEN source = '1-URGENT' THEN 'split' ELSE 'rest' END AS part FROM extract""",
    "intake_new": f"WITH {_keyed()} SELECT * FROM keyed k WHERE {IS_NEW}",
    "intake_new_strict": f"WITH {_keyed('strict')} SELECT * FROM keyed k WHERE {IS_NEW}",
    "intake_not_found": f"WITH {_keyed()} SELECT * FROM keyed k WHERE {IS_NOT_FOUND}",
    "intake_counts": f"""WITH {_keyed()},
t AS (SELECT *, {IS_NEW} AS is_new, {IS_NOT_FOUND} AS is_nf,
             CASE WHEN source = '1-URGENT' THEN 'split' ELSE 'rest' END AS source_group FROM keyed k),
m AS (SELECT CASE WHEN source = '1-URGENT' THEN 'split' ELSE 'rest' END AS source_group,
             count(DISTINCT q_id) AS master_unique FROM known GROUP BY 1)
SELECT source_group, count(DISTINCT q_id) AS extract_unique,
       count(*) FILTER (WHERE is_new) AS new_rows,
       count(DISTINCT q_id) FILTER (WHERE is_new) AS new_unique,
       count(*) FILTER (WHERE is_nf) AS not_found_rows,
       count(DISTINCT q_id) FILTER (WHERE is_nf) AS not_found_unique,
       any_value(master_unique) AS master_unique
FROM t JOIN m USING (source_group) GROUP BY source_group""",
    "combined_status": f"""WITH {_keyed()},
t AS (SELECT *, {IS_NEW} AS new_account, {IS_NOT_FOUND} AS is_nf FROM keyed k)
SELECT * EXCLUDE (is_nf), CASE WHEN new_account THEN 'Pending' ELSE 'Not Found' END AS status
FROM t WHERE new_account OR is_nf""",
    "new_accounts": f"WITH {_keyed()} SELECT *, '01/31/2024' AS date_received FROM keyed k WHERE {IS_NEW}",
    "append_logbook": f"""WITH {_keyed()},
both_sides AS (
  SELECT 0 AS block, ordinal, q_id, source, final_status, FALSE AS new_account, NULL AS name, NULL AS ship_to_code
  FROM known
  UNION ALL
  SELECT CASE WHEN source = '1-URGENT' THEN 1 ELSE 2 END, ordinal, q_id, source, NULL, TRUE, ship_to, ship_to_code
  FROM keyed k WHERE {IS_NEW})
SELECT row_number() OVER (ORDER BY block, ordinal) AS record_number, * EXCLUDE (block) FROM both_sides""",
    "new_by_source": f"""WITH {_keyed()},
s AS (SELECT source, count(DISTINCT q_id) AS unique_keys FROM keyed k
      WHERE {IS_NEW} AND source IS NOT NULL GROUP BY source)
SELECT * FROM s UNION ALL SELECT NULL, coalesce(sum(unique_keys), 0)::BIGINT FROM s""",
    "distinct_pairs": f"""WITH {MASTER}
SELECT count(*) AS n FROM (SELECT DISTINCT q_id, source FROM master WHERE q_id IS NOT NULL AND source IS NOT NULL)""",
    "rename_reorder": f"WITH {EXTRACT} SELECT ship_to_code AS code, ship_to AS name, ordinal, q_id, source FROM extract",
    "drop_empty_columns": """SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS sometimes FROM orders""",
    "align_columns": f"WITH {EXTRACT} SELECT source, NULL::VARCHAR AS comments, q_id, ordinal, ship_to_code FROM extract",
    "normalise_key": f"""WITH {EXTRACT}
SELECT ordinal, {_key('q_id')} AS compat_key, {_key('q_id', 'strict')} AS strict_key FROM extract""",
    "sink_roundtrip": f"WITH {EXTRACT} SELECT ordinal::VARCHAR AS ordinal, q_id, source FROM extract",
    "stream_intake": f"WITH {_keyed()} SELECT * FROM keyed k WHERE {IS_NEW}",
}

_COLUMNS = ("ordinal", "q_id", "ship_to", "ship_to_code")
_PER_SOURCE = f"""WITH {_keyed()}
SELECT source, {', '.join(f'count(DISTINCT {c}) AS n_{c}' for c in _COLUMNS)}
FROM keyed k WHERE {IS_NEW} AND source IS NOT NULL GROUP BY source"""
ORACLE["distinct_all_columns"] = _PER_SOURCE
ORACLE["distinct_all_columns_total"] = (
    f"SELECT {', '.join(f'sum(n_{c})::BIGINT AS n_{c}' for c in _COLUMNS)} FROM ({_PER_SOURCE})"
)
_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
ORACLE["profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, count(*) AS n_rows FROM lineitem"
    for c, t in _TYPES.items()
)

# --- cleaning ---------------------------------------------------------------------

_CLEAN_ADDRESS = _normalise_link("address")
_USABLE = (
    f"({_normalise_link('name')} <> '' AND regexp_matches({_CLEAN_ADDRESS}, '[0-9]')"
    f" AND NOT contains({_CLEAN_ADDRESS}, '?'))"
)
_ZIP_BASE = "split_part(coalesce(zip, ''), '-', 1)"


def _pad(x: str) -> str:
    return f"CASE WHEN length({x}) < 5 THEN lpad({x}, 5, '0') ELSE {x} END"


ORACLE |= {
    "normalise_text": f"SELECT doc_id, {_normalise_text('text')} AS text FROM documents",
    "normalise_link_text": f"""SELECT doc_id, {_normalise_link('text')} AS spaced,
       {_normalise_link('text', '')} AS removed FROM documents""",
    "normalise_zip": f"""WITH {CUSTOMERS}
SELECT record_number, CASE WHEN {_ZIP_BASE} <> '' THEN {_pad(_ZIP_BASE)} END AS strict_zip,
       {_pad(_ZIP_BASE)} AS compat_zip FROM customers""",
    "quality_kept": f"WITH {CUSTOMERS} SELECT * FROM customers WHERE {_USABLE}",
    "quality_dropped": f"WITH {CUSTOMERS} SELECT * FROM customers WHERE NOT {_USABLE}",
    "exclude_type": f"WITH {CUSTOMERS} SELECT * FROM customers WHERE trim(record_type) <> 'household'",
    "excluded_count": f"""WITH {CUSTOMERS} SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE trim(record_type) = 'household') AS skipped FROM customers""",
}

# --- identity -----------------------------------------------------------------------

_MAX = f"""coalesce((SELECT max(TRY_CAST(replace(final_id, 'EMUSHCO', '') AS BIGINT)) FROM clustered
  WHERE NOT {_pending('final_id')}), 0)"""


def _assigned(policy: str = "compat") -> str:
    usable = "coalesce(final_id, '') <> ''" if policy == "compat" else f"NOT {_pending('final_id')}"
    return f"""{CLUSTERED},
known_ids AS (
  SELECT DISTINCT cluster_id, first_value(CASE WHEN {usable} THEN final_id END IGNORE NULLS) OVER (
           PARTITION BY cluster_id ORDER BY record_number
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS known_id,
         min(record_number) OVER (PARTITION BY cluster_id) AS first_row
  FROM clustered),
created AS (
  SELECT cluster_id, {_new_id(f'{_MAX} + row_number() OVER (ORDER BY first_row)')} AS created_id
  FROM known_ids WHERE known_id IS NULL),
assigned AS (
  SELECT c.* REPLACE (CASE WHEN {_pending('final_id')} THEN coalesce(known_id, created_id) ELSE final_id END AS final_id)
  FROM clustered c JOIN known_ids USING (cluster_id) LEFT JOIN created USING (cluster_id))"""


_NUMBER = "TRY_CAST(replace(final_id, 'EMUSHCO', '') AS BIGINT)"
_FLAG = f"(NOT {_pending('final_id')} AND {_NUMBER} > {_MAX})"
_FLAGGED = f"""{_assigned()},
flagged AS (SELECT *, coalesce({_FLAG}, FALSE)::INT AS net_new FROM assigned)"""
_IN_CODES = "ship_to_code IN (SELECT user_id::VARCHAR FROM events)"

ORACLE |= {
    "id_pending": f"WITH {CLUSTERED} SELECT *, {_pending('final_id')} AS pending FROM clustered",
    "id_pending_counts": f"""WITH {CLUSTERED} SELECT count(*) FILTER (WHERE {_pending('final_id')}) AS pending,
       count(*) FILTER (WHERE NOT {_pending('final_id')}) AS not_pending FROM clustered""",
    "id_max": f"WITH {CLUSTERED} SELECT {_MAX} AS max_number, {_new_id(_MAX)} AS max_id",
    "id_max_text": f"WITH {CLUSTERED} SELECT max(final_id) AS max_id_text FROM clustered",
    "id_assign": f"WITH {_assigned()} SELECT * FROM assigned",
    "id_assign_strict": f"WITH {_assigned('strict')} SELECT * FROM assigned",
    "id_qc_counts": f"""WITH {_assigned()} SELECT count(DISTINCT cluster_id) AS unique_clusters,
       count(DISTINCT final_id) AS unique_ids FROM assigned""",
    "id_qc_duplicates": f"""WITH {_assigned()}
SELECT * FROM assigned
QUALIFY count(*) OVER (PARTITION BY final_id) > 1 ORDER BY final_id, record_number""",
    "ids_per_cluster": f"""WITH {CLUSTERED}
SELECT cluster_id, count(DISTINCT final_id) AS unique_ids FROM clustered GROUP BY cluster_id""",
    "cluster_conflict": f"""WITH {CLUSTERED},
n AS (SELECT cluster_id, count(DISTINCT final_id) AS ids FROM clustered GROUP BY cluster_id)
SELECT c.*, (ids > 1)::INT AS label FROM clustered c JOIN n USING (cluster_id)""",
    "net_new": f"WITH {_FLAGGED} SELECT * FROM flagged",
    "net_new_compat": f"WITH {_assigned()} SELECT *, (final_id > {_new_id(_MAX)})::INT AS net_new FROM assigned",
    "net_new_unmatched": f"""WITH {_FLAGGED} SELECT * RENAME (cluster_id AS "Dedupe_Cluster ID")
FROM flagged WHERE net_new = 1 AND NOT {_IN_CODES}""",
    "net_new_matched": f"WITH {_FLAGGED} SELECT * FROM flagged WHERE net_new = 1 AND {_IN_CODES}",
    "seq_id_per_cluster": f"""WITH {CLUSTERED},
f AS (SELECT cluster_id, min(record_number) AS first_row FROM clustered GROUP BY cluster_id),
n AS (SELECT cluster_id, {_new_id('row_number() OVER (ORDER BY first_row)')} AS new_id FROM f)
SELECT new_id, record_number, cluster_id FROM clustered JOIN n USING (cluster_id)""",
    "run_log": f"""WITH {_FLAGGED} SELECT '{RUN_TIME}' AS run_time,
       count(DISTINCT final_id) FILTER (WHERE net_new = 1) AS ids_created, max(final_id) AS max_id FROM flagged""",
    "entry_number": f"""WITH {CLUSTERED} SELECT record_number, cluster_id,
       row_number() OVER (PARTITION BY cluster_id ORDER BY record_number) AS entry FROM clustered""",
}

# --- matching -------------------------------------------------------------------------

_T = roles.DOCUMENT_SIMILARITY
_SCORE = """CASE WHEN both_lang THEN round((sim_text * 0.8 + sim_lang * 0.2) / (0.8 + 0.2), 6)
     ELSE round(sim_text * 0.8 / 0.8, 6) END"""

# Every document with its words and blocking keys; ``copies`` are alike in all of it.
DOCS = f"""docs AS MATERIALIZED (
  SELECT doc_id, lang_or_null AS lang, source, n_chars, norm, string_split(norm, ' ') AS ws,
         list_sort(list_distinct(list_filter(string_split(norm, ' '), lambda w: w <> ''))) AS toks
  FROM (SELECT doc_id, CASE WHEN lang <> 'es' THEN lang END AS lang_or_null, source, n_chars,
               {_normalise_link('text')} AS norm FROM documents)),
word_list AS MATERIALIZED (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM docs WHERE norm <> ''),
phrases AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(concat_ws(' ', w, w2, w3)) AS p FROM (
    SELECT *, lead(w) OVER word_order AS w2, lead(w, 2) OVER word_order AS w3 FROM word_list
    WINDOW word_order AS (PARTITION BY doc_id ORDER BY i))
  WHERE w3 IS NOT NULL OR i = 1),
doc_keys AS MATERIALIZED (
  SELECT doc_id, 'phrases' AS rule, p AS key FROM phrases
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p) <= 8
  UNION ALL SELECT doc_id, 'words', md5(array_to_string(toks, ' ')) FROM docs),
alike AS MATERIALIZED (SELECT doc_id, list_sort(list(rule || key)) AS ks FROM doc_keys GROUP BY doc_id),
copies AS MATERIALIZED (
  SELECT doc_id, lang, toks, ks, CASE WHEN len(toks) = 0 THEN doc_id
         ELSE min(doc_id) OVER (PARTITION BY toks, lang, ks) END AS rep_id FROM docs JOIN alike USING (doc_id)),
reps AS MATERIALIZED (SELECT doc_id AS id, lang, toks, ks FROM copies WHERE doc_id = rep_id)"""


def _pairs(left: str, right: str, on: str) -> str:
    """Scored pairs sharing a key, by brute force over shared words."""
    return f"""lw AS MATERIALIZED (SELECT id, len(toks) AS n, unnest(toks) AS w FROM {left}),
rw AS MATERIALIZED (SELECT id, len(toks) AS n, unnest(toks) AS w FROM {right}),
near AS MATERIALIZED (
  SELECT a.id AS left_id, b.id AS right_id, count(*) / (any_value(a.n) + any_value(b.n) - count(*)) AS j
  FROM lw a JOIN rw b ON a.w = b.w AND {on} GROUP BY 1, 2 HAVING j >= {_T}),
shared AS MATERIALIZED (
  SELECT left_id, right_id, j, a.lang AS la, b.lang AS lb, len(list_intersect(a.ks, b.ks))::INT AS shared_keys
  FROM near JOIN {left} a ON a.id = left_id JOIN {right} b ON b.id = right_id),
features AS MATERIALIZED (
  SELECT left_id, right_id, shared_keys, round(j, 6) AS similarity, round(j, 6) AS sim_text, 0 AS missing_text,
         (la IS NOT NULL AND lb IS NOT NULL) AS both_lang,
         CASE WHEN la = lb THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS sim_lang,
         CASE WHEN la IS NOT NULL AND lb IS NOT NULL THEN 0 ELSE 1 END AS missing_lang
  FROM shared WHERE shared_keys > 0),
scored AS MATERIALIZED (SELECT * EXCLUDE (both_lang), {_SCORE} AS score FROM features)"""


SELF_PAIRS = f"{DOCS}, {_pairs('reps', 'reps', 'a.id < b.id')}"
_EDGES = f"edges AS (SELECT left_id, right_id FROM scored WHERE score >= {DEDUPE_THRESHOLD})"
COMPONENTS = f"""{SELF_PAIRS}, {_EDGES},
reach(id, other) AS (
  SELECT id, id FROM reps
  UNION
  SELECT r.id, CASE WHEN e.left_id = r.other THEN e.right_id ELSE e.left_id END
  FROM reach r JOIN edges e ON r.other IN (e.left_id, e.right_id)),
components AS MATERIALIZED (SELECT id, min(other) AS component FROM reach GROUP BY id),
clusters AS MATERIALIZED (
  SELECT doc_id AS record_id, component FROM copies JOIN components ON rep_id = id)"""

_SCORE_OF = """CASE WHEN a.rep_id = b.rep_id THEN 1.0
  WHEN a.lang IS NOT NULL AND b.lang IS NOT NULL
  THEN round((round({j}, 6) * 0.8 + (a.lang = b.lang)::INT * 0.2::DOUBLE) / (0.8 + 0.2), 6)
  ELSE round(round({j}, 6) * 0.8 / 0.8, 6) END""".replace(
    "{j}",
    "len(list_intersect(a.toks, b.toks)) / (len(a.toks) + len(b.toks) - len(list_intersect(a.toks, b.toks)))",
)

LEFT_RIGHT = f"""{DOCS},
left_docs AS (SELECT c.doc_id AS id, c.lang, c.toks, c.ks FROM copies c JOIN docs USING (doc_id) WHERE length(source) = 4),
right_docs AS (SELECT c.doc_id AS id, c.lang, c.toks, c.ks FROM copies c JOIN docs USING (doc_id) WHERE length(source) <> 4),
{_pairs('left_docs', 'right_docs', 'TRUE')},
best AS MATERIALIZED (
  SELECT left_id, right_id, score FROM scored WHERE score >= {LINK_THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY score DESC, right_id) = 1),
resolved AS (
  SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY right_id ORDER BY score DESC, left_id) = 1),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY left_id) - 1 AS cluster_id FROM best),
linked AS MATERIALIZED (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, cluster_id, score AS link_score, 0 AS source_file
  FROM documents d LEFT JOIN numbered ON doc_id = left_id WHERE length(d.source) = 4
  UNION ALL
  SELECT d.doc_id, d.lang, d.source, d.n_chars, cluster_id, r.score, 1
  FROM documents d LEFT JOIN resolved r ON doc_id = r.right_id LEFT JOIN numbered n ON n.left_id = r.left_id
  WHERE length(d.source) <> 4)"""

_RULES = """rule_keys AS MATERIALIZED (
  SELECT doc_id, unnest([
    {'rule': 'first_word', 'key': ws[1]},
    {'rule': 'length', 'key': n_chars::VARCHAR},
    {'rule': 'lang', 'key': lang}], recursive := true)
  FROM docs UNION ALL SELECT * FROM doc_keys),
keys AS MATERIALIZED (SELECT * FROM rule_keys WHERE trim(coalesce(key, '')) <> '')"""

ORACLE |= {
    "block_pairs": f"WITH {SELF_PAIRS} SELECT left_id, right_id, similarity, shared_keys FROM scored",
    "rule_coverage": f"""WITH {DOCS}, {_RULES},
matches AS (SELECT rep_id AS left_id, doc_id AS right_id FROM copies WHERE doc_id <> rep_id),
sizes AS (SELECT rule, key, count(*) AS n FROM keys GROUP BY ALL),
cost AS (SELECT rule, sum(n * (n - 1) // 2)::DECIMAL(38,0) AS n_pairs, max(n) AS largest_block FROM sizes GROUP BY rule),
cov AS (SELECT a.rule, count(*) AS covered FROM matches JOIN keys a ON a.doc_id = left_id
        JOIN keys b ON b.doc_id = right_id AND a.rule = b.rule AND a.key = b.key GROUP BY a.rule)
SELECT rule, n_pairs, largest_block, coalesce(covered, 0) AS covered,
       round(coalesce(covered, 0) / greatest((SELECT count(*) FROM matches), 1), 6) AS recall
FROM cost LEFT JOIN cov USING (rule)""",
    "score_pairs": f"WITH {SELF_PAIRS} SELECT * FROM scored",
    "pair_sample": f"""WITH {SELF_PAIRS} SELECT left_id, right_id, score FROM scored
ORDER BY md5(left_id || '-' || right_id), left_id, right_id LIMIT {SAMPLE}""",
    "uncertain_pairs": f"""WITH {SELF_PAIRS} SELECT left_id, right_id, score, round(abs(score - 0.5), 6) AS doubt
FROM scored ORDER BY doubt, left_id, right_id LIMIT {REVIEW_QUEUE}""",
    "connected_components": f"WITH RECURSIVE {COMPONENTS} SELECT * FROM clusters",
    "cluster_count": f"WITH RECURSIVE {COMPONENTS} SELECT count(DISTINCT component) AS n_clusters FROM clusters",
    "cluster_confidence": f"""WITH RECURSIVE {COMPONENTS},
member AS (SELECT c.doc_id, c.rep_id, k.component FROM copies c JOIN clusters k ON k.record_id = c.doc_id),
sizes AS (SELECT component, count(*) AS size FROM clusters GROUP BY component),
mates AS (
  SELECT a.doc_id, (1 - coalesce(s.score, CASE WHEN a.rep_id = b.rep_id THEN 1.0 ELSE 0.0 END)) AS d
  FROM member a JOIN member b ON a.component = b.component AND a.doc_id <> b.doc_id
  LEFT JOIN scored s ON s.left_id = least(a.rep_id, b.rep_id) AND s.right_id = greatest(a.rep_id, b.rep_id)),
sums AS (SELECT doc_id, sum(d * d) AS total FROM mates GROUP BY doc_id)
SELECT m.doc_id AS record_id, m.component,
       CASE WHEN size = 1 THEN 1.0 ELSE round(1 - sqrt(total / (size - 1)), 6) END AS confidence_score
FROM member m JOIN sizes USING (component) LEFT JOIN sums USING (doc_id)""",
    "cluster_output": f"""WITH RECURSIVE {COMPONENTS},
numbered AS (SELECT component, row_number() OVER (ORDER BY component) - 1 AS cluster_id
             FROM (SELECT DISTINCT component FROM clusters))
SELECT n.cluster_id, CASE WHEN a.doc_id = b.doc_id THEN 1.0 ELSE {_SCORE_OF} END AS confidence_score,
       d.*
FROM documents d JOIN clusters k ON k.record_id = d.doc_id JOIN numbered n USING (component)
JOIN copies a ON a.doc_id = k.component JOIN copies b ON b.doc_id = d.doc_id""",
    "versioned_set": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'",
    "by_group_size": "SELECT o_orderkey AS record_number, o_custkey AS cluster_id FROM orders",
    "link_best": f"WITH {LEFT_RIGHT} SELECT * FROM best",
    "link_resolved": f"WITH {LEFT_RIGHT} SELECT * FROM resolved",
    "link_output": f"WITH {LEFT_RIGHT} SELECT * FROM linked",
    "pair_horizontal": f"""WITH {LEFT_RIGHT},
two AS (SELECT * FROM linked WHERE cluster_id IS NOT NULL QUALIFY count(*) OVER (PARTITION BY cluster_id) = 2)
SELECT {', '.join(f'{s}.{c} AS {p}{c}' for s, p in (('a', 'SFDC_'), ('b', 'ExFactory_'))
                  for c in ('doc_id', 'lang', 'source', 'n_chars', 'cluster_id', 'link_score'))}
FROM (SELECT * FROM two WHERE source_file = 0) a JOIN (SELECT * FROM two WHERE source_file = 1) b USING (cluster_id)""",
}

# --- review -----------------------------------------------------------------------------


def _ratio(a: str, b: str) -> str:
    """Percentage from the longest common subsequence, a bit per character (up to 62)."""
    a, b = f"lower({a})", f"lower({b})"
    full = f"((1::BIGINT << length({a})) - 1)"
    masks = f"""list_transform(string_split({b}, ''), lambda ch: coalesce(list_sum(list_transform(
  range(1, length({a}) + 1), lambda i: CASE WHEN substr({a}, i::BIGINT, 1) = ch THEN 1::BIGINT << (i - 1)::INT ELSE 0 END)), 0)::BIGINT)"""
    free = f"list_reduce(list_prepend({full}, {masks}), lambda v, m: ((v + (v & m)) | (v & ~m)) & {full})"
    common = f"(length({a}) - bit_count({free}))"
    total = f"(length({a}) + length({b}))"
    whole, rest = f"((200 * {common}) // {total})", f"((200 * {common}) % {total})"
    up = f"CASE WHEN 2 * {rest} > {total} OR (2 * {rest} = {total} AND {whole} % 2 = 1) THEN 1 ELSE 0 END"
    return f"(({whole} + {up}) / 100.0::DOUBLE)"


def _similarity(column: str) -> str:
    a, b = f"first_{column}", f"second_{column}"
    return f"round(1 - levenshtein({a}, {b}) / greatest(length({a}), length({b})), 6)"


_ORDER = ", ".join(roles.REVIEW_ORDER)


def _entries(where: str, columns: tuple[str, ...]) -> str:
    picked = ", ".join(f"a.{c} AS first_{c}, b.{c} AS second_{c}" for c in columns)
    return f"""{REVIEW},
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY {_ORDER}) AS entry
           FROM review WHERE {where}),
pairs AS MATERIALIZED (SELECT a.cluster_id, {picked} FROM ranked a JOIN ranked b
          ON a.cluster_id = b.cluster_id AND a.entry = 1 AND b.entry = 2)"""


_FIELDS = ("name", "address", "city", "state", "zip")
_PAIR_FEATURES = f"""{_entries('TRUE', _FIELDS)},
features AS MATERIALIZED (
  SELECT cluster_id, first_state = second_state AS same_state,
         {_similarity('name')} AS sim_name, 0 AS missing_name,
         {_similarity('address')} AS sim_address, 0 AS missing_address,
         {_similarity('city')} AS sim_city, 0 AS missing_city,
         (first_state = second_state)::INT::DOUBLE AS sim_state, 0 AS missing_state,
         coalesce({_similarity('zip')}, 0.0) AS sim_zip,
         (first_zip IS NULL OR second_zip IS NULL)::INT AS missing_zip
  FROM pairs),
scored AS MATERIALIZED (
  SELECT *, round((0.0::DOUBLE + sim_name * 0.4::DOUBLE + sim_address * 0.3::DOUBLE + sim_city * 0.1::DOUBLE
                   + sim_state * 0.1::DOUBLE + sim_zip * 0.1::DOUBLE)
                  / (0.4::DOUBLE + 0.3::DOUBLE + 0.1::DOUBLE + 0.1::DOUBLE + 0.1::DOUBLE * (1 - missing_zip)), 6) AS score
  FROM features)"""


def _line(side: str) -> str:
    return f"({side}_address || ', ' || {side}_city || ', ' || {side}_state || ' ' || coalesce({side}_zip, ''))"


_LABELS = f"""{_entries(f'link_score < {REVIEW_THRESHOLD}', _FIELDS)},
likeness AS MATERIALIZED (
  SELECT cluster_id, {_ratio('first_name', 'second_name')} AS name_similarity,
         {_ratio(_line('first'), _line('second'))} AS address_similarity FROM pairs),
labels AS MATERIALIZED (
  SELECT *, CASE WHEN name_similarity >= {NAME_CUT} AND address_similarity >= {ADDRESS_CUT} THEN '{LABEL_RELIABLE}'
                 WHEN address_similarity >= {ADDRESS_CUT} THEN '{LABEL_SAME_ADDRESS}'
                 WHEN name_similarity >= {NAME_CUT} THEN '{LABEL_SAME_NAME}'
                 ELSE '{LABEL_NEITHER}' END AS label FROM likeness)"""
_ADJUSTED = " ".join(
    f"WHEN label = '{k}' THEN {REVIEW_THRESHOLD if v is None else v}::DOUBLE" for k, v in ADJUSTED_SCORE.items()
)
_LABELLED = f"""{_LABELS},
labelled AS MATERIALIZED (
  SELECT r.*, coalesce(label, '{LABEL_OTHER}') AS label, name_similarity, address_similarity,
         CASE {_ADJUSTED} ELSE link_score END AS adjusted_link_score
  FROM review r LEFT JOIN labels USING (cluster_id))"""
_WIDE = ("id", "name", "address", "city", "state", "zip", "q_id", "source", "source_file", "link_score")

_CURVE = f"""{_PAIR_FEATURES},
counts AS (SELECT round(score, 6) AS threshold, count(*) AS n, sum(same_state::INT) AS m FROM scored GROUP BY 1),
sums AS (SELECT threshold, sum(n) OVER (ORDER BY threshold DESC) AS selected,
                sum(m) OVER (ORDER BY threshold DESC) AS hits, sum(m) OVER () AS matches FROM counts),
pr AS (SELECT threshold, hits, hits / selected AS p, CASE WHEN matches > 0 THEN hits / matches ELSE 0 END AS r FROM sums),
curve AS (SELECT threshold, round(p, 6) AS precision, round(r, 6) AS recall,
                 CASE WHEN hits > 0 THEN round((1 + {BETA * BETA}::DOUBLE) * p * r / ({BETA * BETA}::DOUBLE * p + r), 6)
                      ELSE 0.0 END AS f_beta FROM pr)"""

ORACLE |= {
    "string_ratio": f"SELECT p_partkey, {_ratio('p_name', '''(p_type || ' ' || p_brand)''')} AS ratio FROM part",
    "pair_features": f"""WITH {_PAIR_FEATURES} SELECT cluster_id,
       {', '.join(f'sim_{c}, missing_{c}' for c in _FIELDS)}, score FROM scored""",
    "label_pairs": f"WITH {_LABELS} SELECT * FROM labels",
    "label_adjust": f"""WITH {_LABELLED} SELECT cluster_id, source_file, ordinal, id, link_score, label,
       name_similarity, address_similarity, adjusted_link_score FROM labelled""",
    "label_pivot": f"""WITH {_LABELLED},
e AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY {_ORDER}) AS entry FROM labelled),
marks AS (SELECT DISTINCT cluster_id, adjusted_link_score, label, name_similarity, address_similarity FROM labelled)
SELECT cluster_id, adjusted_link_score, label, name_similarity, address_similarity,
       {', '.join(f'a.{c} AS SFDC_Acc_{c}, b.{c} AS ExFactory_{c}' for c in _WIDE)}
FROM marks JOIN (SELECT * FROM e WHERE entry = 1) a USING (cluster_id)
LEFT JOIN (SELECT * FROM e WHERE entry = 2) b USING (cluster_id)""".replace(
        "SELECT cluster_id, adjusted_link_score, label, name_similarity, address_similarity,\n       a.",
        "SELECT cluster_id, marks.adjusted_link_score, marks.label, marks.name_similarity, marks.address_similarity,\n       a.",
    ),
    "label_store": """WITH p AS (
  SELECT l_orderkey AS left_id, l_partkey AS right_id, (l_returnflag = 'R')::INT AS is_match,
         strftime(l_shipdate, '%Y-%m-%d') AS labelled_at, l_linestatus = 'O' AS is_new FROM lineitem)
SELECT * EXCLUDE (is_new) FROM p
QUALIFY row_number() OVER (PARTITION BY left_id, right_id ORDER BY labelled_at DESC, is_new DESC, is_match DESC) = 1""",
    "threshold_curve": f"WITH {_CURVE} SELECT * FROM curve",
    "threshold_fbeta": f"WITH {_CURVE} SELECT * FROM curve ORDER BY f_beta DESC, threshold DESC LIMIT 1",
}

# --- accounts ---------------------------------------------------------------------------

# Values are written out here, so that a change of the library's own shows.


def _spelt(number: str) -> str:
    word = f"translate((1000 + {number})::VARCHAR, '0123456789', 'aeioubdflm')"
    return f"(upper({word}[1]) || {word}[2:])"


ACCOUNTS = f"""accounts AS (
  SELECT c_custkey AS id,
         {_spelt('c_custkey // 3')} || CASE c_custkey % 3 WHEN 0 THEN ' Medical Supply' WHEN 1 THEN ' Medical Suply' ELSE ' Clinic' END AS name,
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey || ' Ocean Avenue'
              ELSE (100 + c_custkey // 3) || CASE WHEN c_acctbal < 2000 THEN ' Main Street' ELSE ' Main St.' END END AS address,
         'Town ' || (c_custkey // 30) AS city, 'S' || c_nationkey AS state,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN (c_custkey // 3)::VARCHAR END AS zip
  FROM customer)"""

CRM = f"""crm AS (
  SELECT s_suppkey AS id,
         CASE WHEN s_suppkey % 4 = 3 THEN 'Other ' || {_spelt('s_suppkey * 7')} ELSE {_spelt('s_suppkey')} || ' Medical Supply' END AS name,
         CASE WHEN s_suppkey % 4 = 2 THEN s_suppkey || ' Hill Road, Rear' ELSE (100 + s_suppkey) || ' Main Street' END AS address,
         'Town ' || (s_suppkey // 10) AS city, 'S' || s_nationkey AS state,
         CASE WHEN s_suppkey % 5 > 0 THEN s_suppkey::VARCHAR END AS zip
  FROM supplier)"""


def _cleaned(table: str, clean) -> str:
    """Records with cleaned values; zips have five digits."""
    columns = ", ".join(f"nullif({clean(c)}, '') AS {c}" for c in ("name", "address", "city", "state"))
    digits = "CASE WHEN length(zip) < 5 THEN lpad(zip, 5, '0') ELSE zip END"
    return f"{table}_rec AS MATERIALIZED (SELECT id, {columns}, nullif({clean(digits)}, '') AS zip FROM {table})"


def _soundex(word: str) -> str:
    """First letter and three digits; equal neighbours count once, vowels divide, h and w do not."""
    codes = f"translate(upper({word}), 'AEIOUYBFPVCGJKQSXZDTLMNRHW', '00000011112222222233455677')"
    codes = f"replace({codes}, '7', '')"
    for digit in "0123456":
        codes = f"regexp_replace({codes}, '{digit}+', '{digit}', 'g')"
    return f"(upper({word}[1]) || rpad(left(replace({codes}[2:], '0', ''), 3), 3, '0'))"


def _account_keys(table: str) -> str:
    first = "split_part(name, ' ', 1)"
    rules = (
        "name", "array_to_string(list_sort(list_distinct(list_filter(string_split(name, ' '), lambda w: w <> ''))), ' ')",
        "left(name, 5) || '|' || city", f"{_soundex(first)} || '|' || state", "left(zip, 3) || '|' || left(name, 3)", "address",
    )
    union = " UNION ALL ".join(f"SELECT id, {i} AS rule, {key} AS key FROM {table}_rec" for i, key in enumerate(rules))
    return f"{table}_keys AS MATERIALIZED (SELECT * FROM ({union}) WHERE key IS NOT NULL)"


def _account_score(a: str = "a", b: str = "b") -> str:
    """Weighted mean of similarities; a value that is missing leaves its field out, but not the name."""
    weights = {"name": 0.4, "address": 0.3, "city": 0.1, "state": 0.1, "zip": 0.1}
    both = {c: f"({a}.{c} IS NOT NULL AND {b}.{c} IS NOT NULL)" for c in weights}
    alike = {c: f"round(1 - levenshtein({a}.{c}, {b}.{c}) / greatest(length({a}.{c}), length({b}.{c})), 6)" for c in weights}
    alike["state"] = f"({a}.state = {b}.state)::INT::DOUBLE"
    gained = " + ".join(f"CASE WHEN {both[c]} THEN {alike[c]} ELSE 0 END * {w}::DOUBLE" for c, w in weights.items())
    counted = " + ".join(f"{w}::DOUBLE" if c == "name" else f"{w}::DOUBLE * {both[c]}::INT" for c, w in weights.items())
    return f"round((0.0::DOUBLE + {gained}) / (0.0::DOUBLE + {counted}), 6)"


_DEDUPED = f"""{ACCOUNTS}, {_cleaned('accounts', _normalise_text)}, {_account_keys('accounts')},
met AS (SELECT DISTINCT x.id AS left_id, y.id AS right_id FROM accounts_keys x JOIN accounts_keys y
        ON x.rule = y.rule AND x.key = y.key AND x.id < y.id),
links AS MATERIALIZED (SELECT left_id, right_id FROM met JOIN accounts_rec a ON a.id = left_id JOIN accounts_rec b ON b.id = right_id
         WHERE {_account_score()} >= 0.5),
steps AS MATERIALIZED (SELECT left_id AS x, right_id AS y FROM links UNION ALL SELECT right_id, left_id FROM links),
reach(id, other) AS (SELECT id, id FROM accounts UNION SELECT r.id, s.y FROM reach r JOIN steps s ON s.x = r.other),
clusters AS MATERIALIZED (SELECT id, min(other) AS component FROM reach GROUP BY id)"""

_LINKED = f"""{ACCOUNTS}, {CRM}, {_cleaned('accounts', _normalise_link)}, {_cleaned('crm', _normalise_link)},
{_account_keys('accounts')}, {_account_keys('crm')},
met AS (SELECT DISTINCT x.id AS left_id, y.id AS right_id FROM accounts_keys x JOIN crm_keys y ON x.rule = y.rule AND x.key = y.key),
scored AS MATERIALIZED (SELECT left_id, right_id, {_account_score()} AS score
           FROM met JOIN accounts_rec a ON a.id = left_id JOIN crm_rec b ON b.id = right_id),
best AS MATERIALIZED (SELECT * FROM scored WHERE score >= 0.1
  QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY score DESC, right_id) = 1),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY left_id) - 1 AS cluster_id FROM best),
chosen AS (SELECT * FROM numbered QUALIFY row_number() OVER (PARTITION BY right_id ORDER BY score DESC, left_id) = 1),
linked AS MATERIALIZED (
  SELECT a.*, cluster_id, score AS link_score, 0 AS source_file FROM accounts a LEFT JOIN numbered ON a.id = left_id
  UNION ALL
  SELECT c.*, cluster_id, score, 1 FROM crm c LEFT JOIN chosen ON c.id = right_id)"""

_REVIEWED = f"""{_LINKED},
review AS MATERIALIZED (SELECT * FROM linked WHERE cluster_id IS NOT NULL QUALIFY count(*) OVER (PARTITION BY cluster_id) = 2)"""
_ACCOUNT_COLUMNS = ("id", "name", "address", "city", "state", "zip", "source_file", "link_score")

ORACLE |= {
    "dedupe_accounts": f"""WITH RECURSIVE {_DEDUPED},
numbers AS (SELECT component, row_number() OVER (ORDER BY component) - 1 AS cluster_id FROM (SELECT DISTINCT component FROM clusters))
SELECT cluster_id, CASE WHEN c.id = c.component THEN 1.0 ELSE {_account_score()} END AS confidence_score, raw.*
FROM clusters c JOIN numbers USING (component) JOIN accounts_rec a ON a.id = c.component JOIN accounts_rec b ON b.id = c.id
JOIN accounts raw ON raw.id = c.id""",
    "link_accounts": f"WITH {_LINKED} SELECT * FROM linked",
    "review_accounts": ORACLE["label_pivot"].replace(REVIEW, _REVIEWED).replace(f"ORDER BY {_ORDER}", "ORDER BY source_file, id").replace(
        ", ".join(f"a.{c} AS SFDC_Acc_{c}, b.{c} AS ExFactory_{c}" for c in _WIDE),
        ", ".join(f"a.{c} AS SFDC_Acc_{c}, b.{c} AS ExFactory_{c}" for c in _ACCOUNT_COLUMNS),
    ),
}

ORACLE["index_pairs"] = f"""WITH d AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(list_filter(string_split({_normalise_link('text')}, ' '), lambda w: w <> ''))) AS toks FROM documents
), c AS MATERIALIZED (
  SELECT toks, min(doc_id) AS id, count(*) AS n FROM d WHERE len(toks) > 0 GROUP BY toks
), w AS MATERIALIZED (SELECT id, n, unnest(toks) AS word FROM c),
weights AS (SELECT word, floor(ln(1 + (SELECT sum(n) FROM c) / sum(n)) * 1000 + 0.5)::BIGINT AS weight FROM w GROUP BY word),
t AS MATERIALIZED (SELECT id, word, weight * weight AS square FROM w JOIN weights USING (word)),
norms AS MATERIALIZED (SELECT id, sqrt(sum(square)::DOUBLE) AS norm FROM t GROUP BY id),
products AS (SELECT a.id AS left_id, b.id AS right_id, sum(a.square)::DOUBLE AS product FROM t a JOIN t b ON a.word = b.word AND a.id < b.id GROUP BY ALL)
SELECT left_id, right_id, round(product / (x.norm * y.norm), 6) AS cosine
FROM products JOIN norms x ON x.id = left_id JOIN norms y ON y.id = right_id WHERE round(product / (x.norm * y.norm), 6) >= 0.7"""

_EXPECTED = f"""{_PAIR_FEATURES},
counts AS (SELECT round(score * 1000000)::BIGINT AS units, count(*) AS n FROM scored GROUP BY 1),
sums AS (SELECT units / 1000000 AS threshold, sum(n) OVER down AS selected, sum(units * n) OVER down AS found, sum(units * n) OVER () AS total
         FROM counts WINDOW down AS (ORDER BY units DESC)),
pr AS (SELECT threshold, selected, found, found / (selected * 1000000) AS p, CASE WHEN total > 0 THEN found / total ELSE 0 END AS r FROM sums),
expected AS (SELECT threshold, selected::BIGINT AS selected, round(p, 6) AS expected_precision, round(r, 6) AS expected_recall,
                    CASE WHEN found > 0 THEN round((1 + 0.25::DOUBLE) * p * r / (0.25::DOUBLE * p + r), 6) ELSE 0.0 END AS expected_f_beta FROM pr)"""

ORACLE |= {
    "expected_curve": f"WITH {_EXPECTED} SELECT * FROM expected",
    "expected_threshold": f"WITH {_EXPECTED} SELECT * FROM expected ORDER BY expected_f_beta DESC, threshold DESC LIMIT 1",
}

ORACLE["attach_ids"] = f"""WITH {CLUSTERED}
SELECT record_number, cluster_id, given_id FROM clustered
LEFT JOIN (SELECT cluster_id, min(final_id) AS given_id FROM clustered WHERE starts_with(final_id, 'EMUSHCO') GROUP BY cluster_id) USING (cluster_id)"""


def _model_score(a: str = "a", b: str = "b") -> str:
    """Logistic score: similarities and missing values weigh alike wherever they occur."""
    weights = {"name": 6.0, "address": 3.5, "city": -0.5, "state": 1.0, "zip": 1.5}
    missing = {"address": 1.5, "city": 0.2, "state": 0.3, "zip": 0.8}
    both = {c: f"({a}.{c} IS NOT NULL AND {b}.{c} IS NOT NULL)" for c in weights}
    alike = {c: f"round(1 - levenshtein({a}.{c}, {b}.{c}) / greatest(length({a}.{c}), length({b}.{c})), 6)" for c in weights}
    alike["state"] = f"({a}.state = {b}.state)::INT::DOUBLE"
    terms = [f"CASE WHEN {both[c]} THEN 0 ELSE {w}::DOUBLE END" for c, w in missing.items()]
    terms += [f"CASE WHEN {both[c]} THEN {alike[c]} ELSE 0 END * {w}::DOUBLE" for c, w in weights.items()]
    return f"round(1 / (1 + exp(-(-6.0::DOUBLE + {' + '.join(terms)}))), 6)"


ORACLE |= {
    "model_dedupe": ORACLE["dedupe_accounts"].replace(_account_score(), _model_score()),
    "model_links": ORACLE["link_accounts"].replace(_account_score(), _model_score()),
}
