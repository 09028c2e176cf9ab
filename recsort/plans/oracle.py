"""DuckDB SQL for every SQL-checkable query key.

Each string runs on DuckDB against the pre-registered views of the given
tables and must give the same rows as the Spark query of the same key.
Fixture CTEs repeat the Spark builders in ``recsort.sources.fixtures``.
DuckDB's RE2 has no lookahead, so reply parsing uses the equivalent form
for replies without stray brackets (FIXTURES.md).
"""

from __future__ import annotations

from recsort.constants import (
    CATCH_ALL_CATEGORY,
    PANDAS_NULL_TOKENS,
    RAW_REPLY_MAX_CHARS,
    SELF_MADE_MARKER,
    STATUS_OK,
    STATUS_PARSE_FAIL,
    STATUS_REQUEST_FAIL,
    TAG_NEEDS_EXPERT,
    TAG_RULES_ONLY,
    WS_CLASS,
)
from recsort.functions.prompts import HINT_TEMPLATE, PLAIN_TEMPLATE
from recsort.functions.text import _NARROW, _WIDE
from recsort.operators.classify import NO_RULE_REASON
from recsort.operators.dictionary import edge_patterns
from recsort.operators.quality import CATCH_ALL_MAX_TEXT, MAX_CATEGORIES, QUOTE_SPAN
from recsort.sources.fixtures import (
    CORRECTIONS,
    EDGE_RULES,
    GROUPS,
    KEYWORDS,
    MORE_CORRECTIONS,
    RECOVER_IF_ARTICLE_CONTAINS,
    REMOVED_CATEGORIES,
    REPLY_GROUPS,
    SERVICE_CATEGORIES,
    STOP_TERMS,
    VOCABULARY,
)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'^{WS_CLASS}+|{WS_CLASS}+$')}, '', 'g')"


def clean_text(x: str) -> str:
    s = strip(f"coalesce(CAST({x} AS VARCHAR), '')")
    return f"(CASE WHEN lower({s}) = 'nan' THEN '' ELSE {s} END)"


def split_categories(x: str) -> str:
    parts = f"regexp_split_to_array({clean_text(x)}, {lit(f'{WS_CLASS}*[|][|]{WS_CLASS}*')})"
    return f"list_filter(list_transform({parts}, lambda p: {strip('p')}), lambda p: p <> '')"


def clean_rule_categories(x: str) -> str:
    return (f"array_to_string(list_filter({split_categories(x)}, "
            f"lambda p: p <> {lit(CATCH_ALL_CATEGORY)}), '||')")


def template(tpl: str, fields: dict[str, str]) -> str:
    import string
    parts = []
    for literal, field, _spec, _conv in string.Formatter().parse(tpl):
        if literal:
            parts.append(lit(literal))
        if field is not None:
            parts.append(fields[field])
    return "(" + " || ".join(parts) + ")"


def prompt(text: str, rc: str) -> str:
    t = f"coalesce({text}, '')"
    f = {"text": t, "rule_categories": rc}
    return f"(CASE WHEN {rc} <> '' THEN {template(HINT_TEMPLATE, f)} ELSE {template(PLAIN_TEMPLATE, f)} END)"


def vc_id(d: str = "d") -> str:
    return (f"(CASE WHEN {d}.doc_id % 101 = 0 THEN translate(CAST({d}.doc_id AS VARCHAR), '0123456789', 'abcdefghij') "
            f"ELSE (CASE WHEN {d}.doc_id % 5 = 0 THEN 'B' ELSE 'A' END) || "
            f"(CASE WHEN {d}.doc_id % 3 = 0 THEN '-00' ELSE '-' END) || CAST({d}.doc_id AS VARCHAR) END)")


F1 = f"""
SELECT 'VC-' || CAST(d.doc_id AS VARCHAR) AS vc_id,
       CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE d.text END AS text_combined,
       CASE WHEN d.doc_id % 23 = 0 THEN 'x?'
            WHEN l.quality IS NULL THEN NULL
            WHEN d.doc_id % 7 = 0 THEN CAST(l.quality AS VARCHAR) || '.0'
            ELSE CAST(l.quality AS VARCHAR) END AS isneedai
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

F2 = f"""
SELECT d.doc_id, {vc_id()} AS vc_id,
       CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE d.text END AS text_combined,
       d.source,
       CASE WHEN l.quality IS NULL THEN CAST(d.doc_id % 2 AS INTEGER) ELSE 1 - l.quality END AS need_ai,
       CASE d.doc_id % 6
         WHEN 0 THEN NULL
         WHEN 1 THEN 'permissive || copyleft'
         WHEN 2 THEN 'nan'
         WHEN 3 THEN {lit(' permissive||' + CATCH_ALL_CATEGORY + '|| ')}
         WHEN 4 THEN {lit(CATCH_ALL_CATEGORY)}
         ELSE chr(9) || 'copyleft||||copyleft ' END AS violation_categories
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

F5 = f"""
SELECT d.doc_id, {vc_id()} AS vc_id,
       CASE WHEN d.doc_id % 10 = 9 THEN 'timeout' ELSE NULL END AS error,
       CASE d.doc_id % 10
         WHEN 0 THEN '【违规类别】：permissive||copyleft' || chr(10) || '【判断理由】：quotes ' || translate(d.text, '【】', '  ')
         WHEN 1 THEN '【违规类别】: permissive' || chr(10) || '【判断理由】: line one' || chr(10) || chr(10) || 'line two '
         WHEN 2 THEN '【判断理由】：reason first' || chr(10) || '【违规类别】：copyleft'
         WHEN 3 THEN '违规类别：permissive判断理由：plain labels'
         WHEN 4 THEN '【违规类别】：permissive'
         WHEN 5 THEN translate(d.text, '：:【】', '    ')
         WHEN 6 THEN ''
         WHEN 7 THEN '【违规类别】：permissive||permissive||copyleft【判断理由】：repeats'
         WHEN 8 THEN '【违规类别】：homemade(自创)||unknown【判断理由】：off list'
         ELSE NULL END AS reply
FROM documents d
"""

F6 = f"""
SELECT x.doc_id, x.vc_id, 'old' AS ai_violation_categories,
       CASE x.doc_id % 12 WHEN 0 THEN {lit(STATUS_PARSE_FAIL)} WHEN 1 THEN {lit(STATUS_REQUEST_FAIL)}
                          WHEN 4 THEN NULL WHEN 5 THEN '  ' ELSE {lit(STATUS_OK)} END AS process_status
FROM ({F2}) x WHERE x.doc_id % 4 IN (0, 1)
"""

F8_LINES = """
SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) q
"""


def values(rows, names) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(names)})"


KW = values(KEYWORDS, ["keyword", "category"])
KW_LIST = "[" + ", ".join(f"[{lit(k)}, {lit(c)}]" for k, c in KEYWORDS) + "]"


def clean_category(x: str) -> str:
    return strip(f"regexp_replace({strip(x)}, '[\\n\\r]', '', 'g')")


def clean_reason(x: str) -> str:
    return strip(f"regexp_replace({strip(x)}, '[\\n\\r]+', ' ', 'g')")


def _first_match(r: str, pats, cleaner) -> str:
    arms = " ".join(
        f"WHEN regexp_matches({r}, {lit(head)}) THEN {cleaner(f'regexp_extract({r}, {lit(head + body)}, 1)')}"
        for head, body in pats)
    return f"(CASE {arms} ELSE '' END)"


_CAT_PATS = (("【违规类别】[：:]", "([^【]*)"), ("违规类别[：:]", "([^【判]*)"), ("类别[：:]", "([^【]*)"))
_REA_PATS = (("【判断理由】[：:]", "([^【]*)"), ("判断理由[：:]", "([^【]*)"), ("理由[：:]", "([^【]*)"))


def parsed(src: str, ok: str = "error IS NULL AND reply IS NOT NULL") -> str:
    """Result columns for a (..., error, reply) relation."""
    return f"""
    p0 AS (SELECT *, regexp_extract_all(reply, '【[^】]+】[：:]([^【]*)', 1) AS _secs FROM ({src}) s),
    p1 AS (SELECT *,
             CASE WHEN len(_secs) >= 2 THEN {clean_category('_secs[1]')} ELSE '' END AS _c1,
             CASE WHEN len(_secs) >= 2 THEN {clean_reason('_secs[2]')} ELSE '' END AS _r1 FROM p0),
    p2 AS (SELECT *,
             CASE WHEN _c1 <> '' THEN _c1 ELSE {_first_match('reply', _CAT_PATS, clean_category)} END AS _c2,
             CASE WHEN _r1 <> '' THEN _r1 ELSE {_first_match('reply', _REA_PATS, clean_reason)} END AS _r2 FROM p1),
    p3 AS (SELECT *,
             CASE WHEN _c2 = '' THEN {lit(STATUS_PARSE_FAIL)} ELSE _c2 END AS _c,
             CASE WHEN _r2 = '' THEN {lit(STATUS_PARSE_FAIL)} ELSE _r2 END AS _r FROM p2),
    parsed AS (SELECT * EXCLUDE (_secs, _c1, _r1, _c2, _r2, _c, _r),
             CASE WHEN {ok} THEN _c ELSE {lit(STATUS_REQUEST_FAIL)} END AS ai_violation_categories,
             CASE WHEN {ok} THEN _r ELSE {lit(STATUS_REQUEST_FAIL)} END AS ai_reason,
             CASE WHEN {ok} THEN substr(reply, 1, {RAW_REPLY_MAX_CHARS}) ELSE '' END AS ai_raw_response,
             CASE WHEN {ok} THEN (CASE WHEN _c = {lit(STATUS_PARSE_FAIL)} OR _r = {lit(STATUS_PARSE_FAIL)}
                                       THEN {lit(STATUS_PARSE_FAIL)} ELSE {lit(STATUS_OK)} END)
                  ELSE {lit(STATUS_REQUEST_FAIL)} END AS process_status
           FROM p3)"""


RESULT_COLS = "vc_id, ai_violation_categories, ai_reason, ai_raw_response, process_status"


def flat(x: str) -> str:
    return f"translate({x}, chr(10) || chr(13) || chr(9), '   ')"


def normalise_article(x: str) -> str:
    return strip(f"regexp_replace(translate({x}, {lit(_WIDE)}, {lit(_NARROW)}), {lit(WS_CLASS + '+')}, ' ', 'g')")


def clean_edges(x: str) -> str:
    out = x
    for side in ("lead", "tail"):
        out = f"regexp_replace({out}, {lit(edge_patterns(EDGE_RULES, side)[1])}, '')"
    return out


def rules_fired(x: str) -> str:
    """Names of the rules, one per piece, leads from the left and tails from the right."""
    rest, lists = x, []
    for side in ("lead", "tail"):
        one, whole = edge_patterns(EDGE_RULES, side)
        pieces = f"regexp_extract_all(regexp_extract({rest}, {lit(whole)}), {lit(one)})"
        pieces = pieces if side == "lead" else f"list_reverse({pieces})"
        arms = " ".join(f"WHEN regexp_matches(u, {lit(f'^(?:{p})$')}) THEN {lit(n)}" for n, s, p in EDGE_RULES if s == side)
        lists.append(f"list_transform({pieces}, lambda u: CASE {arms} END)")
        rest = f"regexp_replace({rest}, {lit(whole)}, '')"
    return f"array_to_string(list_concat({lists[0]}, {lists[1]}), '+')"


def article_of(line: str) -> str:
    return clean_edges(normalise_article(line))


def cats_in(x: str) -> str:
    """Distinct categories of the keywords contained in x (a list)."""
    return f"list_distinct(list_transform(list_filter({KW_LIST}, lambda k: contains({x}, k[1])), lambda k: k[2]))"


ENTRIES = f"""
SELECT doc_id, article, unnest({cats_in('article')}) AS category
FROM (SELECT doc_id, {article_of('line')} AS article FROM ({F8_LINES}) l) a
"""

PAIRS = f"SELECT DISTINCT article, category FROM ({ENTRIES}) e"

def citations(pairs: str) -> str:
    """Per document: how many lines are cited, and the categories that the dictionary ``pairs`` has for them."""
    return f"""
w AS (SELECT doc_id, regexp_extract_all(regexp_replace(text, '(?m)^([^\n]+)$', '《\\1》', 'g'), '《([^》]+)》', 1) AS cites
      FROM documents),
e AS (SELECT doc_id, unnest(range(len(cites))) AS pos, unnest(cites) AS citation FROM w),
e2 AS (SELECT doc_id, pos, {article_of('citation')} AS article FROM e),
j AS (SELECT e2.doc_id, e2.pos, p.category FROM e2 LEFT JOIN ({pairs}) p ON e2.article = p.article),
cit AS (SELECT w.doc_id, count(DISTINCT j.pos) AS n_citations,
           coalesce(array_to_string(list_sort(list_distinct(list(j.category) FILTER (WHERE j.category IS NOT NULL))), '||'), '') AS categories
        FROM w LEFT JOIN j ON w.doc_id = j.doc_id GROUP BY w.doc_id)
"""


def rule_cats(text: str) -> str:
    m = f"list_filter({KW_LIST}, lambda k: contains(coalesce({text}, ''), k[1]))"
    return (f"(CASE WHEN len({m}) > 0 THEN array_to_string(list_sort(list_distinct(list_transform({m}, lambda k: k[2]))), '||') "
            f"ELSE {lit(CATCH_ALL_CATEGORY)} END)")


def rule_reply(text: str) -> str:
    m = f"list_filter({KW_LIST}, lambda k: contains(coalesce({text}, ''), k[1]))"
    kws = f"list_sort(list_distinct(list_transform({m}, lambda k: k[1])))"
    reason = (f"(CASE WHEN len({m}) > 0 THEN 'rule: ' || array_to_string(list_transform({kws}, lambda k: '“' || k || '”'), ', ') "
              f"ELSE {lit(NO_RULE_REASON)} END)")
    return f"('【违规类别】：' || {rule_cats(text)} || chr(10) || '【判断理由】：' || {reason})"


_STATUS_STRIPPED = strip("coalesce(process_status, '')")
PROCESSED = f"SELECT vc_id FROM ({F6}) f6 WHERE {_STATUS_STRIPPED} <> ''"

END_TO_END = f"""
WITH f2 AS ({F2}),
todo AS (SELECT * FROM f2 WHERE TRY_CAST(CAST(need_ai AS VARCHAR) AS DOUBLE) = 1
         AND vc_id NOT IN ({PROCESSED})),
resp AS (SELECT doc_id, vc_id, text_combined, CAST(NULL AS VARCHAR) AS error,
                {rule_reply(prompt('text_combined', clean_rule_categories('violation_categories')))} AS reply FROM todo),
{parsed('resp')}
"""


SQL: dict[str, str] = {}

_TC = f"""SELECT vc_id, text_combined AS text, CAST(trunc(TRY_CAST(isneedai AS DOUBLE)) AS BIGINT) AS label
FROM ({F1}) f1 WHERE isneedai IS NOT NULL AND TRY_CAST(isneedai AS DOUBLE) IS NOT NULL AND text_combined IS NOT NULL"""

SQL["train_clean"] = _TC
SQL["label_rejects"] = f"SELECT vc_id, isneedai AS label FROM ({F1}) f1 WHERE isneedai IS NOT NULL AND TRY_CAST(isneedai AS DOUBLE) IS NULL"
SQL["label_distribution"] = f"SELECT label, count(*) AS n FROM ({_TC}) t GROUP BY label"
SQL["text_preview"] = f"""SELECT vc_id, label,
  CASE WHEN label = 1 THEN {lit(TAG_NEEDS_EXPERT)} ELSE {lit(TAG_RULES_ONLY)} END AS label_tag,
  substr(replace(text, chr(10), ' '), 1, 50) AS preview FROM ({_TC}) t ORDER BY vc_id LIMIT 5"""

_ROUTED = f"SELECT * FROM ({F2}) f2 WHERE TRY_CAST(CAST(need_ai AS VARCHAR) AS DOUBLE) = 1"
SQL["triage_input"] = f"SELECT doc_id, vc_id, coalesce(text_combined, '') AS text_combined FROM ({F2}) f2"
SQL["route_need_ai"] = f"SELECT doc_id, vc_id, CAST(need_ai AS BIGINT) AS need_ai FROM ({_ROUTED}) r"
SQL["triage_stats"] = f"""SELECT count(*) AS n_total,
  count(*) FILTER (WHERE need_ai = 1) AS n_need_ai,
  count(*) FILTER (WHERE need_ai <> 1 OR need_ai IS NULL) AS n_no_ai,
  round(CAST(count(*) FILTER (WHERE need_ai = 1) AS DOUBLE) * 100 / count(*), 6) AS pct_need_ai,
  round(CAST(count(*) FILTER (WHERE need_ai <> 1 OR need_ai IS NULL) AS DOUBLE) * 100 / count(*), 6) AS pct_no_ai
FROM ({F2}) f2"""
_Z = "ltrim(regexp_extract(vc_id, '([0-9]+)', 1), '0')"
SQL["sort_natural_id"] = f"SELECT vc_id, CAST(length({_Z}) AS BIGINT) AS nat_len, {_Z} AS nat_key FROM ({_ROUTED}) r"

SQL["widen_schema"] = f"""SELECT *, CAST(NULL AS VARCHAR) AS ai_reason, CAST(NULL AS VARCHAR) AS ai_raw_response FROM ({F6}) f6"""
SQL["flatten_whitespace"] = f"""SELECT doc_id, {flat('vc_id')} AS vc_id, {flat('text_combined')} AS text_combined,
  {flat('source')} AS source, CAST(need_ai AS BIGINT) AS need_ai, {flat('violation_categories')} AS violation_categories FROM ({F2}) f2"""
SQL["clean_text"] = f"""SELECT vc_id, {clean_text('violation_categories')} AS clean_violation,
  {clean_text('text_combined')} AS clean_text FROM ({F2}) f2"""
SQL["clean_rule_categories"] = f"SELECT vc_id, {clean_rule_categories('violation_categories')} AS rule_categories FROM ({F2}) f2"
_PROMPTS = f"SELECT vc_id, {prompt('text_combined', clean_rule_categories('violation_categories'))} AS prompt FROM ({F2}) f2"
SQL["build_prompt"] = _PROMPTS
SQL["build_request"] = f"""SELECT vc_id, 'offline-rules' AS model, CAST(2 AS BIGINT) AS n_messages,
  'system' AS first_role, prompt AS user_content, CAST(0.3 AS DOUBLE) AS temperature,
  CAST(500 AS BIGINT) AS max_tokens, false AS stream FROM ({_PROMPTS}) p"""

_BODIES = f"""SELECT doc_id, vc_id, error,
  CASE WHEN error IS NOT NULL THEN NULL
       WHEN doc_id % 35 = 11 THEN to_json(reply)::VARCHAR
       WHEN doc_id % 35 = 12 THEN json_array(reply)::VARCHAR
       WHEN doc_id % 35 = 13 THEN '["choices"]'
       WHEN doc_id % 5 = 0 THEN json_object('choices', json_array(json_object('message', json_object('content', reply))))::VARCHAR
       WHEN doc_id % 5 = 1 THEN json_object('response', reply)::VARCHAR
       WHEN doc_id % 5 = 2 THEN json_object('content', reply)::VARCHAR
       WHEN doc_id % 5 = 3 THEN json_object('choices', json_array(), 'response', reply)::VARCHAR
       ELSE json_object('id', 'x1', 'choices', json_array(json_object('message', json_object('content', reply))))::VARCHAR END AS body
FROM ({F5}) f5"""


def _jt(path: str) -> str:
    return f"json_type(body, {lit(path)})"


_EXTRACT = f"""CASE
  WHEN body IS NULL OR NOT json_valid(body) THEN NULL
  WHEN json_type(body) = 'VARCHAR' THEN
    CASE WHEN regexp_matches(json_extract_string(body, '$'), 'choices|response|content') THEN NULL ELSE json_extract_string(body, '$') END
  WHEN json_type(body) = 'ARRAY' THEN
    CASE WHEN list_has_any(json_extract_string(body, '$[*]'), ['choices', 'response', 'content']) THEN NULL ELSE body END
  WHEN json_type(body) <> 'OBJECT' THEN NULL
  WHEN {_jt('$.choices')} = 'ARRAY' AND json_array_length(body, '$.choices') > 0 THEN
    CASE WHEN {_jt('$.choices[0]')} <> 'OBJECT' THEN NULL
         WHEN {_jt('$.choices[0].message')} IS NULL THEN ''
         WHEN {_jt('$.choices[0].message')} <> 'OBJECT' THEN NULL
         WHEN {_jt('$.choices[0].message.content')} IS NULL THEN ''
         WHEN {_jt('$.choices[0].message.content')} = 'VARCHAR' THEN json_extract_string(body, '$.choices[0].message.content')
         ELSE NULL END
  WHEN {_jt('$.choices')} IS NOT NULL AND {_jt('$.choices')} <> 'ARRAY'
       AND json_extract(body, '$.choices')::VARCHAR NOT IN ('""', '{{}}') THEN NULL
  WHEN {_jt('$.response')} IS NOT NULL THEN
    CASE WHEN {_jt('$.response')} = 'VARCHAR' THEN json_extract_string(body, '$.response') END
  WHEN {_jt('$.content')} IS NOT NULL THEN
    CASE WHEN {_jt('$.content')} = 'VARCHAR' THEN json_extract_string(body, '$.content') END
  ELSE body END"""
SQL["extract_reply"] = f"""SELECT vc_id, reply_text, reply_text IS NOT NULL AS reply_ok
FROM (SELECT vc_id, {_EXTRACT} AS reply_text FROM ({_BODIES}) b) x"""

SQL["parse_reply"] = f"WITH {parsed(f'SELECT * FROM ({F5}) f5 WHERE error IS NULL', 'reply IS NOT NULL')} SELECT {RESULT_COLS} FROM parsed"
SQL["request_failure_rows"] = f"WITH {parsed(F5)} SELECT {RESULT_COLS} FROM parsed"
SQL["status_summary"] = f"""WITH {parsed(F5)} SELECT process_status, count(*) AS n_rows, count(DISTINCT vc_id) AS n_ids,
  count(*) FILTER (WHERE error IS NULL) AS n_transport_ok FROM parsed GROUP BY process_status"""

_EV_SRC = f"""SELECT f5.doc_id, f5.vc_id, f5.error, f5.reply, f2.text_combined, f2.violation_categories
FROM ({F5}) f5 JOIN ({F2}) f2 ON f5.doc_id = f2.doc_id"""
SQL["event_log"] = f"""WITH {parsed(_EV_SRC)}
SELECT 'request' AS event, vc_id, {clean_rule_categories('violation_categories')} AS rule_categories,
  length(coalesce(text_combined, '')) AS text_len,
  {prompt('text_combined', clean_rule_categories('violation_categories'))} AS prompt,
  CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS ai_category, CAST(NULL AS VARCHAR) AS ai_reason,
  CAST(NULL AS VARCHAR) AS raw_response, CAST(NULL AS INTEGER) AS status_code, CAST(NULL AS VARCHAR) AS error, 'batch' AS mode FROM parsed
UNION ALL
SELECT 'response', vc_id, NULL, NULL, NULL, process_status, ai_violation_categories, ai_reason, reply, NULL, NULL, 'batch'
FROM parsed WHERE error IS NULL AND reply IS NOT NULL
UNION ALL
SELECT 'error', vc_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, coalesce(error, 'unusable reply body'), 'batch' FROM parsed WHERE error IS NOT NULL OR reply IS NULL"""

SQL["resume_pending"] = f"SELECT doc_id, vc_id FROM ({_ROUTED}) r WHERE vc_id NOT IN ({PROCESSED})"
SQL["retry_failed"] = f"""SELECT doc_id, vc_id FROM ({_ROUTED}) r WHERE vc_id IN
  (SELECT vc_id FROM ({F6}) f6 WHERE process_status IN ({lit(STATUS_PARSE_FAIL)}, {lit(STATUS_REQUEST_FAIL)}))"""
SQL["upsert_results"] = f"""WITH {parsed(F5)},
batch AS (SELECT f2.doc_id, {flat('f2.vc_id')} AS vc_id, {flat('f2.text_combined')} AS text_combined,
            {flat('f2.source')} AS source, CAST(f2.need_ai AS VARCHAR) AS need_ai,
            {flat('f2.violation_categories')} AS violation_categories,
            {flat('p.ai_violation_categories')} AS ai_violation_categories, {flat('p.ai_reason')} AS ai_reason,
            {flat('p.ai_raw_response')} AS ai_raw_response, {flat('p.process_status')} AS process_status
          FROM ({F2}) f2 JOIN parsed p ON f2.doc_id = p.doc_id WHERE f2.doc_id % 3 = 0)
SELECT doc_id, vc_id, CAST(NULL AS VARCHAR) AS text_combined, CAST(NULL AS VARCHAR) AS source,
  CAST(NULL AS VARCHAR) AS need_ai, CAST(NULL AS VARCHAR) AS violation_categories,
  ai_violation_categories, CAST(NULL AS VARCHAR) AS ai_reason, CAST(NULL AS VARCHAR) AS ai_raw_response, process_status
FROM ({F6}) f6 WHERE vc_id NOT IN (SELECT vc_id FROM batch)
UNION ALL SELECT * FROM batch"""
SQL["upsert_second_strategy"] = f"""WITH {parsed(F5)},
batch AS (SELECT doc_id, {flat('vc_id')} AS vc_id, {flat('ai_violation_categories')} AS c, {flat('process_status')} AS s
          FROM parsed WHERE doc_id % 3 = 0)
SELECT coalesce(b.doc_id, f6.doc_id) AS doc_id, coalesce(b.vc_id, f6.vc_id) AS vc_id, f6.ai_violation_categories, f6.process_status,
       b.c AS ai_violation_categories_v2, b.s AS process_status_v2
FROM ({F6}) f6 FULL JOIN batch b ON f6.vc_id = b.vc_id"""
SQL["last_write_wins"] = """SELECT user_id, event_id, epoch_us(ts) AS ts_us, event_type, value, props FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) e WHERE rn = 1"""

_EXPLODED = f"""SELECT vc_id, unnest(range(len(arr))) AS pos, unnest(arr) AS category FROM
  (SELECT vc_id, {split_categories('ai_violation_categories')} AS arr FROM parsed WHERE process_status = {lit(STATUS_OK)}) t"""
SQL["explode_categories"] = f"WITH {parsed(F5)} {_EXPLODED}"
_VOCAB = ", ".join(lit(v) for v in VOCABULARY)
SQL["off_vocab_categories"] = f"""WITH {parsed(F5)} SELECT vc_id, pos, category FROM ({_EXPLODED}) x
  WHERE NOT ends_with(category, {lit(SELF_MADE_MARKER)}) AND category NOT IN ({_VOCAB})"""
SQL["category_frequency"] = f"""WITH {parsed(F5)} SELECT category, count(*) AS n, count(DISTINCT vc_id) AS n_records
  FROM ({_EXPLODED}) x GROUP BY category"""
_CONTRACT_SRC = f"""SELECT f5.*, f2.text_combined FROM ({F5}) f5 JOIN ({F2}) f2 ON f5.doc_id = f2.doc_id"""
SQL["category_contract"] = f"""WITH {parsed(_CONTRACT_SRC)},
c AS (SELECT vc_id, text_combined, {split_categories('ai_violation_categories')} AS arr FROM parsed WHERE process_status = {lit(STATUS_OK)}),
d AS (SELECT vc_id, CAST(len(arr) AS BIGINT) AS n_categories, len(arr) > {MAX_CATEGORIES} AS too_many,
        len(arr) <> len(list_distinct(arr)) AS has_repeats,
        list_contains(arr, 'noncommercial') AND len(list_distinct(arr)) < 2 AS pairing_broken,
        list_contains(arr, {lit(CATCH_ALL_CATEGORY)}) AND coalesce(length(text_combined), 0) > {CATCH_ALL_MAX_TEXT} AS catch_all_misused
      FROM c)
SELECT *, NOT (too_many OR has_repeats OR pairing_broken OR catch_all_misused) AS contract_ok FROM d"""
SQL["classify_end_to_end"] = f"""{END_TO_END} SELECT {flat('vc_id')} AS vc_id, {flat('ai_violation_categories')} AS ai_violation_categories,
  {flat('ai_reason')} AS ai_reason, {flat('ai_raw_response')} AS ai_raw_response, {flat('process_status')} AS process_status FROM parsed"""
SQL["evidence_check"] = f"""{END_TO_END},
sp AS (SELECT vc_id, coalesce(text_combined, '') AS t, regexp_extract_all(ai_reason, {lit(QUOTE_SPAN)}, 1) AS spans
       FROM parsed WHERE process_status = {lit(STATUS_OK)})
SELECT vc_id, CAST(len(spans) AS BIGINT) AS n_spans, CAST(len(list_filter(spans, lambda s: contains(t, s))) AS BIGINT) AS n_found,
  len(spans) > 0 AND len(list_filter(spans, lambda s: contains(t, s))) = len(spans) AS evidence_ok FROM sp"""

SQL["rule_classify"] = f"""SELECT vc_id, {rule_cats('text_combined')} AS rule_categories,
  CAST(len(list_distinct(list_transform(list_filter({KW_LIST}, lambda k: contains(coalesce(text_combined, ''), k[1])), lambda k: k[1]))) AS BIGINT) AS n_keywords
FROM ({F2}) f2 WHERE need_ai = 0"""
_KW_PAIRS = f"SELECT d.doc_id, k.keyword, k.category FROM documents d JOIN {KW} ON contains(d.text, k.keyword)".replace(" AS t(", " AS k(")
SQL["keyword_match"] = _KW_PAIRS
_PART_KEYWORDS = """SELECT concat_ws(' ', p_name, CAST(p_partkey AS VARCHAR)) AS keyword, p_type AS category FROM part
  UNION SELECT p_name, 'name' FROM part UNION SELECT unnest(string_split(p_name, ' ')), 'word' FROM part"""
SQL["keyword_match_indexed"] = f"SELECT d.doc_id, k.keyword, k.category FROM documents d JOIN ({_PART_KEYWORDS}) k ON k.keyword <> '' AND contains(d.text, k.keyword)"
SQL["article_dictionary"] = f"""SELECT article, array_to_string(list_sort(list_distinct(list(category))), '||') AS categories,
  count(*) AS n_entries, count(DISTINCT doc_id) AS n_docs FROM ({ENTRIES}) e GROUP BY article"""
SQL["citation_lookup"] = f"WITH {citations(PAIRS)} SELECT doc_id, n_citations, categories FROM cit"
SQL["normalise_article"] = f"SELECT doc_id, line, {normalise_article('line')} AS article_norm FROM ({F8_LINES}) l"
SQL["clean_edges"] = f"SELECT doc_id, line, {article_of('line')} AS article FROM ({F8_LINES}) l"
SQL["clean_edges_log"] = f"""SELECT doc_id, line AS before, {clean_edges('line')} AS after, {rules_fired('line')} AS rule
FROM ({F8_LINES}) l WHERE line IS DISTINCT FROM {clean_edges('line')}"""
_CORR = values(CORRECTIONS, ["article", "old_category", "new_category"]).replace(" AS t(", " AS c(")
SQL["correct_mapping"] = f"""SELECT p.article, p.category AS old_category, coalesce(c.new_category, p.category) AS category
FROM ({PAIRS}) p LEFT JOIN {_CORR} ON p.article = c.article AND p.category = c.old_category"""
SQL["correction_log"] = f"""SELECT p.article, p.category AS old_category, c.new_category
FROM ({PAIRS}) p JOIN {_CORR} ON p.article = c.article AND p.category = c.old_category
WHERE c.new_category <> p.category"""
_STOP = ", ".join(lit(c) for c in REMOVED_CATEGORIES)
SQL["recover_removed"] = f"""SELECT article, category, false AS recovered FROM ({PAIRS}) p WHERE category NOT IN ({_STOP})
UNION ALL
SELECT article, category, true FROM ({PAIRS}) p WHERE category IN ({_STOP}) AND contains(article, {lit(RECOVER_IF_ARTICLE_CONTAINS)})"""

_ALL_CORR = values(CORRECTIONS + MORE_CORRECTIONS, ["article", "old_category", "new_category"]).replace(" AS t(", " AS c(")
FINAL = f"""
WITH RECURSIVE c AS (SELECT * FROM {_ALL_CORR}),
walk AS (SELECT article, old_category, new_category AS cur, 1 AS steps FROM c
         UNION ALL
         SELECT w.article, w.old_category, c.new_category, steps + 1 FROM walk w JOIN c ON c.article = w.article AND c.old_category = w.cur
         WHERE steps <= (SELECT count(*) FROM c)),
ends AS (SELECT article, old_category, max(cur) FILTER (WHERE (article, cur) NOT IN (SELECT (article, old_category) FROM c)) AS new_category
         FROM walk w GROUP BY article, old_category)
SELECT p.article, p.category AS old_category,
       CASE WHEN p.category NOT IN ({_STOP}) AND e.new_category IS NOT NULL THEN e.new_category ELSE p.category END AS category,
       CASE WHEN p.category IN ({_STOP}) THEN 'recovered' WHEN e.old_category IS NOT NULL AND e.new_category IS NULL THEN 'cycle'
            WHEN e.new_category IS NOT NULL THEN 'corrected' ELSE 'kept' END AS origin
FROM ({PAIRS}) p LEFT JOIN ends e ON e.article = p.article AND e.old_category = p.category
WHERE p.category NOT IN ({_STOP}) OR contains(p.article, {lit(RECOVER_IF_ARTICLE_CONTAINS)})"""
SQL["final_dictionary"] = FINAL

_GROUPS = values(GROUPS, ["category", "big_group"]).replace(" AS t(", " AS g(")
_MAPPED = f"""SELECT p.p_partkey, p.p_type AS category, coalesce(g.big_group, p.p_type) AS big_group
FROM part p LEFT JOIN {_GROUPS} ON p.p_type = g.category"""
SQL["category_to_group"] = _MAPPED
SQL["category_group_sorted"] = f"SELECT big_group, category, count(*) AS n FROM ({_MAPPED}) m GROUP BY big_group, category"
_STOPT = ", ".join(lit(t) for t in STOP_TERMS)
SQL["remove_terms"] = f"""SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ' '), lambda w: w NOT IN ({_STOPT})), '||') AS terms FROM part"""

_MERGE_RULES = f"SELECT doc_id, {rule_cats('text_combined')} AS rule_categories FROM ({F2}) f2"
SQL["merge_results"] = f"""WITH {parsed(F5)}, {citations(FINAL)},
base AS (SELECT doc_id, vc_id, text_combined FROM ({F2}) f2),
a AS (SELECT doc_id, ai_violation_categories AS _ai FROM parsed WHERE process_status = {lit(STATUS_OK)}),
dd AS (SELECT doc_id, categories AS _dict FROM cit WHERE categories <> ''),
r AS (SELECT doc_id, {rule_cats('text_combined')} AS _rule FROM base),
m AS (SELECT base.doc_id, base.vc_id, a._ai, dd._dict, r._rule,
        r._rule IS NOT NULL AND r._rule <> {lit(CATCH_ALL_CATEGORY)} AS _rr
      FROM base LEFT JOIN a ON base.doc_id = a.doc_id LEFT JOIN dd ON base.doc_id = dd.doc_id
      LEFT JOIN r ON base.doc_id = r.doc_id)
SELECT doc_id, vc_id, coalesce(_ai, _dict, CASE WHEN _rr THEN _rule END, {lit(CATCH_ALL_CATEGORY)}) AS final_categories,
  CASE WHEN _ai IS NOT NULL THEN 'expert' WHEN _dict IS NOT NULL THEN 'dictionary' WHEN _rr THEN 'rule' ELSE 'fallback' END AS source
FROM m"""

_CENTROIDS = """e AS (SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT label, i, avg(v[i]) AS m FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM e) x GROUP BY label, i),
c AS (SELECT label, list(m ORDER BY i) AS centroid FROM u GROUP BY label)"""
SQL["embedding_cosine"] = f"""WITH {_CENTROIDS}
SELECT e.vec_id, e.label, round(list_cosine_similarity(e.v, c.centroid), 6) AS cosine FROM e JOIN c ON e.label = c.label"""
SQL["centroid_classify"] = f"""WITH {_CENTROIDS},
s AS (SELECT e.vec_id, e.label, c.label AS cl, list_cosine_similarity(e.v, c.centroid) AS cs FROM e, c)
SELECT vec_id, label, arg_max(cl, cs) AS predicted, round(max(cs), 6) AS cosine FROM s GROUP BY vec_id, label"""

# The streamed results table equals one batch run over all routed records
# (no prior results), with every string column flattened at the sink.
SQL["stream_incremental"] = f"""
WITH f2 AS ({F2}),
todo AS (SELECT * FROM f2 WHERE TRY_CAST(CAST(need_ai AS VARCHAR) AS DOUBLE) = 1),
resp AS (SELECT doc_id, vc_id, text_combined, source, need_ai, violation_categories, CAST(NULL AS VARCHAR) AS error,
                {rule_reply(prompt('text_combined', clean_rule_categories('violation_categories')))} AS reply FROM todo),
{parsed('resp')}
SELECT doc_id, {flat('vc_id')} AS vc_id, {flat('text_combined')} AS text_combined, {flat('source')} AS source,
  need_ai, {flat('violation_categories')} AS violation_categories,
  {flat('ai_violation_categories')} AS ai_violation_categories, {flat('ai_reason')} AS ai_reason,
  {flat('ai_raw_response')} AS ai_raw_response, {flat('process_status')} AS process_status
FROM parsed"""


# CSV round trip: the records written in three charsets and read back with
# the charset chosen per file are the F2 records as text.
_TOKENS = ", ".join(lit(t) for t in PANDAS_NULL_TOKENS)


def null_token(x: str) -> str:
    return f"(CASE WHEN {x} IN ({_TOKENS}) THEN NULL ELSE {x} END)"


SQL["src_csv_encodings"] = f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, vc_id, text_combined, source,
  CAST(need_ai AS VARCHAR) AS need_ai, violation_categories FROM ({F2}) f2"""
SQL["src_csv_pruned"] = f"""SELECT {null_token('vc_id')} AS vc_id, {null_token('text_combined')} AS text_combined,
  {null_token('CAST(need_ai AS VARCHAR)')} AS need_ai FROM ({F2}) f2"""
SQL["src_null_tokens"] = f"""SELECT {null_token('vc_id')} AS vc_id, {null_token('violation_categories')} AS violation_categories,
  {null_token('text_combined')} AS text_combined FROM ({F2}) f2"""

SQL["results_upsert"] = SQL["upsert_results"]
SQL["responder_calls"] = f"""
WITH r AS (SELECT doc_id, vc_id, copy, violation_categories, need_ai,
                  CASE WHEN copy = 1 THEN coalesce(text_combined, '') || ' again' ELSE text_combined END AS text_combined
           FROM (SELECT *, unnest(CASE WHEN doc_id % 7 = 0 THEN [0, 0, 1] ELSE [0] END)::BIGINT AS copy FROM ({F2}) f2) c),
n AS (SELECT *, length({prompt('text_combined', clean_rule_categories('violation_categories'))}) AS n FROM r
      WHERE TRY_CAST(CAST(need_ai AS VARCHAR) AS DOUBLE) = 1),
e AS (SELECT *, CASE WHEN n % 101 = 1 THEN 'timeout' WHEN n % 11 = 0 THEN 'ConnectionError: refused' WHEN n % 11 = 2 THEN 'no response' END AS error FROM n),
s AS (SELECT *, CASE WHEN error IS NOT NULL THEN NULL WHEN n % 11 = 3 THEN 'no sections'
                     ELSE '【违规类别】：' || [{', '.join(lit(c) for c in SERVICE_CATEGORIES)}][n % 3 + 1] || chr(10) || '【判断理由】：length ' || n END AS reply FROM e),
{parsed('SELECT * FROM s')}
SELECT doc_id, copy, {RESULT_COLS}, error FROM parsed"""

_SEEDED = "substr(md5('42:' || vc_id), 1, 15)"
SQL["seeded_sample"] = f"""SELECT vc_id, label, substr(replace(text, chr(10), ' '), 1, 30) AS preview FROM ({_TC}) t
ORDER BY {_SEEDED}, vc_id LIMIT 5"""
SQL["holdout_counts"] = f"""SELECT CASE WHEN CAST('0x' || {_SEEDED} AS BIGINT) % 1000 >= 200 THEN 'fit' ELSE 'test' END AS side, label, count(*) AS n
FROM ({_TC}) t GROUP BY 1, 2"""
SQL["contrastive_pairs"] = f"""
WITH r AS (SELECT vc_id, label, row_number() OVER (PARTITION BY label ORDER BY {_SEEDED}, vc_id) - 1 AS rank, count(*) OVER (PARTITION BY label) AS size FROM ({_TC}) t),
a AS (SELECT vc_id, label, rank, j, p_label FROM r, (VALUES (1), (2)) js(j), (VALUES (0), (1)) ls(p_label)),
s AS (SELECT DISTINCT label, size FROM r)
SELECT a.vc_id AS anchor_id, r.vc_id AS partner_id, a.label AS anchor_label, r.label AS partner_label, CAST(j AS BIGINT) AS j,
       CAST(a.label = r.label AS DOUBLE) AS similar
FROM a JOIN s ON s.label = a.p_label
JOIN r ON r.label = a.p_label AND r.rank = (a.rank + j - CASE WHEN a.label = a.p_label THEN 0 ELSE 1 END) % s.size
WHERE CASE WHEN a.label = a.p_label THEN j < s.size ELSE j <= s.size END"""

_TO_GROUP = "CASE p " + " ".join(f"WHEN {lit(c)} THEN {lit(g)}" for c, g in REPLY_GROUPS) + " ELSE p END"
SQL["category_list_groups"] = f"""WITH {parsed(F5)},
g AS (SELECT vc_id, list_transform(list_filter(list_transform(string_split(coalesce(ai_violation_categories, ''), '||'), lambda p: trim(p, ' ')),
                                   lambda p: p <> ''), lambda p: {_TO_GROUP}) AS l FROM parsed)
SELECT vc_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '||') AS big_groups FROM g"""
