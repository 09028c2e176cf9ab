"""DuckDB SQL of the ``opN_<name>`` queries that SQL can express."""

from __future__ import annotations

from recsort.llm.license_scan import PHRASES, TEMPLATES, THRESHOLD, need_of, prepared

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _op8() -> str:
    def at(phrase: str) -> str:
        ws = phrase.split()
        test = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(ws))
        return f"list_filter(range(1, len(w) + 1), lambda i: {test})"

    def best(ws: list[str], size: int) -> str:
        lst = "[" + ", ".join(f"'{x}'" for x in ws) + "]"
        held = f"len(list_filter({lst}, lambda x: list_contains({{}}, x)))"
        blocks = f"list_transform(range(1, greatest(len(w) - {size - 1}, 1) + 1), lambda i: {held.format(f'w[i:i + {size - 1}]')})"
        return f"CASE WHEN {held.format('w')} >= {need_of(ws, THRESHOLD)} THEN list_max({blocks}) / {len(ws)}.0 ELSE 0.0 END"

    places = ", ".join(f"{at(p)} AS p{k}" for k, p in enumerate(PHRASES))
    lists = [f"p{k}" for k in range(len(PHRASES))]
    all_at = "list_concat(" + "list_concat(".join(f"{x}, " for x in lists[:-1]) + lists[-1] + ")" * (len(lists) - 1)
    base = "[" + ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{v}' END" for k, v in enumerate(PHRASES.values())) + "]"
    sets = prepared(TEMPLATES)
    conts = ", ".join(f"{best(ws, size)} AS c{k}" for k, (_, ws, size) in enumerate(sets))
    own = "[" + ", ".join(f"CASE WHEN c{k} >= {THRESHOLD} THEN '{v}' END" for k, (v, *_) in enumerate(sets)) + "]"
    top = "greatest(" + ", ".join(f"CASE WHEN c{k} >= {THRESHOLD} THEN c{k} ELSE 0.0 END" for k in range(len(sets))) + ")"
    return f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n_words, {places}, {conts} FROM d),
q AS (SELECT *, {all_at} AS a, list_filter({base}, lambda x: x IS NOT NULL) AS bl,
             list_filter({own}, lambda x: x IS NOT NULL) AS ol, {top} AS t FROM p)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(a) AS BIGINT) AS n_base,
       CAST(list_min(a) - 1 AS BIGINT) AS first_word, CAST(list_max(a) - 1 AS BIGINT) AS last_word,
       array_to_string(list_sort(list_distinct(bl)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(bl, ol))), ',') AS labels,
       CASE WHEN len(a) > 0 THEN 1.0 ELSE CAST(t AS DOUBLE) END::DOUBLE AS score
FROM q"""


_OP10 = r"""
WITH l AS (SELECT doc_id, md5(coalesce(text, '')) AS th, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first, count(DISTINCT doc_id) AS docs FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.*, (f.key IS NOT NULL AND f.docs >= 2 AND k.doc_id <> f.first) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id, th"""

_OP9 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rid, dw.n, i, item_id FROM dw JOIN win ON dw.n = win.n AND dw.s = win.s),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS items FROM hit GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""

_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# The order of the groups and of their rows, then both trees level by level; runs holds each run of nodes as a list.
_OP12 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, {_leaf('text')} AS leaf, {_leaf("replace(text, chr(10), '')")} AS torn FROM documents),
gs AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT source FROM d)),
l AS (SELECT d.*, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n
      FROM d JOIN gs ON d.source IS NOT DISTINCT FROM gs.source),
up AS (SELECT g, 0 AS lvl, pos, n, leaf AS h FROM l
       UNION ALL
       SELECT g, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY g, lvl, pos // 3, n),
sub AS (SELECT g, h AS subroot FROM up WHERE n = 1),
top AS (SELECT 0 AS lvl, g AS pos, (SELECT count(*) FROM gs) AS n, subroot AS h FROM sub
        UNION ALL
        SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n),
root AS (SELECT h AS root FROM top WHERE n = 1),
low_runs AS (SELECT g, lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM up WHERE n > 1 GROUP BY g, lvl, pos // 3),
top_runs AS (SELECT lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM top WHERE n > 1 GROUP BY lvl, pos // 3),
steps AS (
  SELECT rid, lvl, pos // CAST(pow(3, lvl) AS BIGINT) % 3 AS slot, hs FROM l JOIN low_runs r ON r.g = l.g AND r.run = l.pos // CAST(pow(3, lvl + 1) AS BIGINT)
  UNION ALL
  SELECT rid, 1000 + lvl, g // CAST(pow(3, lvl) AS BIGINT) % 3, hs FROM l JOIN top_runs r ON r.run = l.g // CAST(pow(3, lvl + 1) AS BIGINT)),
path AS (SELECT rid, list({{'l': array_to_string(hs[1:slot], ''), 'r': array_to_string(hs[slot + 2:], '')}} ORDER BY lvl) AS path FROM steps GROUP BY rid),
fold AS (
  SELECT l.rid, 0 AS done, coalesce(path, []) AS path, CASE WHEN crc_even AND torn IS NOT NULL THEN torn ELSE leaf END AS h
  FROM l LEFT JOIN path USING (rid) JOIN (SELECT rid, {{crc}} AS crc_even FROM d) c ON c.rid = l.rid
  UNION ALL
  SELECT rid, done + 1, path, sha256(path[done + 1].l || h || path[done + 1].r) FROM fold WHERE done < len(path))
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256,
       h AS folded_root, h = root AS verified
FROM fold JOIN l USING (rid) JOIN sub USING (g) CROSS JOIN root WHERE done = len(path)"""


def _crc_even() -> str:
    """2 divides the unsigned CRC-32 of the decimal id: the last bit of the checksum, which is linear in the digits' bits."""
    import zlib
    # The parity of the checksum of a string of n bytes is that of n zero bytes, plus one bit per set bit at its place from the end.
    def bit(length, place, value):
        zero = bytes(length)
        one = bytes(value if i == length - 1 - place else 0 for i in range(length))
        return (zlib.crc32(zero) ^ zlib.crc32(one)) & 1
    terms = []
    for length in range(1, 21):
        parts = [str(zlib.crc32(bytes(length)) & 1)]
        for place in range(length):
            masks = [v for v in (1, 2, 4, 8, 16, 32) if bit(length, place, v)]
            if masks:
                parts.append(f"bit_count(ascii(substr(s, {length - place}, 1)) & {sum(masks)})")
        terms.append(f"WHEN {length} THEN ({' + '.join(parts)}) % 2 = 0")
    return "(SELECT CASE length(s) " + " ".join(terms) + " ELSE false END FROM (SELECT CAST(doc_id AS VARCHAR) AS s))"


_OP13 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5"""

SQL = {"op12_merkle_manifest": _OP12.replace("{crc}", _crc_even()), "op13_exact_topk": _OP13, "op9_decontamination": _OP9, "op8_license_scan": _op8(), "op10_line_dedup": _OP10}
