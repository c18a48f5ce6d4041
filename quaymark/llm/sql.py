"""DuckDB SQL for the operators that SQL can express: personal data (6), the Jaccard join (7) and collocations (12)."""

from __future__ import annotations

#: What a match of each kind looks like.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
TERM = r"\p{L}[\p{L}\p{N}]{2,}"
DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
LUHN = f"list_sum(list_transform(range(1, length({DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr({DIGITS}, length({DIGITS}) - i + 1, 1) AS INTEGER) ELSE CAST(substr({DIGITS}, length({DIGITS}) - i + 1, 1) AS INTEGER) * 2 - CASE WHEN CAST(substr({DIGITS}, length({DIGITS}) - i + 1, 1) AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
VALID = {
    "email": "TRUE",
    "ip": "len(list_filter(string_split(value, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(TRY_CAST(nullif(ltrim(x, '0'), '') AS INTEGER), 0) > 255)) = 0",
    "card": f"length({DIGITS}) BETWEEN 14 AND 19 AND {LUHN}",
    "phone": f"length({DIGITS}) BETWEEN 10 AND 15",
}


def _matches(source: str, keys: str, column: str, pattern: str) -> str:
    """keys, start and value of all matches: the text is cut at marks around them, and every other piece is one."""
    cut = f"string_split(regexp_replace({column}, '{pattern}', chr(1) || '\\0' || chr(1), 'g'), chr(1))"
    return (
        f"SELECT {keys}, start, value FROM (SELECT {keys}, i, value, coalesce(sum(length(value)) OVER (PARTITION BY {keys} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start "
        f"FROM (SELECT {keys}, unnest(p) AS value, generate_subscripts(p, 1) AS i FROM (SELECT {keys}, {cut} AS p FROM {source}))) WHERE i % 2 = 0"
    )


def pii_sql(window: int = 100, support: int = 2, threshold: float = 0.9) -> str:
    """Operator 6: base spans, and the terms that disclose them."""
    base = " UNION ALL ".join(f"SELECT rid, start, {rank} AS rank, start + length(value) AS stop, '{kind}' AS kind, value FROM ({_matches('d', 'rid', 'body', PATTERNS[kind])}) WHERE {VALID[kind]}" for rank, kind in enumerate(PATTERNS))
    sides = (
        f"SELECT rid, kind, value, start, stop, TRUE AS ahead, start > {window} AS cut, greatest(start - {window}, 0) AS moved, substr(body, CAST(greatest(start - {window}, 0) + 1 AS BIGINT), CAST(least(start, {window}) AS BIGINT)) AS t FROM base JOIN d USING (rid)"
        f" UNION ALL SELECT rid, kind, value, start, stop, FALSE, length(body) > stop + {window}, stop, substr(body, CAST(stop + 1 AS BIGINT), {window}) FROM base JOIN d USING (rid)"
    )
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in PATTERNS)
    joined = "coalesce(string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank, stop, kind, value), '')"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), chr(1), chr(2)) AS body, coalesce(text, '') AS raw, dense_rank() OVER (ORDER BY doc_id, coalesce(text, '')) AS key FROM documents),
base AS ({base}),
sides AS (SELECT row_number() OVER () AS sid, * FROM ({sides})),
words AS ({_matches('sides', 'sid', 't', TERM)}),
near AS (SELECT rid, key, kind || ':' || s.value AS entity, lower(w.value) AS term, w.value AS value, w.start + moved AS start, w.start + moved + length(w.value) AS stop FROM words w JOIN sides s USING (sid) JOIN d USING (rid) WHERE NOT (cut AND CASE WHEN ahead THEN w.start = 0 ELSE w.start + length(w.value) = {window} END)),
pairs AS (SELECT entity, term, count(*) AS n FROM (SELECT DISTINCT key, entity, term FROM near) GROUP BY 1, 2 HAVING count(*) >= {support}),
entities AS (SELECT entity, count(*) AS n FROM (SELECT DISTINCT key, entity FROM near) GROUP BY 1),
spread AS (SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct(regexp_split_to_array(lower(raw), '[^\\p{{L}}\\p{{N}}]+'))) AS term FROM d) WHERE term IN (SELECT term FROM pairs) GROUP BY 1),
told AS (SELECT entity, term FROM (SELECT p.entity, p.term, log2(CAST(p.n AS DOUBLE) * (SELECT count(*) FROM d) / (e.n * f.n)) AS pmi, log2(CAST((SELECT count(*) FROM d) AS DOUBLE) / e.n) AS content FROM pairs p JOIN entities e USING (entity) JOIN spread f USING (term)) WHERE content > 0 AND pmi >= {threshold} * content),
marked AS (SELECT DISTINCT d.rid, n.start, n.stop, n.value FROM near n JOIN told USING (entity, term) JOIN d ON d.key = n.key),
terms AS (SELECT rid, start, 4 AS rank, stop, 'term' AS kind, value FROM marked m WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = m.rid AND m.start < b.stop AND b.start < m.stop)),
b AS (SELECT rid, {counts}, sha256({joined}) AS base_sha256 FROM base GROUP BY rid),
a AS (SELECT rid, {joined} AS spans FROM (SELECT * FROM base UNION ALL SELECT * FROM terms) GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in PATTERNS)}, coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN b USING (rid) LEFT JOIN a USING (rid)"""


def jaccard_sql(words: int = 5, percent: int = 80) -> str:
    """Operator 7: shingle sets, links and the least doc_id of every component (doc_ids are distinct)."""
    return f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS l FROM documents),
u AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < {words} THEN [array_to_string(l, ' ')] ELSE list_transform(range(1, len(l) - {words - 2}), lambda i: array_to_string(l[i:i + {words - 1}], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM u GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= {percent} * (nx.n + ny.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least.b, w.doc_id) AS component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least ON least.a = w.doc_id"""


def phrases_sql(threshold: int = 100, most: int = 2000) -> str:
    """Operator 12: exact counts of all phrases, their lowest cut, and the first of each language."""
    return f"""WITH pieces AS (SELECT row_number() OVER () AS pid, lang, piece FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS l FROM pieces),
totals AS (SELECT lang, sum(len(l)) AS n FROM w GROUP BY 1),
f AS (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(range(1, len(l) - k + 2), lambda i: array_to_string(l[i:i + k - 1], ' '))) AS phrase FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(l) >= k) GROUP BY 1, 2, 3 HAVING count(*) >= {threshold}),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS l FROM f WHERE k > 1),
inside AS (SELECT lang, array_to_string(l[s:s + m - 1], ' ') AS phrase, max(a) AS around FROM c, (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 5)) AS s) WHERE m < k AND s + m - 1 <= k GROUP BY 1, 2),
kept AS (SELECT c.* FROM c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase WHERE i.around IS NULL OR 100 * i.around < 100 * a),
cuts AS (SELECT x.lang, x.phrase, a, p.f AS l, q.f AS r, t.n, j, (1000::HUGEINT * a * t.n) // (p.f::HUGEINT * q.f) AS score FROM (SELECT kept.*, unnest(range(1, k)) AS j FROM kept) x JOIN totals t ON t.lang = x.lang JOIN f p ON p.lang = x.lang AND p.phrase = array_to_string(x.l[1:j], ' ') JOIN f q ON q.lang = x.lang AND q.phrase = array_to_string(x.l[j + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {most}"""
