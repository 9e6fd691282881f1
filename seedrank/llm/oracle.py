"""DuckDB SQL with the results of the registered queries that SQL can express, over the same tables.

The SQL follows the contract, not the operators' methods: whole strings or windows are compared
where the operators compare hashes, and the link propagation is a recursive query.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(c: str) -> str:
    return f"translate({c}, '{_UPPER}', '{_LOWER}')"


# ---------------------------------------------------------------- 3: 200 repeated bytes

SUFFIX_DEDUP = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS t FROM documents),
s AS MATERIALIZED (SELECT rid, i, md5(t[i:i + 199]) AS h FROM (SELECT rid, t, unnest(range(1, octet_length(t) - 198)) AS i FROM d)),
many AS (SELECT h FROM s GROUP BY h HAVING count(*) > 1),
hit AS (SELECT rid, i FROM s SEMI JOIN many USING (h)),
edge AS (SELECT rid, i, i > coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i) + 200, 0) AS fresh FROM hit),
run AS (SELECT rid, i, sum(fresh::INT) OVER (PARTITION BY rid ORDER BY i) AS r FROM edge),
span AS MATERIALIZED (SELECT rid, min(i) AS a, max(i) + 200 AS b FROM run GROUP BY rid, r),
gone AS (SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY rid),
gap AS (SELECT rid, b AS lo, lead(a) OVER (PARTITION BY rid ORDER BY a) AS hi FROM (SELECT rid, a, b FROM span UNION ALL SELECT rid, 0, 1 FROM d)),
kept AS (SELECT rid, sha256(unhex(string_agg(hex(t[lo:coalesce(hi - 1, octet_length(t))]), '' ORDER BY lo))) AS kept_sha256
         FROM gap JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, octet_length(t) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM d JOIN kept USING (rid) LEFT JOIN gone USING (rid)
"""

# ---------------------------------------------------------------- 4: 35 repeated words

SUBSTRING_DEDUP = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS MATERIALIZED (SELECT rid, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN md5(array_to_string(w[i:i + 34], ' ')) END AS h
      FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
many AS (SELECT h FROM p WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
m AS (SELECT p.rid, p.i, p.word, many.h IS NOT NULL AS again FROM p LEFT JOIN many ON p.h = many.h),
c AS (SELECT rid, i, word, bool_or(again) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM m),
k AS (SELECT rid, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (rid)
"""

# ---------------------------------------------------------------- 7: rules, then trust and distrust over hosts

_LINK = r"""(?i)\bhref\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)"""


def url_filter(rules, damping: float, block_share: float, rounds: int = 60) -> str:
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""
WITH RECURSIVE rules(rh, rp, v) AS (VALUES {listed}),
u AS MATERIALIZED (SELECT row_number() OVER () AS rid, page_id, html,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS MATERIALIZED (SELECT rid, page_id, html, {_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
fit AS (SELECT rid, rh || rp AS rule, v, row_number() OVER (PARTITION BY rid ORDER BY length(rh || rp) DESC) AS n
    FROM q JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
ruled AS MATERIALIZED (SELECT q.rid, page_id, host, path, rule, v FROM q LEFT JOIN fit ON q.rid = fit.rid AND n = 1),
link AS (SELECT host AS src, {_lower(f"unnest(regexp_extract_all(html, '{_LINK}', 1))")} AS dst FROM q WHERE host <> ''),
edge AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM link WHERE src <> dst GROUP BY src, dst),
move AS MATERIALIZED (
    SELECT src AS host, dst AS toward, 'trust' AS kind, n / sum(n) OVER (PARTITION BY src) AS p FROM edge
    UNION ALL SELECT dst, src, 'distrust', n / sum(n) OVER (PARTITION BY dst) FROM edge),
base AS MATERIALIZED (SELECT host, CASE v WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind,
    count(*) / (SELECT count(*) FROM ruled) * (1 - CAST({damping!r} AS DOUBLE)) AS score FROM ruled WHERE host <> '' AND v IS NOT NULL GROUP BY host, v),
spread(r, host, kind, score) AS (
    SELECT 0, host, kind, score FROM base
    UNION ALL
    SELECT r + 1, toward, kind, sum(score * p) * CAST({damping!r} AS DOUBLE) FROM spread JOIN move USING (host, kind)
    WHERE r < {rounds} GROUP BY r, toward, kind),
scored AS (SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0.0) AS trust, coalesce(sum(score) FILTER (kind = 'distrust'), 0.0) AS distrust
    FROM spread GROUP BY host)
SELECT page_id, host, path, rule,
    coalesce(v, CASE WHEN coalesce(distrust, 0.0) > CAST({block_share!r} AS DOUBLE) * (coalesce(trust, 0.0) + coalesce(distrust, 0.0)) THEN 'block' ELSE 'allow' END) AS verdict,
    coalesce(trust, 0.0) AS trust, coalesce(distrust, 0.0) AS distrust
FROM ruled LEFT JOIN scored USING (host)
"""


# ---------------------------------------------------------------- 9: equal texts

EXACT_DEDUP = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(n) AS text_sha256
FROM d WINDOW w AS (PARTITION BY n ORDER BY length(t) DESC, doc_id NULLS LAST)
"""

# ---------------------------------------------------------------- 10: benchmark windows

_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATION = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_WORDS}) AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_lower("coalesce(text, '')")}, {_WORDS}) AS w FROM benchmark),
bw AS MATERIALIZED (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS win
    FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths)),
hit AS MATERIALIZED (SELECT rid, dw.n, i, item FROM dw JOIN bw USING (win)),  -- items of null id hit words, and are not listed
words AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS at FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT rid, item FROM hit WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

# ---------------------------------------------------------------- 12: prefix, middle, suffix

FILL_IN_MIDDLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS x1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS x2,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
         WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT *, least(x1, x2) AS a, greatest(x1, x2) AS b FROM x),
p AS (SELECT *, left(t, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""

# ---------------------------------------------------------------- 13: integer scores, top 20 an item

_TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

RANKED_SEARCH = f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_TERMS}) AS w FROM documents),
d AS MATERIALIZED (SELECT rid, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM w WHERE len(w) > 0),
total AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM d),
b AS (SELECT row_number() OVER () AS row, item_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_TERMS}) AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS MATERIALIZED (SELECT row, item_id, term, count(*) AS repeats FROM (SELECT row, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
tf AS MATERIALIZED (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, total GROUP BY term, big_n),
part AS MATERIALIZED (SELECT rid, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l))) AS x
    FROM tf JOIN weight USING (term) JOIN d USING (rid), total),
s AS (SELECT row, item_id, rid, doc_id, CAST(sum(repeats * x) AS BIGINT) AS score FROM q JOIN part USING (term) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""
