"""DuckDB SQL for the results that SQL can express, over the tables documents, benchmark and conversations."""

from __future__ import annotations

from playlake.llm import divergence, line_frequency, perspectives, prefix_trie

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SPANS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
k AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
win AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 19), ' ')) AS h FROM k),
rep AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM rep),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t, count(*) AS n
         FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, text, source, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
raw AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
rows AS (SELECT doc_id, line, regexp_extract_all(line, '{_WORDS}') AS lw FROM raw),
dup AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines
        FROM (SELECT doc_id, line, count(*) AS n FROM rows WHERE len(lw) > 0 GROUP BY ALL) GROUP BY doc_id),
k AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5),
win AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 4), ' ')) AS h FROM k),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, h) > 1),
hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM rep) GROUP BY doc_id),
norm AS (SELECT doc_id, translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS l, len(lw) AS n
         FROM rows WHERE len(lw) > 0),
hosts AS (SELECT source, count(DISTINCT t) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END)
                 * (1 - max(CASE WHEN text = '' THEN 1 ELSE 0 END)) AS n_host FROM d GROUP BY source),
often AS (SELECT held.source, l FROM (SELECT source, l, count(DISTINCT t) AS n FROM norm JOIN d USING (doc_id) GROUP BY ALL) held
          JOIN hosts ON hosts.source IS NOT DISTINCT FROM held.source
          WHERE n > {line_frequency.LEAST} AND n > {line_frequency.SHARE} * n_host),
gone AS (SELECT doc_id, sum(n)::BIGINT AS n FROM norm JOIN d USING (doc_id) JOIN often o ON o.l = norm.l AND o.source IS NOT DISTINCT FROM d.source GROUP BY doc_id),
base AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words,
           coalesce(gone.n, 0)::BIGINT AS n_removed_words
    FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < {line_frequency.MIN_WORDS} OR 100 * n_repeat_words > {line_frequency.MAX_REPEAT_PCT} * n_words AS base_failed,
       NOT (n_words < {line_frequency.MIN_WORDS} OR 100 * n_repeat_words > {line_frequency.MAX_REPEAT_PCT} * n_words)
       AND n_removed_words <= {line_frequency.DEPLETED} * n_words AS kept
FROM base
"""

LEAKS = rf"""
WITH b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
bk AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS x FROM bk),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
dk AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
found AS (SELECT doc_id, i, n, item_id FROM (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS x FROM dk) JOIN win USING (n, x)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS t FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(item.n, 0)::BIGINT AS n_items,
       sha256(coalesce(t, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
"""

NEAR = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents),
k AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + 3), ' ')) AS x FROM k),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
sym AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN n USING (doc_id)
"""

LINKED = NEAR.replace("100 * c >= 80 * (", "100 * c >= 85 * (").replace(", doc_id = component_id AS kept", "")

ORACLE: dict[str, str] = {
    "op3_perspectives": perspectives.ORACLE,
    "op5_debruijn_spans": SPANS,
    "op7_line_frequency": QUALITY,
    "op8_phrase_index": LEAKS,
    "op10_hyperminhash": NEAR,
    "op11_adaptive_prefixes": LINKED,
    "op12_source_divergence": divergence.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
