"""op3: license scan over all documents."""

from parley.llm.licenses import BLOCK, MARKS, PHRASES, TEMPLATES, THRESHOLD, scan
from parley.llm.registry import query
from parley.registry.base import sql_list, sql_text, table

_PHRASE_ROWS = ", ".join(f"({sql_text(k)}, [{sql_list(p.split())}])" for k, p in PHRASES)
_TEMPLATE_ROWS = ", ".join(f"({sql_text(k)}, [{sql_list(sorted(set(t.split())))}], [{sql_list(m)}]::VARCHAR[])"
                           for (k, t), m in zip(TEMPLATES, MARKS))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
ph(label, p) AS (VALUES {_PHRASE_ROWS}),
te(label, t, m) AS (VALUES {_TEMPLATE_ROWS}),
base AS (SELECT rid, label, i FROM (SELECT rid, label, p, w, unnest(range(0, len(w) - len(p) + 1)) AS i
        FROM w, ph WHERE list_has_any(w, p)) WHERE w[i + 1 : i + len(p)] = p),
b AS (SELECT rid, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS l FROM base GROUP BY rid),
blocks AS (SELECT rid, list_distinct(w[s + 1 : s + {BLOCK}]) AS g FROM (SELECT rid, w,
        unnest(range(0, greatest(len(w) - {BLOCK // 2}, 1), {BLOCK // 2})) AS s FROM w)),
hit AS (SELECT rid, label, len(list_intersect(g, t)) / len(t) AS s FROM blocks, te
        WHERE list_has_all(g, m) AND len(list_intersect(g, t)) >= ceil({THRESHOLD} * len(t))),
m AS (SELECT rid, list(DISTINCT label) AS l, max(s) AS s FROM hit GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
       array_to_string(list_sort(coalesce(b.l, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.l, []), coalesce(m.l, [])))), ',') AS labels,
       greatest(coalesce(s, 0), CASE WHEN n > 0 THEN 1 ELSE 0 END)::DOUBLE AS score
FROM w LEFT JOIN b USING (rid) LEFT JOIN m USING (rid)"""


@query("op3_license_scans", SQL)
def license_scans(spark, sf_dir):
    """Base license places and all license labels of every document."""
    return scan(table(spark, sf_dir, "documents"))
