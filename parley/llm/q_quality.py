"""op9: quality rules over all documents."""

from parley.llm.quality import MAX_REPEAT_PERCENT, MIN_GROUP, MIN_WORDS, RULES, TENTHS, judge
from parley.llm.registry import query
from parley.registry.base import table

STATS_SQL = rf"""
w AS (SELECT rid, doc_id, lang, source, coalesce(text, '') AS t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
      FROM d),
pos AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
win AS (SELECT rid, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g FROM pos),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
cov AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + k AS p FROM rep, (SELECT unnest([0,1,2]) AS k)) GROUP BY rid),
stats AS (SELECT w.rid, doc_id, lang, source, len(w)::BIGINT AS n_words,
        length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        len(l)::BIGINT AS n_lines,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov USING (rid)),
based AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM stats),
meas AS (SELECT *, CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeat_share,
        CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbol_share,
        CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_line_share,
        CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_length FROM based),
long AS ({' UNION ALL '.join(f"SELECT lang, source, '{k}' AS m, {k} AS v FROM meas WHERE NOT base_failed" for k in RULES)}),
b AS (SELECT lang, source, m, CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END AS b FROM long)"""


def _level(name, keys):
    group = ", ".join([*keys, "m"])
    return f"""
{name}_c AS (SELECT {group}, b, count(*) AS n FROM b GROUP BY ALL),
{name}_r AS (SELECT *, sum(n) OVER (PARTITION BY {group} ORDER BY b ROWS UNBOUNDED PRECEDING) AS r,
        sum(n) OVER (PARTITION BY {group}) AS a FROM {name}_c),
{name} AS (SELECT {group}, max(a) AS total, {", ".join(f"min(CASE WHEN 10 * r >= {n} * a THEN b END) AS {c}" for c, n in TENTHS.items())}
      FROM {name}_r GROUP BY ALL)"""


def _room(way):
    told = " ".join(f"WHEN '{k}' THEN CASE WHEN {way} > 0 THEN {times} * ({way}) ELSE {distance} END" for k, (times, distance, _) in RULES.items())
    return f"CASE m {told} END"


def _chosen(c):
    return f"CASE WHEN own.total >= {MIN_GROUP} THEN own.{c} WHEN mid.total >= {MIN_GROUP} THEN mid.{c} ELSE top.{c} END AS {c}"


_OVER = " OR ".join(f"{k} > hi['{k}'][1]" + (f" OR {k} < lo['{k}'][1]" if both else "") for k, (_, _, both) in RULES.items())
KEPT_SQL = f"""{STATS_SQL},{_level('own', ['lang', 'source'])},{_level('mid', ['lang'])},{_level('top', [])},
chosen AS (SELECT own.lang, own.source, own.m, {", ".join(_chosen(c) for c in TENTHS)}
      FROM own JOIN mid ON own.m = mid.m AND own.lang IS NOT DISTINCT FROM mid.lang JOIN top ON own.m = top.m),
lim AS (SELECT lang, source, m, chosen.hi + {_room('chosen.hi - md')} AS hi, chosen.lo - {_room('md - chosen.lo')} AS lo FROM chosen),
lims AS (SELECT lang, source, map_from_entries(list((m, hi))) AS hi, map_from_entries(list((m, lo))) AS lo FROM lim GROUP BY ALL),
judged AS (SELECT meas.*, NOT base_failed AND NOT coalesce({_OVER.replace('][1]', ']')}, false) AS kept
      FROM meas LEFT JOIN lims ON meas.lang IS NOT DISTINCT FROM lims.lang AND meas.source IS NOT DISTINCT FROM lims.source)"""

SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, * FROM documents),{KEPT_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""


@query("op9_quality_rules", SQL)
def quality_rules(spark, sf_dir):
    """Base figures of every document and the verdict of the adaptive fences."""
    return judge(table(spark, sf_dir, "documents"))
