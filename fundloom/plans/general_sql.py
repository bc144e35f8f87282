"""SQL twins of the queries of the general data problems."""

from __future__ import annotations

_LINKS = """links AS (
 SELECT 'investment_owner' AS h, owner_id AS n, CASE WHEN trim(parent_owner_id)<>'' THEN parent_owner_id END AS p FROM investment_owner
 UNION ALL SELECT 'investment_target', target_id, CASE WHEN trim(parent_target_id)<>'' THEN parent_target_id END FROM investment_target
 UNION ALL SELECT 'blocks', block_id, CASE WHEN trim(parent_id)<>'' THEN parent_id END FROM blocks
 UNION ALL SELECT 'lookthrough_edge', child_position_id, CASE WHEN trim(parent_position_id)<>'' THEN parent_position_id END FROM lookthrough_edge
 UNION ALL SELECT 'lookthrough_edge', parent_position_id, NULL FROM lookthrough_edge),
e AS (SELECT h, n, MIN(p) AS p FROM links WHERE trim(n)<>'' GROUP BY 1,2),
up(h, n, c) AS (SELECT h, n, n FROM e UNION SELECT up.h, up.n, e.p FROM up JOIN e ON e.h=up.h AND e.n=up.c JOIN e k ON k.h=e.h AND k.n=e.p),
roots AS (SELECT h, n FROM e WHERE NOT EXISTS (SELECT 1 FROM e k WHERE k.h=e.h AND k.n=e.p)),
r AS (SELECT up.h, up.n, COUNT(*)-1 AS steps, MAX(roots.n) AS root FROM up LEFT JOIN roots ON roots.h=up.h AND roots.n=up.c GROUP BY 1,2)"""

P1_FOUND = f"""WITH RECURSIVE {_LINKS}
SELECT r.h AS hierarchy, r.n AS node_id, COALESCE(root,'CYCLE') AS root_id, CASE WHEN root IS NULL THEN -1 ELSE steps END AS depth
FROM r JOIN e ON e.h=r.h AND e.n=r.n WHERE e.p IS NOT NULL"""

P1_HIERARCHIES = f"""WITH RECURSIVE {_LINKS},
paths AS (SELECT up.h, up.n, string_agg(up.c, '/' ORDER BY a.steps) AS path FROM up JOIN r a ON a.h=up.h AND a.n=up.c GROUP BY 1,2),
below AS (SELECT up.h, up.c AS n, COUNT(*)-1 AS k FROM up JOIN r ON r.h=up.h AND r.n=up.n WHERE r.root IS NOT NULL GROUP BY 1,2)
SELECT r.h AS hierarchy, r.n AS node_id, COALESCE(r.root,'CYCLE') AS root_id, CASE WHEN r.root IS NULL THEN -1 ELSE r.steps END AS depth,
 CASE WHEN r.root IS NULL THEN '' ELSE path END AS path, COALESCE(k,0) AS descendants
FROM r JOIN paths ON paths.h=r.h AND paths.n=r.n LEFT JOIN below ON below.h=r.h AND below.n=r.n"""


P1_DESCENDANTS = f"""WITH RECURSIVE {_LINKS},
walk(h, n, c, k, seen) AS (SELECT h, n, n, 0, [n] FROM e UNION ALL SELECT w.h, w.n, e.p, w.k+1, list_append(w.seen, e.p)
 FROM walk w JOIN e ON e.h=w.h AND e.n=w.c JOIN e k ON k.h=e.h AND k.n=e.p WHERE NOT list_contains(w.seen, e.p))
SELECT h AS hierarchy, c AS ancestor, n AS descendant, CAST(k AS BIGINT) AS distance FROM walk WHERE k>0"""

P1_HIERARCHIES_WHOLE = f"""WITH RECURSIVE {_LINKS},
paths AS (SELECT up.h, up.n, string_agg(up.c, '/' ORDER BY a.steps) AS path FROM up JOIN r a ON a.h=up.h AND a.n=up.c GROUP BY 1,2),
below AS (SELECT h, c AS n, COUNT(*)-1 AS k FROM up GROUP BY 1,2)
SELECT r.h AS hierarchy, r.n AS node_id, COALESCE(r.root,'CYCLE') AS root_id, CASE WHEN r.root IS NULL THEN -1 ELSE r.steps END AS depth,
 CASE WHEN r.root IS NULL THEN '' ELSE path END AS path, below.k AS descendants
FROM r JOIN paths ON paths.h=r.h AND paths.n=r.n JOIN below ON below.h=r.h AND below.n=r.n"""


P1_OTHER_PARENTS = " UNION ALL ".join(
    f"SELECT DISTINCT '{h}' AS hierarchy, a.{n} AS node_id, b.m AS parent_id, a.{p} AS other_parent_id FROM {h} a JOIN (SELECT {n}, MIN({p}) AS m FROM {h} WHERE trim({p})<>'' GROUP BY 1) b ON b.{n}=a.{n}"
    f" WHERE trim(a.{n})<>'' AND trim(a.{p})<>'' AND a.{p}<>b.m"
    for h, n, p in (("investment_owner", "owner_id", "parent_owner_id"), ("investment_target", "target_id", "parent_target_id"), ("blocks", "block_id", "parent_id"), ("lookthrough_edge", "child_position_id", "parent_position_id"))
)


def number_sql(c: str) -> str:
    s = f"translate(regexp_replace({c}, '\\s+', '', 'g'), '−–‒', '---')"
    s = f"regexp_replace({s}, '(?i)(US\\$|C\\$|CA\\$|A\\$|AU\\$|[$€£¥]|USD|EUR|GBP|GBX|JPY|CAD|CHF|AUD|SEK|Sfr\\.?)|%', '', 'g')"
    s = f"regexp_replace({s}, '([0-9.)])[xX]$', '\\1')"
    s = f"regexp_replace({s}, '^-?\\(([^()]*)\\)$', '-\\1')"
    return (
        f"(CASE WHEN regexp_matches({s}, '^-?([0-9]+|[0-9]{{1,3}}(,[0-9]{{3}})+)(\\.[0-9]*)?$') THEN TRY_CAST(replace({s}, ',', '') AS DECIMAL(38,10)) END)"
    )


_KEY = ["source_page", "source_table", "source_row_label", "source_column_label"]
_FIELDS = ["metric_category", "value_raw", "currency", "unit_scale", "as_of_date_raw", "subject_name"]


def _p6() -> str:
    label = lambda c: f"COALESCE(lower(trim(regexp_replace({c}, '\\s+', ' ', 'g'))),'')"
    bare = lambda c: f"COALESCE(regexp_replace({c}, '\\s+', '', 'g'),'')"
    key = ", ".join(["document_id"] + [f"{label(k)} AS {k}" for k in _KEY] + ["source_occurrence"])
    value = f"COALESCE('#'||CAST({number_sql('value_raw')} AS VARCHAR), {bare('value_raw')}) AS value_raw"
    side = lambda t: f"SELECT DISTINCT {key}, {', '.join(value if f == 'value_raw' else bare(f) + ' AS ' + f for f in _FIELDS)} FROM {t}"
    using = "document_id, " + ", ".join(_KEY) + ", source_occurrence"
    differs = " UNION ALL ".join(f"SELECT pair_id, 'differs', '{f}' FROM j WHERE a.document_id IS NOT NULL AND b.document_id IS NOT NULL AND a.{f}<>b.{f}".replace("a.document_id", "has_a").replace("b.document_id", "has_b").replace(f"a.{f}<>b.{f}", f"a_{f}<>b_{f}") for f in _FIELDS)
    cover = []
    plain = {"page_status": False, "layout_checked": False, "expected_observation_count": False, "source_structures": True, "relevant_record_families": True}
    items = lambda c: f"array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(COALESCE({c},''),'|'), lambda x: regexp_replace(x,'\\s+','','g')), lambda x: x<>''))),'|')"
    none = lambda s: " AND ".join(f"{s}_{f} IS NULL" for f in plain)
    for f, listed in plain.items():
        a, b = (items(f"a_{f}"), items(f"b_{f}")) if listed else (bare(f"CAST(a_{f} AS VARCHAR)"), bare(f"CAST(b_{f} AS VARCHAR)"))
        cover.append(f"SELECT document_id||'/'||source_page, 'differs', '{f}' FROM coverage_diff WHERE NOT ({none('a')}) AND NOT ({none('b')}) AND {a}<>{b}")
    cover += [f"SELECT document_id||'/'||source_page, 'missing_{s}', '' FROM coverage_diff WHERE {none(s)}" for s in "ab"]
    return f"""WITH ra AS ({side('records_a')}), rb AS ({side('records_b')}),
pk AS (SELECT pair_id, {key} FROM pair_index),
j AS (SELECT pair_id, ra.document_id AS has_a, rb.document_id AS has_b, {', '.join(f'ra.{f} AS a_{f}, rb.{f} AS b_{f}' for f in _FIELDS)}
 FROM pk LEFT JOIN ra USING ({using}) LEFT JOIN rb USING ({using}))
SELECT DISTINCT 'records' AS copy_name, pair_id AS case_key, k AS diff_kind, f AS field_name FROM (
 SELECT pair_id, 'missing_a' AS k, '' AS f FROM j WHERE has_a IS NULL AND has_b IS NOT NULL
 UNION ALL SELECT pair_id, 'missing_b', '' FROM j WHERE has_b IS NULL AND has_a IS NOT NULL UNION ALL {differs})
UNION ALL SELECT DISTINCT 'coverage', * FROM ({' UNION ALL '.join(cover)})"""


def _p7() -> str:
    squeeze = lambda c: f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
    number = number_sql("value_raw")
    plain = f"regexp_replace(regexp_replace(CAST({number} AS VARCHAR), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '')"
    dated = "CAST(CAST(try_strptime(trim(value_raw), ['%Y-%m-%d','%d %b %Y','%B %d, %Y','%b %d, %Y','%d %B %Y']) AS DATE) AS VARCHAR)"
    text = f"CASE WHEN NOT regexp_matches({squeeze('value_raw')}, '(?i)^(|-+|[—–−]+|n/?\\.?a\\.?|n\\.?/?m\\.?|not available|not meaningful|not applicable|nil|none)$') THEN {squeeze('value_raw')} END"
    return f"""WITH i AS (SELECT *, {squeeze('source_row_label')} AS row_label, {squeeze('source_column_label')} AS col FROM pair_index),
m AS (SELECT document_id, source_table, col, MIN(metric_category) AS metric FROM i WHERE metric_category IS NOT NULL GROUP BY 1,2,3),
c AS (SELECT i.document_id, i.source_table, row_label, COALESCE(i.metric_category, m.metric) AS metric, i.source_occurrence, a_row_number, b_row_number FROM i LEFT JOIN m USING (document_id, source_table, col)),
v AS (SELECT c.*, CASE WHEN a_row_number IS NOT NULL THEN a.value_raw ELSE b.value_raw END AS value_raw FROM c
 LEFT JOIN records_a a ON a.document_id=c.document_id AND a.row_no=a_row_number LEFT JOIN records_b b ON b.document_id=c.document_id AND b.row_no=b_row_number),
t AS (SELECT v.document_id, source_table, row_label, metric, source_occurrence,
 CASE WHEN value_kind IN ('money','percent','multiple','count') THEN {plain} WHEN value_kind='date' THEN {dated} ELSE {text} END AS cell_text
 FROM v JOIN metric_reference ON metric_category=metric)
SELECT document_id, source_table, row_label AS source_row_label, metric AS metric_category, arg_min(cell_text, (source_occurrence, cell_text)) AS cell_text
FROM t WHERE cell_text IS NOT NULL GROUP BY 1,2,3,4"""


#: Spellings of units and currencies as patterns, independent of the engine's tables.
_UNIT_PATTERNS = {
    "m2": "m2|m²|sq ?m|square met(re|er)s?", "sq_ft": "sq ?ft|sf|square (feet|foot)", "acre": "ac|acres?", "hectare": "ha|hectares?",
    "kwh": "kwh|kilowatt.hours?", "mwh": "mwh|megawatt.hours?", "gwh": "gwh|gigawatt.hours?", "kg": "kgs?|kilograms?", "lb": "lbs?|pounds?( weight)?",
    "tonne": "t|mt|tonnes?|metric tons?", "troy_oz": "troy oz|oz ?t|troy ounces?", "m3": "m3|m³|cbm|cubic met(re|er)s?", "bbl": "bbls?|barrels?",
    "us_gallon": "(us )?gal|(us )?gallons?|gallons? \\(us\\)",
}
_CURRENCY_PATTERNS = {
    "USD": "usd|us\\$|us dollars?|\\$", "EUR": "eur|euros?|€", "GBP": "gbp|£|pounds? sterling", "GBX": "gbx|pence( sterling)?", "JPY": "jpy|¥|(japanese )?yen",
    "CAD": "cad|ca?\\$|canadian dollars?", "CHF": "chf|sfr|swiss francs?", "AUD": "aud|au?\\$|australian dollars?", "SEK": "sek|swedish kron(or|a)",
}


def _p4() -> str:
    squeeze = lambda c: f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
    million, thousand = "(^|[ (])(in )?(millions?|mn|mm|m)\\b\\)?", "(^|[ (])(in )?(thousands?|000s?|k)\\b\\)?"
    scale = lambda c: f"CASE WHEN regexp_matches({c}, '{million}') THEN 1000000 WHEN regexp_matches({c}, '{thousand}') THEN 1000 ELSE 1 END"
    bare = lambda c: squeeze(f"regexp_replace(regexp_replace({c}, '{million}', ' ', 'g'), '{thousand}', ' ', 'g')")
    choose = lambda c, patterns: "CASE " + " ".join(f"WHEN regexp_full_match({c}, '{p}') THEN '{code}'" for code, p in patterns.items()) + " END"
    currency = lambda c: f"CASE WHEN regexp_matches(trim({c}), '^GBp\\b') THEN 'GBX' ELSE {choose(f'translate({bare(f'lower({c})')}, chr(46), chr(32))', _CURRENCY_PATTERNS)} END".replace("chr(46), chr(32)", "'.', ''")
    digits = "replace(regexp_extract({c}, '([0-9][0-9,]*\\.?[0-9]*|\\.[0-9]+)', 1), ',', '')"
    half = lambda x: f"CAST(sign({x})*floor(abs({x})+0.5) AS BIGINT)"
    tail = "regexp_extract(trim(quantity_raw),'^[0-9,.]+ ?(.*)$',1)"
    figure = "([0-9]+(?:\\.[0-9]+)?)(?: ([0-9]+)/([0-9]+))?"
    mark = "(%|per ?cent|bps?|basis points)"
    pick = lambda i: f"COALESCE(NULLIF(regexp_extract(lower(rate_basis_raw), '(?:\\+|plus) ?{figure} ?{mark}?', {i}),''), NULLIF(regexp_extract(lower(rate_basis_raw), '^{figure} ?{mark} (?:margin )?(?:over|above)', {i}),''))"
    return f"""WITH q AS (SELECT position_id, {digits.format(c='quantity_raw')} AS n, {squeeze(f"lower(translate(CASE WHEN {tail}<>'' THEN {tail} ELSE quantity_unit END, '_.', ' '))")} AS w FROM fund_position WHERE quantity_raw IS NOT NULL),
qu AS (SELECT q.*, CASE WHEN regexp_full_match({bare('w')}, 'shs?|shares?') THEN CASE {scale('w')} WHEN 1000000 THEN 'million_share' WHEN 1000 THEN 'thousand_share' ELSE 'share' END ELSE {choose('w', _UNIT_PATTERNS)} END AS unit FROM q),
fv AS (SELECT position_id, CAST(fair_value AS DECIMAL(18,6)) AS v, {currency('currency')} AS code, {scale('lower(currency)')} AS s FROM fund_position WHERE fair_value IS NOT NULL AND currency IS NOT NULL),
sp AS (SELECT instrument_id, spread_bps, {pick(1)} AS n, {pick(2)} AS over_, {pick(3)} AS under_, {pick(4)} AS m FROM investment_instrument),
sb AS (SELECT instrument_id, spread_bps, (CAST(n AS DECIMAL(18,6))+COALESCE(CAST(CAST(over_ AS DOUBLE)/CAST(under_ AS DOUBLE) AS DECIMAL(18,6)),0))*CASE WHEN m LIKE '\\%%' ESCAPE '\\' OR m LIKE 'per%' THEN 100 ELSE 1 END AS bps FROM sp WHERE n IS NOT NULL),
x AS (SELECT observation_id, field, trim(printed_value) AS p, COALESCE(note,'') AS note FROM quality_source_exceptions WHERE regexp_matches(printed_value, '[0-9]')),
y AS (SELECT *, CAST({digits.format(c='p')} AS DECIMAL(18,6))*CASE WHEN p LIKE '%(%' OR p LIKE '-%' OR p LIKE '−%' THEN -1 ELSE 1 END AS v,
 COALESCE(NULLIF(regexp_extract(p, '^[-(−]*([A-Z]{{1,3}}\\$|US\\$|[$€£¥]|[A-Z]{{3}})', 1),''), NULLIF(regexp_extract(note, '\\((\\S+) in \\w+\\)', 1),''), NULLIF(regexp_extract(note, 'prints (?:negative )?\\w+ in ([A-Z]{{3}})', 1),''), 'USD') AS mark,
 lower(regexp_extract(p, '[0-9)]\\s*([a-zA-Z ]*)$', 1))||' '||lower(regexp_extract(note, '\\(\\S+ in (\\w+)\\)', 1))||' '||lower(regexp_extract(note, 'prints (?:negative )?\\w+ in [A-Z]{{3}} (\\w+)', 1)) AS words FROM x),
z AS (SELECT observation_id, field, v, p, note, {currency('mark')} AS code, {scale('words')} AS s FROM y)
SELECT DISTINCT 'fund_position' AS record_table, position_id AS record_id, 'quantity' AS field_name, base_unit, {half('CAST(n AS DECIMAL(18,6))*CAST(to_base AS DECIMAL(19,12))')} AS base_value FROM qu JOIN unit_reference ON unit_code=unit WHERE unit<>base_unit
UNION ALL SELECT DISTINCT 'fund_position', position_id, 'fair_value', 'USD', {half('v*CAST(usd_per_unit*s AS DECIMAL(20,8))')} FROM fv JOIN currency_reference ON currency_code=code WHERE NOT (code='USD' AND s=1)
UNION ALL SELECT DISTINCT 'investment_instrument', instrument_id, 'spread_bps', 'bps', {half('bps')} FROM sb WHERE spread_bps IS DISTINCT FROM bps
UNION ALL SELECT DISTINCT 'quality_source_exceptions', observation_id, 'printed_value', 'USD', {half('v*CAST(usd_per_unit*s AS DECIMAL(20,8))')} FROM z JOIN currency_reference ON currency_code=code WHERE field<>'reported_irr'
UNION ALL SELECT DISTINCT 'quality_source_exceptions', observation_id, 'printed_value', 'bps', {half("v*CASE WHEN p LIKE '%bps%' THEN 1 WHEN p LIKE '%\\%%' ESCAPE '\\' THEN 100 WHEN note LIKE '%decimal fraction%' THEN 10000 ELSE 100 END")} FROM z WHERE field='reported_irr'"""


SQL = {"p1_found": P1_FOUND, "p1_hierarchies": P1_HIERARCHIES, "p1_descendants": P1_DESCENDANTS, "p1_hierarchies_whole": P1_HIERARCHIES_WHOLE, "p1_other_parents": P1_OTHER_PARENTS, "p4_found": _p4(), "p6_found": _p6(), "p7_found": _p7()}
