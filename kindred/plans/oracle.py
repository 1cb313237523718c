"""The queries in DuckDB's SQL, written apart from the plans that they check."""

from __future__ import annotations

from .entities import TRUTH as TRUE
from .entities import VIEWS

# Fixed values, written out here apart from those of the plans: the words that do not tell names apart.
STOP = """[
'the', 'a', 'an', 'of', 'in', 'at', 'on', 'to', 'for', 'by', 'with', 'and', 'or', 'is', 'it', 'its', 'this', 'that', 'no', 'not', 'are', 'was', 'were', 'been',
'be', 'being', 'have', 'has', 'had', 'do', 'does', 'did', 'will', 'would', 'could', 'should', 'may', 'might', 'shall', 'can', 'de', 'la', 'le', 'les', 'du',
'des', 'et', 'en', 'un', 'une', 'au', 'aux', 'sur', 'par', 'pour', 'dans', 'avec', 'ke', 'ka', 'ki', 'se', 'ko', 'me', 'hai', 'aur', 'ya', 'inc',
'incorporated', 'corp', 'corporation', 'co', 'company', 'ltd', 'limited', 'llc', 'llp', 'lp', 'plc', 'pvt', 'private', 'gmbh', 'ag', 'sarl', 'sas', 'sa',
'eurl', 'sci', 'snc', 'srl', 'pty', 'bv', 'nv', 'ab', 'oy', 'as', 'kg', 'ohg', 'group', 'groups', 'holdings', 'holding', 'enterprises', 'enterprise',
'industries', 'industry', 'industrial', 'associates', 'associate', 'partners', 'partner', 'partnership', 'international', 'intl', 'global', 'worldwide',
'services', 'service', 'solutions', 'solution', 'technologies', 'technology', 'tech', 'trading', 'traders', 'trader', 'trade', 'systems', 'system',
'consultants', 'consultant', 'consulting', 'consultancy', 'management', 'ventures', 'venture', 'products', 'product', 'productions', 'production',
'communications', 'communication', 'logistics', 'networks', 'network', 'marketing', 'advertising', 'media', 'agencies', 'agency', 'corporate', 'professionals',
'professional', 'foundation', 'institute', 'institution', 'organization', 'organisation', 'com', 'net', 'org', 'io', 'biz', 'info'
]"""
SCORES = {"S1": 64, "S2": 32, "S4": 16, "S7": 12, "S6": 8, "S3": 4, "S5": 2}
BITS = {"S1": 64, "S2": 32, "S4": 16, "S6": 8, "S3": 4, "S5": 2, "S7": 1}


def norm(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(replace(lower(nfc_normalize(coalesce({x}, ''))), '&', ' and '), '[^\\p{{L}}\\p{{M}}\\p{{N}} ]', ' ', 'g'), ' +', ' ', 'g'))"


def toks(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: length(t) > 1 AND NOT list_contains({STOP}, t))"


def rep(view: str) -> str:
    return f"""
ent AS ({VIEWS[view].format(string="VARCHAR")}),
r0 AS (SELECT entity_id AS eid, {norm("trim(business_name)")} AS norm_name, {norm("trim(business_address)")} AS norm_addr, trim(coalesce(country, '')) AS country FROM ent),
r1 AS (SELECT *, strip_accents(norm_name) AS norm_name_af, {toks("norm_name")} AS toks, {toks("strip_accents(norm_name)")} AS toks_af, list_distinct({toks("norm_addr")}) AS addr_toks,
  list_sort(list_distinct(list_filter(string_split(norm_addr, ' '), lambda x: regexp_matches(x, '^[0-9]{{2,}}$'))))[1:5] AS addr_nums FROM r0),
rep AS (SELECT *, array_to_string(list_sort(list_distinct(toks)), ' ') AS core_name, array_to_string(list_sort(list_distinct(toks_af)), ' ') AS core_name_af, array_to_string(toks, '') AS squash,
  CASE WHEN norm_name = '' THEN [] ELSE list_distinct(list_transform(range(1, length(norm_name) + 1), lambda i: substr('^' || norm_name || '$', i, 3))) END AS trigrams,
  list_filter(addr_nums, lambda n: length(n) = 6) AS pins FROM r1),
q AS (SELECT * FROM rep WHERE eid LIKE 'S1-%'), t AS (SELECT * FROM rep WHERE NOT eid LIKE 'S1-%')"""


def strategies(most: int = 10_000, most_tokens: int = 50_000, most_address: int = 200) -> dict[str, str]:
    """Each strategy as a predicate on a pair, its hits counted; lists are gated by how many targets have their key."""
    variants = lambda side, c: f"SELECT eid, country, unnest(list_distinct([{c}, {c}_af])) AS key FROM {side} WHERE {c} <> ''"
    few = lambda keys, n: f"SELECT key, country FROM ({keys}) GROUP BY ALL HAVING count(*) <= {n}"
    tokens = lambda side: f"SELECT eid, country, len(toks) AS k, unnest(list_distinct(toks)) AS key FROM {side}"
    addresses = lambda side, more: f"SELECT eid, country, {more} AS key, len(addr_nums) AS k FROM {side} WHERE len(addr_nums) > 0"
    first = "list_append(addr_nums, toks[1])"
    equal = lambda c: f"SELECT a.eid AS s1_id, b.eid, count(*) AS h FROM ({variants('q', c)}) a JOIN ({variants('t', c)}) b USING (key, country) WHERE (key, country) IN ({few(variants('t', c), most)}) GROUP BY 1, 2"
    with_token = lambda side: f"({addresses(side, first)} AND len(toks) > 0)"
    return {
        "S1": equal("norm_name"),
        "S2": equal("core_name"),
        "S3": f"SELECT s1_id, eid, 1 AS h FROM (SELECT *, count(*) OVER (PARTITION BY s1_id) AS found, count(*) FILTER (n > least) OVER (PARTITION BY s1_id) AS closer FROM (SELECT a.eid AS s1_id, b.eid, count(*) AS n, any_value(a.k) AS k, CASE WHEN any_value(a.k) = 1 THEN 1 ELSE 2 END AS least FROM ({tokens('q')}) a JOIN ({tokens('t')}) b USING (key, country) WHERE (key, country) IN ({few(tokens('t'), most_tokens)}) GROUP BY 1, 2) WHERE n >= least) WHERE found <= {most} OR (least < k AND n > least AND closer <= {most})",
        "S4": f"SELECT a.eid AS s1_id, b.eid, 1 AS h FROM {with_token('q')} a JOIN {with_token('t')} b USING (key, country) WHERE (key, country) IN ({few(with_token('t')[1:-1], most)})",
        "S5": f"SELECT q.eid AS s1_id, b.eid, 1 AS h FROM q JOIN ({variants('t', 'norm_name')}) b ON q.norm_name = b.key AND q.country <> b.country WHERE q.norm_name <> '' AND (b.key, b.country) IN ({few(variants('t', 'norm_name'), most)})",
        "S6": f"SELECT q.eid AS s1_id, b.eid, 1 AS h FROM q JOIN ({tokens('t')}) b ON len(q.toks) >= 2 AND q.squash = b.key WHERE (b.key, b.country) IN ({few(tokens('t'), min(most, most_tokens))})",
        "S7": f"SELECT a.eid AS s1_id, b.eid, 1 AS h FROM ({addresses('q', 'addr_nums')}) a JOIN ({addresses('t', 'addr_nums')}) b USING (key, country) WHERE a.k >= 2 AND (key, country) IN ({few(addresses('t', 'addr_nums'), min(most, most_address))})",
    }


HITS = strategies()


def hits(view: str = "part", **gates: int) -> str:
    every = " UNION ALL ".join(f"SELECT s1_id, eid, h, '{s}' strategy, {BITS[s]} b, {SCORES[s]} s FROM ({q})" for s, q in strategies(**gates).items())
    return f"{rep(view)}, hits AS ({every}), pairs AS (SELECT s1_id, eid, CAST(bit_or(b) AS INTEGER) AS mask, CAST(sum(h * s) AS BIGINT) AS rank FROM hits GROUP BY ALL)"


def capped(n: int, view: str = "part") -> str:
    return f"{hits(view)}, cap AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY rank DESC, eid) <= {n})"


TRUTH = f"tr AS ({TRUE.format(string='VARCHAR')})"
IDS = "ids AS (SELECT entity_id s1_id, country FROM ent WHERE entity_id LIKE 'S1-%')"
LISTS = "lists AS (SELECT i.s1_id id, list_sort(list_distinct(list(eid) FILTER (eid IS NOT NULL))) members FROM ids i LEFT JOIN tr USING (s1_id) GROUP BY 1)"


def jac(a: str, b: str) -> str:
    return f"CASE WHEN len(list_distinct(list_concat({a}, {b}))) = 0 THEN 0.0 ELSE len(list_intersect(list_distinct({a}), list_distinct({b}))) / len(list_distinct(list_concat({a}, {b}))) END"


def feats(n: int) -> str:
    mx = "greatest(length(q.norm_name), length(t.norm_name))"
    inter = "len(list_intersect(list_distinct(q.toks), list_distinct(t.toks)))"
    small = "least(len(list_distinct(q.toks)), len(list_distinct(t.toks)))"
    return f"""{capped(n)}, f AS (SELECT c.s1_id, c.eid,
 CASE WHEN q.norm_name <> '' AND q.norm_name = t.norm_name THEN 1.0 ELSE 0.0 END AS exact_name_match, CASE WHEN q.core_name <> '' AND q.core_name = t.core_name THEN 1.0 ELSE 0.0 END AS core_name_match,
 {jac("q.toks", "t.toks")} AS token_jaccard, CAST({inter} AS DOUBLE) AS token_overlap_count, CASE WHEN {small} > 0 THEN {inter} / {small} ELSE 0.0 END AS token_overlap_ratio,
 {jac("q.trigrams", "t.trigrams")} AS char_trigram_jaccard,
 CASE WHEN q.norm_name <> '' AND t.norm_name <> '' AND 2 * levenshtein(q.norm_name, t.norm_name) <= {mx} THEN 1 - levenshtein(q.norm_name, t.norm_name) / {mx} ELSE 0.0 END AS levenshtein_ratio,
 CASE WHEN q.toks[1] = t.toks[1] THEN 1.0 ELSE 0.0 END AS prefix_token_match,
 CASE WHEN q.squash <> '' AND t.squash <> '' AND (contains(q.squash, t.squash) OR contains(t.squash, q.squash)) THEN 1.0 ELSE 0.0 END AS domain_squash_match,
 {jac("q.addr_toks", "t.addr_toks")} AS addr_token_jaccard, CAST(len(list_intersect(q.addr_nums, t.addr_nums)) AS DOUBLE) AS addr_digit_overlap, {jac("q.addr_nums", "t.addr_nums")} AS addr_digit_jaccard,
 CASE WHEN list_has_any(q.pins, t.pins) THEN 1.0 ELSE 0.0 END AS has_pin_match, CASE WHEN q.country <> '' AND q.country = t.country THEN 1.0 ELSE 0.0 END AS same_country,
 CASE WHEN c.eid LIKE 'S2-%' THEN 1.0 ELSE 0.0 END AS is_s2
 FROM cap c JOIN q ON q.eid = c.s1_id JOIN t ON t.eid = c.eid),
p AS (SELECT s1_id, eid, round(0.25 * exact_name_match + 0.2 * core_name_match + 0.2 * token_jaccard + 0.15 * char_trigram_jaccard + 0.15 * addr_digit_jaccard + 0.05 * same_country, 9) AS p FROM f)"""


F05 = "CASE WHEN n_true = 0 THEN CASE WHEN n_predicted = 0 THEN 1.0 ELSE 0.0 END WHEN n_predicted = 0 OR n_right = 0 THEN 0.0 ELSE 1.25 * (n_right / n_predicted) * (n_right / n_true) / (0.25 * (n_right / n_predicted) + n_right / n_true) END"


def bucket(x: str) -> str:
    out = "0"
    for i in range(8):
        out = f"(({out}) * 96 + CAST(('0x' || substr(sha256({x}), {8 * i + 1}, 8)) AS BIGINT)) % 100"
    return out


#: The distance table of a and b, row by row; worst: the largest of the rows' least entries.
EDIT_TABLE = """list_reduce(list_transform(string_split(a, ''), lambda c: {'row': [0], 'worst': 0, 'c': c}),
 lambda s, x: list_transform([list_reduce(list_prepend([s.row[1] + 1], list_transform(range(1, length(b) + 1), lambda j: [least(s.row[j + 1] + 1, s.row[j] + CASE WHEN substr(b, j, 1) = x.c THEN 0 ELSE 1 END)])),
   lambda r, v: list_append(r, least(v[1], r[-1] + 1)))], lambda r: {'row': r, 'worst': greatest(s.worst, list_min(r)), 'c': x.c})[1],
 {'row': range(0, length(b) + 1), 'worst': 0, 'c': ''})"""


def scored(n: int) -> str:
    return f"""{feats(n)}, {TRUTH}, {IDS}, sc AS (SELECT id, n_true, n_predicted, n_right, {F05} AS f05 FROM (
 SELECT i.s1_id AS id, CAST((SELECT count(*) FROM tr WHERE tr.s1_id = i.s1_id) AS INTEGER) n_true, CAST((SELECT count(*) FROM p WHERE p.s1_id = i.s1_id AND p >= 0.6) AS INTEGER) n_predicted,
 CAST((SELECT count(*) FROM p JOIN tr USING (s1_id, eid) WHERE p.s1_id = i.s1_id AND p >= 0.6) AS INTEGER) n_right FROM ids i))"""


def swept(n: int) -> str:
    return f"""{feats(n)}, {TRUTH}, {IDS}, g AS (SELECT i / 20 AS tau FROM range(1, 20) x(i)), z AS (SELECT tau, {F05} AS f05, n_true FROM (
 SELECT tau, i.s1_id, (SELECT count(*) FROM tr WHERE tr.s1_id = i.s1_id) n_true, count(p.eid) n_predicted, count(tr.eid) n_right
 FROM g CROSS JOIN ids i LEFT JOIN p ON p.s1_id = i.s1_id AND p.p >= tau LEFT JOIN tr ON tr.s1_id = p.s1_id AND tr.eid = p.eid GROUP BY ALL)),
sw AS (SELECT tau, round(avg(f05), 6) AS macro_f05, round(coalesce(avg(f05) FILTER (n_true = 0), 0), 6) AS singleton_f05 FROM z GROUP BY tau)"""


def sql(n: int) -> dict[str, str]:
    part, docs = rep("part"), rep("documents")
    base = f"WITH {part}, {TRUTH}, {IDS}, {LISTS}"
    keys = {
        "name": "SELECT unnest(list_distinct([norm_name, norm_name_af])) AS key, country FROM t WHERE norm_name <> ''",
        "core": "SELECT unnest(list_distinct([core_name, core_name_af])) AS key, country FROM t WHERE core_name <> ''",
        "token": "SELECT unnest(list_distinct(toks)) AS key, country FROM t",
        "addr": "SELECT array_to_string(list_append(addr_nums, toks[1]), '|') AS key, country FROM t WHERE len(addr_nums) > 0 AND len(toks) > 0",
        "addrnum": "SELECT array_to_string(addr_nums, '|') AS key, country FROM t WHERE len(addr_nums) > 0",
    }
    addr = "a AS (SELECT eid, array_to_string(addr_nums, '|') AS key, country, count(*) OVER (PARTITION BY addr_nums, country) AS n FROM t WHERE len(addr_nums) > 0)"
    stats = "max(n) FILTER (rn = CAST(floor(ids / 2) AS BIGINT) + 1) AS median, max(n) FILTER (rn = CAST(floor(ids * 0.95) AS BIGINT) + 1) AS p95"
    recall_of = lambda pairs: f"fnd AS (SELECT tr.*, c.eid IS NOT NULL AS hit, CASE WHEN tr.eid LIKE 'S2-%' THEN 'S2' ELSE 'S3' END AS src FROM tr LEFT JOIN {pairs} c USING (s1_id, eid)), per AS (SELECT i.s1_id, any_value(i.country) AS country, count(fnd.eid) AS n_true, count(*) FILTER (hit) AS n_found FROM ids i LEFT JOIN fnd USING (s1_id) GROUP BY 1)"
    rec = "round(CASE WHEN sum(n_true) > 0 THEN sum(n_found) / sum(n_true) ELSE 0.0 END, 6) AS recall"
    sums = "CAST(sum(n_true) AS BIGINT) AS n_true, CAST(sum(n_found) AS BIGINT) AS n_found"
    out = {
        "representations": f"WITH {docs} SELECT eid, norm_name, norm_name_af, core_name, core_name_af, squash, country, array_to_string(toks, ',') AS toks, array_to_string(addr_nums, ',') AS addr_nums, array_to_string(pins, ',') AS pins, CAST(len(addr_toks) AS INTEGER) AS n_addr_toks, CAST(len(trigrams) AS INTEGER) AS n_trigrams FROM rep",
        "split_buckets": f"WITH {part} SELECT entity_id, {bucket('entity_id')} AS bucket FROM ent",
        "tsv_round_trip": f"WITH {docs} SELECT entity_id, business_name, business_address, trim(country) AS country FROM ent",
        "id_list_round_trip": f"{base} SELECT id, array_to_string(members, ',') AS members FROM (SELECT id, coalesce(members, []) AS members FROM lists)",
        "store_lookup": f"{base} SELECT ent.* FROM ent WHERE entity_id IN (SELECT eid FROM tr)",
        "posting_sizes": f"WITH {part} " + " UNION ALL ".join(f"SELECT '{k}' AS posting, key, country, count(*) AS n FROM ({v}) GROUP BY ALL" for k, v in keys.items()),
        "posting_stats": f"WITH {part}, s AS (SELECT count(*) AS n FROM ({keys['token']}) GROUP BY key, country), o AS (SELECT n, row_number() OVER (ORDER BY n) AS rn, count(*) OVER () AS ids FROM s) SELECT any_value(ids) AS ids, CAST(sum(n) AS BIGINT) AS total, {stats}, max(n) AS max FROM o",
        "pruned_postings": f"WITH {part}, {addr} SELECT key, country, n FROM a WHERE n <= 200 GROUP BY ALL",
        "pruned_targets": f"WITH {part}, {addr} SELECT DISTINCT eid FROM a WHERE n > 200",
        "known_countries": f"WITH {part} SELECT DISTINCT country FROM t",
        "candidates_ranked": f"WITH {hits()} SELECT * FROM pairs",
        "candidates_ranked_documents": f"WITH {hits('documents')} SELECT * FROM pairs",
        "candidates_capped": f"WITH {capped(n)}, {IDS} SELECT s1_id AS id, coalesce(string_agg(eid, ',' ORDER BY eid), '') AS members FROM ids LEFT JOIN cap USING (s1_id) GROUP BY 1",
        "strategy_counts": f"WITH {capped(n)} " + " UNION ALL ".join(f"SELECT '{s}' AS strategy, count(*) FILTER (mask & {b} <> 0) AS n FROM cap" for s, b in BITS.items()),
        "strategy_audit": f"WITH {hits()}, {TRUTH}, d AS (SELECT DISTINCT s1_id, eid, strategy FROM hits), w AS (SELECT d.*, min(strategy) OVER (PARTITION BY s1_id, eid) AS fst, count(*) OVER (PARTITION BY s1_id, eid) AS k, EXISTS (SELECT 1 FROM tr WHERE tr.s1_id = d.s1_id AND tr.eid = d.eid) AS tru FROM d) SELECT strategy, count(*) AS returned, count(*) FILTER (fst = strategy) AS new, count(*) FILTER (tru) AS true_touched, count(*) FILTER (tru AND k = 1) AS true_only FROM w GROUP BY 1",
        "recall": f"WITH {capped(n)}, {TRUTH}, {IDS}, {recall_of('cap')} SELECT 'all' AS scope, '' AS value, {sums}, count(*) AS ids, count(*) FILTER (n_true = n_found) AS all_found, {rec} FROM per UNION ALL SELECT 'country', country, {sums}, count(*), count(*) FILTER (n_true = n_found), {rec} FROM per GROUP BY country UNION ALL SELECT 'source', src, count(*), count(*) FILTER (hit), 0, 0, round(count(*) FILTER (hit) / count(*), 6) FROM fnd GROUP BY src",
        "config_sweep": f"WITH {hits()}, {TRUTH}, {IDS}, ro AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY rank DESC, eid) AS rn FROM pairs), m AS (SELECT tr.s1_id, tr.eid, rn FROM tr LEFT JOIN ro USING (s1_id, eid)) SELECT cap, count(*) AS n_true, count(*) FILTER (rn <= CASE WHEN cap = 0 THEN 1000000 ELSE cap END) AS n_found, round(count(*) FILTER (rn <= CASE WHEN cap = 0 THEN 1000000 ELSE cap END) / count(*), 6) AS recall FROM m CROSS JOIN (VALUES (0), ({2 * n}), ({n})) c(cap) GROUP BY cap",
        "candidate_sizes": f"WITH {hits()}, {IDS}, s AS (SELECT i.s1_id, count(eid) AS n FROM ids i LEFT JOIN pairs USING (s1_id) GROUP BY 1), o AS (SELECT n, row_number() OVER (ORDER BY n) AS rn, count(*) OVER () AS ids FROM s) SELECT any_value(ids) AS ids, CAST(sum(n) AS BIGINT) AS total, {stats}, max(n) AS max, round(avg(n), 6) AS mean, round(1732544 * (14 + avg(n) * 14) / 1048576, 4) AS file_mb FROM o",
        "missed_pairs": f"WITH {part}, {TRUTH}, s AS ({HITS['S1']}) SELECT s1_id, eid FROM tr ANTI JOIN s USING (s1_id, eid)",
        "missed_diagnosis": f"WITH {part}, {TRUTH}, s AS ({HITS['S1']}), m AS (SELECT s1_id, eid FROM tr ANTI JOIN s USING (s1_id, eid)) SELECT m.s1_id, m.eid, q.norm_name AS s1_name, t.norm_name AS name, array_to_string(list_sort(list_intersect(list_distinct(q.toks), list_distinct(t.toks))), ',') AS shared FROM m JOIN q ON q.eid = m.s1_id JOIN t ON t.eid = m.eid",
        "pair_features": f"WITH {feats(n)} SELECT s1_id, eid, round(COLUMNS(* EXCLUDE (s1_id, eid)), 6) FROM f",
        "labelled_pairs": f"WITH {capped(n)}, {TRUTH} SELECT s1_id, eid, CAST(EXISTS (SELECT 1 FROM tr WHERE tr.s1_id = c.s1_id AND tr.eid = c.eid) AS INTEGER) AS label FROM cap c",
        "entity_scores": f"WITH {scored(n)} SELECT id, n_true, n_predicted, n_right, round(f05, 6) AS f05 FROM sc",
        "score_breakdown": f"WITH {scored(n)} SELECT count(*) AS entities, round(avg(f05), 6) AS macro_f05, count(*) FILTER (n_true = 0 AND f05 = 1) AS singletons_right, count(*) FILTER (n_true = 0 AND f05 = 0) AS singletons_wrong, count(*) FILTER (n_true > 0 AND f05 = 1) AS perfect, count(*) FILTER (n_true > 0 AND f05 = 0) AS missed FROM sc",
        "threshold_sweep": f"WITH {swept(n)} SELECT * FROM sw",
        "best_threshold": f"WITH {swept(n)} SELECT tau, macro_f05 FROM sw ORDER BY macro_f05 DESC, tau LIMIT 1",
        "match_histogram": f"{base}, k AS (SELECT CASE WHEN coalesce(len(members), 0) >= 4 THEN '4+' ELSE CAST(coalesce(len(members), 0) AS VARCHAR) END AS matches FROM lists) SELECT m.matches, count(k.matches) AS ids, round(100.0 * count(k.matches) / (SELECT count(*) FROM lists), 6) AS percent FROM (VALUES ('0'), ('1'), ('2'), ('3'), ('4+')) m(matches) LEFT JOIN k USING (matches) GROUP BY 1",
        "match_stats": f"{base}, k AS (SELECT coalesce(len(members), 0) AS n FROM lists) SELECT count(*) AS ids, CAST(sum(n) AS BIGINT) AS links, round(avg(n), 6) AS mean, median(n) AS median, CAST(max(n) AS INTEGER) AS max, count(*) FILTER (n = 0) AS singletons FROM k",
        "split_summary": f"{base} SELECT CASE WHEN {bucket('id')} < 20 THEN 'validation' ELSE 'train' END AS split, count(*) AS ids, CAST(sum(coalesce(len(members), 0)) AS BIGINT) AS links, count(*) FILTER (coalesce(len(members), 0) = 0) AS singletons FROM lists GROUP BY 1",
        "country_counts": f"WITH {docs} SELECT CASE WHEN trim(coalesce(country, '')) = '' THEN '(empty)' ELSE trim(country) END AS country, count(*) AS n FROM ent GROUP BY 1",
        "missing_fields": f"WITH {docs}, m AS (SELECT trim(coalesce(business_name, '')) = '' AS a, NOT length(business_address) > 12 AS b FROM ent) SELECT count(*) AS n, count(*) FILTER (a) AS no_name, count(*) FILTER (b) AS no_address, 100 * avg(CAST(a AS INTEGER)) AS no_name_percent, 100 * avg(CAST(b AS INTEGER)) AS no_address_percent FROM m",
        "pilot_sample": f"WITH {part} SELECT entity_id FROM ent WHERE entity_id LIKE 'S1-%' AND {bucket('entity_id')} < 20 ORDER BY 1 LIMIT 10000",
        "set_tests": f"WITH {part}, i AS (SELECT entity_id, {bucket('entity_id')} < 20 AS v FROM ent WHERE entity_id LIKE 'S1-%'), a AS (SELECT entity_id FROM i WHERE NOT v), b AS (SELECT entity_id FROM i WHERE v) SELECT (SELECT count(*) FROM (FROM a INTERSECT FROM b)) AS common, (SELECT count(*) FROM (SELECT entity_id FROM i EXCEPT (FROM a UNION FROM b))) AS neither",
        "remaining_ids": f"{base} SELECT id AS s1_id FROM lists WHERE coalesce(len(members), 0) = 0",
        "consistent_fallback": f"{base}, g AS (SELECT min(id) AS gap FROM lists WHERE id >= 'S1-0000000600') SELECT id AS s1_id, CASE WHEN gap IS NULL OR id < gap THEN array_to_string(coalesce(members, []), ',') ELSE '' END AS members, CASE WHEN gap IS NULL OR id < gap THEN array_to_string(coalesce(members, []), ',') ELSE '' END AS candidates FROM lists CROSS JOIN g",
        "result_checks": f"WITH {scored(n)} SELECT count(*) AS rows, count(*) FILTER (n_predicted = 0) AS n_empty, count(*) FILTER (n_predicted > 1) AS n_multiple, CAST(0 AS BIGINT) AS n_outside, count(*) AS expected FROM sc",
        "linked_incrementally": f"WITH {feats(n)}, {IDS} SELECT s1_id AS id, coalesce((SELECT string_agg(eid, ',' ORDER BY eid) FROM p WHERE p.s1_id = i.s1_id AND p >= 0.6), '') AS members, coalesce((SELECT string_agg(eid, ',' ORDER BY eid) FROM cap WHERE cap.s1_id = i.s1_id), '') AS candidates FROM ids i",
    }
    smoke = "sm AS (SELECT s1_id FROM ids ORDER BY s1_id LIMIT 100)"
    checked = lambda stage, rows: f"SELECT '{stage}' AS stage, count(*) AS rows, count(*) FILTER (n_predicted = 0) AS n_empty, count(*) FILTER (n_predicted > 1) AS n_multiple, CAST(0 AS BIGINT) AS n_outside, count(*) AS expected FROM sc{rows}"
    pilot = f"SELECT entity_id FROM ent WHERE entity_id LIKE 'S1-%' AND {bucket('entity_id')} < 20"
    out |= {
        "records_of_ids": f"WITH {part} SELECT entity_id, business_name, business_address, country FROM ent WHERE entity_id IN ({pilot})",
        "truth_of_ids": f"{base} SELECT id, array_to_string(coalesce(members, []), ',') AS members FROM lists WHERE {bucket('id')} < 20",
        "needed_ids": f"WITH {capped(n)} SELECT DISTINCT eid FROM cap",
        "last_records": f"WITH {part} SELECT entity_id, CASE WHEN length(business_address) % 2 = 0 THEN concat(business_name, ' again') ELSE business_name END AS business_name, business_address, country FROM ent WHERE NOT entity_id LIKE 'S1-%'",
        "split_files": f"{base} SELECT CASE WHEN {bucket('id')} < 20 THEN 'validation' ELSE 'train' END AS split, id, array_to_string(coalesce(members, []), ',') AS members FROM lists",
        "fallback_file": f"{base}, g AS (SELECT min(id) AS gap FROM lists WHERE id >= 'S1-0000000600') SELECT row_number() OVER (ORDER BY id) AS place, id, CASE WHEN gap IS NULL OR id < gap THEN array_to_string(coalesce(members, []), ',') ELSE '' END AS members FROM lists CROSS JOIN g",
        "first_records": f"WITH {part} SELECT entity_id FROM ent WHERE entity_id LIKE 'S1-%' ORDER BY 1 LIMIT 1000",
        "missed_examples": f"WITH {part}, {TRUTH}, s AS ({HITS['S1']}), m AS (SELECT s1_id, eid FROM tr ANTI JOIN s USING (s1_id, eid) ORDER BY 1, 2 LIMIT 10) SELECT m.s1_id, m.eid, q.norm_name AS s1_name, t.norm_name AS name, array_to_string(list_sort(list_intersect(list_distinct(q.toks), list_distinct(t.toks))), ',') AS shared FROM m JOIN q ON q.eid = m.s1_id JOIN t ON t.eid = m.eid",
        "smoke_then_full": f"WITH {scored(n)}, {smoke} {checked('smoke', ' WHERE id IN (SELECT s1_id FROM sm)')} UNION ALL {checked('full', '')}",
        "resumed_run": f"WITH {feats(n)}, {IDS} SELECT s1_id AS id, coalesce((SELECT string_agg(eid, ',' ORDER BY eid) FROM p WHERE p.s1_id = i.s1_id AND p >= 0.6), '') AS members FROM ids i",
        "edit_ratio_exact": f"WITH {capped(n)}, n AS (SELECT c.s1_id, c.eid, q.norm_name AS a, t.norm_name AS b, greatest(length(q.norm_name), length(t.norm_name)) AS mx FROM cap c JOIN q ON q.eid = c.s1_id JOIN t ON t.eid = c.eid), d AS (SELECT *, {EDIT_TABLE} AS e FROM n) SELECT s1_id, eid, round(CASE WHEN a = '' OR b = '' THEN 0.0 WHEN a = b THEN 1.0 WHEN 2 * abs(length(a) - length(b)) > mx OR 2 * e.worst > mx THEN 0.0 ELSE 1 - e.row[-1] / mx END, 6) AS levenshtein_ratio FROM d",
    }
    for s, q in HITS.items():
        for view in ("part", "documents")[: 1 + (s != "S6")]:
            out[f"strategy_{s.lower()}_{view}"] = f"WITH {rep(view)} SELECT s1_id, eid, CAST(sum(h) AS BIGINT) AS hits, CAST(sum(h) * {SCORES[s]} AS BIGINT) AS score FROM ({q}) GROUP BY 1, 2"
    return out
