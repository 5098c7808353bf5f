"""DuckDB SQL for name similarity, room features and mapping, written from the definitions and not from the engine's code.

Each function gives the text of common table expressions; the last of them has the name that is asked for.
"""

from __future__ import annotations

from ..functions import vocabulary as V


def words(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def norm(x: str) -> str:
    """Normalised names, for texts without entities and spaced letters."""
    return f"trim(regexp_replace(replace(lower(strip_accents(coalesce({x}, ''))), '&', ' and '), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def resolved_access(ts: str) -> str:
    """What becomes of the words of access in a list of words."""
    before = f"coalesce({ts}[i - 1], '')"
    return f"list_filter(list_transform({ts}, lambda t, i: CASE WHEN NOT list_contains({words(V.ACCESS_WORDS)}, t) THEN t WHEN list_contains({words(V.DISABILITY)}, {before}) THEN 'accessible' WHEN t = 'access' OR list_contains({words(V.PERK_WORDS)}, {before}) THEN '' ELSE 'accessible' END), lambda t: t <> '')"


def room_norms(src: str, out: str) -> str:
    """(room_name, norm) of the distinct names of ``src``."""
    text = norm("regexp_replace(regexp_replace(coalesce(room_name, ''), '\\[.*?\\]', ' ', 'g'), '\\b[0-9]+\\s*%', ' ', 'g')")
    for pattern, joined in V.SPLIT_WORDS:
        text = f"regexp_replace({text}, '{pattern}', '{joined}', 'g')"
    short = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in V.ABBREVIATIONS.items())
    noise = words([*V.RATE_WORDS, *V.PROMO_WORDS, *V.PERK_WORDS])
    return f"""{out}_0 AS (SELECT DISTINCT room_name, list_filter(string_split(regexp_replace({text}, '{V.DISABILITY_PHRASE}', 'disabled', 'g'), ' '), lambda t: t <> '') AS ts FROM {src}),
{out}_1 AS (SELECT room_name, list_transform({resolved_access('ts')}, lambda t: CASE t {short} ELSE t END) AS ts FROM {out}_0),
{out}_2 AS (SELECT room_name, list_slice(ts, 1, coalesce(list_min(list_filter(list_transform(ts, lambda t, i: CASE WHEN i > 1 AND list_contains({words(V.PROMO_STARTS)}, t) THEN i END), lambda i: i IS NOT NULL)) - 1, len(ts))) AS ts FROM {out}_1),
{out}_3 AS (SELECT room_name, list_slice(ts, 1, coalesce(list_max(list_transform(ts, lambda t, i: CASE WHEN list_contains({words(V.BOARD_CODES)}, t) THEN 0 ELSE i END)), 0)) AS ts FROM {out}_2),
{out}_4 AS (SELECT room_name, list_filter(ts, lambda t: NOT list_contains({noise}, t) AND NOT regexp_matches(t, '{V.DIMENSION}') AND NOT regexp_matches(t, '{V.YEAR}')) AS ts FROM {out}_3),
{out} AS (SELECT room_name, array_to_string(list_filter(ts, lambda t, i: list_position(ts, t) = i), ' ') AS norm FROM {out}_4)"""


def _chars(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN [] ELSE string_split({x}, '') END"


def _lcs(a: str, b: str) -> str:
    """Longest common subsequence of two lists of characters, by the table of lengths, row after row."""
    cell = f"greatest(acc[len(acc)], row[i + 1], CASE WHEN {a}[i] = c THEN row[i] + 1 ELSE 0 END)"
    row = f"list_reduce(range(1, len({a}) + 1), lambda acc, i: list_append(acc, {cell}), [0::BIGINT])"
    return f"list_reduce({b}, lambda row, c: {row}, list_resize([0::BIGINT], len({a}) + 1, 0::BIGINT))[len({a}) + 1]"


def similarities(src: str, a: str, b: str, out: str) -> str:
    """(a, b, plain, strict, both_ways) for the distinct pairs of ``src``; both_ways is the set similarity."""
    ts = lambda x: f"list_filter(string_split({x}, ' '), lambda t: t <> '')"
    join = lambda x: f"array_to_string(list_sort({x}), ' ')"
    return f"""{out}_0 AS (SELECT DISTINCT {a} AS a, {b} AS b, {ts(a)} AS ta, {ts(b)} AS tb FROM {src}),
{out}_1 AS (SELECT a, b, {join('ta')} AS sa, {join('tb')} AS sb, {join('list_intersect(list_distinct(ta), list_distinct(tb))')} AS i,
  {join('list_filter(list_distinct(ta), lambda t: NOT list_contains(tb, t))')} AS x, {join('list_filter(list_distinct(tb), lambda t: NOT list_contains(ta, t))')} AS y FROM {out}_0),
{out}_2 AS (SELECT *, {_chars('a')} AS ca, {_chars('b')} AS cb, {_chars('sa')} AS csa, {_chars('sb')} AS csb, {_chars('x')} AS cx, {_chars('y')} AS cy,
  length(i) + (i <> '')::INT + length(x) AS lx, length(i) + (i <> '')::INT + length(y) AS ly FROM {out}_1),
{out}_3 AS (SELECT *, {_lcs('ca', 'cb')} AS l_plain, {_lcs('csa', 'csb')} AS l_sorted, {_lcs('cx', 'cy')} AS l_rest FROM {out}_2),
{out} AS (SELECT a, b, CASE WHEN a = '' AND b = '' THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * l_plain / (length(a) + length(b)) END AS plain,
  CASE WHEN sa = '' OR sb = '' THEN 0.0::DOUBLE ELSE 200.0::DOUBLE * l_sorted / (length(sa) + length(sb)) END AS strict,
  CASE WHEN sa = '' OR sb = '' THEN 0.0::DOUBLE WHEN i <> '' AND (x = '' OR y = '') THEN 100.0::DOUBLE
    ELSE greatest(100.0::DOUBLE - 100.0::DOUBLE * (length(x) + length(y) - 2 * l_rest) / (lx + ly),
      CASE WHEN i <> '' THEN 100.0::DOUBLE - 100.0::DOUBLE * (lx - length(i)) / (lx + length(i)) ELSE 0 END,
      CASE WHEN i <> '' THEN 100.0::DOUBLE - 100.0::DOUBLE * (ly - length(i)) / (ly + length(i)) ELSE 0 END) END AS both_ways FROM {out}_3)"""


def view(ts: str) -> str:
    """The view that a list of words states."""
    at = f"list_position({ts}, 'view')"
    back = f"list_reverse(list_slice({ts}, greatest({at} - 3, 1), {at} - 1))"
    stop = f"list_min(list_filter(list_transform({back}, lambda t, i: CASE WHEN list_contains({words(V.VIEW_STOPS)}, t) OR regexp_full_match(t, '[0-9]+') THEN i END), lambda i: i IS NOT NULL))"
    kept = f"list_slice({back}, 1, coalesce({stop} - 1, len({back})))"
    return f"CASE WHEN {at} > 1 AND len({kept}) > 0 THEN array_to_string(list_reverse({kept}), ' ') END"


def features(src: str, out: str) -> str:
    """What the distinct names (norm) of ``src`` state: classes, view, beds, bedrooms, tiers, accessible."""
    one = lambda cond, label: f"CASE WHEN {cond} THEN '{label}' END"
    has = lambda w: f"list_contains(ts, '{w}')"
    some = lambda xs: f"list_filter([{', '.join(xs)}], lambda v: v IS NOT NULL)"
    classes = some(one(" AND ".join(map(has, c.split())), c) for c in sorted(V.CLASSES))
    beds = some(one(f"({has(b)} OR {has(b + 's')})", b) for b in sorted(V.BEDS))
    tiers = f"list_sort(list_distinct({some(one(has(t), V.TIER_SYNONYMS.get(t, t)) for t in V.TIERS)}))"
    count = f"regexp_extract(norm, '([0-9]+|{'|'.join(V.NUMBERS)}){V.BEDROOM_WORDS}', 1)"
    spelled = " ".join(f"WHEN '{w}' THEN {n}" for w, n in V.NUMBERS.items())
    return f"""{out}_0 AS (SELECT DISTINCT norm, list_filter(string_split(norm, ' '), lambda t: t <> '') AS ts FROM {src}),
{out}_1 AS (SELECT norm, ts, {classes} AS cs, {view('ts')} AS view, {beds} AS beds, CASE WHEN {has('studio')} THEN 0 WHEN {count} <> '' THEN CASE {count} {spelled} ELSE try_cast({count} AS INT) END END AS bedrooms, {tiers} AS tiers, list_has_any(ts, {words(V.ACCESSIBILITY)}) AS accessible FROM {out}_0),
{out} AS (SELECT norm, ts, CASE WHEN len(cs) > 0 THEN cs ELSE ['room'] END AS classes, view, beds, bedrooms, tiers, accessible FROM {out}_1)"""


def pairs() -> str:
    """Table p: pairs of a hotel's rooms with raw score, score, veto, corroborations and whether they survive; needs room_a and room_b."""
    bare = lambda n: f"array_to_string(list_filter(string_split({n}, ' '), lambda t: NOT list_contains({words(V.FILLER)}, t)), ' ')"
    apart = lambda c: f"(len(fa.{c}) > 0 AND len(fb.{c}) > 0 AND NOT list_has_any(fa.{c}, fb.{c}))"
    slash = lambda x, c: f"array_to_string({x}.{c}, '/')"
    told = lambda c: f"'{c} ' || {slash('fa', c if c != 'class' else 'classes')} || ' vs ' || {slash('fb', c if c != 'class' else 'classes')} || ' disjoint'"
    shared = f"array_to_string(list_sort(list_filter(list_distinct(list_intersect(fa.ts, fb.ts)), lambda t: NOT list_contains({words(V.GENERIC)}, t))), '/')"
    both = "(len(fa.beds) > 0 AND len(fb.beds) > 0)"
    return f"""rooms AS (SELECT room_name FROM room_a UNION SELECT room_name FROM room_b), {room_norms('rooms', 'nr')}, {features('nr', 'fs')},
c AS (SELECT a.hotel_id, a_id, b_id, a.room_name AS a_name, b.room_name AS b_name, x.norm AS na, y.norm AS nb, {bare('x.norm')} AS ba, {bare('y.norm')} AS bb
  FROM room_a a JOIN room_b b ON a.hotel_id = b.hotel_id JOIN nr x ON x.room_name = a.room_name JOIN nr y ON y.room_name = b.room_name),
named AS (SELECT na AS l, nb AS r FROM c UNION SELECT ba, bb FROM c), {similarities('named', 'l', 'r', 'sim')},
scored AS (SELECT c.*, greatest(f.strict, f.both_ways, g.strict, g.both_ways) AS raw FROM c JOIN sim f ON f.a = na AND f.b = nb JOIN sim g ON g.a = ba AND g.b = bb),
judged AS (SELECT s.*,
  round_even(CASE WHEN fa.accessible <> fb.accessible THEN least({V.ACCESS_CAP}, CASE WHEN NOT {both} THEN raw WHEN fa.beds = fb.beds THEN least(100.0, raw + 4) ELSE raw - 8 END)
    ELSE CASE WHEN NOT {both} THEN raw WHEN fa.beds = fb.beds THEN least(100.0, raw + 4) ELSE raw - 8 END END, 1) AS score,
  CASE WHEN {apart('classes')} THEN {told('class')} WHEN {apart('tiers')} THEN {told('tiers')} WHEN fa.bedrooms <> fb.bedrooms THEN 'bedrooms ' || fa.bedrooms || ' != ' || fb.bedrooms
    WHEN fa.view IS NOT NULL AND fb.view IS NOT NULL AND NOT list_has_any(string_split(fa.view, ' '), string_split(fb.view, ' ')) THEN 'view ''' || fa.view || ''' vs ''' || fb.view || ''' disjoint'
    WHEN {apart('beds')} THEN {told('beds')} END AS veto,
  CASE WHEN fa.accessible = fb.accessible THEN list_filter([CASE WHEN list_has_any(fa.tiers, fb.tiers) THEN 'tier' END, CASE WHEN fa.bedrooms = fb.bedrooms THEN 'bedrooms' END, CASE WHEN list_has_any(fa.beds, fb.beds) THEN 'beds' END,
    CASE WHEN {shared} <> '' THEN 'word:' || substr({shared}, 1, 32) END], lambda v: v IS NOT NULL) ELSE [] END AS cor
  FROM scored s JOIN fs fa ON fa.norm = na JOIN fs fb ON fb.norm = nb),
p AS (SELECT *, coalesce(string_split(veto, ' ')[1] IN ('tiers', 'view'), false) AS soft, veto IS NULL OR (coalesce(string_split(veto, ' ')[1] IN ('tiers', 'view'), false) AND len(cor) > 0) AS alive FROM judged)"""


def mapping() -> str:
    """Table m: the mapping of all rooms; needs room_a and room_b."""
    rank = "-score, na <> nb, abs(length(na) - length(nb)), a_name, a_id, b_name, b_id"
    free = "NOT list_contains(t.a, z.a) AND NOT list_contains(t.b, z.b)"
    return f"""{pairs()},
queue AS (SELECT hotel_id, list(struct_pack(a := a_id, b := b_id) ORDER BY {rank}) AS zs FROM p WHERE alive AND score >= {V.REVIEW} GROUP BY hotel_id),
taken AS (SELECT hotel_id, list_reduce(zs, lambda t, z: CASE WHEN {free} THEN struct_pack(a := list_append(t.a, z.a), b := list_append(t.b, z.b)) ELSE t END, struct_pack(a := []::BIGINT[], b := []::BIGINT[])) AS t FROM queue),
given AS (SELECT hotel_id, unnest(t.a) AS a_id, unnest(t.b) AS b_id FROM taken),
own AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id, a_id ORDER BY {rank}) AS r FROM p WHERE alive) WHERE r = 1),
lost AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id, a_id ORDER BY score DESC, b_name DESC, b_id DESC) AS r FROM p WHERE NOT alive) WHERE r = 1),
best AS (SELECT a.hotel_id, a.a_id, a.room_name, coalesce(g.b_id, own.b_id) AS x_id, coalesce(g.b_name, own.b_name) AS x_name, coalesce(g.score, own.score) AS s, coalesce(g.cor, own.cor) AS cor, l.b_name AS l_name, l.score AS l_score, l.veto AS l_veto
  FROM room_a a LEFT JOIN own ON own.hotel_id = a.hotel_id AND own.a_id = a.a_id LEFT JOIN lost l ON l.hotel_id = a.hotel_id AND l.a_id = a.a_id
  LEFT JOIN (SELECT p.* FROM p JOIN given USING (hotel_id, a_id, b_id)) g ON g.hotel_id = a.hotel_id AND g.a_id = a.a_id),
stated AS (SELECT *, CASE WHEN s >= {V.ACCEPT} OR (s >= {V.REVIEW} AND len(cor) > 0) THEN 'publish' WHEN s >= {V.REVIEW} THEN 'review' ELSE 'unmatched' END AS status FROM best),
mapped AS (SELECT hotel_id, a_id, room_name, status, CASE WHEN status <> 'unmatched' THEN x_id END AS b_id, CASE WHEN status <> 'unmatched' THEN x_name ELSE l_name END AS b_name,
  CASE WHEN status <> 'unmatched' THEN s ELSE l_score END AS score, CASE WHEN status = 'unmatched' THEN l_veto END AS veto, CASE WHEN status <> 'unmatched' THEN array_to_string(cor, ',') END AS corroborated FROM stated),
m AS (SELECT * FROM mapped UNION ALL SELECT hotel_id, NULL, room_name, 'leftover', b_id, room_name, NULL, NULL, NULL FROM room_b b
  WHERE trim(room_name) <> '' AND NOT EXISTS (SELECT 1 FROM given g WHERE g.hotel_id = b.hotel_id AND g.b_id = b.b_id) AND NOT EXISTS (SELECT 1 FROM mapped x WHERE x.hotel_id = b.hotel_id AND x.b_id = b.b_id))"""


KM = "12742 * asin(sqrt(pow(sin(radians(cand_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(cand_lat)) * pow(sin(radians(cand_lon - lon) / 2), 2)))"


def candidates() -> str:
    """Table k: candidates with scores, distance and whether they are in the hotel's city; needs hotel and candidate."""
    return f"""named AS (SELECT h.id AS hotel_id, h.city_id, h.city_name, c.* EXCLUDE (hotel_id), {norm("trim(regexp_replace(h.name, '\\s*\\([^)]*\\)', '', 'g'))")} AS n1, {norm('cand_name')} AS n2, {KM} AS distance, h.lat, coalesce(h.city_id = c.cand_city, false) AS same_city
  FROM hotel h JOIN candidate c ON c.hotel_id = h.id), {similarities('named', 'n1', 'n2', 'sim')},
k AS (SELECT n.*, s.strict, greatest(s.strict, s.both_ways) AS score FROM named n JOIN sim s ON s.a = n1 AND s.b = n2)"""


def _marks(n: str) -> str:
    return f"list_sort(list_distinct(list_concat(regexp_extract_all({n}, '[0-9]+'), list_filter(string_split({n}, ' '), lambda t: list_contains({words(V.COMPASS)}, t)))))"


def same_listings(drop: str) -> str:
    """Table l: candidates of k with ``listed``, whether they are the same listing when the phrase ``drop`` is left out."""
    rid = lambda n: f"trim(regexp_replace(replace(' ' || replace({n}, ' ', '  ') || ' ', CASE WHEN coalesce({drop}, '') = '' THEN chr(10) ELSE ' ' || replace({drop}, ' ', '  ') || ' ' END, ' '), ' +', ' ', 'g'))"
    return f"""shorn AS (SELECT *, {rid('n1')} AS d1, {rid('n2')} AS d2 FROM k), {similarities('shorn', 'd1', 'd2', 'lsim')},
l AS (SELECT w.*, s.strict >= {V.SAME_LISTING} AND {_marks('d1')} = {_marks('d2')} AS listed FROM shorn w JOIN lsim s ON s.a = d1 AND s.b = d2)"""


def matches() -> str:
    """Table r: one row per hotel with its match or the reason why there is none; needs hotel and candidate."""
    band = f"CASE WHEN distance <= {V.NEAR_KM} AND score >= {V.NAME_FLOOR} THEN 'high' WHEN same_city AND strict >= {V.NAME_STRICT} THEN 'medium' WHEN distance <= {V.FAR_KM} AND score >= {V.NAME_STRONG} THEN 'medium' WHEN distance IS NULL AND score >= {V.NAME_STRONG} THEN 'medium' END"
    return f"""{candidates()}, {same_listings(norm('city_name'))},
cuts AS (SELECT hotel_id, min(variant) AS cut FROM l WHERE score >= {V.NAME_STRONG} AND (same_city OR city_id IS NULL) GROUP BY hotel_id),
asked AS (SELECT l.* FROM l LEFT JOIN cuts USING (hotel_id) WHERE cut IS NULL OR variant <= cut),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id, cand_id ORDER BY variant) AS v FROM asked) WHERE v = 1),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY same_city DESC, score DESC, cand_id) AS nth FROM one WHERE score >= {V.NAME_FLOOR}) WHERE nth <= {V.CANDIDATES_B}),
seen AS (SELECT *, NOT is_private OR listed AS counts, coalesce(distance, 'inf'::DOUBLE) AS far, {band} AS confidence FROM top),
hit AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY far, -score, nth) AS r FROM seen WHERE counts AND confidence IS NOT NULL) WHERE r = 1),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY far, nth) AS r FROM seen WHERE counts AND confidence IS NULL) WHERE r = 1),
private AS (SELECT hotel_id, arg_min(cand_name, nth) AS cand_name FROM seen WHERE NOT counts GROUP BY hotel_id),
r AS (SELECT h.id AS hotel_id, hit.cand_id, round_even(hit.score, 1) AS name_score, round_even(hit.distance, 3) AS distance_km, hit.confidence,
  CASE WHEN hit.cand_id IS NOT NULL THEN NULL WHEN h.id NOT IN (SELECT hotel_id FROM one) THEN 'no suggestion' ELSE coalesce(
    'rejected ' || near.cand_name || ' name=' || round_even(near.score, 0)::INT || '% strict=' || round_even(near.strict, 0)::INT || '% dist=' || coalesce(round_even(near.distance, 2)::VARCHAR || 'km', '?') || ' same_city=' || near.same_city::VARCHAR,
    'rejected ' || private.cand_name || ': private listing', 'no candidate above name threshold') END AS reason
  FROM hotel h LEFT JOIN hit ON hit.hotel_id = h.id LEFT JOIN near ON near.hotel_id = h.id LEFT JOIN private ON private.hotel_id = h.id)"""


def resolutions() -> str:
    """Table o: like r of ``matches``, with failed searches (failure: hotel_id, seq, error) and candidates that have ``got``."""
    told = matches().split(", r AS (", 1)[0].replace("r AS (SELECT h.id", "@").rsplit("\nprivate AS", 1)[0].replace("NOT is_private OR listed AS counts", "got = 'ok' AND (NOT is_private OR listed) AS counts")
    return told + f"""
refused AS (SELECT hotel_id, arg_min(CASE got WHEN 'error' THEN 'fetch failed' WHEN 'empty' THEN 'property returned no data' ELSE 'rejected ' || cand_name || ': private listing' END, nth) AS refused FROM seen WHERE NOT counts GROUP BY hotel_id),
tried AS (SELECT hotel_id, count(*) AS considered, count(*) FILTER (got = 'error') AS failed FROM seen GROUP BY hotel_id),
err AS (SELECT hotel_id, arg_min(error, seq) AS error FROM failure GROUP BY hotel_id),
x AS (SELECT h.id AS hotel_id, hit.cand_id, hit.confidence, h.id IN (SELECT hotel_id FROM one) AS offered, refused, considered, failed, error,
  'rejected ' || near.cand_name || ' name=' || round_even(near.score, 0)::INT || '% strict=' || round_even(near.strict, 0)::INT || '% dist=' || coalesce(round_even(near.distance, 2)::VARCHAR || 'km', '?') || ' same_city=' || near.same_city::VARCHAR AS close
  FROM hotel h LEFT JOIN hit ON hit.hotel_id = h.id LEFT JOIN near ON near.hotel_id = h.id LEFT JOIN refused ON refused.hotel_id = h.id LEFT JOIN tried ON tried.hotel_id = h.id LEFT JOIN err ON err.hotel_id = h.id),
o AS (SELECT hotel_id, cand_id, confidence,
  CASE WHEN cand_id IS NOT NULL THEN NULL WHEN NOT offered THEN coalesce('search failed: ' || error, 'no suggestion') WHEN failed >= considered THEN 'every candidate fetch failed (' || failed || '): ' || coalesce(close, refused)
    WHEN error IS NOT NULL AND considered IS NULL THEN 'search partly failed (' || error || ') and no candidate cleared the name floor' ELSE coalesce(close, refused, 'no candidate above name threshold') END AS reason,
  cand_id IS NULL AND (coalesce(failed >= considered, false) OR (error IS NOT NULL AND considered IS NULL)) AS unreachable FROM x)"""
