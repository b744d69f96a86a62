"""SQL of the queries of this package that SQL can express, over the same tables registered as views."""

from __future__ import annotations

from tapeglass.llm import line_templates, merkle_log, sharding, url_templates
from tapeglass.llm.queries import CONTROL, LEAF_COLUMNS, NEAREST, QUERY_EVERY, RULES, SHARDS


#: CRC-32 by byte, and of a text, unsigned.
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"""


def _sharding() -> str:
    tree = sharding.uniform_tree(SHARDS)

    def nodes(shards: list[sharding.Shard]) -> str:
        weights: dict[tuple[str, str], float] = {}
        for shard in shards:
            for edge in zip(("", *shard.path), shard.path):
                weights[edge] = weights.get(edge, 0.0) + shard.weight
        return ", ".join(f"('{parent}', '{path}', CAST({weight} AS DOUBLE))" for (parent, path), weight in weights.items())

    draw = "-ln((CAST('0x' || substr(md5(key || '|' || path), 1, 13) AS BIGINT) + 0.5) / pow(2, 52)) / weight"

    def descent(name: str) -> str:
        steps = [f"{name}0 AS (SELECT DISTINCT key, '' AS node FROM sized)"]
        steps += [
            f"{name}{i + 1} AS (SELECT key, arg_min(path, {draw}) AS node FROM {name}{i}"
            f" JOIN {name}_tree ON parent = node GROUP BY key)"
            for i in range(3)
        ]
        return ", ".join(steps)

    return f"""
WITH {CRC_TABLE},
read AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key, encode(coalesce(text, '')) AS raw FROM documents),
sized AS (SELECT doc_id, key, CAST(octet_length(raw) + 1 AS BIGINT) AS size,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(regexp_extract_all(hex(raw), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM read, crc_table),
now_tree(parent, path, weight) AS (VALUES {nodes(tree)}),
later_tree(parent, path, weight) AS (VALUES {nodes(sharding.grown(tree))}),
{descent("now")}, {descent("later")},
placed AS (SELECT doc_id, key, size, text_crc32, 'key' AS law, split_part(n.node, '/', 1) AS region,
  split_part(n.node, '/', 1) || '/' || split_part(n.node, '/', 2) AS rack,
  CAST(split_part(n.node, '/', 3) AS INTEGER) AS shard, CAST(split_part(l.node, '/', 3) AS INTEGER) AS grown_shard
  FROM sized JOIN now3 n USING (key) JOIN later3 l USING (key))
SELECT doc_id, size, text_crc32, law, shard, grown_shard, region, rack,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY CAST('0x' || substr(md5(key), 1, 3) AS INTEGER),
    doc_id, size, text_crc32) - 1 AS BIGINT) AS slot
FROM placed"""


CHAT = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL}'),
written AS (SELECT *, regexp_replace(regexp_replace(text, '(\\\\+)\\z', '\\1\\1'),
  '(\\\\*)(###|</turn>)', '\\1\\1\\\\\\2', 'g') AS escaped FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ' || role || ': ' || escaped || '</turn>') + 1) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id"""


def _urls() -> str:
    rules = sorted(RULES, key=lambda r: (-len(r.name), r.name))

    def rule(shown) -> str:
        cases = " ".join(
            f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN {shown(r)}"
            for r in rules
        )
        return f"CASE {cases} END"

    depth = url_templates.MAX_DEPTH
    names = [f"s{d}" for d in range(1, depth + 1)]
    cut = [f"segments[{d}] AS s{d}" for d in range(1, depth)]
    cut.append(f"CASE WHEN len(segments) >= {depth} THEN array_to_string(segments[{depth}:], '/') END AS s{depth}")
    levels = []
    for i, name in enumerate(names):
        levels.append(f"""
b{i} AS (SELECT host, template, {name} AS s, CAST(sum(labelled) AS DOUBLE) AS l, CAST(sum(bad) AS DOUBLE) AS b
  FROM l{i} GROUP BY 1, 2, 3),
c{i} AS (SELECT *, sum(l) OVER w AS pl, sum(b) OVER w AS pb FROM b{i} WINDOW w AS (PARTITION BY host, template)),
n{i} AS (SELECT host, template, s, sqrt((pb / nullif(pl, 0)) * (1 - pb / nullif(pl, 0))
    * (CAST(1 AS DOUBLE) / nullif(l, 0) + CAST(1 AS DOUBLE) / nullif(pl - l, 0))) AS spread,
  abs(b / nullif(l, 0) - (pb - b) / nullif(pl - l, 0)) AS apart FROM c{i} WHERE s IS NOT NULL),
l{i + 1} AS (SELECT l.host, {", ".join(names)}, labelled, bad, CASE WHEN s IS NULL THEN l.template ELSE l.template || '/' ||
    CASE WHEN spread > 0 AND apart >= {url_templates.SIGNIFICANT} * spread THEN s ELSE '*' END END AS template
  FROM l{i} l LEFT JOIN n{i} n ON l.host = n.host AND l.template = n.template AND l.{name} = n.s)""")
    same = " AND ".join(f"c.{n} IS NOT DISTINCT FROM t.{n}" for n in names)
    smoothing = url_templates.SMOOTHING
    return f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
read AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
    '{url_templates.UPPER}', '{url_templates.LOWER}'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
ruled AS (SELECT *, {rule(lambda r: f"'{r.name}'")} AS rule, {rule(lambda r: f"'{r.verdict}'")} AS ruling,
  list_filter(string_split(regexp_replace(path, '[0-9]+', '<n>', 'g'), '/'), lambda s: s <> '') AS segments FROM read),
cut AS (SELECT page_id, host, path, rule, ruling, {", ".join(cut)},
  CASE WHEN ruling IS NOT NULL THEN CAST(ruling = 'block' AS BIGINT)
    WHEN list_has_any(string_split_regex(host, '[.-]'), [{", ".join(f"'{w}'" for w in url_templates.JUNK_WORDS)}]) THEN 1 END AS bad
  FROM ruled),
l0 AS (SELECT host, {", ".join(names)}, count(bad) AS labelled, coalesce(sum(bad), 0) AS bad, host AS template
  FROM cut GROUP BY ALL),
{",".join(levels)},
own AS (SELECT host, template, substr(template, length(host) + 1) AS shape, CAST(sum(labelled) AS DOUBLE) AS l,
  CAST(sum(bad) AS DOUBLE) AS b FROM l{depth} GROUP BY 1, 2, 3),
shapes AS (SELECT shape, sum(l) AS sl, sum(b) AS sb FROM own GROUP BY 1),
overall AS (SELECT (sum(sb) + 1) / (sum(sl) + 2) AS everywhere FROM shapes),
priors AS (SELECT shape, (sb + {smoothing} * everywhere) / (sl + {smoothing}) AS prior FROM shapes, overall),
judged AS (SELECT template, CAST(l AS BIGINT) AS labelled_pages,
  round((b + {smoothing} * prior) / (l + {smoothing}), 9) AS bad_share FROM own JOIN priors USING (shape))
SELECT page_id, c.host, path, rule, t.template, labelled_pages, bad_share,
  coalesce(ruling, CASE WHEN bad_share >= {url_templates.REJECT_FROM} THEN 'block' ELSE 'allow' END) AS verdict
FROM cut c JOIN l{depth} t ON c.host = t.host AND {same} JOIN judged j ON j.template = t.template"""


def _line_dedup() -> str:
    rules = line_templates
    leaf = f"n || ' ' || array_to_string(t[1:{rules.LEADING}], ' ') || ' '"
    return f"""
WITH cut AS (SELECT doc_id, md5(text) AS document, string_split(text, chr(10)) AS lines FROM documents),
numbered AS (SELECT doc_id, document, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM cut),
plained AS (SELECT *, trim(regexp_replace(regexp_replace(line, '[0-9]+', '<*>', 'g'), '[ \t\r]+', ' ', 'g'), ' ') AS plain
  FROM numbered),
every AS (SELECT *, string_split(plain, ' ') AS t FROM plained),
sized AS (SELECT *, len(t) AS n, len(t) // 2 AS half FROM every
  WHERE len(t) >= {rules.MIN_TOKENS} OR length(plain) >= {rules.MIN_CHARS}),
tokens AS (SELECT plain, document, n, t[1:{rules.LEADING}] AS front, unnest(range(1, n + 1)) AS place, unnest(t) AS token
  FROM sized WHERE n BETWEEN {rules.MIN_TOKENS} AND {rules.PLACED_TOKENS}),
constant AS (SELECT n, front, place, token FROM tokens GROUP BY ALL
  HAVING count(*) >= {rules.MIN_DOCS} AND count(DISTINCT document) > 1),
held AS (SELECT DISTINCT plain, n, place, token FROM tokens JOIN constant USING (n, front, place, token)),
placed AS (SELECT plain, 'placed ' || n || ' ' || string_agg(place || ' ' || token, ' ' ORDER BY place) AS template FROM held
  GROUP BY plain, n HAVING count(*) < n AND count(*) >= greatest({rules.MIN_TOKENS}, {rules.CONSTANT_SHARE} * n)),
under AS (SELECT doc_id, document, i, 'whole ' || plain AS template, n >= {rules.LONG_TOKENS} AS long FROM sized
  UNION ALL SELECT doc_id, document, i, 'first ' || {leaf} || array_to_string(t[1:half], ' '), false FROM sized
    WHERE n > {rules.PLACED_TOKENS}
  UNION ALL SELECT doc_id, document, i, 'second ' || {leaf} || array_to_string(t[half + 1:], ' '), false FROM sized
    WHERE n > {rules.PLACED_TOKENS}
  UNION ALL SELECT doc_id, document, i, template, false FROM sized JOIN placed USING (plain)),
recurring AS (SELECT template, min(doc_id) AS first FROM under GROUP BY 1
  HAVING count(DISTINCT document) >= {rules.MIN_DOCS} OR (bool_or(long) AND count(DISTINCT document) >= {rules.LONG_DOCS})),
dropped AS (SELECT DISTINCT doc_id, i, true AS gone FROM under JOIN recurring USING (template) WHERE doc_id <> first),
cleaned AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (gone IS NULL), '') AS text,
  count(gone) AS dropped_lines FROM numbered LEFT JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, cleaned.text, coalesce(dropped_lines, 0) AS dropped_lines FROM documents LEFT JOIN cleaned USING (doc_id)"""


#: Levels that the SQL below has above the leaves of a tree: enough for 8^8 documents.
LEVELS = 8


def _merkle() -> str:
    def leaf(text: str) -> str:
        values = [text if c == "text" else f"CAST({c} AS VARCHAR)" for c in LEAF_COLUMNS]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    def tree(name: str, leaves: str) -> list[str]:
        """{name}_paths: (tree, i, left0, right0 .., h0 ..) of the leaves (tree, i, digest)."""
        steps = [f"{name}0 AS (SELECT tree, i, digest, count(*) OVER (PARTITION BY tree) AS n FROM {leaves})"]
        for level in range(LEVELS):
            runs = f"tree, i // {merkle_log.ARITY}"
            steps.append(f"""{name}_b{level} AS (SELECT *, coalesce(string_agg(digest, '') OVER (PARTITION BY {runs} ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS bef, coalesce(string_agg(digest, '') OVER (PARTITION BY {runs}
    ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS aft FROM {name}{level})""")
            steps.append(f"""{name}{level + 1} AS (SELECT tree, i // {merkle_log.ARITY} AS i,
    CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest,
    CAST(ceil(any_value(n) / {merkle_log.ARITY}) AS BIGINT) AS n FROM {name}{level} GROUP BY {runs})""")
        joins = " ".join(
            f"JOIN {name}_b{level} b{level} ON b{level}.tree = l.tree AND b{level}.i = l.i // {merkle_log.ARITY**level}" for level in range(LEVELS)
        )
        sides = ", ".join(f"CASE WHEN b{level}.n > 1 THEN [b{level}.bef, b{level}.aft] END" for level in range(LEVELS))
        steps.append(f"""{name}_paths AS (SELECT l.tree, l.i, list_filter([{sides}], lambda s: s IS NOT NULL) AS path,
    t.digest AS top FROM {name}0 l {joins} JOIN {name}{LEVELS} t ON t.tree = l.tree)""")
        return steps

    lowered = f"translate(text, '{url_templates.UPPER}', '{url_templates.LOWER}')"
    fold = "list_reduce(list_prepend([{start}, ''], path), lambda own, s: [sha256(s[1] || own[1] || s[2]), ''])[1]"
    return f"""
WITH {CRC_TABLE},
read AS (SELECT doc_id, coalesce('+' || lang, '') AS tree, {leaf("text")} AS leaf,
  CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {leaf(lowered)} END AS tampered FROM documents, crc_table),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM read),
leaves AS (SELECT tree, i, leaf AS digest FROM placed),
{",".join(tree("d", "leaves"))},
subroots AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, digest, tree AS lang FROM d{LEVELS}),
{",".join(tree("u", "subroots"))},
proved AS (SELECT doc_id, leaf, tampered, s.digest AS subroot, u.top AS root, list_concat(d.path, u.path) AS path
  FROM placed p JOIN d_paths d USING (tree, i) JOIN subroots s ON s.lang = p.tree JOIN u_paths u ON u.i = s.i),
folded AS (SELECT *, {fold.format(start="coalesce(tampered, leaf)")} AS folded_root,
  sha256(array_to_string(list_transform(path, lambda s: s[1] || s[2]), '')) AS proof_sha256 FROM proved)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded"""


REPAIR = f"""
WITH RECURSIVE {CRC_TABLE},
read AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault
  FROM conversations, crc_table),
faulty AS (SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
  CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM read WHERE fault <> 0),
placed AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
  left(role, 1) AS initial, lag(left(role, 1)) OVER w AS before, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut
  FROM faulty WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy)),
judged AS (SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated'
  ELSE 'sound' END AS kind FROM placed),
counted AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'duplicate') AS duplicate, count(*) FILTER (kind = 'truncated') AS truncated,
  count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
inserts(a, b, added, cost, audit) AS (VALUES ('', '', '', 0, ''), ('s', 's', '', 0, ''), ('u', 'u', '', 0, ''), ('a', 'a', '', 0, ''),
  ('', 'u', chr(10) || 'user:', 5, 'I'), ('s', 'u', chr(10) || 'user:', 5, 'I'), ('a', 'u', chr(10) || 'user:', 5, 'I'),
  ('u', 'a', chr(10) || 'assistant:', 5, 'I'), ('', 'a', chr(10) || 'user:' || chr(10) || 'assistant:', 10, 'II'),
  ('s', 'a', chr(10) || 'user:' || chr(10) || 'assistant:', 10, 'II')),
moves(b, c, name) AS (VALUES ('', 'u', 'user'), ('s', 'u', 'user'), ('a', 'u', 'user'), ('u', 'a', 'assistant')),
options AS (
  SELECT conv_id, i, b, b AS c, 2 AS cost, 'D' AS edit, '' AS said FROM judged, (SELECT DISTINCT b FROM inserts)
  UNION ALL SELECT conv_id, i, b, c, CASE kind WHEN 'truncated' THEN 6 ELSE 1 END, 'R', chr(10) || name || ':' || text
  FROM judged, moves WHERE kind IN ('truncated', 'sound')
  UNION ALL SELECT conv_id, i, b, c, CASE kind WHEN 'truncated' THEN 5 ELSE 0 END, 'K', chr(10) || role || ':' || text
  FROM judged JOIN (SELECT b, c FROM moves UNION ALL SELECT '', 's') ON initial = c WHERE kind IN ('truncated', 'sound')),
states(conv_id, i, state, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '', {{'cost': 0, 'audit': '', 'said': ''}} FROM counted
  UNION ALL
  SELECT s.conv_id, s.i + 1, o.c, min({{'cost': s.best.cost + n.cost + o.cost, 'audit': s.best.audit || n.audit || o.edit,
    'said': s.best.said || n.added || o.said}})
  FROM states s JOIN inserts n ON n.a = s.state JOIN options o ON o.conv_id IS NOT DISTINCT FROM s.conv_id AND o.i = s.i + 1 AND o.b = n.b
  GROUP BY ALL),
ended AS (SELECT c.conv_id, min({{'cost': s.best.cost + n.cost, 'audit': s.best.audit || n.audit, 'said': s.best.said || n.added}}) AS best
  FROM counted c JOIN states s ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.i JOIN inserts n ON n.a = s.state
  WHERE n.b IN ('', 'a') GROUP BY c.conv_id)
SELECT k.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.said, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN counted c ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON k.conv_id IS NOT DISTINCT FROM e.conv_id"""


NEAREST_VECTORS = f"""
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {NEAREST}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_merkle": _merkle(),
        "op12_turn_repair": REPAIR,
        "op13_nearest": NEAREST_VECTORS,
        "op1_sharding": _sharding(),
        "op6_chat": CHAT,
        "op7_urls": _urls(),
        "op10_line_dedup": _line_dedup(),
    }
