"""DuckDB SQL of the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op2_mixing"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || CASE WHEN text IS NULL THEN '-' ELSE '=' || md5(text) END) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ([3.0, 1.0, 2.0])[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE AS w
  FROM d GROUP BY source
), r AS (
  SELECT source, source_size, w, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total,
         row_number() OVER (ORDER BY 2.0 * source_size / w, source IS NULL, source) AS i
  FROM s
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r
), t AS (
  SELECT source, source_size, CASE WHEN level >= cap / w THEN cap ELSE w * max(CASE WHEN level < cap / w THEN level END) OVER () END AS target FROM l
), c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CASE WHEN source_size = 0 THEN 0 ELSE
         (size * (floor(target)::BIGINT // source_size) + least(greatest(floor(target)::BIGINT % source_size - before, 0), size)) END::BIGINT AS taken
FROM c
"""

ORACLES["op4_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""

ORACLES["op9_chat_format"] = r"""
WITH k AS (SELECT *, CASE WHEN conv_id IS NULL THEN 'n' || row_number() OVER () ELSE 'c' || conv_id END AS chat FROM conversations),
t AS (
  SELECT chat, conv_id, role, text, row_number() OVER (PARTITION BY chat ORDER BY turn NULLS FIRST, role NULLS FIRST, md5(text) NULLS FIRST) AS place,
         count(*) OVER (PARTITION BY chat) AS n_turns
  FROM k
), p AS (
  SELECT chat, conv_id, place, n_turns, md5(string_agg(md5(CASE WHEN role IS NULL THEN '0' ELSE '1' || role END) || md5(CASE WHEN text IS NULL THEN '0' ELSE '1' || text END), '') OVER (PARTITION BY chat ORDER BY place)) AS h
  FROM t
), w AS (
  SELECT h, place AS n_turns, first(chat ORDER BY conv_id NULLS LAST, chat) AS chat, min(conv_id) AS conv_id, count(*) AS copies FROM p WHERE place = n_turns GROUP BY h, place
), m AS (
  SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.h = w.h AND p.place = w.n_turns AND p.place < p.n_turns)
), r AS (
  SELECT m.chat, m.conv_id, m.copies, m.n_turns, string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), '' ORDER BY place) AS rendered
  FROM m JOIN t ON t.chat = m.chat GROUP BY ALL
)
SELECT conv_id, copies::BIGINT AS copies, n_turns::BIGINT AS n_turns, length(rendered)::BIGINT AS n_chars, rendered FROM r
"""

ORACLES["op11_warc"] = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""


def _piece(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"


def _merkle_levels(below: str, name: str, levels: int) -> str:
    """CTEs name1 to name{levels}: a level each over below(tree, pos, digest), where a tree with one node left stays as it is.

    Each gives, for every node of the level below, the text before and after it in its run, and the run's digest.
    """
    out = ""
    for k in range(1, levels + 1):
        source = below if k == 1 else f"{name}{k - 1}n"
        out += f""",
{name}{k}r AS (
  SELECT tree, pos // 16 AS run, list(digest ORDER BY pos) AS members, any_value(n) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {source}) GROUP BY tree, pos // 16
), {name}{k}n AS (
  SELECT tree, run AS pos, CASE WHEN n = 1 THEN members[1] ELSE sha256(array_to_string(members, '')) END AS digest FROM {name}{k}r
)"""
    return out


def _merkle_steps(name: str, levels: int, first: str) -> tuple[str, list[str]]:
    """Joins of every level's run to a leaf at {first}.pos, and its (before, after) texts, null above the last level."""
    joins, steps = "", []
    for k in range(1, levels + 1):
        at = f"({first}.pos // {16 ** (k - 1)})"
        joins += f" JOIN {name}{k}r ON {name}{k}r.tree = {first}.tree AND {name}{k}r.run = {at} // 16"
        m = f"{name}{k}r.members"
        steps.append(f"CASE WHEN {name}{k}r.n > 1 THEN [array_to_string({m}[1 : {at} % 16], ''), array_to_string({m}[{at} % 16 + 2 :], '')] END")
    return joins, steps


def _merkle_sql(levels: int = 4, top_levels: int = 3) -> str:
    """For sources of up to 16^levels documents and up to 16^top_levels sources."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = lambda text: "sha256(" + " || ".join([*[_piece(c) for c in ("doc_id", "source", "lang", "n_chars")], _piece(text)]) + ")"
    low_joins, low_steps = _merkle_steps("s", levels, "leaves")
    top_joins, top_steps = _merkle_steps("t", top_levels, "tops")
    steps = low_steps + top_steps
    folds = "".join(
        f""",
f{k} AS (SELECT * EXCLUDE (folded), CASE WHEN w{k} IS NULL THEN folded ELSE sha256(w{k}[1] || folded || w{k}[2]) END AS folded FROM f{k - 1})"""
        for k in range(1, len(steps) + 1)
    )
    witness = ", ".join(f"{s} AS w{k + 1}" for k, s in enumerate(steps))
    proof = " || ".join(f"coalesce(w{k + 1}[1] || w{k + 1}[2], '')" for k in range(len(steps)))
    # crc32 of the decimal doc_id: bits of each byte by the reflected polynomial
    return f"""
WITH bytes AS (SELECT range AS b FROM range(256)),
table8 AS (
  SELECT b, list_reduce(list_prepend(b::BIGINT, range(8)::BIGINT[]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM bytes
), crc_table AS (SELECT list(v ORDER BY b) AS t8 FROM table8
), crcs AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, x: xor(c // 256, t8[xor(c % 256, x) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc_table
), leaves AS (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, {leaf("text")} AS digest,
         CASE WHEN crc % 5 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS found,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {leaf("text")}) - 1 AS pos
  FROM documents LEFT JOIN crcs USING (doc_id)
){_merkle_levels("leaves", "s", levels)},
tops AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, tree AS name, digest FROM s{levels}n){_merkle_levels("tops", "t", top_levels)},
f0 AS (
  SELECT doc_id, leaves.digest AS leaf, tops.digest AS subroot, (SELECT digest FROM t{top_levels}n) AS root, {witness}, found AS folded
  FROM leaves JOIN tops ON tops.name = leaves.tree{low_joins}{top_joins}
){folds}
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM f{len(steps)}
"""


ORACLES["op12_merkle_manifest"] = _merkle_sql()

ORACLES["op13_prefix_trie"] = r"""
WITH bytes AS (SELECT range AS b FROM range(256)),
table8 AS (
  SELECT b, list_reduce(list_prepend(b::BIGINT, range(8)::BIGINT[]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM bytes
), crc_table AS (SELECT list(v ORDER BY b) AS t8 FROM table8), ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, x: xor(c // 256, t8[xor(c % 256, x) + 1])), 4294967295) % 6 AS h
  FROM ids, crc_table
), placed AS (
  SELECT conv_id, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS t, length(coalesce(text, '')) AS width,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), told AS (
  SELECT c.conv_id, p.place AS spot, p.t, p.width FROM convs c JOIN placed p ON p.conv_id = c.base AND p.place <= c.h
  UNION ALL SELECT c.conv_id, p.place + 5, p.t, p.width FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.place > c.h
), deep AS (
  SELECT conv_id, width, row_number() OVER w AS depth, count(*) OVER (PARTITION BY conv_id) AS turns, string_agg(t, '') OVER w AS path FROM told WINDOW w AS (PARTITION BY conv_id ORDER BY spot)
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(width) AS width, string_agg(CASE WHEN depth = turns THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
  FROM deep GROUP BY path, depth
  UNION ALL
  SELECT '', 0, min(conv_id), count(*), 0, string_agg(CASE WHEN conv_id NOT IN (SELECT conv_id FROM deep) THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) FROM convs HAVING count(*) > 0
), children AS (
  SELECT n.path, count(c.path) AS n_children, min(p.conv_id) AS parent_conv_id FROM nodes n
  LEFT JOIN nodes c ON c.depth = n.depth + 1 AND c.path[: 32 * n.depth] = n.path LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[: 32 * (n.depth - 1)] GROUP BY n.path
), below AS (
  SELECT path[: 32 * d] AS path, sum((n_convs - 1) * width) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT n.*, c.n_children, unnest(range(0, n.depth + 1)) AS d FROM nodes n JOIN children c USING (path)) GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, c.parent_conv_id, n.n_convs::BIGINT AS n_convs, c.n_children::BIGINT AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN children c USING (path) JOIN below b USING (path)
"""
