"""SQL that gives the rows of the operators that SQL can express, on the same tables."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text expression: the polynomial's remainder, bit by bit."""
    steps = "list_reduce(range(8), lambda s, i: xor(s >> 1, 3988292384 * (s & 1)), xor(a, b))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda a, b: {steps}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"]
    return "sha256(" + " || ".join(_field(f) for f in fields) + ")"


def _tree(name: str, leaves: str) -> str:
    """Recursive table of all nodes (tree, lvl, place, digest, n) over (tree, place, digest); n is the number of nodes of its level."""
    return f"""{name} AS (
    SELECT tree, 0 AS lvl, place, digest, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
    UNION ALL
    SELECT tree, lvl + 1, place, digest, count(*) OVER (PARTITION BY tree) FROM (
      SELECT tree, lvl, place // 2 AS place, sha256(string_agg(digest, '' ORDER BY place)) AS digest
      FROM {name} WHERE n > 1 GROUP BY tree, lvl, place // 2)
  )"""


def _levels(name: str, leaves: str, nodes: str) -> str:
    """Per leaf its levels as texts ``left.right``, from its own to the top."""
    return f"""{name} AS (
    SELECT l.tree, l.place, list(CASE WHEN (l.place >> k.lvl) % 2 = 1 THEN coalesce(s.digest, '') || '.' ELSE '.' || coalesce(s.digest, '') END ORDER BY k.lvl) AS levels
    FROM {leaves} l JOIN (SELECT DISTINCT tree, lvl FROM {nodes} WHERE n > 1) k ON l.tree IS NOT DISTINCT FROM k.tree
    LEFT JOIN {nodes} s ON s.tree IS NOT DISTINCT FROM l.tree AND s.lvl = k.lvl AND s.place = xor(l.place >> k.lvl, 1)
    GROUP BY l.tree, l.place)"""


OP13 = f"""
WITH RECURSIVE rows_ AS (
    SELECT doc_id, lang AS tree, {_leaf('n_chars')} AS digest,
      CASE WHEN {crc32('doc_id::VARCHAR')} % 7 = 0 THEN {_leaf('n_chars + 1')} END AS tampered
    FROM documents),
  leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place FROM rows_),
  {_tree('nodes', 'leaves')},
  {_levels('paths', 'leaves', 'nodes')},
  subroots AS (SELECT tree AS lang, '' AS tree, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place FROM nodes WHERE n = 1),
  {_tree('tops', 'subroots')},
  {_levels('crowns', 'subroots', 'tops')},
  whole AS (
    SELECT l.doc_id, l.digest AS leaf, coalesce(l.tampered, l.digest) AS shown, u.digest AS subroot, r.digest AS root,
      list_concat(coalesce(p.levels, []), coalesce(c.levels, [])) AS proof
    FROM leaves l LEFT JOIN paths p ON p.tree IS NOT DISTINCT FROM l.tree AND p.place = l.place
    JOIN subroots u ON u.lang IS NOT DISTINCT FROM l.tree LEFT JOIN crowns c ON c.place = u.place
    CROSS JOIN (SELECT digest FROM tops WHERE n = 1) r),
  told AS (
    SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(proof, ''), '.', '')) AS proof_sha256,
      list_reduce(proof, lambda d, s: sha256(split_part(s, '.', 1) || d || split_part(s, '.', 2)), shown) AS folded_root
    FROM whole)
SELECT *, folded_root = root AS verified FROM told
"""

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
  i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
  runs AS (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0),
  phrases AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS phrase FROM runs),
  lengths AS (SELECT DISTINCT k FROM phrases),
  grams AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, lengths),
  hits AS (SELECT g.r, g.s, g.k, p.item_id FROM grams g JOIN phrases p ON p.k = g.k AND p.phrase = array_to_string(g.w[g.s:g.s + g.k - 1], ' ')),
  spots AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hits) GROUP BY r),
  named AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (r) LEFT JOIN named USING (r)
"""

OP11 = f"""
WITH turns AS (
    SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS t
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
  based AS (SELECT c.conv_id, c.t, b.t AS b, ({crc32('c.conv_id::VARCHAR')} % 9)::BIGINT AS h FROM turns c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 5),
  rebuilt AS (SELECT conv_id, list_concat(coalesce(b[1:h], []), t[h + 1:]) AS t FROM based),
  keyed AS (SELECT conv_id, len(t) AS n, list_transform(t, lambda x: md5(strlen(x.role) || ':' || x.role || x.text)) AS d, list_transform(t, lambda x: strlen(x.text)) AS z FROM rebuilt),
  heads AS (SELECT conv_id, n, d, z, unnest(range(0, n + 1)) AS depth FROM keyed),
  named AS (SELECT conv_id, n, depth, sha256(array_to_string(d[1:depth], '')) AS node, CASE WHEN depth > 0 THEN sha256(array_to_string(d[1:depth - 1], '')) END AS parent, coalesce(z[depth], 0) AS size FROM heads),
  nodes AS (
    SELECT depth, node, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
      sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256 FROM named GROUP BY depth, node),
  kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
  sized AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (depth, node)),
  below AS (
    SELECT a.depth, a.node, b.depth AS d, b.node AS x FROM named a JOIN named b ON a.conv_id = b.conv_id AND a.depth <= b.depth GROUP BY ALL),
  sums AS (
    SELECT b.depth, b.node, count(*) FILTER (WHERE s.n_children = 0) AS n_leaves, sum((s.n_convs - 1) * s.size) AS saved
    FROM below b JOIN sized s ON s.depth = b.d AND s.node = b.x GROUP BY b.depth, b.node)
SELECT s.conv_id, s.depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children, n_leaves, saved::BIGINT AS saved_tokens, s.ends_sha256
FROM sized s JOIN sums USING (depth, node) LEFT JOIN sized p ON p.depth = s.depth - 1 AND p.node = s.parent
"""
