"""SQL of the longer queries, for DuckDB over the same tables."""

from __future__ import annotations

import string


def crc32(text: str) -> str:
    """Unsigned crc32 of a text of ASCII characters, bit by bit."""
    bits = "list_reduce(list_prepend(xor({0}, {1}), [-1, -1, -1, -1, -1, -1, -1, -1]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda a, b: {bits.format('a', 'b')}), 4294967295)"


def _record(*fields: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in fields) + ")"


def _tree_levels(name: str, levels: int) -> str:
    """CTEs from ``name``_0 (tree, i, h, n): nodes of each level, and the siblings of each node."""
    parts = []
    for k in range(levels):
        parts.append(
            f"""{name}_{k + 1} AS (
            SELECT tree, i // 8 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, (any_value(n) + 7) // 8 AS n
            FROM {name}_{k} GROUP BY tree, i // 8),
        {name}_beside_{k} AS (
            SELECT a.tree || '/' || a.i AS node, any_value(a.n) AS n,
                   coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
            FROM {name}_{k} a JOIN {name}_{k} b ON a.tree || '/' || (a.i // 8) = b.tree || '/' || (b.i // 8) GROUP BY a.tree, a.i)"""
        )
    return ",\n        ".join(parts)


def _climb(name: str, rows: str, levels: int) -> tuple[str, str]:
    """Joins of a row (tree, i) to its siblings level by level, and the text of its proof."""
    joins = " ".join(f"JOIN {name}_beside_{k} {name}{k} ON {name}{k}.node = {rows}.tree || '/' || ({rows}.i // {8**k})" for k in range(levels))
    return joins, " || ".join(f"{name}{k}.l || {name}{k}.r" for k in range(levels))


_LEVELS, _TOP_LEVELS = 7, 2


def _merkle() -> str:
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    fields = ("doc_id", "source", "lang", "n_chars")
    low_joins, low_proof = _climb("low", "leaves", _LEVELS)
    top_joins, top_proof = _climb("top", "places", _TOP_LEVELS)
    steps = []
    for name, levels in (("low", _LEVELS), ("top", _TOP_LEVELS)):
        for k in range(levels):
            before = f"folded_{len(steps)}"
            node = f"CASE WHEN {name}{k}_n > 1 THEN sha256({name}{k}_l || f || {name}{k}_r) ELSE f END"
            steps.append(f"folded_{len(steps) + 1} AS (SELECT * REPLACE ({node} AS f) FROM {before})")
    sides = ", ".join(f"{name}{k}.n AS {name}{k}_n, {name}{k}.l AS {name}{k}_l, {name}{k}.r AS {name}{k}_r" for name, levels in (("low", _LEVELS), ("top", _TOP_LEVELS)) for k in range(levels))
    return f"""
        WITH digests AS (
            SELECT doc_id, coalesce('=' || lang, '') AS tree, {_record(*fields, 'text')} AS leaf,
                   CASE WHEN doc_id IS NOT NULL AND {crc32("coalesce(doc_id, 0)::VARCHAR")} % 3 = 0 THEN {_record(*fields, lowered)} END AS tampered
            FROM documents),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM digests),
        low_0 AS (SELECT tree, i, leaf AS h, n FROM leaves),
        {_tree_levels("low", _LEVELS)},
        places AS (SELECT tree AS name, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, h FROM low_{_LEVELS}),
        top_0 AS (SELECT tree, i, h, n FROM places),
        {_tree_levels("top", _TOP_LEVELS)},
        folded_0 AS (
            SELECT leaves.doc_id, leaves.leaf, places.h AS subroot, top_{_TOP_LEVELS}.h AS root, sha256({low_proof} || {top_proof}) AS proof_sha256,
                   coalesce(leaves.tampered, leaves.leaf) AS f, {sides}
            FROM leaves {low_joins} JOIN places ON places.name = leaves.tree {top_joins} CROSS JOIN top_{_TOP_LEVELS}),
        {", ".join(steps)}
        SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM folded_{len(steps)}"""


MERKLE = _merkle()

TRIE = f"""
    WITH placed AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) - 1 AS place, id, words,
               {crc32("conv_id::VARCHAR")} % 4 AS h
        FROM (
            SELECT conv_id, turn, left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS id,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
            FROM conversations WHERE conv_id IS NOT NULL)),
    convs AS (SELECT DISTINCT conv_id, h FROM placed),
    rebuilt AS (
        SELECT c.conv_id, p.place, p.id, p.words FROM convs c JOIN placed p ON p.conv_id = c.conv_id - c.conv_id % 20 AND p.place < c.h
        UNION ALL SELECT conv_id, place, id, words FROM placed WHERE place >= h),
    prefixes AS (
        SELECT conv_id, row_number() OVER w AS depth, string_agg(id, '') OVER w AS path, words
        FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
        UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
    nodes AS (
        SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
               left(path, greatest(length(path) - 32, 0)) AS parent
        FROM prefixes GROUP BY path),
    children AS (SELECT parent AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
    own AS (
        SELECT nodes.*, coalesce(children.n, 0) AS n_children, (n_convs - 1) * words AS saved
        FROM nodes LEFT JOIN children ON children.path = nodes.path),
    subtrees AS (
        SELECT left(path, 32 * up) AS path, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
        FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM own) GROUP BY 1),
    ends AS (
        SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
        FROM (SELECT conv_id, max(path) AS path FROM prefixes GROUP BY conv_id) GROUP BY path)
    SELECT own.conv_id, own.depth, CASE WHEN own.depth > 0 THEN up.conv_id END AS parent_conv_id, own.n_convs, own.n_children,
           subtrees.n_leaves::BIGINT AS n_leaves, subtrees.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
    FROM own JOIN subtrees ON subtrees.path = own.path JOIN nodes up ON up.path = own.parent LEFT JOIN ends ON ends.path = own.path"""
