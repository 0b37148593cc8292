"""SQL twins that are put together from parts."""

from __future__ import annotations

#: Levels of hashing that the SQL of the manifest spells out: up to 3^10 rows a source and 3^7 sources.
LEVELS, HIGH = 10, 7


def crc32(text: str) -> str:
    """Unsigned CRC-32 of ASCII text, bit by bit."""
    step = "CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END"
    byte = f"list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda r, i: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {byte}), 4294967295::BIGINT)"


def leaf(*fields: str) -> str:
    parts = [f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


def tree(name: str, start: str, levels: int) -> str:
    """``<name>0`` … with the nodes of every level out of ``start`` (``grp, pos, h``), and ``<name>_path`` with the siblings of each leaf."""
    steps = [f"{name}0 AS (SELECT grp, pos, h, count(*) OVER (PARTITION BY grp) AS n FROM {start})"]
    for i in range(levels):
        steps.append(
            f"{name}{i + 1} AS (SELECT grp, pos // 3 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h, "
            f"(any_value(n) + 2) // 3 AS n FROM {name}{i} GROUP BY grp, pos // 3)"
        )
    side = "coalesce(string_agg(m.h, '' ORDER BY m.pos) FILTER (m.pos {0} l.pos // {1}), '')"
    paths = [
        f"SELECT l.grp, l.pos, {i} AS level, {side.format('<', 3**i)} AS before, {side.format('>', 3**i)} AS behind FROM {name}0 l "
        f"JOIN {name}{i} m ON m.grp = l.grp AND m.pos // 3 = l.pos // {3 ** (i + 1)} AND m.n > 1 GROUP BY l.grp, l.pos"
        for i in range(levels)
    ]
    return ", ".join([*steps, f"{name}_path AS ({' UNION ALL '.join(paths)})"])


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
MANIFEST = f"""
    WITH d AS (
        SELECT *, coalesce('=' || source, '') AS grp, {leaf(*FIELDS)} AS h,
            CASE WHEN {crc32("coalesce(doc_id::VARCHAR, '')")} % 2 = 0 THEN {leaf(*FIELDS[:-1], "replace(text, chr(10), '')")} ELSE {leaf(*FIELDS)} END AS given
        FROM documents
    ), p AS (SELECT doc_id, grp, h, given, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM d),
    {tree("a", "p", LEVELS)},
    g AS (SELECT 0 AS grp, grp AS name, h, row_number() OVER (ORDER BY grp) - 1 AS pos FROM a{LEVELS}),
    {tree("b", "g", HIGH)},
    whole AS (
        SELECT grp, pos, level, before, behind FROM a_path
        UNION ALL SELECT p.grp, p.pos, {LEVELS} + level, before, behind FROM p JOIN g ON g.name = p.grp JOIN b_path ON b_path.pos = g.pos
    ), proof AS (
        SELECT grp, pos, list({{'before': before, 'behind': behind, 'h': ''}} ORDER BY level) AS l, string_agg(before || behind, '' ORDER BY level) AS s
        FROM whole GROUP BY grp, pos
    ), f AS (
        SELECT doc_id, p.h AS leaf, g.h AS subroot, (SELECT h FROM b{HIGH}) AS root, sha256(coalesce(s, '')) AS proof_sha256,
            (list_reduce(list_prepend({{'before': '', 'behind': '', 'h': given}}, coalesce(l, [])),
                lambda a, b: {{'before': '', 'behind': '', 'h': sha256(b.before || a.h || b.behind)}})).h AS folded_root
        FROM p JOIN g ON g.name = p.grp LEFT JOIN proof ON proof.grp = p.grp AND proof.pos = p.pos
    )
    SELECT *, folded_root = root AS verified FROM f
"""

TRIE = f"""
    WITH t AS (
        SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS p
        FROM conversations WHERE conv_id IS NOT NULL
    ), k AS (SELECT c, {crc32("c::VARCHAR")} % 6 AS h, c - c % 100 AS base FROM (SELECT DISTINCT c FROM t)),
    b AS (
        SELECT k.c, 0 AS part, p, r, x FROM k JOIN t ON t.c = k.base AND t.p < k.h
        UNION ALL SELECT k.c, 1, p, r, x FROM k JOIN t ON t.c = k.c AND t.p >= k.h
    ), s AS (SELECT c, r, x, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d FROM b),
    q AS (
        SELECT c, d, length(x) AS tokens, sha256(string_agg(sha256(r) || sha256(x), '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS node FROM s
        UNION ALL SELECT c, 0, 0, '' FROM k
    ), w AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS above, d = max(d) OVER (PARTITION BY c) AS last FROM q),
    n AS (
        SELECT node, d, min(c) AS c, any_value(above) AS above, any_value(tokens) AS tokens, count(*) AS n,
            sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends
        FROM w GROUP BY node, d
    ), kids AS (SELECT above AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY above),
    under AS (
        SELECT w.node, count(*) FILTER (kids.node IS NULL) AS n_leaves, sum((n.n - 1) * n.tokens) AS saved
        FROM n JOIN w ON w.c = n.c AND w.d <= n.d LEFT JOIN kids ON kids.node = n.node GROUP BY w.node
    )
    SELECT n.c AS conv_id, n.d AS depth, up.c AS parent_conv_id, n.n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
        CAST(saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
    FROM n JOIN under USING (node) LEFT JOIN kids USING (node) LEFT JOIN n AS up ON up.node = n.above AND n.d > 0
"""
