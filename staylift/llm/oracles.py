"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


SQL = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS norm FROM documents),
        g AS (SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
    "op3_line_runs": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
        k AS (SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
        f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
        m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY r, doc_id""",
}

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: CRC-32 of a decimal number, bit by bit: every digit is mixed in, then shifted out in eight steps (-1).
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
          lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
          lambda c, step: CASE WHEN step >= 0 THEN xor(c, step) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""


def _tree(name: str, nodes: str) -> str:
    """All levels of the trees over ``nodes`` (tree, place, digest); ``folds`` says how far a tree goes on."""
    return f"""{name} AS (
          SELECT tree, 0 AS level, place, digest FROM {nodes}
          UNION ALL
          SELECT tree, any_value(level) + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place))
          FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS nodes FROM {name}) WHERE nodes > 1 GROUP BY tree, place // 2)"""


_MERKLE = f"""
        WITH RECURSIVE
        d AS (
          SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
            CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS changed
          FROM documents),
        leaves AS (SELECT *, leaf AS digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d),
        {_tree("lower_tree", "leaves")},
        tops AS (SELECT tree AS of, digest FROM lower_tree QUALIFY level = max(level) OVER (PARTITION BY tree)),
        ranked AS (SELECT '' AS tree, of, digest, row_number() OVER (ORDER BY of) - 1 AS place FROM tops),
        {_tree("upper_tree", "ranked")},
        root AS (SELECT digest AS root FROM upper_tree ORDER BY level DESC LIMIT 1),
        -- Every leaf's way: its node of each level of its language's tree, then its language's in the upper one.
        heights AS (SELECT tree, max(level) AS height FROM lower_tree GROUP BY tree),
        steps AS (
          SELECT r, n.level AS step, place // (2 ** n.level)::BIGINT AS spot, leaves.tree AS tree, n.level AS level, 1 AS part
          FROM leaves JOIN heights USING (tree), generate_series(0, height - 1) AS n(level) WHERE n.level < height
          UNION ALL
          SELECT r, height + n.level, ranked.place // (2 ** n.level)::BIGINT, '', n.level, 2
          FROM leaves JOIN heights USING (tree) JOIN ranked ON ranked.of = leaves.tree,
            generate_series(0, (SELECT max(level) FROM upper_tree) - 1) AS n(level) WHERE n.level < (SELECT max(level) FROM upper_tree)),
        nodes AS (SELECT 1 AS part, * FROM lower_tree UNION ALL SELECT 2, * FROM upper_tree),
        way AS (
          SELECT r, step, spot % 2 = 1 AS from_right, coalesce(digest, '') AS sibling
          FROM steps LEFT JOIN nodes ON nodes.part = steps.part AND nodes.tree = steps.tree AND nodes.level = steps.level AND nodes.place = xor(spot, 1)),
        fold AS (
          SELECT r, 0 AS step, changed AS digest FROM leaves
          UNION ALL
          SELECT fold.r, fold.step + 1, sha256(CASE WHEN from_right THEN sibling || digest ELSE digest || sibling END)
          FROM fold JOIN way ON way.r = fold.r AND way.step = fold.step),
        ends AS (SELECT r, arg_max(digest, step) AS folded_root FROM fold GROUP BY r),
        proofs AS (SELECT r, string_agg(sibling, '' ORDER BY step) AS siblings FROM way GROUP BY r)
        SELECT doc_id, leaf, ranked.digest AS subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
        FROM leaves JOIN ranked ON ranked.of = leaves.tree JOIN ends USING (r) LEFT JOIN proofs USING (r), root"""


_LINKS = """
        WITH RECURSIVE
        e AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        v AS (SELECT *, e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0 AS usable FROM e),
        link AS (
          SELECT a.r, b.r AS other FROM v a JOIN v b ON a.r <> b.r AND a.usable AND b.usable AND len(a.e) = len(b.e)
          WHERE CASE WHEN a.usable AND b.usable AND len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 ELSE false END),
        reach AS (SELECT r, r AS other FROM v UNION SELECT reach.r, link.other FROM reach JOIN link ON link.r = reach.other),
        class AS (SELECT reach.r, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.other GROUP BY reach.r),
        many AS (SELECT r, count(*) AS n FROM link GROUP BY r)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
        FROM v JOIN class USING (r) LEFT JOIN many USING (r)"""


def _kmeans(k: int, rounds: int) -> str:
    ctes = [
        "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE len(embedding) = 64)",
        "v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(e, lambda x: CAST(floor(256 * x) AS BIGINT)) AS x FROM e "
        "WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster, x AS c FROM v
          QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id)) <= {k})""",
    ]
    for n in range(rounds + 1):
        ctes.append(f"""a{n} AS MATERIALIZED (
          SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
          FROM (SELECT r, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{n}) GROUP BY r)""")
        if n < rounds:
            ctes.append(f"""c{n + 1} AS MATERIALIZED (
          SELECT c{n}.cluster, coalesce(m.c, c{n}.c) AS c FROM c{n} LEFT JOIN (
            SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
              SELECT cluster, i, sum(u) AS s, count(*) AS n FROM (
                SELECT cluster, unnest(x) AS u, generate_subscripts(x, 1) AS i FROM a{n} JOIN v USING (r)) GROUP BY cluster, i) GROUP BY cluster) m USING (cluster))""")
    return f"""
        WITH {", ".join(ctes)}
        SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
          sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN v USING (r) JOIN c{rounds} USING (cluster)"""


SQL |= {"op11_merkle_manifest": _MERKLE, "op12_quantised_tiles": _LINKS, "op13_shallot": _kmeans(40, 5)}
