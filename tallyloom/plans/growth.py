"""Checking SQL for trees of several cuts: splits searched level by level from counts per value.

It follows the rules of a tree whose features have few values, so that every cut between neighbouring values is tried: the
largest Gini gain wins, the earlier feature and the lower cut on ties, a node without a gain is a leaf, and two leaves under
one node that predict the same are taken together.
"""

from __future__ import annotations


def _gini(p: str, n: str) -> str:
    return f"(2 * ({p} / {n}) * (1 - {p} / {n}))"


def tree_sql(base: str, features: list[str], depth: int, folds: int = 0, name: str = "t") -> str:
    """CTEs <name>_nodes(held, node, n, p, feature, cut, gain, is_leaf) and <name>_reached(held, id, fold, label, share, prediction).

    ``base`` is the name of a table of id, fold, label and the features. One tree is grown for each ``held`` from -1 to ``folds`` - 1, on
    the rows of folds from 0 on other than ``held``; ``reached`` has the rows of fold ``held``. The root is node 1, the children of k are 2k and 2k + 1.
    """
    parts = [
        f"{name}_folds AS (SELECT unnest(range(-1, {folds})) AS held)",
        f"{name}_at0 AS (SELECT held, 1 AS node, b.* FROM {base} b JOIN {name}_folds ON fold <> held AND fold >= 0)",
    ]
    for d in range(depth):
        stacked = " UNION ALL ".join(f"SELECT held, node, {i} AS place, '{f}' AS feature, {f}::DOUBLE AS v, label FROM {name}_at{d}" for i, f in enumerate(features))
        move = " ".join(f"WHEN '{f}' THEN {f}::DOUBLE" for f in features)
        parts += [
            f"{name}_values{d} AS (SELECT held, node, place, feature, v, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS p FROM ({stacked}) GROUP BY ALL)",
            f"""{name}_cuts{d} AS (SELECT held, node, place, feature, v, sum(n) OVER w AS nl, sum(p) OVER w AS pl,
                sum(n) OVER t AS nt, sum(p) OVER t AS pt FROM {name}_values{d}
                WINDOW w AS (PARTITION BY held, node, place ORDER BY v), t AS (PARTITION BY held, node, place))""",
            f"""{name}_gains{d} AS (SELECT *, {_gini('pt', 'nt')} - nl / nt * {_gini('pl', 'nl')} - (nt - nl) / nt * {_gini('(pt - pl)', '(nt - nl)')} AS gain
                FROM {name}_cuts{d} WHERE nl < nt)""",
            f"""{name}_best{d} AS (SELECT held, node, feature, v AS cut, gain FROM (SELECT *, row_number() OVER (PARTITION BY held, node
                ORDER BY round(gain, 14) DESC, place, v) AS rank FROM {name}_gains{d}) WHERE rank = 1 AND gain > 1e-13)""",
            f"""{name}_at{d + 1} AS (SELECT held, 2 * node + CASE WHEN CASE feature {move} END <= cut THEN 0 ELSE 1 END AS node,
                id, fold, label, {', '.join(features)} FROM {name}_at{d} JOIN {name}_best{d} USING (held, node))""",
        ]
    grown = " UNION ALL ".join(f"SELECT held, node, {d} AS level, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS p FROM {name}_at{d} GROUP BY ALL" for d in range(depth + 1))
    bests = " UNION ALL ".join(f"SELECT * FROM {name}_best{d}" for d in range(depth))
    parts.append(f"{name}_grown AS (SELECT g.*, feature, cut, gain, (p * 2 > n)::INTEGER AS prediction FROM ({grown}) g LEFT JOIN ({bests}) USING (held, node))")
    # leaves from the deepest level up: a node whose two children are leaves of one prediction is a leaf
    parts.append(f"{name}_leaf{depth} AS (SELECT held, node, prediction FROM {name}_grown WHERE level = {depth})")
    for d in range(depth - 1, -1, -1):
        parts.append(f"""{name}_leaf{d} AS (SELECT held, node, prediction FROM {name}_grown g WHERE level = {d} AND (feature IS NULL OR
                (SELECT count(*) = 2 AND count(DISTINCT l.prediction) = 1 FROM {name}_leaf{d + 1} l WHERE l.held = g.held AND l.node // 2 = g.node)))""")
    leaves = " UNION ALL ".join(f"SELECT held, node FROM {name}_leaf{d}" for d in range(depth + 1))
    move = " ".join(f"WHEN '{f}' THEN {f}::DOUBLE" for f in features)
    parts += [
        f"""{name}_walk0 AS (SELECT held, 1 AS node, b.* FROM {base} b JOIN {name}_folds ON fold = held)""",
        *(f"""{name}_walk{d + 1} AS (SELECT held, CASE WHEN is_leaf THEN node ELSE 2 * node + CASE WHEN CASE feature {move} END <= cut THEN 0 ELSE 1 END END AS node,
                id, fold, label, {', '.join(features)} FROM {name}_walk{d} JOIN {name}_nodes USING (held, node))""" for d in range(depth)),
        f"{name}_reached AS (SELECT w.held, id, fold, label, p / n AS share, prediction::DOUBLE AS prediction FROM {name}_walk{depth} w JOIN {name}_nodes USING (held, node))",
    ]
    at = next(i for i, part in enumerate(parts) if part.startswith(f"{name}_walk0"))
    # children of a leaf are no nodes
    parts.insert(at, f"""{name}_marked AS (SELECT g.*, (l.node IS NOT NULL) AS is_leaf FROM {name}_grown g LEFT JOIN ({leaves}) l USING (held, node)),
        {name}_nodes AS (SELECT * FROM {name}_marked m WHERE NOT EXISTS (SELECT 1 FROM {name}_marked a WHERE a.held = m.held AND a.is_leaf AND a.level < m.level
            AND m.node // (2 ** (m.level - a.level))::BIGINT = a.node))""")
    return ",\n    ".join(parts)
