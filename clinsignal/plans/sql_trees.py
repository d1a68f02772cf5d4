"""DuckDB SQL of the tree models: growing, applying and explaining them."""

from __future__ import annotations

import itertools
import math

from clinsignal.operators.ensemble import TreeEnsemble
from clinsignal.operators.newton import MIN_GAIN, Settings
from clinsignal.plans.sql_base import sigmoid_sql


def newton_ctes(source: str, features: list[str], s: Settings) -> str:
    """CTEs that grow ``s.rounds`` trees on ``source`` (event_id, features, label).

    ``found`` has the inner nodes (tree, node, f, threshold, gain, cover) and
    ``ended`` the leaves (tree, node, value, cover).
    """
    xs = ", ".join(f"CAST({f} AS DOUBLE) AS x{i}" for i, f in enumerate(features))
    pick = "CASE b.f " + " ".join(f"WHEN {i} THEN x{i}" for i in range(len(features))) + " END"
    out = [f"s0 AS (SELECT event_id, {xs}, label AS y, CAST({s.base!r} AS DOUBLE) AS margin FROM ({source}))"]
    for r in range(s.rounds):
        out.append(
            f"r{r}_0 AS (SELECT *, p - y AS g, p * (1 - p) AS h, 1 AS node FROM "
            f"(SELECT *, {sigmoid_sql('margin')} AS p FROM s{r}))"
        )
        for d in range(s.max_depth):
            hist = " UNION ALL ".join(
                f"SELECT node, {i} AS f, x{i} AS v, sum(g) AS g, sum(h) AS h FROM r{r}_{d} WHERE node >= {2**d} GROUP BY node, x{i}"
                for i in range(len(features))
            )
            out.append(
                f"c{r}_{d} AS (SELECT node, f, lead(v) OVER w AS threshold, sum(g) OVER w AS gl, sum(h) OVER w AS hl, "
                f"sum(g) OVER a AS ga, sum(h) OVER a AS ha FROM ({hist}) "
                "WINDOW w AS (PARTITION BY node, f ORDER BY v), a AS (PARTITION BY node, f))"
            )
            gain = (
                f"(gl * gl / (hl + {s.l2!r}) + (ga - gl) * (ga - gl) / (ha - hl + {s.l2!r}) - ga * ga / (ha + {s.l2!r})) / 2 - {s.gamma!r}"
            )
            out.append(
                f"b{r}_{d} AS (SELECT * FROM (SELECT node, f, threshold, gain, ha, "
                "row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, f, threshold) AS place "
                f"FROM (SELECT *, {gain} AS gain FROM c{r}_{d} WHERE threshold IS NOT NULL "
                f"AND hl >= {s.min_child_weight!r} AND ha - hl >= {s.min_child_weight!r}) WHERE gain > {MIN_GAIN!r}) WHERE place = 1)"
            )
            out.append(
                f"r{r}_{d + 1} AS (SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node "
                f"WHEN {pick} < b.threshold THEN 2 * r.node ELSE 2 * r.node + 1 END AS node "
                f"FROM r{r}_{d} r LEFT JOIN b{r}_{d} b ON b.node = r.node)"
            )
        out.append(
            f"l{r} AS (SELECT node, -{s.rate!r} * sum(g) / (sum(h) + {s.l2!r}) AS value, sum(h) AS cover "
            f"FROM r{r}_{s.max_depth} GROUP BY node)"
        )
        kept = ", ".join(f"x{i}" for i in range(len(features)))
        out.append(
            f"s{r + 1} AS (SELECT event_id, {kept}, y, margin + value AS margin FROM r{r}_{s.max_depth} JOIN l{r} USING (node))"
        )
    found = " UNION ALL ".join(
        f"SELECT {r} AS tree, node, f, threshold, gain, ha AS cover FROM b{r}_{d}"
        for r in range(s.rounds)
        for d in range(s.max_depth)
    )
    ended = " UNION ALL ".join(f"SELECT {r} AS tree, node, value, cover FROM l{r}" for r in range(s.rounds))
    out += [f"found AS ({found})", f"ended AS ({ended})"]
    return ", " + ", ".join(out)


def applied_ctes(source: str, features: list[str], s: Settings) -> str:
    """CTE ``scored`` (columns of ``source``, margin): the trees of ``newton_ctes`` on other rows."""
    pick = "CASE b.f " + " ".join(f"WHEN {i} THEN CAST({f} AS DOUBLE)" for i, f in enumerate(features)) + " END"
    out = [f"t0 AS (SELECT *, CAST({s.base!r} AS DOUBLE) AS margin FROM ({source}))"]
    for r in range(s.rounds):
        walk = f"(SELECT *, 1 AS node FROM t{r})"
        for _ in range(s.max_depth):
            walk = (
                f"(SELECT q.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN q.node WHEN {pick} < b.threshold "
                f"THEN 2 * q.node ELSE 2 * q.node + 1 END AS node FROM {walk} q "
                f"LEFT JOIN (SELECT * FROM found WHERE tree = {r}) b ON b.node = q.node)"
            )
        out.append(
            f"t{r + 1} AS (SELECT q.* EXCLUDE (node, margin), q.margin + e.value AS margin FROM {walk} q "
            f"JOIN (SELECT * FROM ended WHERE tree = {r}) e USING (node))"
        )
    out.append(f"scored AS (SELECT * FROM t{s.rounds})")
    return ", " + ", ".join(out)


def explained_ctes(source: str, model: TreeEnsemble) -> str:
    """CTE ``explained`` (event_id, phi_0.., base_value): Shapley values over all
    coalitions of the features, from the node table of the model."""
    m = range(len(model.features))
    rows = ", ".join(
        f"({n.tree}, {n.node}, {'NULL' if n.feature is None else n.feature}, {'NULL' if n.threshold is None else repr(float(n.threshold))}, "
        f"{'NULL' if n.left is None else n.left}, {'NULL' if n.right is None else n.right}, {float(n.value)!r}, {float(n.cover)!r})"
        for n in model.nodes
    )

    def step(side: str) -> str:
        """One level down: bounds and cover shares of the path, by feature."""
        cols = []
        for i in m:
            low = f"CASE WHEN p.f = {i} THEN greatest(lo{i}, p.threshold) ELSE lo{i} END" if side == "rgt" else f"lo{i}"
            high = f"CASE WHEN p.f = {i} THEN least(hi{i}, p.threshold) ELSE hi{i} END" if side == "lft" else f"hi{i}"
            share = f"CASE WHEN p.f = {i} THEN z{i} * n.cover / (l.cover + r.cover) ELSE z{i} END"
            cols.append(f"{low}, {high}, {share}")
        return (
            f"SELECT n.tree, n.node, n.f, n.threshold, n.lft, n.rgt, n.value, {', '.join(cols)} FROM paths p "
            f"JOIN nodes n ON n.tree = p.tree AND n.node = p.{side} "
            "JOIN nodes l ON l.tree = p.tree AND l.node = p.lft JOIN nodes r ON r.tree = p.tree AND r.node = p.rgt"
        )

    start = ", ".join(
        f"CAST('-infinity' AS DOUBLE) AS lo{i}, CAST('infinity' AS DOUBLE) AS hi{i}, CAST(1 AS DOUBLE) AS z{i}" for i in m
    )
    out = [
        f"nodes AS (SELECT * FROM (VALUES {rows}) AS t(tree, node, f, threshold, lft, rgt, value, cover))",
        f"paths AS (SELECT tree, node, f, threshold, lft, rgt, value, {start} FROM nodes "
        "WHERE (tree, node) IN (SELECT (tree, min(node)) FROM nodes GROUP BY tree) "
        f"UNION ALL ({step('lft')} UNION ALL {step('rgt')}))",
        "leaves AS (SELECT * FROM paths WHERE f IS NULL)",
    ]
    known = ", ".join(f"CAST(CAST(s.{f} AS DOUBLE) >= lo{i} AND CAST(s.{f} AS DOUBLE) < hi{i} AS DOUBLE) AS o{i}" for i, f in enumerate(model.features))
    worth = []
    for mask in range(2 ** len(model.features)):
        factors = " * ".join(f"{'o' if mask >> i & 1 else 'z'}{i}" for i in m)
        worth.append(f"sum(value * {factors}) AS v{mask}")
    out.append(
        f"worth AS (SELECT event_id, {', '.join(worth)} FROM (SELECT s.event_id, l.value, {', '.join(f'l.z{i}' for i in m)}, {known} "
        f"FROM ({source}) s, leaves l) GROUP BY event_id)"
    )
    phis = []
    for i in m:
        others, terms = [j for j in m if j != i], []
        for k in range(len(others) + 1):
            weight = math.factorial(k) * math.factorial(len(others) - k) / math.factorial(len(others) + 1)
            for group in itertools.combinations(others, k):
                mask = sum(1 << j for j in group)
                terms.append(f"{weight!r} * (v{mask | 1 << i} - v{mask})")
        phis.append(f"{' + '.join(terms)} AS phi_{i}")
    out.append(f"explained AS (SELECT event_id, {', '.join(phis)}, v0 + {model.base!r} AS base_value FROM worth)")
    return ", " + ", ".join(out)
