"""Models in SQL: least squares by elimination in a recursive query, and regression trees by trying every split."""

from __future__ import annotations


def least_squares_ctes(
    rows: str, key: str, features: dict[str, str], label: str, fold: str = "fold", *, prefix: str = "ls"
) -> dict[str, str]:
    """CTEs ending in ``<prefix>_scored``: key, fold, y and prediction of each row by the model of the other folds, and
    ``<prefix>_fit``: per fold g and feature i the slope b and the coefficient w of the scaled feature.

    Features and label are shifted by their overall means first. Pivots that vanish (features that others determine)
    are left out, with coefficient 0.
    """
    p = len(features)
    values = ", ".join(f"CAST({e} AS DOUBLE)" for e in [*features.values(), label])
    t = {n: f"{prefix}_{n}" for n in ("raw", "mean", "u", "sums", "parts", "cov", "corr", "steps", "w", "fit", "scored")}
    return {
        t["raw"]: f"SELECT {key} AS k, CAST({fold} AS INTEGER) AS g, unnest([{values}]) AS v, unnest(range(1, {p + 2})) AS i FROM {rows}",
        t["mean"]: f"SELECT i, avg(v) AS m FROM {t['raw']} GROUP BY 1",
        t["u"]: f"SELECT r.k, r.g, r.i, r.v - m.m AS v FROM {t['raw']} r JOIN {t['mean']} m USING (i) "
                f"UNION ALL SELECT k, g, 0, 1.0::DOUBLE FROM {t['raw']} WHERE i = 1",
        t["sums"]: f"SELECT a.g, a.i, b.i AS j, sum(a.v * b.v) AS s FROM {t['u']} a JOIN {t['u']} b ON b.k = a.k GROUP BY ALL",
        # the sums of the rows outside each fold
        t["parts"]: f"SELECT f.g, s.i, s.j, sum(s.s) AS s FROM (SELECT DISTINCT g FROM {t['sums']}) f "
                    f"JOIN {t['sums']} s ON s.g <> f.g GROUP BY ALL",
        t["cov"]: f"SELECT s.g, s.i, s.j, s.s / n.s - (a.s / n.s) * (b.s / n.s) AS c FROM {t['parts']} s "
                  f"JOIN {t['parts']} n ON n.g = s.g AND n.i = 0 AND n.j = 0 JOIN {t['parts']} a ON a.g = s.g AND a.i = s.i AND a.j = 0 "
                  f"JOIN {t['parts']} b ON b.g = s.g AND b.i = s.j AND b.j = 0 WHERE s.i > 0 AND s.j > 0",
        t["corr"]: f"SELECT c.g, c.i, c.j, c.c / sqrt(CASE WHEN a.c > 1e-24 THEN a.c ELSE 1 END) "
                   f"/ CASE WHEN c.j = {p + 1} THEN 1 ELSE sqrt(CASE WHEN b.c > 1e-24 THEN b.c ELSE 1 END) END AS v "
                   f"FROM {t['cov']} c JOIN {t['cov']} a ON a.g = c.g AND a.i = c.i AND a.j = c.i "
                   f"JOIN {t['cov']} b ON b.g = c.g AND b.i = c.j AND b.j = c.j WHERE c.i <= {p}",
        t["steps"]: f"SELECT 0 AS step, g, i, j, v FROM {t['corr']} UNION ALL "
                    f"SELECT m.step + 1, m.g, m.i, m.j, CASE WHEN p.v < 1e-9 THEN m.v WHEN m.i = m.step + 1 THEN m.v / p.v "
                    f"ELSE m.v - r.v * c.v / p.v END FROM {t['steps']} m "
                    f"JOIN {t['steps']} p ON p.g = m.g AND p.i = m.step + 1 AND p.j = m.step + 1 "
                    f"JOIN {t['steps']} r ON r.g = m.g AND r.i = m.i AND r.j = m.step + 1 "
                    f"JOIN {t['steps']} c ON c.g = m.g AND c.i = m.step + 1 AND c.j = m.j WHERE m.step < {p}",
        t["w"]: f"SELECT a.g, a.i, CASE WHEN d.v > 0.5 THEN a.v ELSE 0 END AS w FROM {t['steps']} a "
                f"JOIN {t['steps']} d ON d.step = {p} AND d.g = a.g AND d.i = a.i AND d.j = a.i WHERE a.step = {p} AND a.j = {p + 1}",
        t["fit"]: f"SELECT w.g, w.i, w.w, w.w / sqrt(CASE WHEN c.c > 1e-24 THEN c.c ELSE 1 END) AS b, a.s / n.s AS m "
                  f"FROM {t['w']} w JOIN {t['cov']} c ON c.g = w.g AND c.i = w.i AND c.j = w.i "
                  f"JOIN {t['parts']} a ON a.g = w.g AND a.i = w.i AND a.j = 0 JOIN {t['parts']} n ON n.g = w.g AND n.i = 0 AND n.j = 0",
        t["scored"]: f"SELECT u.k, u.g, max(CASE WHEN u.i = {p + 1} THEN u.v + o.m END) AS y, "
                     f"max(o.m + y.s / n.s) + coalesce(sum(f.b * (u.v - f.m)), 0) AS prediction "
                     f"FROM {t['u']} u JOIN {t['mean']} o ON o.i = {p + 1} "
                     f"JOIN {t['parts']} y ON y.g = u.g AND y.i = {p + 1} AND y.j = 0 JOIN {t['parts']} n ON n.g = u.g AND n.i = 0 AND n.j = 0 "
                     f"LEFT JOIN {t['fit']} f ON f.g = u.g AND f.i = u.i GROUP BY 1, 2",
    }


def scores_sql(scored: str, digits: int = 6) -> str:
    """``mse`` and ``r2`` per fold; no ``r2`` where the label is constant."""
    return (
        f"SELECT g AS fold, round(avg(pow(y - prediction, 2)), {digits}) AS mse, "
        f"round(1 - sum(pow(y - prediction, 2)) / nullif(var_pop(y) * count(*), 0), {digits}) AS r2 FROM {scored} GROUP BY 1"
    )


def feature_ctes(rows: str, key: str, features: dict[str, str], held: str) -> dict[str, str]:
    """``tree_x``: key, held and every feature's number and value; ``tree_t``: the thresholds between the values of
    the rows that are not held out."""
    values = ", ".join(f"CAST({e} AS DOUBLE)" for e in features.values())
    return {
        "tree_x": f"SELECT {key} AS k, {held} AS held, unnest([{values}]) AS v, unnest(range(0, {len(features)})) AS f FROM {rows}",
        "tree_t": "SELECT f, (v + next) / 2 AS t FROM (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS next "
                  "FROM (SELECT DISTINCT f, v FROM tree_x WHERE NOT held)) WHERE next IS NOT NULL",
    }


def tree_ctes(prefix: str, target: str, depth: int, min_leaf: int) -> dict[str, str]:
    """CTEs of one tree grown on ``target`` (k, y; the rows not held out) over ``feature_ctes``: ``<prefix>_splits``
    with node, feature and the squares removed, and ``<prefix>_tree`` with the prediction of every row.

    The best split removes the most squares; of equal ones the first feature's lowest threshold is taken, each child
    keeps ``min_leaf`` rows, and nodes without such a split are leaves.
    """
    ctes = {f"{prefix}_n0": "SELECT DISTINCT k, 1 AS node FROM tree_x"}
    for level in range(1, depth + 1):
        before, splits = f"{prefix}_n{level - 1}", f"{prefix}_s{level}"
        ctes |= {
            f"{prefix}_c{level}":
                f"SELECT n.node, t.f, t.t, count(*) AS n, sum(y.y) AS s, count(*) FILTER (x.v <= t.t) AS nl, "
                f"coalesce(sum(y.y) FILTER (x.v <= t.t), 0) AS sl FROM {before} n JOIN {target} y ON y.k = n.k "
                f"JOIN tree_x x ON x.k = n.k JOIN tree_t t ON t.f = x.f GROUP BY 1, 2, 3",
            f"{prefix}_g{level}":
                f"SELECT node, f, t, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain "
                f"FROM {prefix}_c{level} WHERE nl >= {min_leaf} AND n - nl >= {min_leaf}",
            splits: f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(gain, 12) DESC, f, t) AS place "
                    f"FROM {prefix}_g{level}) WHERE place = 1 AND gain > 1e-12",
            f"{prefix}_n{level}":
                f"SELECT n.k, CASE WHEN s.node IS NULL THEN n.node ELSE 2 * n.node + CAST(x.v > s.t AS INTEGER) END AS node "
                f"FROM {before} n LEFT JOIN {splits} s ON s.node = n.node LEFT JOIN tree_x x ON x.k = n.k AND x.f = s.f",
        }
    last = f"{prefix}_n{depth}"
    return ctes | {
        f"{prefix}_splits": " UNION ALL ".join(f"SELECT node, f, gain FROM {prefix}_s{i}" for i in range(1, depth + 1)),
        f"{prefix}_tree": f"SELECT n.k, m.mean AS prediction FROM {last} n JOIN (SELECT n.node, avg(y.y) AS mean "
                          f"FROM {last} n JOIN {target} y ON y.k = n.k GROUP BY 1) m ON m.node = n.node",
    }
