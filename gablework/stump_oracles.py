"""DuckDB SQL for models of depth one, which SQL can express exactly.

A tree of depth one over features with few values tries every border between two values,
so its best split is the cumulative sum that explains most. Boosting fits the next such
tree to twice the error left, and cross-validation does all of this per fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from gablework.oracles import _LINEITEM_KEY, _PRICED, _hash

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
STRONG = ("price_band", "l_quantity", "l_discount", "l_tax", "line_number")
WEAK = ("l_quantity", "l_discount", "l_tax", "line_number")

_ROWS = f"""
rows AS (
  SELECT {KEY}, net, floor(l_extendedprice / 4000) AS price_band, l_quantity, l_discount, l_tax,
         l_linenumber::DOUBLE AS line_number, {_hash(_LINEITEM_KEY, 667, 3)} AS fold,
         {_hash(_LINEITEM_KEY, 666, 1000000)} < 700000 AS train
  FROM ({_PRICED}))"""


def _stump(name: str, source: str, where: str, target: str, features: Sequence[str]) -> str:
    """A one-row CTE: the feature and value to split at, and the means of both sides."""
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS v, count(*)::DOUBLE AS n, sum({target}) AS s FROM {source} WHERE {where} GROUP BY 2" for f in features
    )
    return f"""
{name}_cells AS ({parts}),
{name}_sums AS (
  SELECT feature, v, sum(n) OVER upto AS nl, sum(s) OVER upto AS sl,
         sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s
  FROM {name}_cells WINDOW upto AS (PARTITION BY feature ORDER BY v)),
{name} AS (
  SELECT feature, v AS cut, sl / nl AS low, (s - sl) / (n - nl) AS high FROM {name}_sums WHERE nl < n
  ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)"""


def _guess(name: str, features: Sequence[str]) -> str:
    value = " ".join(f"WHEN '{f}' THEN {f}" for f in features)
    return f"(SELECT CASE WHEN (CASE feature {value} END) <= cut THEN low ELSE high END FROM {name})"


def _selected(name: str, source: str, where: str, top: int, features: Sequence[str]) -> str:
    """As ``_stump``, among the ``top`` features by F-test."""
    tests = " UNION ALL ".join(f"SELECT '{f}' AS feature, abs(corr({f}, net)) AS r FROM {source} WHERE {where}" for f in features)
    chosen = f"{name}_chosen AS (SELECT feature FROM ({tests}) ORDER BY r DESC LIMIT {top}),"
    kept = f"WHERE nl < n AND feature IN (SELECT feature FROM {name}_chosen)"
    return f"\n{chosen}{_stump(name, source, where, 'net', features).replace('WHERE nl < n', kept)}"


def _boosted(name: str, where: str, rounds: int, step: float, features: Sequence[str]) -> str:
    """CTEs up to ``name``: all rows with the guess after each round as ``g0, g1, ...``."""
    steps = [_stump(f"{name}_t0", "rows", where, "net", features)]
    steps.append(f"\n{name}_r0 AS (SELECT *, {_guess(f'{name}_t0', features)} AS g0 FROM rows)")
    for i in range(1, rounds):
        before = f"{name}_r{i - 1}"
        steps.append(_stump(f"{name}_t{i}", before, where, f"2 * (net - g{i - 1})", features))
        steps.append(f"\n{name}_r{i} AS (SELECT *, g{i - 1} + {step} * {_guess(f'{name}_t{i}', features)} AS g{i} FROM {before})")
    return ",".join([*steps, f"\n{name} AS (SELECT * FROM {name}_r{rounds - 1})"])


_RMSE = "sqrt(avg((net - {0}) * (net - {0})))"
# The settings of the boosted grid, in its order.
GRID = [(rounds, step) for rounds in (1, 2) for step in (0.1, 0.5)]


def _boosted_grid() -> str:
    """One round is the same tree for any step; the second tree does not depend on the step either."""
    parts = [_ROWS]
    scores = []
    for fold in (0, 1, 2, None):
        where = "train" if fold is None else f"train AND fold <> {fold}"
        scored = "NOT train" if fold is None else f"train AND fold = {fold}"
        name = "whole" if fold is None else f"fold{fold}"
        for i, (rounds, step) in enumerate(GRID):
            parts.append(_boosted(f"{name}_{i}", where, rounds, step, STRONG))
            error = _RMSE.format(f"g{rounds - 1}")
            scores.append(f"SELECT {i} AS point, {'NULL' if fold is None else fold} AS fold, {error} AS e FROM {name}_{i} WHERE {scored}")
    points = " UNION ALL ".join(f"SELECT {i} AS point, {r}::INTEGER AS rounds, {s}::DOUBLE AS step" for i, (r, s) in enumerate(GRID))
    return f"""
    WITH {",".join(parts)},
    points AS ({points}),
    scores AS ({" UNION ALL ".join(scores)}),
    means AS (SELECT point, avg(e) FILTER (fold IS NOT NULL) AS m, max(e) FILTER (fold IS NULL) AS h FROM scores GROUP BY 1),
    ranked AS (SELECT *, row_number() OVER (ORDER BY round(m, 6), point) = 1 AS is_best FROM means)
    SELECT rounds, step, round(m, 4) AS avg_rmse, is_best, CASE WHEN is_best THEN round(h, 4) END AS holdout_rmse
    FROM ranked JOIN points USING (point)"""


def _selected_grid() -> str:
    parts, scores = [_ROWS], []
    for top in (1, 4):
        for fold in (0, 1, 2, None):
            where = "train" if fold is None else f"train AND fold <> {fold}"
            scored = "NOT train" if fold is None else f"train AND fold = {fold}"
            name = f"top{top}_{'whole' if fold is None else fold}"
            parts.append(_selected(name, "rows", where, top, WEAK))
            error = _RMSE.format(_guess(name, WEAK))
            scores.append(f"SELECT {top} AS top, {'NULL' if fold is None else fold} AS fold, {error} AS e FROM rows WHERE {scored}")
    return f"""
    WITH {",".join(parts)},
    scores AS ({" UNION ALL ".join(scores)}),
    means AS (SELECT top, avg(e) FILTER (fold IS NOT NULL) AS m, max(e) FILTER (fold IS NULL) AS h FROM scores GROUP BY 1),
    ranked AS (SELECT *, row_number() OVER (ORDER BY round(m, 6), top) = 1 AS is_best FROM means)
    SELECT top::DOUBLE AS top, round(m, 4) AS avg_rmse, is_best, CASE WHEN is_best THEN round(h, 4) END AS holdout_rmse FROM ranked"""


def _comparison() -> str:
    entries = []
    for recipe, guess in (("stump", "g0"), ("stump_minmax", "g0"), ("boosted_stumps", "g2")):
        for part, where in (("train", "train"), ("test", "NOT train")):
            entries.append(
                f"SELECT '{recipe}' AS recipe, '{part}' AS part, count(*) AS n, round({_RMSE.format(guess)}, 4) AS rmse FROM b WHERE {where}"
            )
    return f"WITH {_ROWS},{_boosted('b', 'train', 3, 0.1, STRONG)} {' UNION ALL '.join(entries)}"


_PAIR = ("l_quantity", "l_extendedprice")
_A, _B = _PAIR

ORACLES: dict[str, str] = {
    "rf_stump": f"""
    WITH {_ROWS},{_stump("t", "rows", "train", "net", STRONG)}
    SELECT {KEY}, round({_guess("t", STRONG)}, 4) AS prediction FROM rows WHERE NOT train""",
    "rf_stump_scaled": f"""
    WITH {_ROWS},{_stump("t", "rows", "train", "net", STRONG)}
    SELECT {KEY}, round({_guess("t", STRONG)}, 4) AS standardized, round({_guess("t", STRONG)}, 4) AS minmax FROM rows WHERE NOT train""",
    "rf_stump_selected": f"""
    WITH {_ROWS},{_selected("t", "rows", "train", 1, WEAK)}
    SELECT {KEY}, round({_guess("t", WEAK)}, 4) AS prediction FROM rows WHERE NOT train""",
    "gbt_stumps": f"""
    WITH {_ROWS},{_boosted("b", "train", 3, 0.1, STRONG)}
    SELECT {KEY}, round(g2, 4) AS prediction FROM b WHERE NOT train""",
    "cv_stump_grid": _boosted_grid(),
    "cv_stump_selected": _selected_grid(),
    "compare_stumps": _comparison(),
    # Of two columns: eigenvalues and directions in closed form, signs left aside, rows not centred.
    "pca_pair": f"""
    WITH c AS (SELECT var_samp({_A}) AS a, var_samp({_B}) AS d, covar_samp({_A}, {_B}) AS b FROM lineitem),
    e AS (SELECT *, (a + d) / 2 + sqrt((a - d) * (a - d) / 4 + b * b) AS big FROM c),
    v AS (SELECT b / sqrt(b * b + (big - a) * (big - a)) AS x, (big - a) / sqrt(b * b + (big - a) * (big - a)) AS y,
                 big / (a + d) AS share FROM e)
    SELECT {KEY}, round(abs({_A} * x + {_B} * y), 4) AS first, round(abs({_A} * y - {_B} * x), 4) AS second,
           round(share, 8) AS first_share, round(1 - share, 8) AS second_share
    FROM lineitem, v""",
}
