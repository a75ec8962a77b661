"""The isolation forest in SQL: draws, growth, walk, thresholds and sweep, for a second engine.

Trees are 8 levels deep, as a sample of 129 to 256 rows makes them. Tables in and out are common
table expressions with names that begin with a prefix, so that several forests fit into one statement.
"""

from __future__ import annotations

from collections.abc import Sequence

from fraudspark.functions.trees import EULER_GAMMA, PATH_UNITS
from fraudspark.operators.anomaly import least_prime

LEVELS = 8


def _hex(text: str, first: int, size: int) -> str:
    return f"CAST('0x' || substr({text}, {first}, {size}) AS BIGINT)"


def _uniform(text: str, first: int) -> str:
    return f"({_hex(text, first, 13)} / CAST({16**13} AS DOUBLE))"


def _mean_path(n: str) -> str:
    return (
        f"CASE WHEN {n} <= 1 THEN CAST(0 AS DOUBLE) WHEN {n} = 2 THEN CAST(1 AS DOUBLE) "
        f"ELSE 2 * (ln(CAST({n} - 1 AS DOUBLE)) + CAST({EULER_GAMMA} AS DOUBLE)) - CAST(2 * ({n} - 1) AS DOUBLE) / {n} END"
    )


def vectors(prefix: str, source: str, columns: Sequence[str], label: str = "is_fraud", key: str = "transaction_id") -> str:
    """``<prefix>_m``: key, label and the model columns as one list of doubles, complete rows only."""
    cells = ", ".join(f'CAST("{c}" AS DOUBLE)' for c in columns)
    complete = " AND ".join(f'"{c}" IS NOT NULL' for c in columns)
    text = ", ".join(f'CAST(CAST("{c}" AS DECIMAL(38,2)) AS VARCHAR)' for c in columns)
    return f"""{prefix}_m AS MATERIALIZED (
  SELECT {key} AS id, {label} AS label, [{cells}] AS v, concat_ws(':', CAST({key} AS VARCHAR), {text}) AS row_text
  FROM {source} WHERE {complete})"""


def forest(prefix: str, rows: str, width: int, n_trees: int, seed: int, first_tree: int = 0, max_samples: int = 256) -> str:
    """``<prefix>_nodes`` grown from ``rows`` (id, v, row_text), and ``<prefix>_size``, its rows a tree."""
    prime = least_prime(n_trees)
    low = ", ".join(f"min(v[{i + 1}])" for i in range(width))
    high = ", ".join(f"max(v[{i + 1}])" for i in range(width))
    parts = [
        f"""{prefix}_size AS MATERIALIZED (
  SELECT count(*) AS total, least({max_samples}, count(*)) AS psi, ceil(log2(least({max_samples}, count(*)))) AS deepest FROM {rows})""",
        f"""{prefix}_digests AS (
  SELECT id, v, md5('{seed}:{first_tree}:' || row_text) AS digest FROM {rows})""",
        f"""{prefix}_times AS (
  SELECT id, v, digest, CAST(floor({prime} * least(CAST(1 AS DOUBLE), CAST(2 * psi + 20 AS DOUBLE) / total)
    + {_uniform("digest", 1)}) AS BIGINT) AS times FROM {prefix}_digests, {prefix}_size)""",
        f"""{prefix}_taken AS (
  SELECT id, v, digest, ({_hex("digest", 14, 8)} + i * (1 + {_hex("digest", 22, 8)} % {prime - 1})) % {prime} AS tree
  FROM (SELECT id, v, digest, unnest(range(times)) AS i FROM {prefix}_times))""",
        f"""{prefix}_ordered AS (
  SELECT tree + {first_tree} AS tree, id, v, row_number() OVER (
    PARTITION BY tree ORDER BY {_hex("md5(digest || ':' || CAST(tree AS VARCHAR))", 1, 13)}, id) AS place
  FROM {prefix}_taken WHERE tree < {n_trees})""",
        f"""{prefix}_s0 AS MATERIALIZED (
  SELECT tree, CAST(0 AS BIGINT) AS node, id, v FROM {prefix}_ordered, {prefix}_size WHERE place <= psi)""",
    ]
    for level in range(LEVELS + 1):
        digest = f"md5('{seed}:' || CAST(tree AS VARCHAR) || ':' || CAST(node AS VARCHAR))"
        parts.append(f"""{prefix}_b{level} AS (
  SELECT tree, node, count(*) AS n, [{low}] AS low, [{high}] AS high FROM {prefix}_s{level} GROUP BY tree, node)""")
        parts.append(f"""{prefix}_c{level} AS (
  SELECT tree, node, n, low, high, {digest} AS digest,
    CASE WHEN {level} < deepest THEN list_filter(range(1, {width + 1}), lambda f: low[f] < high[f]) ELSE [] END AS varying
  FROM {prefix}_b{level}, {prefix}_size)""")
        parts.append(f"""{prefix}_d{level} AS (
  SELECT *, CASE WHEN len(varying) > 0 THEN varying[1 + CAST(floor({_uniform("digest", 1)} * len(varying)) AS BIGINT)] END AS f
  FROM {prefix}_c{level})""")
        parts.append(f"""{prefix}_n{level} AS MATERIALIZED (
  SELECT tree, node, n, f, CASE WHEN low[f] + (high[f] - low[f]) * {_uniform("digest", 14)} <= low[f] THEN high[f]
    ELSE low[f] + (high[f] - low[f]) * {_uniform("digest", 14)} END AS cut FROM {prefix}_d{level})""")
        if level < LEVELS:
            parts.append(f"""{prefix}_s{level + 1} AS MATERIALIZED (
  SELECT s.tree, 2 * s.node + CASE WHEN s.v[n.f] >= n.cut THEN 2 ELSE 1 END AS node, s.id, s.v
  FROM {prefix}_s{level} s JOIN {prefix}_n{level} n ON s.tree = n.tree AND s.node = n.node WHERE n.f IS NOT NULL)""")
    nodes = " UNION ALL ".join(f"SELECT *, {level} AS depth FROM {prefix}_n{level}" for level in range(LEVELS + 1))
    parts.append(f"{prefix}_nodes AS MATERIALIZED ({nodes})")
    return ",\n".join(parts)


NODE_COLUMNS = """CAST(tree AS INT) AS tree_id, CAST(node AS INT) AS node_id, CAST(coalesce(f, 0) - 1 AS INT) AS feature,
  round(cut, 6) AS threshold, CAST(CASE WHEN f IS NOT NULL THEN 2 * node + 1 END AS INT) AS left,
  CAST(CASE WHEN f IS NOT NULL THEN 2 * node + 2 END AS INT) AS right, CAST(n AS INT) AS size, CAST(depth AS INT) AS depth"""


def scores(prefix: str, rows: str, counts: Sequence[int], first_tree: int = 0) -> str:
    """``<prefix>_scores``: id, label and a score n<count> for each tree count."""
    units = f"CAST({PATH_UNITS} AS DOUBLE)"
    joins = ""
    for level in range(1, LEVELS + 1):
        up = f"n{level - 1}"
        joins += f"""
    LEFT JOIN {prefix}_n{level} n{level} ON n{level}.tree = n0.tree AND {up}.f IS NOT NULL
      AND n{level}.node = 2 * {up}.node + CASE WHEN m.v[{up}.f] >= {up}.cut THEN 2 ELSE 1 END"""
    size = "coalesce(" + ", ".join(f"n{level}.n" for level in range(LEVELS, -1, -1)) + ")"
    depth = "CASE " + " ".join(f"WHEN n{level}.n IS NOT NULL THEN {level}" for level in range(LEVELS, -1, -1)) + " END"
    sums = ", ".join(f"CAST(sum(path) FILTER (WHERE tree < {first_tree + n}) AS BIGINT) AS t{n}" for n in counts)
    made = ", ".join(f"pow(CAST(2 AS DOUBLE), -t{n} / ({n} * ({_mean_path('psi')}) * {units})) AS n{n}" for n in counts)
    return f"""{prefix}_walk AS (
  SELECT m.id, m.label, n0.tree, {size} AS size, {depth} AS depth FROM {rows} m CROSS JOIN {prefix}_n0 n0{joins}),
{prefix}_paths AS (SELECT id, label, tree, CAST(round((depth + {_mean_path("size")}) * {units}) AS BIGINT) AS path FROM {prefix}_walk),
{prefix}_totals AS (SELECT id, label, {sums} FROM {prefix}_paths GROUP BY id, label),
{prefix}_scores AS MATERIALIZED (SELECT id, label, {made} FROM {prefix}_totals, {prefix}_size)"""


def sweep(prefix: str, counts: Sequence[int], contamination: float, limits: str = "") -> str:
    """``<prefix>_sweep``: the confusion row of each tree count; thresholds from all rows, or from ``limits``."""
    share = f"CAST({1.0 - contamination!r} AS DOUBLE)"
    limits = limits or "SELECT " + ", ".join(f"quantile_cont(n{n}, {share}) AS l{n}" for n in counts) + f" FROM {prefix}_scores"
    cells = []
    for n in counts:
        for name, test in (("tp", f"n{n} > l{n} AND label"), ("fp", f"n{n} > l{n} AND NOT label"), ("fn", f"n{n} <= l{n} AND label"), ("tn", f"n{n} <= l{n} AND NOT label")):
            cells.append(f"CAST(count(*) FILTER (WHERE {test}) AS BIGINT) AS {name}{n}")
    rows = " UNION ALL ".join(f"SELECT CAST({n} AS INT) AS n_estimators, tp{n} AS tp, fp{n} AS fp, fn{n} AS fn, tn{n} AS tn FROM {prefix}_wide" for n in counts)
    return f"""{prefix}_limits AS MATERIALIZED ({limits}),
{prefix}_wide AS (SELECT {", ".join(cells)} FROM {prefix}_scores, {prefix}_limits),
{prefix}_sweep AS MATERIALIZED (
  SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, tp + fn = 0 AS no_positives
  FROM ({rows}))"""


SWEEP_COLUMNS = "n_estimators, tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, no_positives"


def chosen(prefix: str, counts: Sequence[int]) -> str:
    """``<prefix>_chosen``: id, label, score and limit of the best tree count, smallest first at ties."""
    pick = lambda c: "CASE best " + " ".join(f"WHEN {n} THEN {c}{n}" for n in counts) + " END"
    return f"""{prefix}_best AS (SELECT n_estimators AS best FROM {prefix}_sweep ORDER BY f1 DESC, n_estimators LIMIT 1),
{prefix}_chosen AS MATERIALIZED (
  SELECT id, label, {pick("n")} AS score, {pick("l")} AS lim FROM {prefix}_scores, {prefix}_limits, {prefix}_best)"""
