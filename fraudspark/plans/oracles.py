"""The same results in SQL, for a second engine to check the named queries against."""

from __future__ import annotations

from collections.abc import Sequence

from fraudspark.plans import forest_sql
from fraudspark.plans.catalog import CONFIG, FIXED_CLUSTERS, POOL_SIZES, RULE_LIMIT

TRANSACTIONS = """
WITH b AS (
  SELECT o_orderkey k, o_orderdate d, o_totalprice amt, o_orderpriority pr, o_orderstatus st,
         c_custkey ck, c_mktsegment seg, n_name nn, r_name rn
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
t AS (
  SELECT k AS transaction_id,
    CASE WHEN k%997=5 THEN 'N/A'
         ELSE concat(substr(CAST(d AS VARCHAR(30)),1,10), 'T', lpad(CAST(k%24 AS VARCHAR(2)),2,'0'), ':',
                     lpad(CAST(k%60 AS VARCHAR(2)),2,'0'), ':00', CASE WHEN k%3=0 THEN 'Z' ELSE '' END)
    END AS transaction_datetime,
    CASE WHEN k%11=4 THEN amt*4 ELSE amt END AS transaction_amount,
    CASE substr(pr,1,1) WHEN '1' THEN 'withdrawal' WHEN '2' THEN 'purchase' WHEN '3' THEN 'transfer'
         WHEN '4' THEN 'refund' ELSE 'payment' END AS transaction_type,
    CASE WHEN substr(pr,1,1)='1' AND k%4=0 THEN NULL WHEN k%101=0 THEN NULL ELSE seg END AS merchant_category,
    concat('merchant_', CAST(ck%20 AS VARCHAR(5))) AS merchant_name,
    CASE WHEN k%53=0 THEN NULL ELSE nn END AS transaction_city,
    CASE WHEN k%53=0 THEN NULL ELSE rn END AS transaction_country,
    st AS entry_mode, CAST(18+ck%63 AS INT) AS cardholder_age,
    CASE k%4 WHEN 0 THEN 'True' WHEN 1 THEN 'FALSE' WHEN 2 THEN '1' ELSE '0' END AS is_online,
    CASE WHEN k%29=0 THEN NULL WHEN k%31=0 THEN 'maybe' WHEN k%7<2 THEN 'true' ELSE 'false' END AS is_international,
    CASE WHEN k%11=4 OR k%211=0 THEN 'True' ELSE 'False' END AS is_fraud
  FROM b),
tx AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE transaction_id%41=0)
"""


def _boolean(column: str) -> str:
    return (
        f"CASE WHEN upper({column}) IN ('TRUE', '1') THEN TRUE "
        f"WHEN upper({column}) IN ('FALSE', '0') THEN FALSE END"
    )


_STAMP = (
    "TRY_CAST(CASE WHEN upper(trim(transaction_datetime)) NOT IN ('NA', 'N/A', 'NULL', 'NONE', '') "
    "THEN regexp_replace(transaction_datetime, 'Z$', '') END AS TIMESTAMP)"
)

_DEFAULT = """
(SELECT merchant_category FROM tx
 WHERE {where} transaction_type = 'withdrawal' AND merchant_category IS NOT NULL
 ORDER BY transaction_id, merchant_category LIMIT 1)
"""

CLEAN = f"""{TRANSACTIONS},
distinct_rows AS (SELECT DISTINCT * FROM tx WHERE transaction_country IS NOT NULL),
parsed AS (
  SELECT transaction_id, {_STAMP} AS transaction_datetime, transaction_amount, transaction_type,
    coalesce(CASE WHEN merchant_category IS NULL AND transaction_type = 'withdrawal'
                  THEN {_DEFAULT.format(where="transaction_country IS NOT NULL AND")}
                  ELSE merchant_category END, 'NA') AS merchant_category,
    coalesce(merchant_name, 'NA') AS merchant_name, coalesce(transaction_city, 'NA') AS transaction_city,
    transaction_country, coalesce(entry_mode, 'NA') AS entry_mode, cardholder_age,
    {_boolean("is_online")} AS is_online, {_boolean("is_international")} AS is_international,
    {_boolean("is_fraud")} AS is_fraud
  FROM distinct_rows),
clean AS (
  SELECT *, is_online AND is_fraud AS is_online_fraud, is_international AND is_fraud AS is_international_fraud
  FROM parsed WHERE is_international IS NOT NULL)
"""

# The categories of the driver tables.
CATEGORIES = {
    "transaction_type": ["payment", "purchase", "refund", "transfer", "withdrawal"],
    "merchant_category": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "NA"],
    "entry_mode": ["F", "O", "P"],
}
ONE_HOT_NAMES = [f"{c}_{v}" for c, values in CATEGORIES.items() for v in values]
ONE_HOT = ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, values in CATEGORIES.items() for v in values
)
TIME_PARTS = (
    "CAST(month(transaction_datetime) AS INT) AS transaction_month, "
    "CAST(dayofweek(transaction_datetime) + 1 AS INT) AS transaction_dayofweek, "
    "CAST(hour(transaction_datetime) AS INT) AS transaction_hour"
)
FEATURES = f"""{CLEAN},
feats AS (
  SELECT clean.* REPLACE (CAST(is_international AS INT) AS is_international, CAST(is_online AS INT) AS is_online),
         {TIME_PARTS}, {ONE_HOT}
  FROM clean)
"""
NUMERIC = [
    "transaction_amount",
    "cardholder_age",
    "is_online",
    "is_international",
    "transaction_month",
    "transaction_dayofweek",
    "transaction_hour",
    *ONE_HOT_NAMES,
]


def _quote(name: str) -> str:
    return f'"{name}"'


def _kendall(source: str, table: str, key: str, columns: list[str]) -> str:
    """tau-b per column pair from sums over the grid of distinct values of the two columns."""
    long = " UNION ALL ".join(
        f"SELECT {key} AS id, {i} AS pos, '{c}' AS col, CAST({_quote(c)} AS DOUBLE) AS v FROM {table}"
        for i, c in enumerate(columns)
    )
    return f"""{source},
long AS (SELECT * FROM ({long}) WHERE v IS NOT NULL),
points AS (
  SELECT l.col AS col_a, r.col AS col_b, l.v AS x, r.v AS y, CAST(count(*) AS HUGEINT) AS w
  FROM long l JOIN long r ON l.id = r.id AND l.pos < r.pos GROUP BY ALL),
xs AS (SELECT col_a, col_b, x, sum(w) AS w FROM points GROUP BY ALL),
ys AS (SELECT col_a, col_b, y, sum(w) AS w FROM points GROUP BY ALL),
grid AS (
  SELECT col_a, col_b, xs.x, ys.y, coalesce(points.w, 0) AS w
  FROM xs JOIN ys USING (col_a, col_b) LEFT JOIN points USING (col_a, col_b, x, y)),
lower_y AS (
  SELECT *, sum(w) OVER (PARTITION BY col_a, col_b, x ORDER BY y
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below FROM grid),
crossed AS (
  SELECT *, sum(below) OVER (PARTITION BY col_a, col_b, y ORDER BY x
                             ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM lower_y),
q AS (SELECT col_a, col_b, coalesce(sum(w * later), 0) AS q, sum(w) AS n, sum(w * (w - 1)) AS n3
      FROM crossed GROUP BY ALL),
n1 AS (SELECT col_a, col_b, sum(w * (w - 1)) AS n1 FROM xs GROUP BY ALL),
n2 AS (SELECT col_a, col_b, sum(w * (w - 1)) AS n2 FROM ys GROUP BY ALL)
SELECT col_a, col_b,
       round(CASE WHEN n * (n - 1) > n1 AND n * (n - 1) > n2
                  THEN CAST(n * (n - 1) - n1 - n2 + n3 - 4 * q AS DOUBLE)
                       / (sqrt(CAST(n * (n - 1) - n1 AS DOUBLE)) * sqrt(CAST(n * (n - 1) - n2 AS DOUBLE)))
             END, 9) AS tau
FROM q JOIN n1 USING (col_a, col_b) JOIN n2 USING (col_a, col_b)
"""


_DIMENSIONS = [
    "transaction_month",
    "transaction_dayofweek",
    "transaction_hour",
    "merchant_category",
    "transaction_type",
    "merchant_name",
]

_SCHEMA = {
    "transaction_id": "bigint",
    "transaction_datetime": "timestamp",
    "transaction_amount": "double",
    "transaction_type": "string",
    "merchant_category": "string",
    "merchant_name": "string",
    "transaction_city": "string",
    "transaction_country": "string",
    "entry_mode": "string",
    "cardholder_age": "int",
    "is_online": "boolean",
    "is_international": "boolean",
    "is_fraud": "boolean",
    "is_online_fraud": "boolean",
    "is_international_fraud": "boolean",
}
_RAW = list(_SCHEMA)[:13]
_TEXT = ["transaction_datetime", "is_online", "is_international", "is_fraud"] + [
    c for c, kind in _SCHEMA.items() if kind == "string"
]


def _describe(column: str) -> str:
    v = f"CAST({column} AS DOUBLE)"
    statistics = {
        "count": "CAST(count(v) AS DOUBLE)",
        "mean": "avg(v)",
        "std": "stddev_samp(v)",
        "min": "min(v)",
        "25%": "quantile_cont(v, 0.25)",
        "50%": "quantile_cont(v, 0.5)",
        "75%": "quantile_cont(v, 0.75)",
        "max": "max(v)",
    }
    return " UNION ALL ".join(
        f"SELECT '{column}' AS \"column\", '{name}' AS statistic, round({e}, 5) AS value "
        f"FROM (SELECT {v} AS v FROM tx)"
        for name, e in statistics.items()
    )


_RULED = f"""{CLEAN},
c AS (
  SELECT CAST(count(*) FILTER (WHERE p AND is_fraud) AS BIGINT) AS tp,
         CAST(count(*) FILTER (WHERE p AND NOT is_fraud) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE NOT p AND is_fraud) AS BIGINT) AS fn,
         CAST(count(*) FILTER (WHERE NOT p AND NOT is_fraud) AS BIGINT) AS tn
  FROM (SELECT is_fraud, transaction_amount > {RULE_LIMIT} AS p FROM clean))
"""
_CLASS_ROWS = {
    ("0", "precision"): "tn / (tn + fn)",
    ("0", "recall"): "tn / (tn + fp)",
    ("0", "f1"): "2 * tn / (2 * tn + fn + fp)",
    ("0", "support"): "tn + fp",
    ("1", "precision"): "tp / (tp + fp)",
    ("1", "recall"): "tp / (tp + fn)",
    ("1", "f1"): "2 * tp / (2 * tp + fp + fn)",
    ("1", "support"): "tp + fn",
    ("accuracy", "f1"): "(tp + tn) / n",
    ("accuracy", "support"): "n",
    ("macro avg", "precision"): "(tn / (tn + fn) + tp / (tp + fp)) / 2",
    ("macro avg", "recall"): "(tn / (tn + fp) + tp / (tp + fn)) / 2",
    ("macro avg", "f1"): "(2 * tn / (2 * tn + fn + fp) + 2 * tp / (2 * tp + fp + fn)) / 2",
    ("macro avg", "support"): "n",
    ("weighted avg", "precision"): "(tn / (tn + fn) * (tn + fp) + tp / (tp + fp) * (tp + fn)) / n",
    ("weighted avg", "recall"): "(tn / (tn + fp) * (tn + fp) + tp / (tp + fn) * (tp + fn)) / n",
    ("weighted avg", "f1"): (
        "(2 * tn / (2 * tn + fn + fp) * (tn + fp) + 2 * tp / (2 * tp + fp + fn) * (tp + fn)) / n"
    ),
    ("weighted avg", "support"): "n",
}

_SCALED = """
s AS (SELECT avg(transaction_amount) AS ma, stddev_samp(transaction_amount) AS sa,
             avg(cardholder_age) AS mg, stddev_samp(cardholder_age) AS sg FROM clean),
z AS (SELECT transaction_id, cardholder_age, (transaction_amount - ma) / sa AS a, (cardholder_age - mg) / sg AS g
      FROM clean, s)
"""


def _fraction_sample(columns: str, fraction: float) -> str:
    return f"""{CLEAN},
keyed AS (
  SELECT *, CAST('0x' || substr(md5('42:' || CAST(transaction_id AS VARCHAR)), 1, 8) AS BIGINT) AS sample_key
  FROM clean)
SELECT {columns} FROM keyed WHERE sample_key < {fraction} * 4294967296
"""


def _hash_sample(columns: str, fraction: float, size: int) -> str:
    return f"""{CLEAN},
keyed AS (
  SELECT *, CAST('0x' || substr(md5('42:' || CAST(transaction_id AS VARCHAR)), 1, 8) AS BIGINT) AS sample_key
  FROM clean)
SELECT {columns} FROM keyed
WHERE sample_key < least({fraction}, {2 * size + 1000} / (SELECT CAST(count(*) AS DOUBLE) FROM clean)) * 4294967296
ORDER BY sample_key, transaction_id LIMIT {size}
"""


def _index(column: str) -> str:
    return (
        f"(SELECT {column} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS INT) AS i, "
        f"CAST(count(*) OVER () + 1 AS INT) AS n FROM clean GROUP BY {column})"
    )


_INDEX_JOINS = " ".join(f"JOIN {_index(c)} AS j_{c} ON clean.{c} = j_{c}.v" for c in CATEGORIES)

_SEPARATED = f"""{CLEAN},
g AS (SELECT transaction_id, is_fraud, transaction_id % 4 AS grp, transaction_amount + (transaction_id % 4) * CAST(1e8 AS DOUBLE) AS amount,
             cardholder_age + (transaction_id % 4 % 2) * CAST(3e4 AS DOUBLE) AS age FROM clean),
gs AS (SELECT avg(amount) AS ma, stddev_samp(amount) AS sa, avg(age) AS mg, stddev_samp(age) AS sg, sign(corr(amount, age)) AS r FROM g),
gp AS (SELECT g.*, ((amount - ma) / sa + r * (age - mg) / sg) / sqrt(2.0) AS pc1, ((amount - ma) / sa - r * (age - mg) / sg) / sqrt(2.0) AS pc2
       FROM g, gs),
numbers AS (SELECT grp, CAST(row_number() OVER (ORDER BY avg(pc1), avg(pc2)) - 1 AS INT) AS cluster_labels FROM gp GROUP BY grp),
labelled AS (SELECT gp.*, cluster_labels FROM gp JOIN numbers USING (grp))
"""
_GROWN = ",\n".join(
    [
        FEATURES.rstrip(),
        forest_sql.vectors("f", "feats", NUMERIC, CONFIG.label_column, CONFIG.id_column),
        forest_sql.forest("f", "f_m", len(NUMERIC), max(CONFIG.tree_counts), CONFIG.seed),
    ]
)
_SCORED_FOREST = f"{_GROWN},\n{forest_sql.scores('f', 'f_m', CONFIG.tree_counts)}"
_SWEPT = f"{_SCORED_FOREST},\n{forest_sql.sweep('f', CONFIG.tree_counts, CONFIG.contamination)}"
_CHOSEN = f"{_SWEPT},\n{forest_sql.chosen('f', CONFIG.tree_counts)}"
_FLAGS = (
    "CASE WHEN score IS NULL THEN NULL WHEN score > lim THEN -1 ELSE 1 END AS predictions, "
    "CASE WHEN score IS NULL THEN NULL WHEN score > lim THEN 1 ELSE 0 END AS df_pred"
)


def _pool_sweep(sizes: Sequence[int]) -> str:
    """The sweep of a forest for each pool of least digests; thresholds come from the pool's own rows."""
    counts, trees = CONFIG.tree_counts, max(CONFIG.tree_counts)
    parts = [FEATURES.rstrip(), forest_sql.vectors("f", "feats", NUMERIC, CONFIG.label_column, CONFIG.id_column)]
    for i, size in enumerate(sizes):
        p, first = f"p{i}", i * trees
        parts.append(f"""{p}_m AS MATERIALIZED (
  SELECT * FROM f_m ORDER BY CAST('0x' || substr(md5('{CONFIG.seed}:' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT), id LIMIT {size})""")
        parts.append(forest_sql.forest(p, f"{p}_m", len(NUMERIC), trees, CONFIG.seed, first))
        parts.append(forest_sql.scores(p, "f_m", counts, first))
        share = f"CAST({1.0 - CONFIG.contamination!r} AS DOUBLE)"
        limits = ", ".join(f"quantile_cont(n{n}, {share}) AS l{n}" for n in counts)
        limits = f"SELECT {limits} FROM {p}_scores WHERE id IN (SELECT id FROM {p}_m)"
        parts.append(forest_sql.sweep(p, counts, CONFIG.contamination, limits))
    rows = " UNION ALL ".join(f"SELECT CAST({size} AS INT) AS pool, {forest_sql.SWEEP_COLUMNS} FROM p{i}_sweep" for i, size in enumerate(sizes))
    return ",\n".join(parts) + "\n" + rows


ORACLES: dict[str, str] = {
    "raw_transactions": f"{TRANSACTIONS} SELECT * FROM tx",
    "csv_round_trip": f"""{TRANSACTIONS} SELECT * REPLACE (nullif(transaction_datetime, 'N/A') AS transaction_datetime)
        FROM tx""",
    "parquet_round_trip": f"""{TRANSACTIONS}
        SELECT * REPLACE (nullif(transaction_datetime, 'N/A') AS transaction_datetime) FROM tx""",
    "csv_safe_columns": f"{CLEAN} SELECT * FROM clean",
    "profile_numeric": TRANSACTIONS
    + " UNION ALL ".join(_describe(c) for c in ("transaction_id", "transaction_amount", "cardholder_age")),
    "profile_schema": CLEAN
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{kind}' AS type, CAST(count({c}) AS BIGINT) AS non_null FROM clean"
        for c, kind in _SCHEMA.items()
    ),
    "profile_nulls": TRANSACTIONS
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM tx" for c in _RAW
    ),
    "joint_nulls": f"""{TRANSACTIONS}
        SELECT CAST(count(*) AS BIGINT) AS joint_nulls FROM tx
        WHERE transaction_city IS NULL AND transaction_country IS NULL""",
    "preview": f"{TRANSACTIONS} SELECT * FROM tx ORDER BY transaction_id LIMIT 5",
    "dedup_rows": f"{TRANSACTIONS} SELECT DISTINCT * FROM tx",
    "required_columns": f"{TRANSACTIONS} SELECT * FROM tx WHERE transaction_country IS NOT NULL",
    "category_default": f"""{TRANSACTIONS}
        SELECT transaction_id, transaction_type,
               CASE WHEN merchant_category IS NULL AND transaction_type = 'withdrawal'
                    THEN {_DEFAULT.format(where="")} ELSE merchant_category END AS merchant_category FROM tx""",
    "category_default_all": f"""{TRANSACTIONS}
        SELECT transaction_id, transaction_type,
               coalesce(merchant_category, {_DEFAULT.format(where="")}) AS merchant_category FROM tx""",
    "fill_na_strings": f"{TRANSACTIONS} SELECT * REPLACE ("
    + ", ".join(f"coalesce({c}, 'NA') AS {c}" for c in _TEXT)
    + ") FROM tx",
    "parse_timestamps": f"{TRANSACTIONS} SELECT transaction_id, {_STAMP} AS transaction_datetime FROM tx",
    "parse_booleans": f"""{TRANSACTIONS} SELECT transaction_id, {_boolean("is_fraud")} AS is_fraud,
        {_boolean("is_online")} AS is_online, {_boolean("is_international")} AS is_international FROM tx""",
    "drop_invalid_flags": f"""{TRANSACTIONS}
        SELECT * FROM (SELECT * REPLACE ({_boolean("is_international")} AS is_international) FROM tx)
        WHERE is_international IS NOT NULL""",
    "derived_flags": f"""{TRANSACTIONS}
        SELECT transaction_id, o AND f AS is_online_fraud, i AND f AS is_international_fraud
        FROM (SELECT transaction_id, {_boolean("is_online")} AS o, {_boolean("is_international")} AS i,
                     {_boolean("is_fraud")} AS f FROM tx)""",
    "clean_transactions": f"{CLEAN} SELECT * FROM clean",
    "time_parts": f"{CLEAN} SELECT transaction_id, {TIME_PARTS} FROM clean",
    "time_parts_monday_first": f"""{CLEAN}
        SELECT transaction_id, CAST(month(transaction_datetime) AS INT) AS transaction_month,
               CAST(isodow(transaction_datetime) - 1 AS INT) AS transaction_dayofweek,
               CAST(hour(transaction_datetime) AS INT) AS transaction_hour FROM clean""",
    "flags_as_int": f"""{CLEAN} SELECT transaction_id, CAST(is_international AS INT) AS is_international,
        CAST(is_online AS INT) AS is_online FROM clean""",
    "one_hot": f"{CLEAN} SELECT transaction_id, {ONE_HOT} FROM clean",
    "string_index": f"{CLEAN} SELECT transaction_id, "
    + ", ".join(f"CAST(j_{c}.i AS DOUBLE) AS {c}_idx" for c in CATEGORIES)
    + f" FROM clean {_INDEX_JOINS}",
    "one_hot_sparse": f"{CLEAN} SELECT transaction_id, "
    + ", ".join(f"j_{c}.i AS {c}_slot, j_{c}.n AS {c}_size" for c in CATEGORIES)
    + f" FROM clean {_INDEX_JOINS}",
    "feature_table": f"{FEATURES} SELECT * FROM feats",
    "numeric_features": f"{FEATURES} SELECT transaction_id, {', '.join(_quote(c) for c in NUMERIC)} FROM feats",
    "fraud_by_hour": f"""{FEATURES}
        SELECT transaction_hour, CAST(sum(CAST(is_fraud AS INT)) AS BIGINT) AS fraud_count
        FROM feats WHERE transaction_hour IS NOT NULL GROUP BY transaction_hour""",
    "fraud_by_dimension": FEATURES
    + " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, "
        f"CAST(sum(CAST(is_fraud AS INT)) AS BIGINT) AS fraud_count FROM feats WHERE {d} IS NOT NULL GROUP BY {d}"
        for d in _DIMENSIONS
    ),
    "amount_age_sample": _fraction_sample("cardholder_age, transaction_amount", 0.05),
    "kendall_amount_age": _kendall(CLEAN, "clean", "transaction_id", ["transaction_amount", "cardholder_age"]),
    "kendall_fraud_amount": _kendall(CLEAN, "clean", "transaction_id", ["is_fraud", "transaction_amount"]),
    "kendall_matrix": _kendall(FEATURES, "feats", "transaction_id", NUMERIC),
    "kendall_events": """
        WITH s AS (
          SELECT CAST(sign(a.user_id - b.user_id) AS BIGINT) AS sx, CAST(sign(a.value - b.value) AS BIGINT) AS sy
          FROM events a JOIN events b ON a.event_id < b.event_id),
        tau AS (SELECT round(sum(sx * sy) / (sqrt(sum(sx * sx)) * sqrt(sum(sy * sy))), 9) AS tau FROM s)
        SELECT 'user_id' AS col_a, 'value' AS col_b, tau FROM tau
        UNION ALL SELECT 'value', 'user_id', tau FROM tau
        UNION ALL SELECT 'user_id', 'user_id', 1.0 UNION ALL SELECT 'value', 'value', 1.0""",
    "feature_vector": f"""{CLEAN} SELECT transaction_id, transaction_amount AS feature_0,
        CAST(cardholder_age AS DOUBLE) AS feature_1 FROM clean""",
    "standardised": f"""{CLEAN}, {_SCALED}
        SELECT transaction_id, round(a, 6) AS amount_scaled, round(g, 6) AS age_scaled FROM z""",
    "forest_scaled_features": f"""{CLEAN}, {_SCALED}
        SELECT transaction_id, round(a, 6) AS transaction_amount, round(g, 6) AS cardholder_age FROM z""",
    "pca_variance": f"""{CLEAN}, r AS (SELECT abs(corr(transaction_amount, cardholder_age)) AS r FROM clean)
        SELECT 1 AS component, round((1 + r) / 2, 6) AS ratio FROM r
        UNION ALL SELECT 2, round((1 - r) / 2, 6) FROM r""",
    "pca_loadings": f"""{CLEAN},
        r AS (SELECT sign(corr(transaction_amount, cardholder_age)) AS r FROM clean),
        l AS (SELECT r, round(sqrt(0.5), 6) AS v FROM r)
        SELECT 'transaction_amount' AS feature, 1 AS component, v AS loading FROM l
        UNION ALL SELECT 'cardholder_age', 1, r * v FROM l
        UNION ALL SELECT 'transaction_amount', 2, v FROM l
        UNION ALL SELECT 'cardholder_age', 2, -r * v FROM l""",
    "pca_projection": f"""{CLEAN}, {_SCALED},
        r AS (SELECT sign(corr(transaction_amount, cardholder_age)) AS r FROM clean)
        SELECT transaction_id, round(abs(a + r * g) / sqrt(2.0), 4) AS pc1, round(abs(a - r * g) / sqrt(2.0), 4) AS pc2
        FROM z, r""",
    "kmeans_coverage": f"""{FEATURES}
        SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS unlabelled,
               CAST({CONFIG.n_clusters} AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS out_of_range
        FROM feats WHERE transaction_month IS NOT NULL""",
    "kmeans_profile_totals": f"""{FEATURES}
        SELECT round(sum(transaction_amount), 2) AS amount, round(CAST(sum(cardholder_age) AS DOUBLE), 2) AS age,
               CAST(sum(CAST(is_fraud AS INT)) AS BIGINT) AS frauds
        FROM feats WHERE transaction_month IS NOT NULL""",
    "malformed_lines": """
        WITH l AS (SELECT c_mktsegment AS segment, round(c_acctbal, 2) AS balance,
                          c_custkey % 17 = 3 OR c_custkey % 19 = 5 OR c_custkey % 23 = 7 AS bad FROM customer)
        SELECT segment, CAST(count(*) AS BIGINT) AS lines, round(sum(balance), 2) AS balance FROM l WHERE NOT bad GROUP BY segment
        UNION ALL SELECT 'malformed', CAST(count(*) AS BIGINT), NULL FROM l WHERE bad""",
    "partitioned_output": f"""{FEATURES}
        SELECT transaction_hour, CAST(count(*) AS BIGINT) AS transactions, CAST(count(*) FILTER (WHERE is_fraud) AS BIGINT) AS frauds
        FROM feats WHERE transaction_month = 3 GROUP BY transaction_hour""",
    "separated_labels": f"{_SEPARATED} SELECT transaction_id, cluster_labels FROM labelled",
    "separated_centroids": f"""{_SEPARATED}
        SELECT cluster_labels AS cluster, CAST(1 AS INT) AS component, round(avg(pc1), 4) AS value FROM labelled GROUP BY 1
        UNION ALL SELECT cluster_labels, CAST(2 AS INT), round(avg(pc2), 4) FROM labelled GROUP BY 1""",
    "separated_profile": f"""{_SEPARATED}
        SELECT cluster_labels, round(avg(amount), 4) AS mean_amount, round(avg(age), 4) AS mean_age,
               CAST(sum(CAST(is_fraud AS INT)) AS BIGINT) AS fraud_sum FROM labelled GROUP BY 1""",
    "separated_sample": f"""{_SEPARATED}
        SELECT round(pc1, 4) AS "PC1", round(pc2, 4) AS "PC2", cluster_labels FROM labelled
        WHERE CAST('0x' || substr(md5('{CONFIG.seed}:' || CAST(transaction_id AS VARCHAR)), 1, 8) AS BIGINT) < 0.05 * 4294967296""",
    "separated_silhouette": f"""{_SEPARATED},
        c AS (SELECT grp AS k, count(*) AS n, sum(pc1) AS t1, sum(pc2) AS t2, sum(pc1 * pc1 + pc2 * pc2) AS tq FROM labelled GROUP BY 1),
        d AS (SELECT transaction_id, l.grp = c.k AS own,
                     (c.n * (pc1 * pc1 + pc2 * pc2) - 2 * (pc1 * t1 + pc2 * t2) + tq) / (CASE WHEN l.grp = c.k THEN n - 1 ELSE n END) AS d
              FROM labelled l, c),
        m AS (SELECT transaction_id, min(d) FILTER (WHERE own) AS ao, min(d) FILTER (WHERE NOT own) AS bo FROM d GROUP BY 1)
        SELECT round(avg((bo - ao) / greatest(ao, bo)), 6) AS silhouette FROM m""",
    "rescored_transactions": f"""{_CHOSEN} SELECT feats.*, round(score, 6) AS anomaly_score, {_FLAGS}
        FROM feats LEFT JOIN f_chosen ON transaction_id = id""",
    "anomaly_score_in_sql": f"{_CHOSEN} SELECT id AS transaction_id, round(score, 6) AS anomaly_score FROM f_chosen",
    "iforest_nodes": f"{_GROWN} SELECT {forest_sql.NODE_COLUMNS} FROM f_nodes",
    "iforest_scores": f"{_SCORED_FOREST} SELECT id AS transaction_id, "
    + ", ".join(f"round(n{n}, 6) AS n{n}" for n in CONFIG.tree_counts)
    + " FROM f_scores",
    "iforest_sweep": f"{_SWEPT} SELECT {forest_sql.SWEEP_COLUMNS} FROM f_sweep",
    "iforest_predictions": f"{_CHOSEN} SELECT id AS transaction_id, round(score, 6) AS anomaly_score, {_FLAGS} FROM f_chosen",
    "iforest_report": f"""{_CHOSEN},
        c AS (SELECT count(*) FILTER (WHERE score > lim AND label) AS tp, count(*) FILTER (WHERE score > lim AND NOT label) AS fp,
                     count(*) FILTER (WHERE score <= lim AND label) AS fn, count(*) FILTER (WHERE score <= lim AND NOT label) AS tn
              FROM f_chosen),
        n AS (SELECT *, tp + fp + fn + tn AS n FROM c) """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS class, '{m}' AS metric, round(CAST({e} AS DOUBLE), 6) AS value FROM n"
        for (c, m), e in _CLASS_ROWS.items()
    ),
    "iforest_pool_sweep": _pool_sweep(POOL_SIZES),
    "scored_anomalies": f"""{_CHOSEN} SELECT feats.*, round(score, 6) AS anomaly_score, {_FLAGS}
        FROM feats LEFT JOIN f_chosen ON transaction_id = id""",
    "quarantined_rows": f"{FEATURES} SELECT * FROM feats WHERE transaction_month IS NULL",
    "silhouette_fixed_clusters": f"""{CLEAN}, {_SCALED},
        p AS (SELECT transaction_id, cardholder_age % {FIXED_CLUSTERS} AS k, a, g FROM z),
        c AS (SELECT k, count(*) AS n, sum(a) AS ta, sum(g) AS tg, sum(a * a + g * g) AS tq FROM p GROUP BY k),
        d AS (
          SELECT transaction_id, p.k = c.k AS own,
                 (c.n * (a * a + g * g) - 2 * (a * ta + g * tg) + tq) / (CASE WHEN p.k = c.k THEN n - 1 ELSE n END) AS d
          FROM p, c),
        m AS (SELECT transaction_id, min(d) FILTER (WHERE own) AS ao, min(d) FILTER (WHERE NOT own) AS bo
              FROM d GROUP BY transaction_id)
        SELECT round(avg((bo - ao) / greatest(ao, bo)), 6) AS silhouette FROM m""",
    "cluster_profile": f"""{CLEAN}
        SELECT cardholder_age % {FIXED_CLUSTERS} AS cluster_labels, round(avg(transaction_amount), 6) AS mean_amount,
               round(avg(cardholder_age), 6) AS mean_age, CAST(sum(CAST(is_fraud AS INT)) AS BIGINT) AS fraud_sum
        FROM clean GROUP BY 1""",
    "rule_confusion": f"""{_RULED}
        SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
               round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""",
    "class_report": f"{_RULED}, n AS (SELECT *, tp + fp + fn + tn AS n FROM c) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS class, '{m}' AS metric, round(CAST({e} AS DOUBLE), 6) AS value FROM n"
        for (c, m), e in _CLASS_ROWS.items()
    ),
    "label_totals": f"""{CLEAN}
        SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE is_fraud) AS BIGINT) AS positives,
               count(*) FILTER (WHERE is_fraud) = 0 AS no_positives FROM clean""",
    "training_pool": _hash_sample("transaction_amount, cardholder_age", 0.2, 1000),
    "contamination_flags": f"""{CLEAN}, q AS (SELECT quantile_cont(transaction_amount, 0.85) AS q FROM clean)
        SELECT transaction_id, CASE WHEN transaction_amount > q THEN -1 ELSE 1 END AS predictions,
               CASE WHEN transaction_amount > q THEN 1 ELSE 0 END AS df_pred FROM clean, q""",
    "sql_on_clean_view": f"""{CLEAN}
        SELECT transaction_country, entry_mode, CAST(count(*) AS BIGINT) AS transactions,
               CAST(count(*) FILTER (WHERE is_fraud) AS BIGINT) AS frauds, round(sum(transaction_amount), 2) AS amount
        FROM clean GROUP BY ALL""",
}
