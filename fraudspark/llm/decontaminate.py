"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every text becomes hashes of ``gram`` consecutive words; of each run of window - gram + 1 hashes the
least is kept, so a shared span of ``window`` words always shares a kept hash. The documents' kept
hashes travel with the words around them, are joined with the benchmark's, and the hits are extended
to whole windows, which are compared word by word. One scan of the documents feeds all of it; if the
benchmark's hashes fit Spark's broadcast threshold no document row is shuffled before it has a hit,
else both sides are shuffled by the hash.

Defined results: null texts, ids of items and empty texts have no words; an item of fewer words than
``window`` is one window of its own length; repeated documents are rows of their own, repeated items
count once by their id; an empty benchmark hits nothing; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark.session import materialize

WINDOW = 10
GRAM = 5
POSITION_BITS = 28  # a kept hash carries its place in the low bits: texts up to 268 million words

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, letters and all characters beyond ASCII, A-Z in lower case."""
    parts = F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), BETWEEN_WORDS)
    return F.filter(parts, lambda w: w != "")


def _numbers(first: Column, last: Column) -> Column:
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _gram_hash(w: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(w, at + k) for k in range(size)])


def _print_of(kept: Column) -> Column:
    return F.shiftright(kept, POSITION_BITS)


def _placed_hashes(w: Column, gram: int) -> Column:
    """The hash of each gram with its place in the low bits."""
    place = (1 << POSITION_BITS) - 1
    return F.transform(
        _numbers(F.lit(0), F.size(w) - gram),
        lambda i: _gram_hash(w, i, gram).bitwiseAND(F.lit(~place)).bitwiseOR(i.cast("long")),
    )


def _least_of_runs(h: Column, run: int) -> Column:
    """The least of every ``run`` neighbours, each once."""
    runs = F.transform(_numbers(F.lit(1), F.size(h) - run + 1), lambda i: F.array_min(F.slice(h, i, run)))
    return F.array_distinct(runs)


def benchmark_windows(items: DataFrame, item_column: str, text_column: str, window: int) -> DataFrame:
    """Distinct (item_id, m, words): each window of an item, joined by spaces."""
    w = F.col("w")
    rows = items.where(F.col(item_column).isNotNull()).select(
        F.col(item_column).cast("string").alias("item_id"), words(F.col(text_column)).alias("w")
    )
    m = F.least(F.size(w), F.lit(window))
    return (
        rows.where(F.size(w) > 0)
        .select("item_id", m.alias("m"), F.explode(F.transform(_numbers(F.lit(1), F.size(w) - m + 1), lambda i: F.array_join(F.slice(w, i, m), " "))).alias("window"))
        .distinct()
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the hit spans."""
    found = materialize(benchmark_windows(benchmark, item_column, item_text_column, window), "windows")
    short = [r.m for r in found.where(F.col("m") < window).select("m").distinct().collect()]  # below 10 numbers

    # the benchmark's hashes: of whole windows the least gram, of short items the whole
    w = F.split("window", " ")
    run = window - gram + 1
    least = F.array_min(F.transform(F.sequence(F.lit(0), F.lit(run - 1)), lambda i: F.shiftright(_gram_hash(w, i, gram), POSITION_BITS)))
    prints = found.where(F.col("m") == window).select(F.col("m"), least.alias("print"))
    for m in short:
        hashed = F.shiftright(_gram_hash(w, F.lit(0), m), POSITION_BITS)
        prints = prints.unionByName(found.where(F.col("m") == m).select("m", hashed.alias("print")))
    prints = materialize(prints.distinct(), "prints")

    # one scan: a marker for each document and its kept hashes with the words around them
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        words(F.col(text_column)).alias("w"),
    )
    rows = rows.withColumn("h", _placed_hashes(F.col("w"), gram)).withColumn("kept", _least_of_runs(F.col("h"), run))
    w, place = F.col("w"), (1 << POSITION_BITS) - 1

    def entry(print_: Column, m: int | Column, at: Column, around: Column, first: Column) -> Column:
        return F.struct(
            print_.alias("print"), F.lit(m).alias("m"), at.cast("int").alias("at"), around.alias("around"), first.cast("int").alias("first")
        )

    def around(x: Column) -> Column:
        at = x.bitwiseAND(F.lit(place)).cast("int")
        first = F.greatest(at - (window - gram), F.lit(0))
        return entry(_print_of(x), window, at, F.array_join(F.slice(w, first + 1, at + window - first), " "), first)

    # the marker's print spreads markers over the tasks of a shuffled join
    marker = F.array(entry(F.xxhash64("row"), 0, F.size("w"), F.lit(None).cast("string"), F.lit(-1)))
    parts = [marker, F.transform("kept", around)]

    def brief_windows(m: int) -> Column:
        def at(i: Column) -> Column:
            hashed = F.shiftright(_gram_hash(w, i, m), POSITION_BITS)
            return entry(hashed, m, i, F.array_join(F.slice(w, i + 1, m), " "), i)

        return F.transform(_numbers(F.lit(0), F.size(w) - m), at)

    parts += [brief_windows(m) for m in short]
    emitted = rows.select("row", "doc_id", F.explode(F.concat(*parts)).alias("e")).select("row", "doc_id", "e.*")
    hit = prints.withColumn("hit", F.lit(True))
    scanned = materialize(
        emitted.join(hit, ["print", "m"], "left").where((F.col("m") == 0) | F.col("hit")).drop("print", "hit"), "hits"
    )

    # extension: the windows around each hit, compared as words
    a = F.split("around", " ")
    start = F.explode(_numbers(F.greatest(F.col("at") - (window - gram), F.lit(0)), F.col("at")))
    whole = (
        scanned.where(F.col("m") == window)
        .select("row", "first", a.alias("a"), start.alias("start"))
        .where(F.col("start") - F.col("first") + window <= F.size("a"))
        .select("row", "start", F.array_join(F.slice("a", F.col("start") - F.col("first") + 1, window), " ").alias("window"), F.lit(window).alias("m"))
    )
    brief = scanned.where(F.col("m").between(1, window - 1)).select("row", F.col("at").alias("start"), F.col("around").alias("window"), "m")
    tried = whole.distinct().unionByName(brief)
    same = materialize(tried.join(found.select("window", "m").distinct(), ["window", "m"]), "shared")

    reached = F.aggregate(
        F.col("spans"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["to"]), F.lit(0))).alias("n"),
            F.greatest(acc["to"], s["end"]).alias("to"),
        ),
    )["n"]
    covered = (
        same.groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("m")).alias("end")))).alias("spans"))
        .withColumn("n_hit", reached.cast("long"))
    )
    items = (
        same.select("row", "window", "m").distinct().join(found, ["window", "m"]).select("row", "item_id").distinct()
        .groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    )
    return (
        scanned.where(F.col("m") == 0)
        .select("row", "doc_id", F.col("at").cast("long").alias("n_words"))
        .join(covered, "row", "left")
        .join(items, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        )
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lengths WHERE len(w) >= m)),
h AS (SELECT doc_id, i, dw.m, g, item_id FROM dw JOIN bw USING (m, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM h) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS s
        FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(its.s, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
