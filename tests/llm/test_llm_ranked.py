"""Ranked search against full scoring and SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudspark.llm import queries, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    big_n, big_l = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for item, words in asked.items():
        found = []
        for i, c, n in held:
            m = 50 + (50 * n * big_n) // big_l
            score = 0
            for t in words:
                if tf := c[t]:
                    score += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                found.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [{}, {"chunk_rows": 20, "terms_at_once": 7}])
def test_ranked_search(spark, size):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["Über", "日本", "x_y", "été"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rng.choice([" ", ", ", "--"]).join(rng.choices(words, weights, k=rng.randint(1, 90)))) for i in range(300)]
    docs += [(None, docs[3][1]), (None, None), (400, ""), (401, " .,"), *docs[:20], (500, "w0 " * 5000), (501, docs[7][1])]
    items = [(f"q{i}", " ".join(rng.choices(words, k=rng.randint(1, 12))) + " nowhere") for i in range(12)]
    items += [("none", None), ("empty", ""), ("nothing", "nowhere else"), (None, "w1 w50"), items[0], ("q1", "w2 w3 W2")]
    clash = {c: F.lit(1) for c in ("n", "terms", "item", "rank", "score")}
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash).repartition(3)
    q = spark.createDataFrame(items, "item_id string, text string").withColumns(clash)
    found = ranked.ranked_search(d, q, top=7, **size)
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items, 7)
    assert ranked.ranked_search(d.limit(0), q).count() == 0
    assert ranked.ranked_search(d, q.limit(0)).count() == 0


def test_accumulators_skip_blocks():
    """With rare terms the accumulators carry the search: most blocks of long lists are never visited."""
    rng = np.random.default_rng(2)
    rows, common, rare = 8192, 0, 1
    holds = rng.random(rows) < 0.9
    special = np.sort(rng.choice(np.flatnonzero(holds), 60, replace=False))
    pairs = sorted([(d, common) for d in np.flatnonzero(holds)] + [(d, rare) for d in special])
    owner, term = np.array(pairs).T
    offsets = np.searchsorted(owner, np.arange(rows + 1))
    chunk = ranked.Chunk(np.arange(rows), np.zeros(rows, bool), np.full(rows, 9), term, np.ones(len(term), np.int64), offsets, rows, 9 * rows)
    weights = np.array([100, 5000])
    best, whole = ranked.Best(50), ranked.Best(50)
    visited = ranked.search_chunk(chunk, np.array([common, rare]), weights, best)
    assert ranked.search_chunk(chunk, np.array([common, rare]), weights, whole, short_share=0.0) >= visited
    assert best.ids.tolist() == whole.ids.tolist() == special[:50].tolist()
    assert visited <= 200 < chunk.n_blocks


def test_ranked_search_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    expected = con.sql(ranked.ORACLE).fetchall()
    found = queries.op12_ranked_search(spark, folder).select("item_id", "rank", "doc_id", "score").collect()
    assert len(expected) > 100 and sorted(map(tuple, found)) == sorted(expected)
