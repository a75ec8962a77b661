"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudspark.llm import queries, variants


def brute(rows, every=97):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                count[run] += 1
    n = {w: c for w, c in count.items() if c >= 3}
    holes = {}
    for w in n:
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + "\0" + w[i + 1 :]), set()).add(w)
    near = {w: set() for w in n}
    for (i, hole), group in holes.items():
        cut = hole[:i] + hole[i + 1 :]
        for w in group:
            near[w] |= group - {w}
            if cut in n:
                near[w].add(cut)
                near[cut].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n.get(form[w]), root)
    return out


def result(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@pytest.mark.parametrize("filter_bytes", [variants.FILTER_BYTES, 64])
def test_variants_of_random_words(spark, filter_bytes):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdéÀ") for _ in range(rng.randint(4, 8))) for _ in range(150)]
    for w in list(base):
        at = rng.randrange(len(w))
        base += [w[:at] + rng.choice("abß") + w[at:], w[:at] + w[at + 1 :]]
    base += ["z" * 70, "z" * 69, "z" * 64, "z" * 63, "Z" * 65]
    weights = [rng.randint(1, 30) for _ in base]
    rows = [(i, rng.choice(" ,1÷\n").join(rng.choices(base, weights, k=40))) for i in range(200)]
    rows += [(None, None), (1, ""), (None, "zzzzz zzzzz zzzzz"), (2, "ab " * 5), *rows[:3]]
    rows.append((9, "z" * 400 + " " + " ".join(["y" * 3000] * 3)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("word", "n", "other", "root")}).repartition(3)
    expected = brute(rows)
    assert len(expected) > 300 and any(v[3] for v in expected.values())
    assert result(variants.spelling_variants(docs, filter_bytes=filter_bytes)) == expected
    assert result(variants.spelling_variants(docs.limit(0))) == {}


def test_variants_of_the_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in queries.table(spark, folder, "documents").collect()]
    assert result(queries.op11_spelling_variants(spark, folder)) == brute(rows)


def test_filters_stay_small_and_seldom_wrong():
    plan = variants._rounds({5: 10**6, 6: 10, 64: 3}, 1 << 16)
    assert all(sum(size for _, _, size in r.values()) * 64 <= (1 << 16) + 64 * len(r) for r in plan)
    assert sum(5 in r for r in plan) == -(-(10**6) * 16 // (8 << 16))
    key = np.random.default_rng(1).integers(0, 2**63, 200_000).astype(np.uint64)
    bits = np.zeros(8 * (10_000 * 16 // 512), np.uint64)
    block, other = variants.places(key[:10_000], len(bits) // 8)
    for i in range(variants.PROBES):
        bit = variants.probe_bits(other, i)
        np.bitwise_or.at(bits, (block * np.uint64(8) + (bit >> np.uint64(6))).astype(int), np.uint64(1) << (bit & np.uint64(63)))
    assert len(variants.passes(bits, key[:10_000])) == 10_000
    assert len(variants.passes(bits, key[10_000:])) < 0.005 * 190_000
