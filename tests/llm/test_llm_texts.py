"""Text operators on small tables: brute force, odd rows, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fraudspark.llm import decontaminate, jaccard, language, lines, lm, pack, quality, queries, shard, toxicity
from fraudspark.session import with_setting

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    plain = [sentence(rng, rng.randint(20, 60)) for _ in range(30)]
    near = plain[0].split()
    near[-1] = "changed"
    texts = [
        None, "", " \n\t ", "one", "Two words", "\n\n", "a line of twelve\nshort\na line of twelve",
        *plain, " ".join(near), plain[1], plain[1], plain[2] + "\n" + plain[3],
        " ".join(sentence(rng, 400) for _ in range(15)),
        "été über $$ 日本語 <|endoftext|> " + plain[4], "12 34 !!", "an almost equal line here\nan almost equal lime here",
    ]
    found = [(i, t, "en" if i % 2 else None, "s") for i, t in enumerate(texts)]
    return [*found, found[8], found[8], (None, "no id at all, but a text", "en", "s")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """Extra columns clash with names that operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = "row score key n set word h kept spans n_lines size shard bucket item length y first".split()
    return df.withColumns({c: F.lit("x") for c in clash}).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < -1")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, None) for i in range(40)], "doc_id long, quality int, toxic int")


def spaced(text):
    return (text or "").encode().lower().split()


def test_packing(spark, docs, rows, none):
    from tokenizers import Tokenizer

    path = queries.bpe_path()
    found = pack.pack(docs, path, capacity=64, keep_ids=True, cell_pieces=8).toPandas()
    whole = Tokenizer.from_file(path)
    expected = Counter()
    for i, text, *_ in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        parts = [ids[max(0, to - 64) : to] for to in range(len(ids), 0, -64)][::-1]  # full ones from the end
        at = 0
        for piece, part in enumerate(parts):
            crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            expected[(i, piece, at, len(part), crc, tuple(part))] += 1
            at += len(part)
    got = Counter(
        (None if math.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids))
        for r in found.itertuples()
    )
    assert got == expected
    for _, bin_ in found.sort_values("offset").groupby("sequence_id"):
        assert bin_["length"].sum() <= 64
        assert (bin_["length"].cumsum() - bin_["length"] == bin_["offset"]).all()
    assert found["sequence_id"].nunique() <= found["length"].sum() / 64 * 1.1 + 1
    assert pack.pack(none, path).count() == 0


def test_packing_keeps_batches_and_workers_small(spark, docs, monkeypatch):
    """Texts reach the tokenizer in small batches, the session keeps its own; plain texts load no second tokenizer."""
    import pyarrow as pa

    from fraudspark.llm import tokens
    from fraudspark.llm.text import blocks

    key, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, pack.materialize
    before = spark.conf.get(key)
    monkeypatch.setattr(pack, "materialize", lambda df, name: (seen.setdefault(name, int(spark.conf.get(key))), write(df, name))[1])
    assert pack.pack(docs, queries.bpe_path()).count() >= docs.count()
    assert seen["pieces"] <= 1000 and spark.conf.get(key) == before
    tokens.exact.cache_clear()
    for block in blocks(pa.array(["plain words", "more\nof them", None, ""])):
        ids, starts = tokens.encode_block(block, queries.bpe_path())
        assert len(starts) == 5 and len(ids)
    assert tokens.exact.cache_info().currsize == 0


def test_pipeline_stages_keep_batches_small(spark, docs, labels, monkeypatch, tmp_path):
    """Whole texts reach Python in small batches in the stages of toxicity and near copies; the session keeps its own."""
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    before = spark.conf.get(key)

    def noted(write):
        return lambda df, name: (seen.setdefault(name, int(spark.conf.get(key))), write(df, name))[1]

    for module in (corpus_pipeline, jaccard):
        monkeypatch.setattr(module, "materialize", noted(module.materialize))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == docs.count()  # no label says toxic
    assert jaccard.jaccard_components(docs).count() == docs.count()
    assert all(seen[x] <= 1000 for x in ("not_toxic", "shingle_sets", "star_sets", "star_links", "crossing_sets", "more_links"))
    assert spark.conf.get(key) == before


def test_kept_rows_go_through_python_once(spark, labels):
    """The text is not in the kept struct as well on its way; rows come back whole and in their order of columns."""
    rows = [(f"text number {i} été", i, None if i % 3 else "x", i % 2 == 0) for i in range(12)] + [(None, 3, None, None)]
    docs = spark.createDataFrame(rows, "text string, doc_id long, `a.b` string, row boolean")
    found = toxicity.toxicity(docs, labels, keep_rows=True)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "struct(text" not in plan.split("MapInArrow", 1)[1]
    assert found.select("row.*").schema == docs.schema
    assert Counter(found.select("row.*").collect()) == Counter(docs.collect())


def test_frequent_shingles_are_counted_over_many_small_batches(spark):
    """A shingle that stands once in each of several small batches is frequent."""
    rng = random.Random(9)
    texts = [sentence(rng, 12) + (" one passage of five words" if i % 10 == 0 else "") for i in range(60)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    whole = [x.tolist() for x in jaccard.frequent_shingles(docs, 5)]
    with with_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", 7):
        assert [x.tolist() for x in jaccard.frequent_shingles(docs, 5)] == whole
    counts = Counter(" ".join(t.split()[i : i + 5]) for t in texts for i in range(len(t.split()) - 4))
    assert sorted(whole[1]) == sorted(n for n in counts.values() if n >= jaccard.SEEN_OFTEN) != []


def test_hashing_a_block_takes_little_memory():
    """Beside the powers, which all blocks share, one array of 64-bit numbers."""
    import tracemalloc

    import numpy as np

    from fraudspark.llm.text import hash_spans

    data, n = np.frombuffer(b"a few words " * 40_000, np.uint8), 480_000
    begin = np.arange(0, n, 12)
    first = hash_spans(data, begin, begin + 11)
    tracemalloc.start()
    again = hash_spans(data, begin, begin + 11)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (again == first).all() and len(set(first.tolist())) == 1
    assert peak < 14 * n


def test_evolution_reaches_a_known_optimum():
    rng = random.Random(3)
    sizes = []
    for _ in range(40):  # 40 bins of three pieces that fill them
        a = rng.randint(20, 45)
        b = rng.randint(20, 45)
        sizes += [a, b, 100 - a - b]
    best = pack.evolve(sizes, 100, [], 60, seed=1)
    assert sorted(p for b in best.bins for p in b) == list(range(len(sizes)))
    assert all(sum(sizes[p] for p in b) == f <= 100 for b, f in zip(best.bins, best.fills, strict=True))
    assert len(best.bins) <= 43


def test_sharding(docs, rows, none):
    ones = [1.0] * 16
    found = shard.shard(docs, ones, [1.0] * 17).toPandas()  # the new shard fills a region of its own
    assert len(found) == len(rows)
    for _, part in found.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    moved = found[found["shard"] != found["grown_shard"]]
    assert set(moved["grown_shard"]) <= {16}
    assert found.groupby(found["doc_id"].fillna(-1))["shard"].nunique().max() == 1
    by_id = {i: t for i, t, *_ in rows}
    for r in found.itertuples():
        text = (by_id[None if math.isnan(r.doc_id) else int(r.doc_id)] or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 16, zlib.crc32(text))
    assert shard.shard(none, ones).count() == 0


def test_weights_move_rows_in_the_changed_subtree_only(spark):
    keys = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    before, after = [1.0] * 16, [1.0] * 5 + [3.0] + [1.0] * 10
    pair = keys.select(shard.place(F.col("k"), before).alias("a"), shard.place(F.col("k"), after).alias("b")).collect()
    for a, b in pair:  # shard 5 stands in rack 1 of region 0
        if a != b:
            assert 0 in (a.region, b.region)
            assert a.region != b.region or a.rack == b.rack or 1 in (a.rack, b.rack)
            assert a.rack != b.rack or 5 in (a.shard, b.shard)
    assert any(a.region != b.region and b.shard != 5 for a, b in pair)  # the levels below are drawn anew
    share = sum(r.b.shard == 5 for r in pair) / len(pair)
    assert abs(share - 3 / 18) < 0.03
    assert all(r.a.rack == r.a.shard // 4 and r.a.region == r.a.rack // 2 for r in pair)


def links(rows):
    sets = []
    for _, text, *_ in rows:
        w = spaced(text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {}
    for x, r in zip(label, rows, strict=True):
        if r[0] is not None:
            least[x] = min(least.get(x, r[0]), r[0])
    return Counter((r[0], len(s), least.get(x)) for r, s, x in zip(rows, sets, label, strict=True))


@pytest.mark.parametrize("chunk", [jaccard.CHUNK, 2])
def test_jaccard_components(docs, rows, chunk):
    found = jaccard.jaccard_components(docs, chunk=chunk).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == links(rows)


def test_jaccard_groups_of_near_copies(spark):
    """Chains and stars of edited copies, many of them, around the threshold."""
    rng = random.Random(8)
    base, made = sentence(rng, 60).split(), []
    base = [f"{w}{i}" for i, w in enumerate(base)]
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        made.append((i, " ".join(w), "en", "s"))
    made += [(i, sentence(rng, 30) + " " + " ".join(base[:12]), "en", "s") for i in range(150, 220)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string, source string")
    for chunk in (jaccard.CHUNK, 20):
        found = jaccard.jaccard_components(df, chunk=chunk).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == links(made)


def test_jaccard_of_nothing(none):
    assert jaccard.jaccard_components(none).count() == 0


def test_decontamination(spark, docs, rows, none):
    texts = {i: t for i, t, *_ in rows}
    items = [
        (1, texts[7]), (2, "Two Words"), (3, " ".join(texts[9].split()[3:15])), (3, " ".join(texts[9].split()[3:15])),
        (4, None), (5, ""), (None, texts[10]), (10, "x " + texts[7] + " y"), (6, "never seen anywhere"),
    ]
    benchmark = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, row string")
    found = decontaminate.decontaminate(docs, benchmark).collect()
    cut = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    expected = Counter()
    for i, text, *_ in rows:
        w, hit, seen = cut(text), set(), set()
        for item, body in items:
            b = cut(body)
            m = min(10, len(b))
            if item is None or not m:
                continue
            windows = {tuple(b[k : k + m]) for k in range(len(b) - m + 1)}
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in windows:
                    hit |= set(range(k, k + m))
                    seen.add(str(item))
        digest = hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest()
        expected[(i, len(w), len(hit), len(seen), digest, bool(hit))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found) == expected
    assert decontaminate.decontaminate(none, benchmark).count() == 0
    nothing = decontaminate.decontaminate(docs, benchmark.where("false")).collect()
    assert len(nothing) == len(rows) and not any(r.contaminated for r in nothing)


def edits(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def test_banded_edit_distance(spark):
    rng, pairs = random.Random(5), []
    for _ in range(400):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(3, 12)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "c"])
        x, y = sorted((a, "".join(b)), key=len)
        if len(x) > 2:
            pairs.append((x, y))
    pairs = [(list(x), list(y)) for x, y in pairs]
    found = lines.edit_distance(spark.createDataFrame(pairs, "x array<string>, y array<string>"), 2).collect()
    assert all(min(r.edits, 3) == min(edits(r.x, r.y), 3) for r in found)


def near_lines(x, y):
    """By words if both have ten or more, by bytes if both have fewer; one edit for every ten, two at most."""
    if min(len(x), len(y)) < 10 or x == y:
        return x == y and len(x) >= 10
    a, b = x.split(b" "), y.split(b" ")
    if (len(a) >= 10) != (len(b) >= 10):
        return False
    a, b = (a, b) if len(a) >= 10 else (x, y)
    return abs(len(a) - len(b)) <= 2 and edits(a, b) <= min(2, min(len(a), len(b)) // 10)


def test_banded_edit_distance_of_words(spark):
    rng, pairs = random.Random(6), []
    for _ in range(300):
        a = [rng.choice(WORDS) for _ in range(rng.randint(3, 25))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 1)] = rng.choice([[], ["new"], [rng.choice(WORDS)]])
        x, y = sorted((a, b), key=len)
        if len(x) > 2:
            pairs.append((x, y))
    found = lines.edit_distance(spark.createDataFrame(pairs, "x array<string>, y array<string>"), 2).collect()
    assert all(min(r.edits, 3) == min(edits(r.x, r.y), 3) for r in found)


@pytest.mark.parametrize("hot", [lines.HOT, 3])
def test_large_families_of_lines(spark, monkeypatch, hot):
    """Many lines share a passage and are far apart, others are a word or two apart; hot keys or not."""
    monkeypatch.setattr(lines, "HOT", hot)
    rng = random.Random(12)
    passage, texts = sentence(rng, 40), []
    for _ in range(60):
        words = passage.split()
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(40)] = "w" + str(rng.randint(0, 999))
        texts.append(" ".join(words))
        texts.append(passage + " " + " ".join(str(rng.randint(0, 10**6)) for _ in range(12)))
    texts.append("The quick brown fox jumps over the lazy dog and runs away from here to the far hills.")
    texts.append(texts[-1].replace("fox", "cat"))
    texts += ["short line number " + rng.choice("abcd") * rng.randint(1, 9) for _ in range(40)]
    found = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5))
    gone = {r.doc_id for r in found.collect() if r.n_dropped}
    expected = {i for i, y in enumerate(texts) if any(near_lines(x.encode(), y.encode()) for x in texts[:i])}
    assert gone == expected and 121 in gone and 40 < len(gone) < 130


@pytest.mark.parametrize("hot", [lines.HOT, 3])
def test_far_lines_of_one_passage_make_few_pairs(spark, monkeypatch, hot):
    """Lines that share passages and most words, but are three and more words apart, do not all meet."""
    monkeypatch.setattr(lines, "HOT", hot)
    made, near = [], lines._near
    monkeypatch.setattr(lines, "_near", lambda pairs, *rest: (made.append(pairs.count()), near(pairs, *rest))[1])
    rng = random.Random(31)
    passage, texts = sentence(rng, 60).split(), []
    for _ in range(200):
        words = list(passage)
        for at in rng.sample(range(20), 3):
            words[at] = "w" + str(rng.randint(0, 10**6))
        texts.append(" ".join(words))
    texts.append(texts[77].replace(passage[40], "other"))
    found = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5))
    gone = {r.doc_id for r in found.collect() if r.n_dropped}
    assert gone == {i for i, y in enumerate(texts) if any(near_lines(x.encode(), y.encode()) for x in texts[:i])}
    assert 200 in gone and sum(made) < 3 * len(texts)


def test_line_dedup(docs, rows, none):
    found = lines.dedup_lines(docs)
    assert set(docs.columns) <= set(found.columns)
    every = []  # equal rows are one document, null ids come first
    for i, text in sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        every += [(i, k, x.encode()) for k, x in enumerate(text.split("\n"))]
    gone = set()
    for b, (i, k, y) in enumerate(every):
        for _, _, x in every[:b]:
            if near_lines(x, y):
                gone.add((i, k))
                break
    expected = Counter()
    for i, text, *_ in rows:
        own = [] if text is None else text.split("\n")
        kept = [x for k, x in enumerate(own) if (i, k) not in gone]
        expected[(i, None if text is None else "\n".join(kept), len(own), len(own) - len(kept))] += 1
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()) == expected
    assert lines.dedup_lines(none).count() == 0


def test_lm_counts(docs, rows, none):
    found = lm.lm_score(docs).collect()
    seen = Counter()
    for i, text, *_ in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            seen.update([*spaced(text), b"\0end"])
    total = sum(seen.values())
    expected = Counter()
    for i, text, *_ in rows:
        own = [*spaced(text), b"\0end"]
        base = sum(math.log10((seen[w] + 1) / (total + len(seen) + 1)) for w in own)
        expected[(i, len(own), sum(seen[w] > 0 for w in own), total, round(base, 6))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    assert all(r.score < 0 for r in found)
    assert lm.lm_score(none).count() == 0


def test_lm_rare_words_are_joined(docs):
    """Most words outside of the vocabulary: the same base score by the other way."""
    key = lambda df: sorted((str(r.doc_id), r.n_known, round(r.base_score, 6)) for r in df.collect())
    assert key(lm.lm_score(docs, word_share=0.05, gram_share=0.05)) == key(lm.lm_score(docs))


def trigram_scores(rows):
    """log10 probability of each text under all n-grams of the training rows."""
    of = lambda text: ["<s>", "<s>", *spaced(text), "</s>"]
    training = [of(text) for i, text in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    n3 = Counter((*g,) for s in training for g in zip(s, s[1:], s[2:], strict=False))
    n2, n1, follow1, follow2 = Counter(), Counter(), {}, {}
    for (a, b, c), n in n3.items():
        n2[b, c] += n
        n1[c] += n
        follow1.setdefault(b, set()).add(c)
        follow2.setdefault((a, b), set()).add(c)
    once = sum(n == 1 for w, n in n1.items() if w != "</s>")
    mass = sum(n1.values()) + 0.5 * len(n1) + 0.5 + once
    p1 = lambda c: ((n1[c] or once) + 0.5) / mass
    m1 = {b: sum(n2[b, c] for c in own) for b, own in follow1.items()}
    m2 = {k: sum(n3[(*k, c)] for c in own) for k, own in follow2.items()}
    back1 = {b: min(max(0.75 * len(own) / m1[b], 1e-9) / max(1 - sum(map(p1, own)), 1e-9), 1e3) for b, own in follow1.items()}
    p2 = lambda b, c: (n2[b, c] - 0.75) / m1[b] if n2[b, c] else back1.get(b, 1) * p1(c)
    back2 = {k: min(max(0.75 * len(own) / m2[k], 1e-9) / max(1 - sum(p2(k[1], c) for c in own), 1e-9), 1e3) for k, own in follow2.items()}

    def p3(a, b, c):
        return (n3[a, b, c] - 0.75) / m2[a, b] if n3[a, b, c] else back2.get((a, b), 1) * p2(b, c)

    return {i: sum(math.log10(p3(*g)) for g in zip(of(text), of(text)[1:], of(text)[2:], strict=False)) for i, text in rows}


@pytest.mark.parametrize("tokens", [1 << 20, 500])
def test_lm_keeps_every_gram(spark, monkeypatch, tokens):
    """Beyond a million tokens words seen once and their n-grams are still in the model, in one bucket or in many."""
    monkeypatch.setattr(lm, "BUCKET_TOKENS", tokens)
    monkeypatch.setattr(lm, "MERGE_ROWS", 100)
    rng = random.Random(9)
    texts = [sentence(rng, rng.randint(1, 40)) + f" only{k} " + sentence(rng, 5) for k in range(60)]
    texts += [None, "", texts[3], "never seen words", "fill " * (2_200_000 if tokens > 500 else 3_000)]
    rows = [(k if k < 64 else 65, text) for k, text in enumerate(texts)]
    assert zlib.crc32(b"65") % 7 != 2
    expected = trigram_scores(rows)
    found = lm.lm_score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(found) == len(rows) and any(r.held_out for r in found)
    for r in found:  # 8 bits over about 6 decades
        assert abs(r.score - expected[r.doc_id]) <= 0.015 * r.n_tokens + 1e-6, (r, expected[r.doc_id])


@pytest.mark.parametrize("hot", [40, 1 << 22])
def test_lm_sends_each_trigram_once(spark, monkeypatch, hot):
    """Middle words of one bucket or, if hot, of several; the successors of contexts are not sent again."""
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 300)
    monkeypatch.setattr(lm, "HOT_TOKENS", hot)
    written, write = {}, lm.materialize
    monkeypatch.setattr(lm, "materialize", lambda df, name: written.setdefault(name, write(df, name)))
    rng = random.Random(19)
    rows = [(k, sentence(rng, rng.randint(1, 40)) + f" only{k % 20}") for k in range(120)]
    expected = trigram_scores(rows)
    found = lm.lm_score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), word_share=0.02).collect()
    assert len(found) == len(rows)
    for r in found:
        assert abs(r.score - expected[r.doc_id]) <= 0.015 * r.n_tokens + 1e-6, (r, expected[r.doc_id])
    answers = written["trigram_answers"]
    assert "bigrams" not in written and "context" not in answers.columns
    held = sum(len(spaced(text)) + 1 for i, text in rows if zlib.crc32(str(i).encode()) % 7 == 2)
    assert answers.where("kind = 1").count() <= held


def test_elias_fano():
    import numpy as np

    rng = np.random.default_rng(1)
    for n, top in ((1, 0), (1, 5), (1000, 1000), (5000, 10**6), (300, 2**40)):
        values = np.unique(rng.integers(0, top + 1, n))
        coded = lm.EliasFano.encode(values)
        assert (coded.access(np.arange(len(values))) == values).all()
        asked = np.concatenate((values, rng.integers(0, top + 1, 500)))
        got = coded.find(asked, np.zeros(len(asked), np.int64), np.full(len(asked), len(values)))
        assert (got == np.where(np.isin(asked, values), np.searchsorted(values, asked), -1)).all()


def test_long_runs_of_successors_are_halved(monkeypatch):
    import numpy as np

    values = np.append(np.arange(0, 40_000, 2), 1 << 40)
    coded, steps, low_of = lm.EliasFano.encode(values), [], lm.EliasFano._low_of
    monkeypatch.setattr(lm.EliasFano, "_low_of", lambda self, i: steps.append(len(i)) or low_of(self, i))
    asked = np.arange(0, 40_000, 7)
    found = coded.find(asked, np.zeros(len(asked), np.int64), np.full(len(asked), len(values)))
    assert found.tolist() == [x // 2 if x % 2 == 0 else -1 for x in asked.tolist()]
    assert len(steps) < 40


def test_joined_columns_keep_the_order():
    import numpy as np

    rng = np.random.default_rng(5)
    for bits in ((3, 5, 7), (40, 30, 2, 60), (0, 63, 1)):
        columns = [rng.integers(0, 1 << b, 500, dtype=np.int64) if b else np.zeros(500, np.int64) for b in bits]
        columns = [np.append(x, x[:50]) for x in columns]
        order, new = lm._distinct_rows(*columns)
        packed_order, packed_new = lm._distinct_rows(*lm._joined(*columns))
        assert order.tolist() == packed_order.tolist() and new.tolist() == packed_new.tolist()
    assert len(lm._joined(*[np.arange(9)] * 5)) == 1


def test_trie_probabilities_sum_to_one():
    import numpy as np

    text = "a b a c a b d b a c".split() * 3
    words = np.array(sorted({hash(w) & 0xFFFF for w in "abcd"}))
    ids = {w: i + lm.FIRST_WORD for i, w in enumerate("abcd")}
    sequence = [lm.START, *[ids[w] for w in text], lm.END]
    pairs = Counter((a << lm.ID_BITS) | b for a, b in zip(sequence, sequence[1:], strict=False))
    triples = Counter((((a << lm.ID_BITS) | b) << lm.ID_BITS) | c for a, b, c in zip(sequence, sequence[1:], sequence[2:], strict=False))
    arrays = []
    for counts in (pairs, triples):
        keys = np.array(sorted(counts), np.int64)
        arrays += [keys, np.array([counts[k] for k in keys.tolist()], np.int64)]
    counted = np.array([text.count(w) for w in "abcd"])
    trie = lm.Trie.load(lm.Trie.build(words, counted, 0, 1, *arrays, 0).dump())
    for context in ([ids["a"], ids["b"]], [ids["d"], ids["b"]], [ids["c"], ids["a"]]):
        total = 0.0
        for last in (lm.UNK, lm.END, *ids.values()):
            total += 10 ** trie.log_probs(np.array([lm.START, *context, last]), np.array([0]))[-1]
        assert abs(total - 1) < 0.05


def test_toxicity_finds_misspelled_and_spares_quoted(spark):
    rng = random.Random(6)
    made, marks = [], []
    for i in range(400):
        text, toxic = sentence(rng, 25).split(), i % 4 == 0
        if toxic:
            text.insert(rng.randrange(25), rng.choice(["scoundrel", "blockhead", "dimwitted"]))
        made.append((i, " ".join(text)))
        marks.append((i, int(toxic)))
    tests = [(1001, "alpha beta scoundrels gamma"), (1002, "alpha beta blockhezd gamma blckhead"), (1003, "alpha beta gamma"), (1004, None), (1005, "")]
    docs = spark.createDataFrame([*made, *tests], "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()}
    wrong = [i for i, y in marks if found[i].predicted != y]
    assert len(wrong) <= 4
    assert found[1001].predicted == 1 and found[1002].fuzzy > 0 and found[1002].score > found[1003].score
    assert found[1003].score == found[1004].score == found[1005].score < 0.5


def test_automaton_against_all_pairs():
    import numpy as np

    rng = random.Random(7)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 7))) for _ in range(40)})
    trie = toxicity.Trie([(t, float(k)) for k, t in enumerate(terms)])
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    table = np.zeros((len(words), 9), np.uint32)
    for r, w in enumerate(words):
        table[r, : len(w)] = [ord(c) for c in w]
    exact, fuzzy = trie.match(table, np.array([len(w) for w in words]))
    for w, e, f in zip(words, exact, fuzzy, strict=True):
        begins = [t for t in terms if w.startswith(t)]
        assert (e >= 0) == bool(begins) and (e < 0 or terms[e] in begins)
        close = [t for t in terms if len(t) >= toxicity.FUZZY_LENGTH and edits(t, w) <= 1]
        assert (terms[f] if f >= 0 else None) == (close[-1] if close else None)


def test_words_of_any_length_and_repeated_ids(spark):
    """A stem counts however long its word is, and the sample does not depend on the partitioning."""
    scorer = toxicity.Scorer([("scoundrel", 2.0)])
    import pyarrow as pa

    from fraudspark.llm.text import blocks

    texts = ["a scoundrel", "a scoundrel" + "s" * 200, "a " + "s" * 200, "a scoundrl", "a scoundrl" + "s" * 200]
    found = scorer.features(next(blocks(pa.array(texts)))) != 0
    assert found.any(axis=1).tolist() == [True, True, False, True, False]

    rows = [(1, "b"), (1, "a"), (1, None), (2, None), (3, "c"), (3, "c")]
    labels = spark.createDataFrame([(i, 1) for i in (1, 2, 3)], "doc_id long, toxic int")
    seen = set()
    for parts in (1, 3, 6):
        docs = spark.createDataFrame(rows[::-1] if parts == 3 else rows, "doc_id long, text string").repartition(parts)
        sample = toxicity.labelled_sample(docs, labels, "toxic", 10, (5, 0), "doc_id", "text")
        assert sample.columns == ["doc_id", "text", "y"]
        seen.add(tuple(sorted((r.doc_id, r.text or "", r.y) for r in sample.collect())))
    assert len(seen) == 1


@pytest.mark.parametrize("name", ["toxicity", "quality", "language"])
def test_learned_scores_of_odd_rows(docs, labels, none, rows, name):
    operator = {
        "toxicity": lambda d: toxicity.toxicity(d, labels),
        "quality": lambda d: quality.quality(d, labels),
        "language": language.language,
    }[name]
    found = operator(docs).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert all(0 <= r.score <= 1 for r in found)
    modulus, rest = {"toxicity": (5, 0), "quality": (4, 2), "language": (5, 0)}[name]
    for r in found:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % modulus == rest)
    if name == "language":
        lettered = {i: any(c.isalpha() for c in t or "") for i, t, *_ in rows}
        assert all((r.lang_pred == "und") != lettered[r.doc_id] for r in found)
    assert operator(none).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    found = queries.op9_language_id(spark, folder).where("held_out").collect()
    assert sum(langs[r.doc_id] == r.lang_pred for r in found) >= 0.97 * len(found)
    found = [r for r in queries.op6_quality_classifier(spark, folder).where("held_out").collect() if r.doc_id in labels]
    assert sum(labels[r.doc_id].quality == r.predicted for r in found) >= 0.9 * len(found)
    found = [r for r in queries.op2_toxicity(spark, folder).where("held_out").collect() if r.doc_id in labels]
    assert sum(labels[r.doc_id].toxic == r.predicted for r in found) >= 0.9 * len(found)


def test_each_level_draws_for_itself(spark):
    """The tree against a descent in plain Python over the same draws."""
    weights, seed = [2.0, 0.0, 1.0, 0.5, 3.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 4.0], 11
    nodes = [(level, n) for level, many in enumerate((2, 4, 13)) for n in range(many)]
    bits = [F.xxhash64("k", F.lit(seed), F.lit(level), F.lit(n)).alias(f"d{level}_{n}") for level, n in nodes]
    keys = spark.range(500).select(F.col("id").cast("string").alias("k"))
    found = keys.select("k", shard.place(F.col("k"), weights).alias("at"), *bits).collect()
    weight = {(2, n): w for n, w in enumerate(weights)}
    for level, size in ((1, 4), (0, 2)):
        for n in range((4, 2)[level == 0]):
            weight[level, n] = sum(weight.get((level + 1, n * size + i), 0.0) for i in range(size))
    for r in found:
        at = 0
        path = []
        for level, children in enumerate((range(2), 2, 4)):
            below = children if level == 0 else range(at * children, at * children + children)
            draws = {}
            for n in below:
                if weight.get((level, n), 0.0) > 0:
                    u = (((r[f"d{level}_{n}"] % 2**64) >> 11) + 0.5) / 2.0**53
                    draws[n] = -math.log(u) / weight[level, n]
            at = min(draws, key=lambda n: (draws[n], n))
            path.append(at)
        assert tuple(r["at"]) == tuple(path)


def test_language_under_one_id(spark):
    """A language whose rows all carry one id, and one text that fills a third of the rows."""
    rng = random.Random(3)
    words = {"aa": "the house of and with stone".split(), "bb": "zwei häuser und großer über straße".split()}
    rows = [(5 if lang == "aa" else i, " ".join(rng.choice(words[lang]) for _ in range(30)), lang) for i in range(400) for lang in words]
    rows += [(1, "the house and the stone", "aa")] * 400
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    if zlib.crc32(b"5") % 5 == 0:
        raise AssertionError("the id must train")
    found = language.language(docs, sample_per_language=50).select("doc_id", "lang_pred").collect()
    predicted = Counter(r.lang_pred for r in found)
    assert predicted == {"aa": 800, "bb": 400}
    sample = language._sample(docs, 50, 1000)
    assert {r.lang: r.n for r in sample.groupBy("lang").agg(F.count("*").alias("n")).collect()} == {"aa": 50, "bb": 50}
    assert sample.distinct().count() == 100
    assert language._sample(docs, 50, 40).count() == 40


def test_quality_against_a_plain_forward_pass():
    """Scores of whole texts, short and very long, against a loop over passages of 512 bytes."""
    import numpy as np
    import pyarrow as pa

    from fraudspark.llm.text import blocks

    rng = np.random.default_rng(4)
    draw = random.Random(4)
    texts = [None, "", sentence(draw, 40), sentence(draw, 300), sentence(draw, 16000)]
    assert len(texts[-1]) > 2 * 512 * quality.LEARNED_PASSAGES
    block = next(blocks(pa.array(texts)))
    measures, count = quality.passages(block)
    assert count.tolist() == [max(1, -(-len(t or "") // 512)) for t in texts]
    model = quality.fit(measures, count, np.array([0.0, 0.0, 1.0, 1.0, 0.0]), steps=20)
    got = model.score(measures, count)
    p, first = model.parts, 0
    for i, n in enumerate(count):
        total, rest = 0.0, np.zeros(quality.HIDDEN)
        for x in (measures[first : first + n] - model.center) / model.scale:
            h = np.tanh(x @ p["encode"] + p["encode_bias"])
            a = math.exp(float((np.tanh(h @ p["look"]) / (1 + np.exp(-(h @ p["gate"])))) @ p["attend"]))
            total, rest = total + a, rest + a * h
        logit = float((rest / total) @ p["score"] + p["bias"][0])
        assert abs(got[i] - 1 / (1 + math.exp(-logit))) < 1e-9
        first += n
    # the grain does not change with length: a passage measures the same wherever its text ends
    part = "".join(draw.choice("abcdefgh ") for _ in range(512))
    a, _ = quality.passages(next(blocks(pa.array([part]))))
    b, n = quality.passages(next(blocks(pa.array([part + texts[-1]]))))
    assert n[0] > quality.LEARNED_PASSAGES
    same = slice(0, quality._N_KINDS)
    assert np.allclose(a[0][same], b[0][same])
    assert quality.spread(5, 64).tolist() == [0, 1, 2, 3, 4]
    assert quality.spread(1000, 4).tolist() == [0, 250, 500, 750]


def test_pipeline(spark, docs, rows, labels, tmp_path):
    """Every stage against its rule, on its own input, with odd rows."""
    folder = str(tmp_path)
    docs.select("doc_id", "text", "lang", "source").write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    items = [(1, rows[8][1])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    state = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = state.collect()
        state = corpus_pipeline.materialize(stage(spark, state, folder), "tested")
        after = state.collect()
        if name != "best_fit_packing":
            assert state.columns == ["doc_id", "text", "lang", "source"]
            assert {r.doc_id for r in after} <= {r.doc_id for r in before}
        if name == "toxicity":
            assert Counter(after) == Counter(before)  # no label says toxic
        if name == "ngram_jaccard_join":
            heads = {c for _, _, c in links(before)}
            assert Counter(r.doc_id for r in after) == Counter(dict.fromkeys(heads, 1))
        if name == "benchmark_decontamination":
            assert not any(rows[8][1] in (r.text or "") for r in after)
    assert {r.doc_id for r in after} == {r.doc_id for r in before}


def test_pipeline_drops_rows_not_ids(spark, tmp_path):
    """Null and repeated ids: a contaminated or near row takes no other text along, and near rows without ids meet."""
    rng = random.Random(12)
    item, long = sentence(rng, 30), [sentence(rng, 200) for _ in range(5)]
    near = long[1] + " changed"
    rows = [
        (None, item), (None, long[0]), (7, "before " + item), (7, long[2]), (8, long[3]),
        (None, long[1]), (None, near), (3, long[3] + " changed"), (8, long[4]), (8, long[4]), (None, None), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()
    assert Counter((*r,) for r in clean) == Counter(r for r in rows if r[1] is None or item not in r[1])
    kept = Counter((*r,) for r in corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect())
    expected = Counter(set(rows) - {(None, item), (None, long[1]), (None, near), (8, long[3])})
    heads = [r for r in ((None, long[1]), (None, near)) if kept[r]]
    assert len(heads) == 1  # either, by the hash of its text
    assert kept == expected + Counter(heads)
