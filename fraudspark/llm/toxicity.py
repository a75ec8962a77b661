"""Toxicity: Levenshtein automata over a lexicon trie, with context-window scores.

The lexicon is a set of stems learned, with weights, from a bounded sample of labelled training
rows; a stem also stands for the words that begin with it. Every distinct word of a block runs as a Levenshtein automaton, the bit-parallel one with a state set
for 0 and one for 1 edit, down the trie of all terms; a branch goes on with the words whose
automaton still has a live state. Around each match a window of characters tells quotation
(quotation marks on both sides, or a reporting word before) from address (a second person near).
The sums of the weights by kind are the features of a logistic model.

Scoring is one pass over the texts without a shuffle; the model is a list of at most
``lexicon_size`` terms and a few numbers. Learning reads at most ``sample_rows`` labelled rows,
the ones of least hash.

Defined results: null and empty texts get the score of a text without matches; documents without
label are scored; conflicting labels of one id count as toxic; without usable labels the score is 0
for all; repeated rows get equal scores; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from fraudspark.llm.text import Block, blocks, hash_spans, spans
from fraudspark.session import materialize, small_batches

SAMPLE_ROWS = 20_000
LEXICON_SIZE = 2_000
MIN_DOCUMENTS = 3
MIN_GAIN = 20.0
MIN_ODDS = 1.5
STEM_LENGTHS = (3, 10)
FUZZY_LENGTH = 5  # shorter terms must match exactly
LONGEST_WORD = 60  # an automaton fits one 64-bit number; no word beyond is a term
NEAR = 60  # characters of the context window to each side
CACHE_WORDS = 2_000_000
HELD_OUT = (5, 0)  # crc32(id) mod 5 = 0 is never learned from

# Words that report what others say, and second persons, in four languages.
REPORTING = (
    "said says say wrote writes quote quoted quoting called calls according "
    "dit disait écrit selon appelle citation sagte sagt schrieb laut zitat nannte "
    "dijo dice escribió según llamó cita"
).split()
SECOND_PERSON = "you your yours youre u du dich dir dein deine ihr euch sie tu te toi vous votre tú ti usted eres".split()
FEATURES = ("plain", "quoted", "addressed", "fuzzy", "matches", "strongest", "density")
PRIOR = np.array([0.5, 0.2, 0.3, 0.3, 0.2, 0.5, 0.2])


def held_out(id_column: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, split: tuple[int, int], id_column: str, text_column: str
) -> DataFrame:
    """At most ``rows`` labelled training rows (doc_id, text, y), those of least hash of the id."""
    ids = (
        labels.select(F.col(id_column).alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), *split))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    # bounded by ``rows``, so it may be broadcast; of a repeated id the same text under any partitioning
    first = F.min_by("text", F.xxhash64("text")).alias("text")
    sample = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(first, F.first("y").alias("y"))
    return materialize(sample, "labelled")


def _gain(a: Column, b: Column, toxic: float, clean: float) -> Column:
    """Log-likelihood ratio of a term seen in ``a`` of ``toxic`` and ``b`` of ``clean`` texts."""
    share = (a + b) / (toxic + clean)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (
        part(a, share * toxic)
        + part(b, share * clean)
        + part(toxic - a, (1 - share) * toxic)
        + part(clean - b, (1 - share) * clean)
    )


def learn_lexicon(sample: DataFrame, size: int = LEXICON_SIZE) -> list[tuple[str, float]]:
    """Stems much more frequent in toxic texts, with log odds.

    Of texts with the same least shingle, copies mostly, one counts. A stem inside or around a
    chosen one is left out: where words begin alike the most telling length is kept.
    """
    w = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{Nd}]+"), lambda x: x != "")
    grams = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w") - 5, F.lit(0))), lambda i: F.xxhash64(F.slice("w", i + 1, 5))
    )
    rows = sample.select("y", "doc_id", w.alias("w")).withColumn("copy", F.array_min(grams))
    rows = rows.groupBy("copy").agg(F.max_by(F.struct("y", "w"), F.struct("y", "doc_id")).alias("r")).select("r.*")
    rows = materialize(rows, "distinct_texts")
    totals = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0) + 1.0, totals.get(0, 0) + 1.0
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / toxic) - F.log(b / clean)
    lengths = F.sequence(F.lit(STEM_LENGTHS[0]), F.lit(STEM_LENGTHS[1]))
    fitting = F.filter(F.array_distinct("w"), lambda x: F.length(x) >= STEM_LENGTHS[0])
    stems = F.array_distinct(F.flatten(F.transform(fitting, lambda x: F.transform(lengths, lambda k: F.left(x, k)))))
    found = (
        rows.select("y", F.explode(stems).alias("stem"))
        .groupBy("stem")
        .agg(F.sum(F.col("y")).alias("a"), F.sum(1 - F.col("y")).alias("b"))
        .where(F.col("a") >= MIN_DOCUMENTS)
        .withColumn("odds", odds)
        .withColumn("gain", _gain(F.col("a"), F.col("b"), toxic - 1, clean - 1))
        .where((F.col("gain") >= MIN_GAIN) & (F.col("odds") >= MIN_ODDS))
        .orderBy(F.desc("gain"), F.desc(F.length("stem")), "stem")
        .limit(size)
    )
    chosen: dict[str, float] = {}
    for r in found.collect():  # at most ``size`` rows
        if not any(r.stem.startswith(x) or x.startswith(r.stem) for x in chosen):
            chosen[r.stem] = float(r.odds)
    return sorted(chosen.items())


class Trie:
    """Terms as nodes; next(node) gives (letter, child) pairs."""

    def __init__(self, terms: list[tuple[str, float]]):
        self.terms = terms
        self.children: list[dict[int, int]] = [{}]
        self.term: list[int] = [-1]
        for number, (word, _) in enumerate(terms):
            node = 0
            for letter in map(ord, word):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                node = self.children[node][letter]
            self.term[node] = number
        self.letters = np.array(sorted({x for c in self.children for x in c}), np.uint32)
        self.weights = np.array([x for _, x in terms], float)
        self.lengths = np.array([len(x) for x, _ in terms], np.int64)

    def match(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word (a row of zero-padded code points) the stem it begins with and the best term at one edit, or -1."""
        n = len(lengths)
        exact, fuzzy = np.full(n, -1), np.full(n, -1)
        if not self.terms or not n:
            return exact, fuzzy
        slot = np.searchsorted(self.letters, codes)
        slot[slot == len(self.letters)] = 0
        known = self.letters[slot] == codes
        slot[~known] = len(self.letters)
        masks = np.zeros((len(self.letters) + 1, n), np.uint64)  # bit i: the word's letter i is this one
        every = np.arange(n)
        for i in range(codes.shape[1]):
            masks[slot[:, i], every] |= np.uint64(1 << i)
        one = np.uint64(1)
        limit = (one << (lengths + 1).astype(np.uint64)) - one
        last = one << lengths.astype(np.uint64)
        start = np.ones(n, np.uint64)
        work = [(0, every, start, (start | (start << one)) & limit)]
        while work:
            node, who, none, some = work.pop()
            for letter, child in self.children[node].items():
                here = masks[np.searchsorted(self.letters, letter)][who]
                none2 = ((none & here) << one) & limit[who]
                some2 = (((some & here) << one) | none | (none << one) | (none2 << one)) & limit[who]
                live = some2 != 0
                if not live.any():
                    continue
                rest, none2, some2 = who[live], none2[live], some2[live]
                term = self.term[child]
                if term >= 0:
                    exact[rest[(none2 >> np.uint64(self.lengths[term])) & one != 0]] = term
                    if self.lengths[term] >= FUZZY_LENGTH:
                        near = rest[(some2 & last[rest]) != 0]
                        better = (fuzzy[near] < 0) | (self.weights[term] > self.weights[fuzzy[near]])
                        fuzzy[near[better]] = term
                work.append((child, rest, none2, some2))
        return exact, fuzzy


_alnum: list[np.ndarray] = []


def _character_classes() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case form and word membership of the code points up to U+FFFF (all beyond are no word)."""
    if not _alnum:
        chars = [chr(i) for i in range(0x10000)]
        lower = [c.lower() for c in chars]
        _alnum.append(np.array([ord(x) if len(x) == 1 else i for i, x in enumerate(lower)], np.uint32))
        _alnum.append(np.array([c.isalnum() for c in chars]))
    return _alnum[0], _alnum[1]


class Scorer:
    """Features of whole documents; remembers words that match nothing within a bounded cache."""

    def __init__(self, terms: list[tuple[str, float]]):
        self.trie = Trie(terms)
        self.clear = np.zeros(0, np.uint64)
        self.reporting, self.second = (self._hashes(x) for x in (REPORTING, SECOND_PERSON))

    @staticmethod
    def _hashes(listed: list[str]) -> np.ndarray:
        codes = [np.array([ord(c) for c in w], np.uint32) for w in listed]
        stop = np.cumsum([len(c) for c in codes])
        return np.sort(hash_spans(np.concatenate(codes), np.concatenate(([0], stop[:-1])), stop))

    def features(self, block: Block) -> np.ndarray:
        """One row of FEATURES per document."""
        lower, inside = _character_classes()
        codes = np.frombuffer(block.data.tobytes().decode().encode("utf-32-le"), np.uint32)
        starts = block.starts - np.searchsorted(np.flatnonzero((block.data & 0xC0) == 0x80), block.starts)
        small = np.minimum(codes, 0xFFFF)
        wide = codes >= 0x10000
        codes = np.where(wide, codes, lower[small])
        begin, end, doc = spans(inside[small] & ~wide, starts)
        del small, wide
        out = np.zeros((len(block), len(FEATURES)))
        if not len(begin) or not self.trie.terms:
            return out
        hashes = hash_spans(codes, begin, end)
        size = end - begin
        distinct, first = np.unique(hashes, return_index=True)
        fits = size[first] >= STEM_LENGTHS[0] - 1
        if len(self.clear):
            at = np.minimum(np.searchsorted(self.clear, distinct), len(self.clear) - 1)
            fits &= self.clear[at] != distinct
        distinct, first = distinct[fits], first[fits]
        if not len(distinct):
            return out
        # stems are shorter by far: a longer word begins with the same ones and is near to none
        length = np.minimum(size[first], LONGEST_WORD)
        longest = int(length.max())
        table = np.zeros((len(first), longest), np.uint32)
        for i in range(longest):
            has = length > i
            table[has, i] = codes[begin[first[has]] + i]
        exact, fuzzy = self.trie.match(table, length)
        matched = (exact >= 0) | (fuzzy >= 0)
        self.clear = np.union1d(self.clear, distinct[~matched])
        if len(self.clear) > CACHE_WORDS:
            self.clear = np.zeros(0, np.uint64)
        if not matched.any():
            return out
        distinct, exact, fuzzy = distinct[matched], exact[matched], fuzzy[matched]
        at = np.minimum(np.searchsorted(distinct, hashes), len(distinct) - 1)
        hit = np.flatnonzero(distinct[at] == hashes)
        term, near = exact[at[hit]], fuzzy[at[hit]]
        weight = self.trie.weights[np.where(term >= 0, term, near)]
        quoted, addressed = self._context(codes, starts, hashes, begin, end, doc, hit)
        sums = np.zeros_like(out)
        for column, chosen in enumerate(((term >= 0) & ~quoted, (term >= 0) & quoted, (term >= 0) & addressed & ~quoted, term < 0)):
            sums[:, column] = np.bincount(doc[hit], weight * chosen, len(block))
        matches = np.bincount(doc[hit], minlength=len(block))
        sums[:, 4] = matches
        strongest = np.zeros(len(block))
        np.maximum.at(strongest, doc[hit], weight * (term >= 0) * ~quoted)
        out[:] = np.log1p(sums)
        out[:, 5] = strongest
        out[:, 6] = np.log1p(100 * matches / (20 + np.bincount(doc, minlength=len(block))))
        return out

    def _context(self, codes, starts, hashes, begin, end, doc, hit) -> tuple[np.ndarray, np.ndarray]:
        """Whether each match is quoted, and whether it is addressed to someone."""
        low, high = np.maximum(begin[hit] - NEAR, starts[doc[hit]]), np.minimum(end[hit] + NEAR, starts[doc[hit] + 1])

        def any_between(places: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.searchsorted(places, b) > np.searchsorted(places, a)

        marks = np.flatnonzero(np.isin(codes, np.array([ord(c) for c in '"“”„«»'], np.uint32)))
        enclosed = any_between(marks, low, begin[hit]) & any_between(marks, end[hit], high)
        reported = any_between(begin[np.isin(hashes, self.reporting)], low, begin[hit])
        second = begin[np.isin(hashes, self.second)]
        return enclosed | reported, any_between(second, low, high)


def _feature_rows(rows: DataFrame, terms: list[tuple[str, float]], keep_text: bool = False) -> DataFrame:
    """Rows of (key columns, text last) with the features, in place of the text unless it is kept."""
    kept = rows.columns if keep_text else rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(terms)
        for batch in batches:
            parts = [scorer.features(block) for block in blocks(batch.column(batch.num_columns - 1))]
            found = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            columns = [*batch.columns[: len(kept)], *[pa.array(found[:, i]) for i in range(len(FEATURES))]]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *FEATURES])

    schema = StructType([*rows.schema.fields[: len(kept)], *[StructField(f, DoubleType()) for f in FEATURES]])
    return rows.mapInArrow(run, schema)


def logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, pull: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights (bias last) of a logistic model by Newton steps, drawn to ``prior``."""
    full = np.column_stack((x, np.ones(len(x))))
    at = np.append(prior, -3.0)
    center, w = at.copy(), at
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        slope = full.T @ (p - y) + pull * (w - center)
        bend = (full * (p * (1 - p))[:, None]).T @ full + pull * np.eye(full.shape[1])
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _named(column: str) -> Column:
    """A column by its name, with whatever characters."""
    return F.col(f"`{column.replace('`', '``')}`")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    lexicon_size: int = LEXICON_SIZE,
    threshold: float = 0.5,
    keep_rows: bool = False,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted and the features behind the score.

    With ``keep_rows`` also the input row, as the struct ``row``.
    """
    sample = labelled_sample(docs, labels, label_column, sample_rows, HELD_OUT, id_column, text_column)
    terms = learn_lexicon(sample, lexicon_size)
    with small_batches(docs.sparkSession):
        learned = _feature_rows(sample.select("y", "text"), terms).toPandas() if terms else None  # at most sample_rows rows
    # of kept rows the text, most of a row, goes through Python once only
    text_once = keep_rows and text_column in docs.columns and docs.schema[text_column].dataType == StringType()
    others = [c for c in docs.columns if not (text_once and c == text_column)]
    own = [F.struct(*map(_named, others)).alias("row")] if keep_rows else []
    rows = docs.select(*own, F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    found = _feature_rows(rows, terms, text_once)
    if text_once:
        found = found.withColumn("row", F.struct(*[F.col("text").alias(c) if c == text_column else F.col("row")[c] for c in docs.columns]))
    if learned is None:
        score = F.lit(0.0)
    else:
        w = logistic(learned[list(FEATURES)].to_numpy(), learned["y"].to_numpy(float), PRIOR)
        total = sum((F.col(f) * float(v) for f, v in zip(FEATURES, w, strict=False)), F.lit(float(w[-1])))
        score = 1 / (1 + F.exp(-total))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
        *FEATURES,
        *(["row"] if keep_rows else []),
    )
