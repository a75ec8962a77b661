"""Language identification by hierarchical discrimination.

A text is its frequencies of hashed byte bigrams and trigrams, as a unit vector of square roots.
Families are groups of the learned languages whose mean vectors are alike (average linkage, about the
square root of the number of languages). One linear support vector machine per family chooses the
family first; within it one machine for every two languages votes.

Scoring is one pass over the whole texts without a shuffle. Learning takes different training rows,
those of least hash of id and text: at most ``sample_per_language`` of each language and about
``sample_rows`` in all. Equal rows count once, so neither one id nor one text can fill or miss the sample.

Defined results: ``und`` with score 0 for null texts, texts without a letter, and if nothing can be
learned; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudspark.llm.text import Block, blocks, lower_ascii
from fraudspark.llm.toxicity import held_out
from fraudspark.session import materialize

SAMPLE_PER_LANGUAGE = 1_000
SAMPLE_ROWS = 20_000
BIGRAM_BITS, TRIGRAM_BITS = 10, 11
WIDTH = (1 << BIGRAM_BITS) + (1 << TRIGRAM_BITS)
HELD_OUT = (5, 0)
UNKNOWN = "und"

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def features(block: Block) -> np.ndarray:
    """One unit vector per document; zero without n-grams."""
    b = _LETTER[lower_ascii(block.data)].astype(np.uint32)
    doc = np.repeat(np.arange(len(block)), np.diff(block.starts))
    out = np.zeros(len(block) * WIDTH)
    spread = np.uint32(0x9E3779B1)
    for size, bits, base in ((2, BIGRAM_BITS, 0), (3, TRIGRAM_BITS, 1 << BIGRAM_BITS)):
        n = len(b) - size + 1
        if n <= 0:
            continue
        gram = b[:n]
        for k in range(1, size):
            gram = (gram << np.uint32(8)) | b[k : n + k]
        slot = (gram * spread) >> np.uint32(32 - bits)
        inside = doc[:n] == doc[size - 1 :]
        at = doc[:n][inside] * WIDTH + base + slot[inside]
        out += np.bincount(at, minlength=len(out))
    out = np.sqrt(out.reshape(len(block), WIDTH))
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return (out / np.maximum(norm, 1e-12)).astype(np.float32)


def has_letter(block: Block) -> np.ndarray:
    lower = lower_ascii(block.data)
    ascii_letters = np.concatenate(([0], np.cumsum((lower >= 97) & (lower <= 122))))
    found = np.diff(ascii_letters[block.starts]) > 0
    for i in np.flatnonzero(~found & (np.diff(block.starts) > 0)):
        found[i] = any(c.isalpha() for c in block.text(i).decode())
    return found & block.valid


def linear_svm(x: np.ndarray, y: np.ndarray, seed: int, epochs: int = 12, strength: float = 1e-4) -> np.ndarray:
    """Weights (bias last) of a linear machine with hinge loss, averaged over the second half of the steps."""
    rng = np.random.default_rng(seed)
    x = np.column_stack((x, np.ones(len(x), np.float32)))
    w, mean, kept, step = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0, 0
    total = epochs * -(-len(x) // 32)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 32):
            part = order[at : at + 32]
            step += 1
            rate = 1 / (strength * (step + 1000))
            wrong = part[y[part] * (x[part] @ w) < 1]
            w *= 1 - rate * strength
            if len(wrong):
                w += rate / len(part) * (y[wrong] @ x[wrong]) * 0.01
            if step * 2 > total:
                kept += 1
                mean += (w - mean) / kept
    return mean


def families_of(means: np.ndarray) -> list[list[int]]:
    """Groups of languages by average linkage of their mean vectors."""
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    alike = unit @ unit.T
    groups = [[i] for i in range(len(means))]
    while len(groups) > max(1, round(len(means) ** 0.5)):
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: alike[np.ix_(groups[p[0]], groups[p[1]])].mean())
        groups[a] += groups.pop(b)
    return [sorted(g) for g in groups]


@dataclass
class Model:
    languages: list[str]
    families: list[list[int]]
    family_weights: np.ndarray
    pair_weights: dict[tuple[int, int], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language and score from 0 to 1 for each row."""
        x = np.column_stack((x, np.ones(len(x), np.float32)))
        margins = x @ self.family_weights.T
        rise = np.exp(2 * (margins - margins.max(axis=1, keepdims=True)))
        family = margins.argmax(axis=1)
        sure = rise.max(axis=1) / rise.sum(axis=1)
        language, score = np.zeros(len(x), np.int64), np.zeros(len(x))
        for f, members in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            votes, won = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for i, j in combinations(range(len(members)), 2):
                p = 1 / (1 + np.exp(-2 * (x[rows] @ self.pair_weights[members[i], members[j]])))
                votes[:, i] += p >= 0.5
                votes[:, j] += p < 0.5
                won[:, i] += p
                won[:, j] += 1 - p
            best = (votes + 1e-3 * won).argmax(axis=1)
            language[rows] = np.array(members)[best]
            inner = won[np.arange(len(rows)), best] / max(1, len(members) - 1) if len(members) > 1 else 1.0
            score[rows] = sure[rows] * inner
        return language, score


def fit(x: np.ndarray, langs: np.ndarray, seed: int = 5) -> Model:
    languages = sorted(set(langs.tolist()))
    number = np.array([languages.index(v) for v in langs])
    families = families_of(np.stack([x[number == i].mean(axis=0) for i in range(len(languages))]))
    of = np.array([next(f for f, g in enumerate(families) if i in g) for i in range(len(languages))])[number]
    one = [linear_svm(x, np.where(of == f, 1.0, -1.0), seed) if len(families) > 1 else np.zeros(x.shape[1] + 1) for f in range(len(families))]
    pairs = {}
    for members in families:
        for i, j in combinations(members, 2):
            rows = np.flatnonzero((number == i) | (number == j))
            pairs[i, j] = linear_svm(x[rows], np.where(number[rows] == i, 1.0, -1.0), seed)
    return Model(languages, families, np.stack(one), pairs)


def _sample(docs: DataFrame, per_language: int, rows: int) -> DataFrame:
    """Different training rows (lang, text) of least hash, at most ``per_language`` of each and ``rows`` in all.

    Rows are named by a hash of id and text; equal ones collapse per task before the narrow shuffle.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), *HELD_OUT))
    known = known.select("lang", "text", F.xxhash64("doc_id", "text").alias("name"))
    names = materialize(known.select("lang", "name").distinct(), "names")
    counts = names.groupBy("lang").count()
    languages = counts.count()
    if not languages:
        return known.select("lang", "text").limit(0)
    each = max(1, min(per_language, rows // languages))
    draw = F.pmod(F.xxhash64("name", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    near = names.join(F.broadcast(counts), "lang").withColumn("draw", draw)  # one row per language
    near = near.where(F.col("draw") * F.col("count") < 1.3 * each + 50)
    first = Window.partitionBy("lang").orderBy("draw", "name")
    chosen = near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= each).select("lang", "name")
    found = known.join(F.broadcast(chosen), ["lang", "name"])  # bounded by ``rows``
    return found.groupBy("lang", "name").agg(F.min("text").alias("text")).select("lang", "text")


def language(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, family."""
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        F.col(lang_column).cast("string").alias("lang"),
    )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                found = [v.tobytes() for v in features(block)]
                langs = batch.column(0).slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays([langs, pa.array(found, pa.binary())], ["lang", "vector"])

    learned = materialize(_sample(rows, sample_per_language, sample_rows), "languages").mapInArrow(vectors, "lang string, vector binary").toPandas()
    model = None
    if len(learned):
        model = fit(np.stack([np.frombuffer(v, np.float32) for v in learned["vector"]]), learned["lang"].to_numpy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, groups = [], [], []
            for block in blocks(batch.column(1)):
                lettered = has_letter(block)
                if model is None:
                    lettered[:] = False
                    number, score = np.zeros(len(block), np.int64), np.zeros(len(block))
                else:
                    number, score = model.predict(features(block))
                family = {i: f for f, g in enumerate(model.families) for i in g} if model else {}
                names += [model.languages[n] if ok else UNKNOWN for n, ok in zip(number, lettered, strict=True)]
                groups += [family[n] if ok else None for n, ok in zip(number.tolist(), lettered, strict=True)]
                scores.append(np.where(lettered, score, 0.0))
            columns = [batch.column(0), pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else []), pa.array(groups, pa.int32())]
            yield pa.RecordBatch.from_arrays([c.cast(pa.float64()) if i == 2 else c for i, c in enumerate(columns)], ["doc_id", "lang_pred", "score", "family"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, family int")
    return found.select("doc_id", held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"), "lang_pred", "score", "family")
