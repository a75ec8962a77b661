"""Quality by attention-based multiple-instance learning.

A text is a bag of passages: pieces of ``PASSAGE_BYTES`` each (the last may be shorter), which together
are the whole text, at every length of text. Every passage is measured (shares of kinds of bytes,
lengths and repetition of words, byte histogram), encoded by a small layer, and weighted by gated
attention learned from the document labels alone; the weighted sum is scored.

Scoring is one pass without a shuffle. Learning takes at most ``sample_rows`` labelled rows, those of
least hash; of a longer text it takes ``LEARNED_PASSAGES`` passages spread evenly over the whole text.
Scoring looks at all of them.

Defined results: a null or empty text is one empty passage; without usable labels the score is 0.5;
conflicting labels of one id count as good; repeated rows get equal scores; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.llm.text import Block, blocks, hash_spans, lower_ascii, space_words
from fraudspark.llm.toxicity import held_out, labelled_sample

SAMPLE_ROWS = 4_000
PASSAGE_BYTES = 512
LEARNED_PASSAGES = 64
HIDDEN = 16
ATTENTION = 8
STEPS = 400
HELD_OUT = (4, 2)

# kinds of bytes that are counted one by one
_KINDS = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "wide": range(128, 256),
    "blank": (9, 11, 12, 13, 32),
    "line": (10,),
    "stop": map(ord, ".!?"),
    "pause": map(ord, ",;:"),
    "mark": map(ord, "#$%&*@^~_=+<>"),
    "rule": map(ord, "|\\/-"),
    "bracket": map(ord, "()[]{}\"'`"),
}
_KIND = np.full(256, len(_KINDS))
for _number, _codes in enumerate(_KINDS.values()):
    _KIND[list(_codes)] = _number
_N_KINDS = len(_KINDS) + 1
_N_WORDS = 8
WIDTH = _N_KINDS + _N_WORDS + 32


def passages(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Measures of all passages of a block, and how many each document has (at least one)."""
    length = np.diff(block.starts)
    count = np.maximum(1, -(-length // PASSAGE_BYTES))
    base = np.cumsum(count) - count
    n = int(count.sum())
    doc = np.repeat(np.arange(len(block)), length)
    place = np.arange(len(block.data)) - block.starts[doc]
    own = base[doc] + place // PASSAGE_BYTES
    total = np.maximum(np.bincount(own, minlength=n), 1)[:, None]
    out = np.zeros((n, WIDTH))
    kinds = np.bincount(own * _N_KINDS + _KIND[block.data], minlength=n * _N_KINDS)
    out[:, :_N_KINDS] = kinds.reshape(n, _N_KINDS) / total
    slot = ((lower_ascii(block.data).astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(27)).astype(np.int64)
    out[:, _N_KINDS + _N_WORDS :] = np.bincount(own * 32 + slot, minlength=n * 32).reshape(n, 32) / total
    begin, end, _ = space_words(block.data, block.starts)
    if len(begin):
        at, hashes = own[begin], hash_spans(lower_ascii(block.data), begin, end)
        words = np.maximum(np.bincount(at, minlength=n), 1)

        def share(flags: np.ndarray) -> np.ndarray:
            return np.bincount(at, flags, n) / words

        order = np.lexsort((hashes, at))
        new = np.ones(len(order))
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (at[order][1:] != at[order][:-1])
        again = np.zeros(len(at))
        again[1:] = (hashes[1:] == hashes[:-1]) & (at[1:] == at[:-1])
        first, last = block.data[begin], block.data[end - 1]
        letters = np.concatenate(([0], np.cumsum((block.data >= 128) | (_KIND[block.data] < 2))))
        measures = (
            np.bincount(at[order], new, n) / words,
            share(again),
            share((end - begin) / 10.0),
            share((end - begin) > 15),
            share((first >= 65) & (first <= 90)),
            share((last < 48) & (last != 46) & (last != 44)),
            share((letters[end] - letters[begin]) == 0),
            np.log1p(words) / 5,
        )
        out[:, _N_KINDS : _N_KINDS + _N_WORDS] = np.column_stack(measures)
    return out, count


def spread(count: int, most: int) -> np.ndarray:
    """Numbers of at most ``most`` of ``count`` passages, evenly apart."""
    return np.arange(count) if count <= most else np.arange(most) * count // most


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
        p, first = self.parts, np.cumsum(count) - count
        bag = np.repeat(np.arange(len(count)), count)
        h = np.tanh(x @ p["encode"] + p["encode_bias"])
        look, gate = np.tanh(h @ p["look"]), 1 / (1 + np.exp(-(h @ p["gate"])))
        e = (look * gate) @ p["attend"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        logit = z @ p["score"] + p["bias"]
        return {"bag": bag, "first": first, "h": h, "look": look, "gate": gate, "a": a, "z": z, "logit": logit}

    def score(self, measures: np.ndarray, count: np.ndarray) -> np.ndarray:
        logit = self.forward((measures - self.center) / self.scale, count)["logit"]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit(measures: np.ndarray, count: np.ndarray, y: np.ndarray, seed: int = 3, steps: int = STEPS, rate: float = 0.02) -> Model:
    """Full-batch Adam on the logistic loss of the bags."""
    rng = np.random.default_rng(seed)
    center, scale = measures.mean(axis=0), measures.std(axis=0) + 1e-3
    shapes = {"encode": (WIDTH, HIDDEN), "encode_bias": (HIDDEN,), "look": (HIDDEN, ATTENTION), "gate": (HIDDEN, ATTENTION), "attend": (ATTENTION,), "score": (HIDDEN,), "bias": (1,)}
    parts = {k: rng.normal(0, 0.3 / max(1, s[0]) ** 0.25, s) if "bias" not in k else np.zeros(s) for k, s in shapes.items()}
    model = Model(center, scale, parts)
    x = (measures - center) / scale
    m, v = ({k: np.zeros_like(p) for k, p in parts.items()} for _ in range(2))
    for t in range(1, steps + 1):
        f = model.forward(x, count)
        p = 1 / (1 + np.exp(-np.clip(f["logit"], -30, 30)))
        d = (p - y) / len(y)
        dz = d[:, None] * parts["score"]
        bag, a, h, look, gate = (f[k] for k in ("bag", "a", "h", "look", "gate"))
        da = (dz[bag] * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, f["first"])[bag])
        dlook = de[:, None] * gate * parts["attend"] * (1 - look**2)
        dgate = de[:, None] * look * parts["attend"] * gate * (1 - gate)
        dh = a[:, None] * dz[bag] + dlook @ parts["look"].T + dgate @ parts["gate"].T
        dx = dh * (1 - h**2)
        slopes = {"encode": x.T @ dx, "encode_bias": dx.sum(axis=0), "look": h.T @ dlook, "gate": h.T @ dgate, "attend": (look * gate).T @ de, "score": f["z"].T @ d, "bias": np.array([d.sum()])}
        for k, g in slopes.items():
            g = g + 1e-5 * parts[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            parts[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return model


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = 0.7,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    sample = labelled_sample(docs, labels, label_column, sample_rows, HELD_OUT, id_column, text_column)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                found, count = passages(block)
                stop = np.cumsum(count)
                bags = [found[b - c + spread(c, LEARNED_PASSAGES)].astype(np.float32).tobytes() for b, c in zip(stop, count, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, len(block)), pa.array(bags, pa.binary())], ["y", "bag"])

    learned = sample.select("y", "text").mapInArrow(measured, "y int, bag binary").toPandas()
    model = None
    if len(learned):
        bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in learned["bag"]]
        model = fit(np.concatenate(bags).astype(float), np.array([len(b) for b in bags]), learned["y"].to_numpy(float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(*passages(block)) if model else np.full(len(block), 0.5) for block in blocks(batch.column(1))]
            found = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, score double")
    return found.select(
        "doc_id",
        held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
