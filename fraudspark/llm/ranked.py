"""Ranked lexical search: short lists are summed term at a time, long lists are skipped document at a time.

One pass over the texts writes the postings of the wanted terms a document (``doc_id, n, terms, tfs``);
document frequencies and lengths are summed from it. Then each task indexes its documents in chunks:
a list an asked term, and the greatest impact of every list in every block of ``BLOCK_ROWS`` documents.
For an item the lists of at most ``SHORT_SHARE`` of a chunk's documents are summed into accumulators,
which from then on are one iterator more, with an exact bound a block. Blocks come in document order;
one is left out if the bounds of accumulators and long lists together stay below the item's k-th score
so far (from all chunks the task has seen) or below the k-th accumulator, so nothing that could be listed is skipped. What is
visited adds its long lists to its accumulator. Each task returns at most k rows an item, and the
lists of all tasks are merged by Spark.

Items are searched in blocks of at most ``TERMS_AT_ONCE`` asked terms; only a block's terms, weights and
items are held by a task.

Defined results: null texts and items have no terms; empty tables give no rows; repeated documents are
ranked each, a null id behind all others of its score; items that repeat an id are one item with the
terms of all; an item with a null id is an item; documents without any asked term have score 0 and
are not listed. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudspark.llm.text import Block, blocks, gather_places, hash_spans, lower_ascii, spans
from fraudspark.session import materialize

TOP = 50
BLOCK_ROWS = 16
CHUNK_ROWS = 8192
SHORT_SHARE = 1 / 64
BLOCKS_AT_ONCE = 64
TERMS_AT_ONCE = 1_000_000
_TERM = np.ones(256, bool)
_TERM[:48] = _TERM[58:65] = _TERM[91:97] = _TERM[123:128] = False


def terms_of(text: Column) -> Column:
    """Terms of a text column, in order."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))


def _runs(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every term of a block."""
    data = lower_ascii(block.data)
    begin, end, doc = spans(_TERM[data], block.starts)
    return hash_spans(data, begin, end), doc


def postings(docs: DataFrame, id_column: str, text_column: str, names: np.ndarray) -> DataFrame:
    """Columns doc_id, n, terms (numbers in ``names``, the sorted hashes of the asked terms), tfs."""
    shared = docs.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value
        for batch in batches:
            for block in blocks(batch.column(1)):
                word, doc = _runs(block)
                n = np.bincount(doc, minlength=len(block))
                at = np.minimum(np.searchsorted(names, word), max(len(names) - 1, 0))
                asked = names[at] == word if len(names) else np.zeros(len(word), bool)
                key, tf = np.unique(doc[asked] * np.int64(max(len(names), 1)) + at[asked], return_counts=True)
                owner, term = np.divmod(key, max(len(names), 1))
                offsets = pa.array(np.searchsorted(owner, np.arange(len(block) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (term, tf)]
                ids = batch.column(0).slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n.astype(np.int64)), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy().astype(np.int64), offsets - offsets[0]


def frequencies(found: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term; tasks send one row a term they have seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0))[0], minlength=n_terms)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32), pa.int32()), pa.array(total[seen])], ["term", "df"])

    rows = found.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(n_terms, np.int64)
    df[rows["term"].to_numpy()] = rows["df"].to_numpy()
    return df


class Chunk:
    """An index of some documents: postings by document and by term, and block bounds of the lists."""

    def __init__(self, ids: np.ndarray, no_id: np.ndarray, n: np.ndarray, terms: np.ndarray, tfs: np.ndarray, offsets: np.ndarray, n_docs: int, n_words: int):
        self.ids, self.no_id, self.offsets, self.terms = ids, no_id, offsets, terms
        m = 50 + (50 * n * n_docs) // max(n_words, 1)
        self.rows = len(ids)
        owner = np.repeat(np.arange(self.rows), np.diff(offsets))
        self.impact = (1_000_000_000 * tfs) // (1000 * tfs + 20 * m[owner])
        self.n_blocks = -(-self.rows // BLOCK_ROWS)
        order = np.argsort(terms, kind="stable")
        self.list_docs, self.list_impact = owner[order], self.impact[order]
        self.names, first = np.unique(terms[order], return_index=True)
        self.first = np.append(first, len(order))
        self.bounds: dict[int, np.ndarray] = {}

    def list_at(self, term: int) -> slice | None:
        """Where the list of a term stands."""
        i = int(np.searchsorted(self.names, term))
        if i == len(self.names) or self.names[i] != term:
            return None
        return slice(self.first[i], self.first[i + 1])

    def bound(self, term: int, where: slice) -> np.ndarray:
        """Greatest impact of the list in each block; made when first asked for."""
        if term not in self.bounds:
            block = self.list_docs[where] // BLOCK_ROWS
            starts = np.flatnonzero(np.diff(block, prepend=-1))
            out = np.zeros(self.n_blocks, np.int64)
            out[block[starts]] = np.maximum.reduceat(self.list_impact[where], starts)
            self.bounds[term] = out
        return self.bounds[term]


class Best:
    """The k best documents of an item so far: highest score, then least id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.ids, self.no_id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """Documents below this score cannot be listed any more."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        keep = score >= self.least
        score, ids, no_id = (np.concatenate(x) for x in ((self.score, score[keep]), (self.ids, ids[keep]), (self.no_id, no_id[keep])))
        order = np.lexsort((ids, no_id, -score))[: self.k]
        self.score, self.ids, self.no_id = score[order], ids[order], no_id[order]


def search_chunk(chunk: Chunk, terms: np.ndarray, weights: np.ndarray, best: Best, short_share: float = SHORT_SHARE) -> int:
    """Adds a chunk's documents to an item's best; the number of blocks visited."""
    summed = np.zeros(chunk.n_blocks * BLOCK_ROWS, np.int64)
    ceiling = np.zeros(chunk.n_blocks, np.int64)
    long_terms, long_weights = [], []
    for term, weight in zip(terms.tolist(), weights.tolist(), strict=True):
        where = chunk.list_at(term)
        if where is None:
            continue
        if where.stop - where.start <= short_share * chunk.rows:
            summed[chunk.list_docs[where]] += weight * chunk.list_impact[where]
        else:
            long_terms.append(term)
            long_weights.append(weight)
            ceiling += weight * chunk.bound(term, where)
    ceiling += summed.reshape(-1, BLOCK_ROWS).max(axis=1)
    names, by_name = np.array(long_terms, np.int64), np.array(long_weights, np.int64)
    # the long lists only add, so k accumulators of this height are k documents at or above it
    floor = int(np.partition(summed, -best.k)[-best.k]) if len(summed) >= best.k else 0
    waiting, visited = np.flatnonzero(ceiling >= max(floor, best.least)), 0
    while len(waiting):
        now, waiting = waiting[:BLOCKS_AT_ONCE], waiting[BLOCKS_AT_ONCE:]
        visited += len(now)
        rows = gather_places(now * BLOCK_ROWS, np.full(len(now), BLOCK_ROWS))
        rows = rows[rows < chunk.rows]
        score = summed[rows]
        if len(names):
            size = chunk.offsets[rows + 1] - chunk.offsets[rows]
            at = gather_places(chunk.offsets[rows], size)
            place = np.minimum(np.searchsorted(names, chunk.terms[at]), len(names) - 1)
            part = np.where(names[place] == chunk.terms[at], by_name[place] * chunk.impact[at], 0)
            total = np.concatenate(([0], np.cumsum(part)))
            stop = np.cumsum(size)
            score = score + total[stop] - total[stop - size]
        some = score > 0
        best.add(score[some], chunk.ids[rows[some]], chunk.no_id[rows[some]])
        waiting = waiting[ceiling[waiting] >= max(floor, best.least)]
    return visited


def _ranked_block(docs: DataFrame, asked: list[tuple], id_column: str, text_column: str, top: int, chunk_rows: int) -> DataFrame:
    """Best documents of some items, given as (number, hashes of terms)."""
    spark = docs.sparkSession
    names = np.unique(np.concatenate([h for _, h in asked])) if asked else np.zeros(0, np.uint64)
    found = materialize(postings(docs, id_column, text_column, names), "postings")
    n_docs, n_words = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = frequencies(found, len(names))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in df.tolist()], np.int64)
    items = [(number, np.searchsorted(names, np.sort(h))) for number, h in asked]
    shared = spark.sparkContext.broadcast((items, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = shared.value
        best = [Best(top) for _ in items]
        waiting, rows = [], 0

        def search() -> None:
            table = pa.Table.from_batches(waiting).combine_chunks().to_batches()
            for batch in table:
                terms, offsets = _flat(batch.column(2))
                tfs, _ = _flat(batch.column(3))
                no_id = ~np.asarray(batch.column(0).is_valid())
                ids = batch.column(0).fill_null(0).to_numpy()
                chunk = Chunk(ids, no_id, batch.column(1).to_numpy(), terms, tfs, offsets, n_docs, n_words)
                for (_, asked), one in zip(items, best, strict=True):
                    search_chunk(chunk, asked, weight[asked], one)

        for batch in batches:
            for at in range(0, batch.num_rows, chunk_rows):
                waiting.append(batch.slice(at, chunk_rows))
                rows += waiting[-1].num_rows
                if rows >= chunk_rows:
                    search()
                    waiting, rows = [], 0
        if waiting:
            search()
        for (number, _), one in zip(items, best, strict=True):
            if len(one.score):
                ids = pa.array(one.ids, pa.int64(), mask=one.no_id)
                item = pa.array(np.full(len(one.score), number, np.int64))
                yield pa.RecordBatch.from_arrays([item, ids, pa.array(one.score)], ["item", "doc_id", "score"])

    lists = found.mapInArrow(run, "item long, doc_id long, score long")
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return lists.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    query_id_column: str = "item_id",
    query_text_column: str = "text",
    top: int = TOP,
    terms_at_once: int = TERMS_AT_ONCE,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Per item and listed document: item_id, rank, doc_id, score."""
    asked = queries.select(F.col(query_id_column).alias("item_id"), F.explode(terms_of(F.col(query_text_column).cast("string"))).alias("term"))
    asked = materialize(asked.distinct(), "asked_terms")
    # items are numbered and dealt into blocks by hash; the terms of one block at a time come to the driver
    parts = max(1, math.ceil(asked.count() / terms_at_once))
    found = None
    for part in range(parts):
        listed: dict = {}
        for row in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).collect():
            listed.setdefault(row.item_id, []).append(row.term)
        numbers = [(i, hash_terms(terms)) for i, terms in enumerate(listed.values())]
        kind = queries.schema[query_id_column].dataType.simpleString()
        names = docs.sparkSession.createDataFrame(list(enumerate(listed)), f"item long, item_id {kind}")
        block = _ranked_block(docs, numbers, id_column, text_column, top, chunk_rows)
        # one row an item of the block
        block = block.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = block if found is None else found.unionByName(block)
    return found


def hash_terms(terms: list[str]) -> np.ndarray:
    """Hashes of terms, as the texts' terms are hashed."""
    whole = [t.encode() for t in terms]
    ends = np.cumsum([len(t) for t in whole])
    data = np.frombuffer(b"".join(whole), np.uint8)
    return hash_spans(data, ends - np.array([len(t) for t in whole]), ends)


ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
lengths AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM words GROUP BY doc_id),
total AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
held AS (
  SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, total GROUP BY term, big_n),
scored AS (
  SELECT item_id, held.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN lengths ON held.doc_id = lengths.doc_id, total
  GROUP BY item_id, held.doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
