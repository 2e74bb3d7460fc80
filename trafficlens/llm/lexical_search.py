"""Ranked lexical search over K2-treaps (operator 13).

One pass over the documents counts documents and terms; a second one builds an
index shard of every few million term occurrences, wherever the documents lie:
a grid with the shard's terms as rows and its documents as columns, whose cells
hold the impact of the term on the document, kept as a K2-treap (``k2_treap``).
Each item's terms descend together through a shard, best range of documents
first, and stop at the k-th score found so far by the task. Shards are searched
where they are built, so no index moves; k rows per item leave each task.

Documents of a shard are put in order of their most frequent term and length,
so documents of one language and size share quadrants and the maxima are tight.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .common import ship, text_or_empty
from .k2_treap import Best, K2Treap, range_minima, search

CELLS = 2 << 20  # cells of a shard, but for a longer document
SHARD_DOCS = 1 << 14  # documents of a shard at most
HELD_TERMS = 500_000  # terms a task counts before it passes them on
BLOCK_TERMS = 2_000_000  # terms of all items searched in one job
SALTS = 32  # groups in which an item's candidates are ranked first
NO_ID = (1 << 63) - 1  # stands for a null id, after all others


def _byte_map() -> bytes:
    """A-Z lower-cased; digits, letters and bytes of other scripts stay; a blank for all else."""
    kept = lambda b: chr(b).isalnum() if b < 0x80 else True
    return bytes(ord(chr(b).lower()) if kept(b) and b < 0x80 else b if kept(b) else 0x20 for b in range(256))


BYTES = _byte_map()


def terms_of(text: str) -> list[bytes]:
    """The maximal runs of ASCII digits and letters and of non-ASCII characters."""
    return text.encode().translate(BYTES).split()


def corpus_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``term, df, occurrences``: in how many documents each term stands, and
    how often. The row of the null term counts the documents that have a term,
    and all terms."""
    ship(docs.sparkSession)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        n = total = 0

        def flush() -> pa.RecordBatch:
            terms = [None, *df]
            values = [n, *df.values()]
            return pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), pa.array(values, pa.int64()), pa.array([total] + [0] * len(df), pa.int64())], names=["term", "df", "occurrences"])

        for batch in batches:
            for text in batch.column(0):
                terms = terms_of(text.as_py())
                n, total = n + bool(terms), total + len(terms)
                df.update(set(terms))
                if len(df) >= HELD_TERMS:
                    yield flush()
                    df.clear()
                    n = total = 0
        yield flush()

    counted = docs.select(text_or_empty(text_col)).mapInArrow(tally, "term binary, df bigint, occurrences bigint")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("occurrences").alias("occurrences"))


class Shard:
    """Index of some documents: term rows, document ids by column, K2-treap."""

    def __init__(self, rows: dict[bytes, int], ids: np.ndarray, treap: K2Treap):
        self.rows, self.ids, self.treap = rows, ids, treap
        self.least = range_minima(ids, treap.height)

    def search(self, terms: list[bytes], weights: np.ndarray, best: Best) -> int:
        found = [(self.rows[t], w) for t, w in zip(terms, weights.tolist()) if t in self.rows]
        if not found:
            return 0
        rows, weights = (np.array(x, np.int64) for x in zip(*found))
        return search(self.treap, rows, weights, self.ids, self.least, best)


def impacts(tf: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What an occurrence count adds to a document's score, before the weight."""
    m = 100 - 90 + 90 * lengths * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class ShardBuilder:
    def __init__(self, n_docs: int, n_terms: int, most: int = CELLS):
        self.n_docs, self.n_terms, self.most = n_docs, n_terms, most
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[bytes, int] = defaultdict(count().__next__)
        self.row_parts, self.tf_parts, self.ids, self.lengths, self.cells = [], [], [], [], 0

    def add(self, ident: int | None, text: str) -> None:
        terms = terms_of(text)
        if not terms:
            return
        tf = Counter(terms)
        self.row_parts.append(np.fromiter(map(self.rows.__getitem__, tf), np.int64, len(tf)))
        self.tf_parts.append(np.fromiter(tf.values(), np.int64, len(tf)))
        self.ids.append(NO_ID if ident is None else ident)
        self.lengths.append(len(terms))
        self.cells += len(tf)

    def full(self) -> bool:
        return self.cells >= self.most or len(self.ids) >= SHARD_DOCS

    def finish(self) -> Shard | None:
        if not self.ids:
            return None
        sizes = np.array([len(x) for x in self.row_parts])
        rows, tf = np.concatenate(self.row_parts), np.concatenate(self.tf_parts)
        lengths, ids = np.array(self.lengths), np.array(self.ids, np.int64)
        starts = np.cumsum(sizes) - sizes
        main = np.maximum.reduceat(tf << 32 | (0xFFFFFFFF - rows), starts) & 0xFFFFFFFF
        order = np.lexsort((ids, lengths, main))
        column = np.empty(len(ids), np.int64)
        column[order] = np.arange(len(ids))
        treap = K2Treap(rows, np.repeat(column, sizes), impacts(tf, np.repeat(lengths, sizes), self.n_docs, self.n_terms), len(self.rows), len(ids))
        shard = Shard(dict(self.rows), ids[order], treap)
        self._clear()
        return shard


def build_shards(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int, most: int = CELLS) -> Iterator[Shard]:
    """Shards of a task's documents (columns id and text), one at a time."""
    builder = ShardBuilder(n_docs, n_terms, most)
    for batch in batches:
        for ident, text in zip(batch.column(0), batch.column(1)):
            builder.add(ident.as_py(), text.as_py())
            if builder.full():
                yield builder.finish()
    if (last := builder.finish()) is not None:
        yield last


def _item_weights(items: DataFrame, stats: DataFrame, n_docs: int, item_col: str, text_col: str) -> DataFrame:
    """``item, term, weight`` for the distinct terms of each item that some document has."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(i, t) for i, text in zip(*(c.to_pylist() for c in batch.columns)) for t in set(terms_of(text))]
            ids, terms = zip(*pairs) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item", "term"])

    own = items.select(F.col(item_col).cast("bigint"), text_or_empty(text_col)).mapInArrow(split, "item bigint, term binary").distinct()
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    return own.join(stats, "term").select("item", "term", weight.alias("weight")).where("weight > 0")


def _searcher(spark: SparkSession, queries: dict[int | None, tuple[list[bytes], np.ndarray]], n_docs: int, n_terms: int, k: int, cells: int):
    shared = spark.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int | None, Best] = {}
        for shard in build_shards(batches, n_docs, n_terms, cells):
            for item, (terms, weights) in shared.value.items():
                shard.search(terms, weights, best.setdefault(item, Best(k)))
        found = [(item, None if i == NO_ID else i, s) for item, b in best.items() for s, i in b.ranked()]
        columns = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc", "score"])

    return run


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
    cells: int = CELLS,
) -> DataFrame:
    """``<item_col>, rank, <doc_col>, score``: for each item the ``k`` documents
    with the largest scores above 0, equal scores by ascending id.

    The score is a sum over the item's distinct terms of a weight from the
    term's document count times an impact from its occurrences and the
    document's length, all in integers (``impacts``). Ids are integers.

    Null and empty texts have no terms: such documents count nowhere and such
    items have no rows. Rows with one item id are one item with the terms of
    all. Documents with equal ids are ranked each; a null document id stands
    after all others of its score (the largest long is taken for null). Other
    columns are ignored. With an empty table on either side there are no rows.

    The items' terms are broadcast, at most about ``block_terms`` of them to a
    job; more items make more jobs. A task holds one shard: ``cells`` cells or
    the terms of one document.
    """
    spark = docs.sparkSession
    ship(spark)
    stats = materialize(corpus_statistics(docs, text_col), name="term-statistics")
    totals = stats.where("term IS NULL").agg(F.sum("df").alias("n"), F.sum("occurrences").alias("l")).first()
    n_docs, n_terms = totals.n or 0, totals.l or 0
    empty = "item bigint, doc bigint, score bigint"
    found = spark.createDataFrame([], empty)
    if n_docs:
        weights = materialize(_item_weights(items, stats, n_docs, item_col, item_text_col), name="item-terms")
        blocks = -(-weights.count() // block_terms)
        texts = docs.select(F.col(doc_col).cast("bigint"), text_or_empty(text_col))
        for b in range(blocks):
            queries: dict[int | None, tuple[list, list]] = {}
            for r in weights.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toLocalIterator():
                own = queries.setdefault(r.item, ([], []))
                own[0].append(bytes(r.term))
                own[1].append(r.weight)
            packed = {i: (t, np.array(w, np.int64)) for i, (t, w) in queries.items()}
            part = texts.mapInArrow(_searcher(spark, packed, n_docs, n_terms, k, cells), empty)
            found = part if not b else found.unionByName(part)
    by_score = [F.desc("score"), F.asc_nulls_last("doc")]
    salt = F.pmod(F.xxhash64("doc", "score"), F.lit(SALTS))
    few = found.withColumn("_salt", salt)
    few = few.withColumn("_r", F.row_number().over(Window.partitionBy("item", "_salt").orderBy(*by_score))).where(F.col("_r") <= k)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by_score))).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(doc_col), "score")
