"""Ranked lexical search: the best documents for each item, with documents of equal bags scored once.

A document counts for the items only through its bag, the frequencies of the items' terms in it, and its length class ``m``. Documents are restricted to the
items' vocabulary, equal (bag, m) are found by a hash and verified by the bags themselves, each class is scored once, and its members take places by
ascending id. Of a class no more than ``k`` members can have a place, so each task cuts it to the ``k`` smallest ids before the
shuffle: a group of copies of any size costs one score and ``k`` ids a task.

Scores are sums over postings (term, items) of the vocabulary; a task keeps the ``k`` best per item and hands on these only. Items are worked off in
blocks of about ``BLOCK_TERMS`` terms, so that vocabulary and postings of a block fit into a task at any size of the benchmark; each
block reads the documents once. Scores are exact: 64-bit integers, and sums of at most 200,000 terms stay below 2**53.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.frames import small_batches, utf8, written

#: Pairs of item and term in a block of items.
BLOCK_TERMS = 200_000
#: Cells (class, item) and postings that are held at a time.
CELLS = 1 << 21
SLICE = 1 << 20
NO_ID = 2**63 - 1

# Fixed values of the score.
TF_SCALE, TF_ONE, TF_LENGTH = 1_000_000_000, 1000, 20
LENGTH_BASE, LENGTH_SHARE = 100, 50

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^0-9a-z\x80-\xff]")


def term_counts(text: bytes | None) -> Counter:
    """How often each term occurs: runs of ASCII digits, letters and characters beyond ASCII, A-Z in lower case."""
    counts: Counter = Counter()
    data = (text or b"").lower()  # of bytes: ASCII only
    start = 0
    while start < len(data):  # in slices between terms, so that a very long text isn't held as a list of its terms
        cut = _BETWEEN.search(data, min(start + SLICE, len(data)))
        end = cut.start() if cut else len(data)
        counts.update(_TERM.findall(data, start, end))
        start = end
    return counts


# --- items ----------------------------------------------------------------------------------------------


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, term) of all rows with a term; rows of one id are one item."""
    small_batches(benchmark.sparkSession)
    schema = T.StructType([T.StructField("item", benchmark.schema[item_id].dataType), T.StructField("term", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(term_counts(t)) for t in utf8(batch.column(1))]
            rows = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array([t for ts in terms for t in ts], pa.binary())], names=["item", "term"]
            )

    return benchmark.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema).distinct()


class Postings:
    """The terms of a block of items by number, and for each term the items that have it."""

    def __init__(self, pairs: list[tuple[int, bytes]], n_items: int):
        self.n_items = n_items
        self.number = {term: i for i, term in enumerate(sorted({t for _, t in pairs}))}
        pairs = sorted((self.number[t], item) for item, t in pairs)
        self.items = np.array([item for _, item in pairs], dtype=np.int64)
        self.first = np.searchsorted(np.array([t for t, _ in pairs], dtype=np.int64), np.arange(len(self.number) + 1))


# --- documents as bags ------------------------------------------------------------------------------------


def _bags(docs: DataFrame, postings) -> DataFrame:
    """(doc_id, n, bag): all terms with repeats, and (term, frequency) of the vocabulary's terms, sorted, as bytes."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = postings.value.number
        for batch in batches:
            sizes, bags = [], []
            for text in utf8(batch.column(1)):
                counts = term_counts(text)
                sizes.append(counts.total())
                found = sorted((number[t], c) for t, c in counts.items() if t in number)
                bags.append(np.array(found, dtype="<i4").tobytes() if found else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], names=["doc_id", "n", "bag"])

    return docs.mapInArrow(run, "doc_id long, n long, bag binary").filter("n > 0")


def _document_counts(bags: DataFrame) -> dict[int, int]:
    """Term -> number of documents that hold it, summed per task first; at most as many as a block has terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<i4")[::2]
            counts = np.bincount(held, minlength=len(total)).astype(np.int64)
            counts[: len(total)] += total
            total = counts
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(total[terms], pa.int64())], names=["term", "df"])

    parts = bags.filter("bag IS NOT NULL").select("bag").mapInArrow(run, "term long, df long")
    return {r["term"]: r["df"] for r in parts.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def _classes(bags: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(m, bag, members): each distinct bag and length class with the ``k`` smallest ids of its documents."""
    m = F.expr(f"{LENGTH_BASE - LENGTH_SHARE}L + ({LENGTH_SHARE}L * n * {n_docs}L) div {n_terms}L")
    held = bags.filter("bag IS NOT NULL").select("doc_id", m.alias("m"), "bag").withColumn("hash", F.xxhash64("bag", "m"))
    one = ["hash", "m", "bag"]  # equal hashes bring documents together, equal bags make them one class
    place = F.row_number().over(Window.partitionBy(*one).orderBy(F.asc_nulls_last("doc_id")))
    cut = held.withColumn("place", place).filter(F.col("place") <= k)
    members = F.sort_array(F.collect_list(F.coalesce("doc_id", F.lit(NO_ID))))
    return cut.groupBy(*one).agg(members.alias("members")).select("m", "bag", "members")


# --- scores -------------------------------------------------------------------------------------------------


class Best:
    """The ``k`` best (score, doc_id) of every item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.item, self.score, self.doc = k, *(np.zeros(0, np.int64) for _ in range(3))
        self.least = np.ones(n_items, dtype=np.int64)  # what a score must reach to have a place

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        item, score, doc = (np.concatenate(p) for p in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < self.k
        self.item, self.score, self.doc = item[kept], score[kept], doc[kept]
        full = place == self.k - 1
        self.least[item[full]] = score[full]


def _scores(postings: Postings, weights: np.ndarray, rows: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores (class, item); ``rows`` is the class of each (term, tf), ``m`` its length class."""
    part = weights[terms] * ((TF_SCALE * tfs) // (TF_ONE * tfs + TF_LENGTH * m))
    start, count = postings.first[terms], postings.first[terms + 1] - postings.first[terms]
    of = np.repeat(np.arange(len(terms)), count)
    items = postings.items[start[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)]
    size = int(rows[-1]) + 1 if len(rows) else 0
    cells = np.bincount(rows[of] * postings.n_items + items, weights=part[of], minlength=size * postings.n_items)
    return cells.astype(np.int64).reshape(size, postings.n_items)


def _scored(classes: DataFrame, postings, weights, k: int) -> DataFrame:
    """(item, doc_id, score): the ``k`` best of each task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weight = postings.value, weights.value
        width = np.diff(index.first)
        best = Best(index.n_items, k)

        def score(bags: list[np.ndarray], ms: list[int], members: list[list[int]]) -> None:
            rows = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
            pairs = np.concatenate(bags).astype(np.int64)
            found = _scores(index, weight, rows, pairs[:, 0], pairs[:, 1], np.array(ms, dtype=np.int64)[rows])
            at, item = np.nonzero(found >= best.least)
            counts = np.array([len(members[i]) for i in at], dtype=np.int64)
            docs = [d for i in at.tolist() for d in members[i]]
            best.add(np.repeat(item, counts), np.repeat(found[at, item], counts), np.array(docs, dtype=np.int64))

        for batch in batches:
            bags, ms, members, held = [], [], [], 0
            for m, data, ids in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                bag = np.frombuffer(data, dtype="<i4").reshape(-1, 2)
                if bags and (held > CELLS or len(bags) * index.n_items > CELLS):
                    score(bags, ms, members)
                    bags, ms, members, held = [], [], [], 0
                bags.append(bag)
                ms.append(m)
                members.append(ids)
                held += int(width[bag[:, 0]].sum())
            if bags:
                score(bags, ms, members)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (best.item, best.doc, best.score)], names=["item", "doc_id", "score"])

    return classes.mapInArrow(run, "item long, doc_id long, score long")


def _block(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame | None:
    """(item, rank, doc_id, score) of the items of a block; None where no document has a term."""
    spark = docs.sparkSession
    rows = [(r["item"], bytes(r["term"])) for r in pairs.collect()]  # about BLOCK_TERMS
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i))
    number = {i: n for n, i in enumerate(ids)}
    postings = spark.sparkContext.broadcast(Postings([(number[i], t) for i, t in rows], len(ids)))
    bags = written(_bags(docs, postings), "bags")
    n_docs, n_terms = bags.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    df = _document_counts(bags)
    logs = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(postings.value.number))]
    weights = spark.sparkContext.broadcast(np.array(logs, dtype=np.int64))
    found = _scored(_classes(bags, n_docs, n_terms, k), postings, weights, k)
    order = [F.desc("score"), F.asc("doc_id")]  # a null id, standing as the largest, comes last
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    kind = pairs.schema["item"].dataType
    names = spark.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", kind)]))
    doc = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", doc, "score")


def ranked_search(
    docs: DataFrame, benchmark: DataFrame, *, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: for each item its ``k`` best documents with a score above 0, ties by ascending id.

    N counts the documents with a term, L all their terms, n one document's terms, df the documents with a term, tf its occurrences in the document. A term
    weighs ``floor(1000 * ln((2N + 2) / (2df + 1)))``, ``m`` is ``50 + 50nN div L``, and a document scores the sum over the item's distinct
    terms of ``weight * (1000000000tf div (1000tf + 20m))``.

    Ids of documents are whole numbers; null ids come last among equal scores. Repeated rows are documents of their own and may have a place
    each. Rows of one item id are one item, a null item id included. Null, empty and termless texts have no terms: such items have no rows,
    such documents do not count in N. Other columns are not read, and an empty table on either side gives an empty result. The terms of one
    item must fit into a task.
    """
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    pairs = written(_items(benchmark, item_id, item_text), "terms")
    blocks = -(-pairs.count() // BLOCK_TERMS)
    results = [_block(docs, pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), k) for b in range(blocks)]
    results = [r for r in results if r is not None]
    if not results:
        kind = benchmark.schema[item_id].dataType
        empty = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
        return docs.sparkSession.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, results)
