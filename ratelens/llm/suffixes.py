"""Repeated passages by sparse suffix arrays, decided exactly by their windows.

Of all suffixes (from a word to the end of its text) only those at minimiser positions are kept: in every window of ``length`` words the one whose
first gram has the least hash, so a passage that two texts hold keeps the same suffixes in both. Suffixes whose gram stands in one text
only drop out. The others carry the hashes of the words on either side and are sorted twice, by the words to the right and by
the words to the left. In sorted order a suffix shares the most words with the nearest one of another text, above it or below; that is how far it
reaches to that side. Where gram and both reaches come to ``length`` words, the stretch between them may be repeated, and nothing outside of
such stretches can be.

Right and left may be shared with different texts, so the windows inside the stretches decide: for each hash of a window one pre-aggregated
grouping finds whether several texts hold it and which is the first. Each text's repeated windows join into spans.

Rows are sorted by range over all tasks, so a gram of very many texts is spread. Rows at the border of a task, whose nearest other text lies in
another task, are completed from two rows on either side of each border. Exact up to clashes of 64-bit hashes. Equal texts are one source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.frames import lean, with_arrow_columns, written
from ratelens.llm.hashing import EMPTY, mix, shingle_hashes, word_hashes

LENGTH = 50
GRAM = 16
SLICE = 65536
SIDES = 4096
BROADCAST_IDS = 500_000
LAST = 2**63 - 1

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))


def words_of(text: str | None) -> np.ndarray:
    return word_hashes(text.encode()) if text else EMPTY


def text_name(words: np.ndarray) -> int | None:
    """64-bit name of a sequence of words; None without words."""
    if not len(words):
        return None
    place = mix(np.arange(1, len(words) + 1, dtype=np.uint64))
    return int(mix(words * (place | np.uint64(1))).sum(dtype=np.uint64).view(np.int64))


def minimisers(words: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the kept suffixes and the hashes of their first grams; the leftmost least hash of every window."""
    if len(words) < length:
        return np.empty(0, np.int64), EMPTY
    hashes = shingle_hashes(words, gram)
    width = length - gram + 1
    chosen = []
    for start in range(0, len(hashes) - width + 1, SLICE):  # windows of a slice, so that memory stays bounded
        view = np.lib.stride_tricks.sliding_window_view(hashes[start : start + SLICE + width - 1], width)
        chosen.append(np.unique(view.argmin(axis=1) + np.arange(len(view))) + start)
    positions = np.unique(np.concatenate(chosen))
    return positions, hashes[positions]


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """One hash per window of ``length`` words."""
    if len(words) < length:
        return EMPTY
    powers = np.full((2, min(len(words), SLICE + length)), _STEP, dtype=np.uint64)
    powers[1] = _BACK
    powers[:, 0] = 1
    powers = np.multiply.accumulate(powers, axis=1)
    hashes = []
    for start in range(0, len(words) - length + 1, SLICE):
        part = words[start : start + SLICE + length - 1]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * powers[0, : len(part)], dtype=np.uint64)))
        hashes.append(mix((sums[length:] - sums[:-length]) * powers[1, : len(part) - length + 1]))
    return np.concatenate(hashes)


def _sources(docs: DataFrame) -> DataFrame:
    """(id, n_words, name) of every document."""
    added = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("name", T.LongType())])

    def compute():
        def slice_(texts: pa.Array) -> list[pa.Array]:
            words = [words_of(t) for t in texts.to_pylist()]
            return [pa.array([len(w) for w in words], pa.int64()), pa.array([text_name(w) for w in words], pa.int64())]

        return slice_

    return with_arrow_columns(docs, ["text"], added, compute).select("id", "n_words", "name")


def _grams(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, name): the distinct first grams of the kept suffixes of each text."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("name", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in batches:
            keys, names = [EMPTY], [np.empty(0, np.int64)]
            for text in part.column(0).to_pylist():
                words = words_of(text)
                name = text_name(words)
                if len(words) < length or name in seen:
                    continue
                seen.add(name)
                key = np.unique(minimisers(words, length, gram)[1])
                keys.append(key)
                names.append(np.full(len(key), name, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(names))], names=["key", "name"]
            )

    return texts.mapInArrow(lean(run), schema)


def _suffixes(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, right, left, name, at) of the kept suffixes whose first gram several texts have.

    Suffixes of one text with equal words on both sides are one row with all their positions ``at``.
    """
    names = ["key", "right", "left", "name", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for text, shared, name in zip(*[part.column(i).to_pylist() for i in range(3)]):
                words = words_of(text)
                if text_name(words) != name:
                    continue
                positions, keys = minimisers(words, length, gram)
                kept = np.isin(keys, np.array(shared, dtype=np.int64).view(np.uint64))
                positions, keys = positions[kept], keys[kept].view(np.int64)
                short = (words >> np.uint64(32)).astype(np.uint32) | np.uint32(1)  # 0 stands for no word
                short = np.concatenate((np.zeros(length, np.uint32), short, np.zeros(length, np.uint32))).astype(">u4")
                reach = np.arange(length - gram)
                for i in range(0, len(positions), SIDES):
                    at = positions[i : i + SIDES]
                    right = short[at[:, None] + length + gram + reach]
                    left = short[at[:, None] + length - 1 - reach]
                    places: dict[tuple[int, bytes, bytes], list[int]] = {}
                    for k, r, l, p in zip(keys[i : i + SIDES].tolist(), right, left, at.tolist()):
                        places.setdefault((k, r.tobytes(), l.tobytes()), []).append(p)
                    columns = [list(c) for c in zip(*places)]
                    kinds = (pa.int64(), pa.binary(), pa.binary())
                    rows = [pa.array(c, k) for c, k in zip(columns, kinds)]
                    rows += [pa.array(np.full(len(places), name, np.int64)), pa.array(list(places.values()), pa.list_(pa.int32()))]
                    yield pa.RecordBatch.from_arrays(rows, names=names)

    return texts.select("text", "keys", "name").mapInArrow(lean(run), "key long, right binary, left binary, name long, at array<int>")


def shared_words(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that rows of equal places have in common from the start; 0 stands for no word."""
    return np.cumprod((a == b) & (a != 0), axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)


def nearest_other(names: list[int], common: list[int]) -> list[int]:
    """For sorted rows, what each shares with the nearest row before it of another name; -1 where all before it are of its own.

    ``common[i]`` is what row i shares with the row before it. What two rows share is the least of that on the way from one to the other.
    """
    out = [-1] * len(names)
    for i in range(1, len(names)):
        out[i] = common[i] if names[i] != names[i - 1] else min(common[i], out[i - 1])
    return out


#: The first and last rows of a task, and the first and last ones of another name than these.
EDGES = ("first", "second", "second_last", "last")


def _reaches(suffixes: DataFrame, side: str, length: int, gram: int) -> DataFrame:
    """(name, at, reach): the most words that each suffix shares on one side with a suffix of another text; -1: none has its gram."""
    words = length - gram
    columns = [("name", pa.int64()), ("at", pa.list_(pa.int32())), ("reach", pa.int32()), ("to_first", pa.int32()), ("to_last", pa.int32()),
               ("task", pa.int32()), ("edge", pa.string()), ("key", pa.int64()), ("side", pa.binary())]
    schema = "name long, at array<int>, reach int, to_first int, to_last int, task int, edge string, key long, side binary"

    def table(rows: dict[str, list]) -> pa.RecordBatch:
        count = len(next(iter(rows.values())))
        return pa.RecordBatch.from_arrays([pa.array(rows[c], k) if c in rows else pa.nulls(count, k) for c, k in columns], names=[c for c, _ in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        keys, sides, names, at = [], [], [], []
        for batch in batches:
            keys.append(batch.column(0).to_numpy())
            sides.append(batch.column(1).to_pylist())
            names += batch.column(2).to_pylist()
            at.append(batch.column(3))
        if not names:
            return
        key, side_bytes = np.concatenate(keys), [v for part in sides for v in part]
        common = np.full(len(names), -1, dtype=np.int64)
        for i in range(0, len(names), SLICE):  # each slice with the row before it
            start = max(0, i - 1)
            table_ = np.frombuffer(b"".join(side_bytes[start : i + SLICE]), dtype=">u4").reshape(-1, words)
            same = key[start : i + SLICE]
            found = np.where(same[1:] == same[:-1], shared_words(table_[1:], table_[:-1]), -1)
            common[start + 1 : start + 1 + len(found)] = found
        before = nearest_other(names, common.tolist())
        after = nearest_other(names[::-1], [-1, *common[:0:-1].tolist()])[::-1]
        # rows of the first name from the start on, and of the last name up to the end, may have a nearer other text in another task
        n = len(names)
        head = next((i for i in range(n) if names[i] != names[0]), n)
        tail = next((i for i in range(n) if names[n - 1 - i] != names[-1]), n)
        to_first, to_last = [None] * n, [None] * n
        low = words
        for i in range(head):
            low = min(low, int(common[i])) if i else words
            to_first[i] = low
        for i in range(tail):
            low = min(low, int(common[n - i])) if i else words
            to_last[n - 1 - i] = low
        reach = [max(b, a) for b, a in zip(before, after)]
        lists = pa.chunked_array(at).combine_chunks()
        for i in range(0, n, 10_000):
            part = slice(i, i + 10_000)
            yield table({"name": names[part], "at": lists.slice(i, 10_000), "reach": reach[part], "to_first": to_first[part], "to_last": to_last[part], "task": [task] * len(names[part])})
        at_edge = {"first": 0, "last": n - 1} | ({"second": head, "second_last": n - 1 - tail} if head < n else {})
        places = list(at_edge.values())
        yield table({"edge": list(at_edge), "task": [task] * len(places), "key": key[places], "side": [side_bytes[p] for p in places], "name": [names[p] for p in places]})

    order = ["key", side, "name"]
    spread = suffixes.select("key", side, "name", "at").repartitionByRange(*order).sortWithinPartitions(*order)
    compared = written(spread.mapInArrow(lean(run), schema), "compared")
    rows = compared.filter("edge IS NULL").drop("edge", "key", "side")
    borders = compared.filter("edge IS NOT NULL").select("task", "edge", "key", "side", "name").collect()  # four rows a task at most
    beyond = borders_of([r.asDict() for r in borders], words)
    known = compared.sparkSession.createDataFrame(beyond, "task int, before int, after int")
    # a row shares with what lies beyond the border the least of its way to the border and of the border's own
    over = [F.when(F.col(way).isNotNull(), F.least(way, border)) for way, border in (("to_first", "before"), ("to_last", "after"))]
    return rows.join(F.broadcast(known), "task").select("name", "at", F.greatest("reach", *over).alias("reach"))


def borders_of(edges: list[dict], words: int) -> list[tuple[int, int, int]]:
    """(task, before, after): what the first row of a task shares with the nearest row of another name in the tasks before it, and the last
    row with the nearest one after it; -1 for none."""
    by_task: dict[int, dict[str, dict]] = {}
    for e in edges:
        by_task.setdefault(e["task"], {})[e["edge"]] = e
    tasks = sorted(by_task)

    def shares(a: dict, b: dict) -> int:
        if a["key"] != b["key"]:
            return -1
        one, other = (np.frombuffer(bytes(x["side"]), dtype=">u4").reshape(1, words) for x in (a, b))
        return int(shared_words(one, other)[0])

    def nearest(row: dict, others: list[int], near: str, next_: str) -> int:
        for task in others:  # goes on only while whole tasks are of the row's own name
            for edge in (near, next_):
                other = by_task[task].get(edge)
                if other and other["name"] != row["name"]:
                    return shares(row, other)
            if by_task[task][near]["key"] != row["key"]:
                return -1
        return -1

    out = []
    for i, task in enumerate(tasks):
        ends = by_task[task]
        out.append((task, nearest(ends["first"], tasks[:i][::-1], "last", "second_last"), nearest(ends["last"], tasks[i + 1 :], "first", "second")))
    return out


def _stretches(suffixes: DataFrame, length: int, gram: int) -> DataFrame:
    """(name, starts, ends): where a text may be repeated, by its suffixes' reaches on both sides."""
    right = _reaches(suffixes, "right", length, gram).withColumnRenamed("reach", "to_right").withColumn("to_left", F.lit(None).cast("int"))
    left = _reaches(suffixes, "left", length, gram).withColumnRenamed("reach", "to_left").withColumn("to_right", F.lit(None).cast("int"))
    one = right.unionByName(left).groupBy("name", F.col("at")[0].alias("place")).agg(F.max("to_right").alias("to_right"), F.max("to_left").alias("to_left"), F.first("at").alias("at"))
    long = one.filter(F.col("to_right") + F.col("to_left") + gram >= length)
    spans = long.select("name", F.explode("at").alias("p"), "to_left", "to_right")
    return spans.groupBy("name").agg(F.collect_list(F.struct((F.col("p") - F.col("to_left")).alias("start"), (F.col("p") + gram + F.col("to_right")).alias("end"))).alias("stretches"))


def _windows(texts: DataFrame, length: int) -> DataFrame:
    """(hash, name, first, at) of the windows, by their start, that lie in a stretch."""
    names = ["hash", "name", "first", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for text, stretches, name, first in zip(*[part.column(i).to_pylist() for i in range(4)]):
                words = words_of(text)
                if text_name(words) != name:
                    continue
                inside = np.zeros(len(words) + 1, dtype=np.int64)
                ends = np.array([(s["start"], s["end"]) for s in stretches], dtype=np.int64)
                np.add.at(inside, ends[:, 0], 1)
                np.add.at(inside, ends[:, 1] - length + 1, -1)  # windows start at ``start`` to ``end - length``
                places = np.flatnonzero(np.cumsum(inside) > 0)
                hashes = window_hashes(words, length)[places].view(np.int64)
                for i in range(0, len(places), SLICE):
                    at = places[i : i + SLICE].astype(np.int32)
                    same = [pa.array(np.full(len(at), v, dtype=np.int64)) for v in (name, first)]
                    yield pa.RecordBatch.from_arrays([pa.array(hashes[i : i + SLICE]), *same, pa.array(at)], names=names)

    return texts.select("text", "stretches", "name", "first").mapInArrow(lean(run), "hash long, name long, first long, at int")


def _held(windows: DataFrame, before: Column) -> DataFrame:
    """(name, at, later) of the windows that several texts hold; ``later``: a text that comes first by ``before`` holds it too."""
    least = windows.groupBy("hash").agg(F.min(before).alias("least"), F.min("name").alias("a"), F.max("name").alias("b"))
    held = written(least.filter("a <> b").select("hash", "least"), "held")  # so that the join splits a window of very many texts
    return windows.join(held, "hash").select("name", "at", (before > F.col("least")).alias("later"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined, in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


def _joined(found: DataFrame, length: int) -> DataFrame:
    """(name, every, later): the joined spans of each text, from the lists of the starts of its windows."""
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def compute():
        def join(column: pa.Array) -> pa.Array:
            lists = [merged([(p, p + length) for p in v]) for v in column.to_pylist()]
            return pa.array([[{"start": a, "end": b} for a, b in v] for v in lists], kind)

        return lambda every, later: [join(every), join(later)]

    added = T.StructType([T.StructField("every", span), T.StructField("later", span)])
    return with_arrow_columns(found, ["every_at", "later_at"], added, compute).select("name", "every", "later")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (name, wanted_id, ...) with the text of each name; other texts of the same id may come along.

    Texts without an id are found by their names, as the id would bring them all together.
    """
    ids = wanted.filter("wanted_id IS NOT NULL").select(F.col("wanted_id").alias("id")).distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    with_id = docs.filter("text IS NOT NULL").join(ids, "id", "left_semi").join(wanted, F.col("id") == F.col("wanted_id"))
    nameless = docs.filter("text IS NOT NULL AND id IS NULL")
    if not nameless.limit(1).count():
        return with_id.drop("id")

    def compute():
        return lambda texts: [pa.array([text_name(words_of(t)) for t in texts.to_pylist()], pa.int64())]

    named = with_arrow_columns(nameless.select("text"), ["text"], T.StructType([T.StructField("name", T.LongType())]), compute)
    rest = named.dropDuplicates(["name"]).join(wanted.filter("wanted_id IS NULL"), "name")
    return with_id.drop("id").unionByName(rest)


def repeated_passages(
    docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_words, repeated, cut.

    ``repeated`` are the spans (start, end in words, end exclusive) of at least ``length`` words that other documents hold too, ``cut``
    those of them that a document before it holds (by id, nulls last), so that leaving out ``cut`` keeps one copy. A text
    that is whole in another document is repeated whole, and cut whole but for the smallest id. Repeats within one
    document do not count. Null, empty and short texts have no spans, repeated rows stay, other columns are not read and an empty table gives an empty one.
    """
    docs = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    sources = written(_sources(docs), "sources")
    classes = sources.filter("name IS NOT NULL").groupBy("name").agg(F.min("id").alias("wanted_id"), F.count("*").alias("copies"))
    grams = written(_grams(docs.select("text"), length, gram), "grams")
    common = grams.groupBy("key").agg(F.min("name").alias("a"), F.max("name").alias("b")).filter("a <> b").select("key")
    shared = written(grams.join(common, "key").groupBy("name").agg(F.collect_set("key").alias("keys")).join(classes, "name"), "wanted")
    suffixes = written(_suffixes(_texts_of(docs, shared), length, gram), "suffixes")
    stretches = _stretches(suffixes, length, gram).join(shared.select("name", "wanted_id"), "name")
    held = written(stretches.withColumn("first", F.coalesce("wanted_id", F.lit(LAST))), "stretches")
    windows = written(_windows(_texts_of(docs, held), length), "windows")
    before = F.col("first")
    if shared.groupBy("wanted_id").count().filter("count > 1").limit(1).count():
        before = F.struct("first", "name")  # texts that share their smallest id
    held = _held(windows, before).groupBy("name")
    spans = _joined(held.agg(F.collect_list("at").alias("every_at"), F.collect_list(F.when(F.col("later"), F.col("at"))).alias("later_at")), length)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    copied = (F.col("copies") > 1) & (F.col("n_words") >= length)
    all_rows = sources.join(classes, "name", "left").join(spans, "name", "left")
    none = F.slice(whole, 1, 0)
    return all_rows.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.when(copied, whole).otherwise(F.coalesce("every", none)).alias("repeated"),
        F.when(copied & ~F.col("id").eqNullSafe(F.col("wanted_id")), whole).otherwise(F.coalesce("later", none)).alias("cut"),
    )
