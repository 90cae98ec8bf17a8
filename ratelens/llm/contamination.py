"""Benchmark passages in training documents, found by a broadcast hash set of the benchmark's word windows.

Words are runs of ASCII digits, ASCII letters and characters beyond ASCII, with A-Z in lower case. A benchmark item gives its windows
of ``size`` consecutive words, an item with fewer words the whole of them as one window. Every word position of a document starts one window of
each length that occurs in the benchmark; its 64-bit hash is looked up in the broadcast set, and a hit counts only if the words themselves are equal.

The windows of a document leave the scan one after the other and all but the hits are dropped by the join at once, so only hits and
one row per document are shuffled. The set is broadcast in slices of at most ``BROADCAST_WINDOWS`` windows: a larger benchmark takes several
scans of the documents, and nothing larger than a slice is ever held. Only DataFrame functions: no Python runs in tasks.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.frames import free_name, written

SIZE = 10
#: Windows in one broadcast slice; a window is ``size`` words, some hundred bytes.
BROADCAST_WINDOWS = 500_000
#: Rows that one list of copies is made of.
COPIES = 4096

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; a text of ASCII characters only takes the short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), _BETWEEN), ""), F.array().cast("array<string>"))


def _window(words: Column, start: Column, length: Column) -> Column:
    return F.slice(words, start + 1, length)


def benchmark_windows(benchmark: DataFrame, *, size: int = SIZE, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(hash, length, window, items) of the distinct windows; ``items`` holds the ids, as strings, of the items with that window.

    A null id counts as the empty id, rows of one id are one item, and items without words have no windows.
    """
    items = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item"), words_of(F.col(f"`{text}`")).alias("words"))
    length = F.least(F.lit(size), F.size("words"))
    starts = items.filter(F.size("words") > 0).select("item", "words", length.alias("length"), F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("start"))
    window = starts.select("item", "length", _window(F.col("words"), F.col("start"), F.col("length")).alias("window")).distinct()
    return window.groupBy("window", "length").agg(F.sort_array(F.collect_set("item")).alias("items")).select(F.xxhash64("window").alias("hash"), "length", "window", "items")


def _row_key(doc_id: str, text: str) -> list[Column]:
    return [F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash")]


def _hits(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per hit window, and one with ``end`` null for each row of ``docs``, in one scan."""
    words = F.col("words")
    every = docs.withColumn("n_words", F.size(words)).select(
        "id", "text_hash", "words", "n_words", F.posexplode(F.concat(words, F.array(F.lit("")))).alias("start", "word")
    )
    if len(lengths) > 1:
        every = every.withColumn("span", F.explode(F.array(*map(F.lit, lengths))))
    else:
        every = every.withColumn("span", F.lit(lengths[0]))
    whole = F.col("start") + F.col("span") <= F.col("n_words")
    every = every.withColumn("here", F.when(whole, F.xxhash64(_window(words, F.col("start"), F.col("span")))))
    found = every.join(F.broadcast(windows), F.col("here") == F.col("hash"), "left")
    row = (F.col("start") == F.col("n_words")) & (F.col("span") == lengths[0])
    same = F.coalesce(_window(words, F.col("start"), F.col("span")) == F.col("window"), F.lit(False))
    return found.filter(row | same).select(
        "id", "text_hash", F.col("n_words").cast("long").alias("n_words"), "start", F.when(~row, F.col("start") + F.col("span")).alias("end"), "items"
    )


def _spans(covered: Column) -> Column:
    """Sorted places as spans (start, end exclusive) without gaps."""
    first = F.filter(covered, lambda p, i: (i == 0) | (F.get(covered, i - 1) < p - 1))
    last = F.filter(covered, lambda p, i: (i == F.size(covered) - 1) | (F.get(covered, i + 1) > p + 1))
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end")))


def _found(docs: DataFrame, benchmark: DataFrame, size: int, item_id: str, text: str) -> DataFrame:
    """(id, text_hash, n_words, copies, covered, items) of each distinct document; ``docs`` has id, text_hash and words."""
    windows = written(benchmark_windows(benchmark, size=size, item_id=item_id, text=text), "windows")
    by_length = windows.groupBy("length").count().collect()  # ``size`` rows at most
    lengths = sorted(r["length"] for r in by_length) or [size]
    slices = -(-sum(r["count"] for r in by_length) // BROADCAST_WINDOWS) or 1
    parts = [windows.filter(F.pmod(F.xxhash64("hash"), F.lit(slices)) == i) for i in range(slices)]
    hits = [_hits(docs, part.drop("length"), lengths) for part in parts]
    # the rows that stand for documents come from the first scan
    found = reduce(DataFrame.unionByName, [hits[0], *(h.filter("end IS NOT NULL") for h in hits[1:])])
    hit = F.col("end").isNotNull()
    return found.groupBy("id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.count_if(~hit).alias("copies"),
        F.collect_set(F.when(hit, F.struct("start", "end"))).alias("hits"),
        F.collect_set(F.when(hit, F.col("items"))).alias("items"),
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    size: int = SIZE,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items, spans, contaminated.

    ``spans`` are the words (start, end exclusive) inside occurrences of benchmark windows, ``n_hit`` their number, ``items`` the sorted ids, as strings, of
    the items with an occurring window. Null, empty and wordless texts have no words and no hits; repeated rows stay,
    each with the same result; other columns are not read; without items nothing is hit; an empty table gives an empty one.
    """
    read = docs.select(*_row_key(doc_id, text), words_of(F.col(f"`{text}`")).alias("words"))
    found = _found(read, benchmark, size, item_id, item_text)
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["end"] - 1)))))
    rows = found.select(
        "id", "n_words", "copies", covered.alias("covered"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items")
    )
    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))
    members = F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col("copies") - F.col("block") * COPIES))
    rows = rows.withColumn("block", F.explode(blocks)).withColumn("member", F.explode(members))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("covered").cast("long").alias("n_hit"),
        "items",
        _spans(F.col("covered")).alias("spans"),
        (F.size("covered") > 0).alias("contaminated"),
    )


def _without(text: Column, spans: Column) -> Column:
    """The text without the words of the spans; what stands between words stays, but for what lies inside a span."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    gaps = F.split(text, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    ends = F.concat(F.array(F.lit(0)), spans["end"])
    starts = F.concat(spans["start"], F.array(F.size(words)))

    def piece(start: Column, end: Column) -> Column:
        # the gap before each word and the word, and after the last one the gap that follows
        body = F.zip_with(F.slice(gaps, start + 1, end - start), F.slice(words, start + 1, end - start), lambda g, w: F.concat(g, w))
        return F.concat(F.array_join(body, ""), F.get(gaps, end))

    return F.array_join(F.zip_with(ends, starts, piece), "")


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    remove: str = "spans",
    size: int = SIZE,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` without benchmark passages, all columns kept: ``remove`` is "spans" (hit words are cut out) or "documents" (hit documents go).

    Documents without a hit stay as they are, null texts and repeated rows included.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    read = docs.select(*_row_key(doc_id, text), words_of(F.col(f"`{text}`")).alias("words"))
    found = _found(read, benchmark, size, item_id, item_text).filter(F.size("hits") > 0)
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["end"] - 1)))))
    names = [free_name(docs, n) for n in ("hit_id", "hit_hash", "hit_covered")]
    hit = found.select(F.col("id").alias(names[0]), F.col("text_hash").alias(names[1]), covered.alias(names[2]))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(names[0])) & (F.xxhash64(F.col(f"`{text}`")) == F.col(names[1]))
    if remove == "documents":
        return docs.join(hit, same, "left_anti")
    clean = F.when(F.col(names[2]).isNull(), F.col(f"`{text}`")).otherwise(_without(F.col(f"`{text}`"), _spans(F.col(names[2]))))
    return docs.join(hit, same, "left").select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
