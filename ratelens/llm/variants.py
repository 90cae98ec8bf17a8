"""Spelling variants: words of a corpus that are one edit apart, and the frequent word each of them stands for.

The vocabulary is indexed in blocks of words, bit-sliced: for each (position, letter) one bitset says which words of the block have that letter
there. A word is looked up by running over its letters once; word-parallel recurrences carry, for all words of the block at the same time,
the set without an error so far and the sets with one error (letter replaced, one more, one less), the latter read at positions shifted by one.
A word leaves the first set at its first difference, so every near pair is found once. Words stand in a block by falling
frequency, then by spelling: the number of set bits is the number of near words and the lowest one is the best of them, and
no pair is ever a row.

Words meet in a block only if they can be near: a word's letters are cut into ``SEGMENTS`` segments, and one edit lies in one of them, so near words
agree on all the others. They share a bucket (length, segment, letters outside of it), and the index covers the segment. A bucket of
more than ``BLOCK`` words is split into blocks, which each of its words asks one by one; rows are streamed through a task in sorted order, so
a task holds one block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.frames import small_batches, written

SEGMENTS = 3
#: Words of one block of the index.
BLOCK = 8192
BROADCAST_BUCKETS = 500_000


# --- words and how often they occur ---------------------------------------------------------------------


def _lowered(text: Column) -> Column:
    short = F.octet_length(text) == F.char_length(text)
    return F.when(short, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def word_counts(
    docs: DataFrame, *, min_chars: int = 5, min_count: int = 3, noise: int | None = 97, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(word, n): runs of the letters a-z and U+00C0 to U+00FF, A-Z in lower case, with ``min_chars`` and more, found ``min_count`` times or more.

    With ``noise``, a run of a document loses the letter ``h % length``, counted from 0, where ``noise`` divides h, the crc32 of "id:run"; a null id
    counts as the empty one. Null and empty texts have no words. All counts are summed per task before they are shuffled.
    """
    runs = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.explode(F.split(_lowered(F.col(f"`{text}`")), "[^a-z\\u00C0-\\u00FF]+")).alias("run")
    ).filter(F.char_length("run") >= min_chars)
    if noise is not None:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.char_length("run")).cast("int")
        dropped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        runs = runs.select(F.when(F.col("h") % noise == 0, dropped).otherwise(F.col("run")).alias("run")).filter(F.char_length("run") >= min_chars)
    return runs.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


# --- the bit-sliced index -------------------------------------------------------------------------------


def _borders(size: int, segment: int) -> tuple[int, int]:
    """Start and end of a segment of words of ``size`` letters."""
    return segment * size // SEGMENTS, (segment + 1) * size // SEGMENTS


class Block:
    """Index of words of one bucket: some of ``size`` letters, some with one more; all have the same letters before the segment and after it.

    ``words`` holds (-n, word), sorted. Bit i of every set stands for the word i.
    """

    def __init__(self, words: list[tuple[int, str]], size: int, segment: int):
        self.words, self.size = words, size
        self.start, self.end = _borders(size, segment)
        self.last = segment == SEGMENTS - 1
        self.slices: dict[tuple[int, str], int] = {}
        self.all, self.longer = (1 << len(words)) - 1, 0
        for i, (_, word) in enumerate(words):
            bit = 1 << i
            if len(word) > size:
                self.longer |= bit
            for place in range(self.start, min(self.end + 1, len(word))):
                self.slices[place, word[place]] = self.slices.get((place, word[place]), 0) | bit

    def near(self, word: str) -> int:
        """The words one edit away whose first difference lies in the segment; of two words with one letter more none."""
        return self._shorter(word) if len(word) > self.size else self._replaced_or_longer(word)

    def _replaced_or_longer(self, word: str) -> int:
        same, replaced, longer = self.all, 0, 0
        shorter, more, slices = self.all ^ self.longer, self.longer, self.slices
        for place in range(self.start, self.end):
            here = slices.get((place, word[place]), 0)
            left = same & ~here
            replaced = replaced & here | left & shorter
            longer = (longer | left & more) & slices.get((place + 1, word[place]), 0)
            same &= here
        return replaced | longer | (same & more if self.last else 0)

    def _shorter(self, word: str) -> int:
        same, shorter, slices = self.all ^ self.longer, 0, self.slices
        for place in range(self.start, self.end):
            here = slices.get((place, word[place]), 0)
            shorter = (shorter | same & ~here) & slices.get((place, word[place + 1]), 0)
            same &= here
        return shorter | (same if self.last else 0)


def _buckets(words: DataFrame, min_chars: int) -> DataFrame:
    """(bucket, size, segment, word, n): each word in the buckets of its own length and, as the longer one, of one letter less."""
    length = F.char_length("word")
    sized = words.select("word", "n", F.explode(F.filter(F.array(length, length - 1), lambda s: s >= min_chars)).alias("size"))
    cut = sized.select("word", "n", "size", F.explode(F.array(*map(F.lit, range(SEGMENTS)))).alias("segment"))
    start = F.floor(F.col("segment") * F.col("size") / SEGMENTS).cast("int")
    end = F.floor((F.col("segment") + 1) * F.col("size") / SEGMENTS).cast("int") + length - F.col("size")
    outside = [F.substring("word", F.lit(1), start), F.substring("word", end + 1, length)]
    return cut.select(F.xxhash64("size", "segment", *outside).alias("bucket"), "size", "segment", "word", "n")


def _dealt(rows: DataFrame) -> DataFrame:
    """Adds ``block`` and ``asks``: a word is indexed in one block of its bucket and asks all others as well (``asks`` true there)."""
    large = written(rows.groupBy("bucket").count().filter(F.col("count") > BLOCK).select("bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "large")
    found = large.count()
    if not found:
        return rows.select("*", F.lit(0).alias("block"), F.lit(False).alias("asks"))
    spread = rows.join(F.broadcast(large) if found <= BROADCAST_BUCKETS else large, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    spread = spread.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.select(*rows.columns, "block", (F.col("block") != F.pmod(F.xxhash64("word"), F.col("blocks"))).alias("asks"))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, best_n, best) for the words that have near ones in a block; rows come by bucket and block, the indexed words first."""
    found: list[tuple] = []
    current, indexed, blocks = None, [], None

    def parts() -> dict[tuple, Block]:
        """Blocks by the letters themselves: a bucket is a hash."""
        by_letters: dict[tuple, list] = {}
        for size, segment, word, n in indexed:
            by_letters.setdefault(letters(size, segment, word), []).append((-n, word))
        return {k: Block(sorted(v), k[0], k[1]) for k, v in by_letters.items()}

    def letters(size: int, segment: int, word: str) -> tuple:
        start, end = _borders(size, segment)
        return size, segment, word[:start], word[end + len(word) - size :]

    def ask(size: int, segment: int, word: str) -> None:
        block = blocks.get(letters(size, segment, word))
        near = block.near(word) if block else 0
        if near:
            less_n, best = block.words[(near & -near).bit_length() - 1]
            found.append((word, near.bit_count(), -less_n, best))

    def finish() -> None:
        nonlocal blocks
        if blocks is None and len(indexed) > 1:
            blocks = parts()
        if len(indexed) > 1:
            for size, segment, word, _ in indexed:
                ask(size, segment, word)

    def answers() -> pa.RecordBatch:
        columns = list(zip(*found)) or [(), (), (), ()]
        found.clear()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n_near", "best_n", "best"])

    for batch in batches:
        for bucket, block, asks, size, segment, word, n in zip(*[batch.column(c).to_pylist() for c in ("bucket", "block", "asks", "size", "segment", "word", "n")]):
            if (bucket, block) != current:
                finish()
                current, indexed, blocks = (bucket, block), [], None
            if not asks:
                indexed.append((size, segment, word, n))
                continue
            if blocks is None:
                blocks = parts()
            ask(size, segment, word)
        yield answers()
    finish()
    yield answers()


def near_words(words: DataFrame, *, min_chars: int = 5) -> DataFrame:
    """(word, n, n_near, best_n, best) of every word of (word, n): how many near words it has, and the most frequent one (ties: the smallest)."""
    small_batches(words.sparkSession)
    dealt = _dealt(_buckets(words, min_chars)).repartition("bucket", "block").sortWithinPartitions("bucket", "block", "asks")
    found = dealt.select("bucket", "block", "asks", "size", "segment", "word", "n").mapInArrow(_asked, "word string, n_near long, best_n long, best string")
    none = F.lit(None)
    rows = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("struct<less:bigint,best:string>").alias("first")).unionByName(
        found.select("word", none.cast("long").alias("n"), "n_near", F.struct((-F.col("best_n")).alias("less"), "best").alias("first"))
    )
    grouped = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("first").alias("first"))
    return grouped.select("word", "n", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))


# --- groups -----------------------------------------------------------------------------------------------


def _roots(steps: DataFrame) -> DataFrame:
    """(word, root) for (word, form): each round goes twice as far, so a chain of k forms takes log2(k) rounds."""
    reached = written(steps.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        after = written(reached.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if not after.filter("moved").limit(1).count():
            return after.select("word", "root")
        reached = after.select("word", "root")


def spelling_groups(words: DataFrame, *, ratio: int = 2, min_chars: int = 5) -> DataFrame:
    """One row per row of (word, n), words being distinct: word, form, root, n, n_near, form_n.

    ``form`` is the most frequent near word (ties: the smallest in code-point order) if it occurs ``ratio`` times as often or more, else null;
    ``root`` is where the forms of a word's form, and so on, end, the word itself without a form. Words of fewer than ``min_chars``
    letters must not be in the table.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words, so that they come to an end")
    near = near_words(written(words, "words"), min_chars=min_chars)
    chosen = F.col("best_n") >= ratio * F.col("n")
    forms = written(near.select("word", F.when(chosen, F.col("best")).alias("form"), "n", "n_near", F.when(chosen, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(forms.filter("form IS NOT NULL").select("word", "form"))
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame, *, min_chars: int = 5, min_count: int = 3, noise: int | None = 97, ratio: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The spelling groups of the words of all documents: word, form, root, n, n_near, form_n; see ``word_counts`` and ``spelling_groups``.

    Ids, null or repeated, matter for ``noise`` only, repeated rows count as often as they stand there, other columns are not read, and an
    empty table gives an empty one.
    """
    counts = word_counts(docs, min_chars=min_chars, min_count=min_count, noise=noise, doc_id=doc_id, text=text)
    return spelling_groups(counts, ratio=ratio, min_chars=min_chars)
