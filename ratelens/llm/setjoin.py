"""N-gram Jaccard join: universe-partition pigeonhole with exact verification.

Sizes fall into bands such that a linked pair lies in one band or in two adjacent ones; the space of a band joins its sets with each
other and with those of the next band. In a space every token hash belongs to one of H + 1 segments, H being the largest
symmetric difference of a linked pair there. So a linked pair agrees in a whole segment, or, where the agreeing segments
are of no use, differs by one token in another:

* ``subset`` keys: the hash of a set's tokens in a segment, for every segment that holds any;
* ``deletion`` keys: the same with one token left out, in the first ``reserve`` segments of the space, or in all of them for a set
  with more useless segments than the space allows for.

A segment is of no use where it is empty, or where its key is so common that comparing its sets costs more than
``HOT`` partners each. The allocation weighs the keys of a larger reserve against the sets that need all deletions
(``allocation``). Rows with a key of their own drop out after one shuffle. The sets that are left are first compared with
the best connected one of each key, and linked ones joined into components; then only pairs of different components are compared.
So a large group of near copies costs one comparison per member, not one per pair. Pairs of different components that meet in a key are
first held against a lower bound of their difference: a sketch of groups of tokens, more of them for larger sets, tells groups that differ, and
by how many tokens at least. That happens inside tiles of bounded size. Only pairs that may be linked leave them, and hardly ever from
a segment before which the two agree in ``AGREEING`` of ``BEFORE`` others.

Tokens and sets are known by 64-bit hashes; pairs are verified on the full sets. In spaces of up to 16 segments all are in reserve. In
larger ones a pair can be missed only if segments of the reserve are empty, and fewer are left than segments that are empty in both sets, while
the two agree in no other segment, although they differ in fewer tokens than there are segments: below 1e-9 per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.components import components
from ratelens.llm.frames import free_name, lean, release, utf8, with_arrow_columns, written
from ratelens.llm.hashing import EMPTY, mix, shingle_set

HOT = 8192
TILE = 1024
AGREEING = 3
BEFORE = 32
GROUPS = 128
MOST_GROUPS = 512
STAR_GROUPS = 256
FINE_GROUPS = 1024
PLACES = 4096
HOT_IN_SLICE = 32
SALTS = 64
SLICE_ROWS = 400_000
SLICE_NAMES = 50_000
KEY_BYTES = 5
RUN_KEYS = 500_000
BROADCAST_IDS = 500_000

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ONE = np.uint64(1)
_SPACE_TAGS = np.arange(1, 4097, dtype=np.uint64) * _C


class Space(NamedTuple):
    """Join space of a band: segments, useless segments that it allows for, and segments with deletion keys."""

    segments: int
    spare: int
    reserve: int


@lru_cache(maxsize=8)
def bands(percent: int) -> np.ndarray:
    """Smallest size of each band: sets linked to one of a band lie in it, in the next or in the one before."""
    lows = [1]
    while lows[-1] < 2**40:
        lows.append(max(lows[-1] + 1, -(-lows[-1] * 100 // percent)))
    return np.array(lows, dtype=np.int64)


def most_different(total: int, percent: int) -> int:
    """Largest symmetric difference of linked sets whose sizes sum to ``total``."""
    return total - 2 * -(-percent * total // (100 + percent))


@lru_cache(maxsize=4096)
def allocation(space: int, percent: int) -> Space:
    """Segments of a space, and the reserve that costs the fewest keys for its smallest sets."""
    low, high = int(bands(percent)[space]), int(bands(percent)[space + 1]) - 1
    total = high + high * 100 // percent  # of the largest pair; the difference rises with it but for steps of rounding
    segments = 1 + max(most_different(t, percent) for t in range(max(2, total - 200), total + 1))
    if segments <= 16:
        return Space(segments, segments // 2, segments)
    empty = max(segments * math.exp(-low / segments), 1e-300)  # expected; their number is close to a Poisson variable
    last = min(segments // 2, math.ceil(empty + 12 * math.sqrt(empty)) + 30)  # beyond it the tail is next to nothing and cost rises
    spare = np.arange(last)
    log_chance = spare * math.log(empty) - empty - np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, last)))))
    tail = np.maximum(1.0 - np.cumsum(np.exp(log_chance)), 0.0)
    cost = (spare + 1) * low / segments + tail * low
    best = 1 + int(np.argmin(cost[1:]))
    return Space(segments, best, best + 1)


def _even(total: np.ndarray, count: int) -> int:
    return int(mix(total + np.full(1, count, dtype=np.uint64) * _C)[0] & ~_ONE)


def set_hash(tokens: np.ndarray) -> int:
    """Even 64-bit name of a set, as a signed integer."""
    name = _even(mix(tokens + _B).sum(dtype=np.uint64, keepdims=True), len(tokens))
    return name - 2**64 if name >= 2**63 else name


class Keys(NamedTuple):
    """Subset and deletion keys of a set in a space with their segments, and its number of empty segments."""

    subset: np.ndarray
    subset_segment: np.ndarray
    deletion: np.ndarray
    deletion_segment: np.ndarray
    empty: int


def segments_of(tokens: np.ndarray, plan: Space) -> tuple[np.ndarray, np.ndarray]:
    """First token of each segment that a sorted set has tokens in, and the segment's number; it rises with the token."""
    segment = ((tokens >> np.uint64(32)) * np.uint64(plan.segments)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
    return starts, segment[starts]


def space_keys(tokens: np.ndarray, values: np.ndarray, space: int, percent: int) -> Keys:
    """Keys of a sorted set in a space; ``values`` are the mixed tokens."""
    plan = allocation(space, percent)
    starts, segment = segments_of(tokens, plan)
    sums = np.add.reduceat(values, starts)
    tags = segment * _B + _SPACE_TAGS[space]
    empty = plan.segments - len(starts)
    segments = segment.astype(np.int32)
    # deletions of the segments that have them, which come first; a token alone leaves nothing to hash
    held = len(starts) if empty > plan.spare else int(np.searchsorted(segments, plan.reserve))
    end = starts[held] if held < len(starts) else len(tokens)
    sizes = np.diff(np.append(starts[:held], end))
    index = np.repeat(np.arange(held), np.where(sizes > 1, sizes, 0))
    kept = values[:end] if (sizes > 1).all() else values[:end][np.repeat(sizes > 1, sizes)]
    deletions = mix((sums + tags)[index] - kept)
    return Keys(mix(sums + tags), segments, deletions, segments[index], empty)


def sketch(tokens: np.ndarray, groups: int = GROUPS) -> bytes:
    """A byte for each of some groups of tokens: their number modulo 32 and three bits of their hash."""
    values = mix(tokens + _B)
    group = ((values >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
    sizes = np.bincount(group, minlength=groups)
    bits = np.zeros(groups, dtype=np.uint64)
    np.add.at(bits, group, mix(values))
    return (((sizes & 31) << 3) | (mix(bits) & np.uint64(7)).astype(np.int64)).astype(np.uint8).tobytes()


def least_difference(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Lower bounds of the symmetric difference of sets from their sketches, row by row or of one with many.

    Groups of unequal numbers differ by that many tokens at least, other groups with unequal tokens by two.
    """
    one, many = one.view(np.uint8), many.view(np.uint8)
    apart = ((many >> 3) - (one >> 3)) & np.uint8(31)
    apart = np.minimum(apart, np.uint8(32) - apart)
    apart[(apart == 0) & (many != one)] = 2
    return apart.sum(axis=1, dtype=np.int64)


@lru_cache(maxsize=4096)
def groups_of(space: int, percent: int) -> int:
    """Groups of the sketches in a space: so many that its smallest sets have 16 tokens in a group, within limits."""
    groups = GROUPS
    while groups < MOST_GROUPS and 16 * groups < bands(percent)[space]:
        groups *= 2
    return groups


def segment_marks(tokens: np.ndarray, space: int, percent: int) -> np.ndarray:
    """Sixteen bits of the hash of each segment, 0 for an empty one, after ``BEFORE`` zeros."""
    plan = allocation(space, percent)
    starts, segment = segments_of(tokens, plan)
    bits = (mix(np.add.reduceat(mix(tokens + _A), starts)) & np.uint64(65535)).astype(np.uint16) | np.uint16(1)
    out = np.zeros(BEFORE + plan.segments, dtype="<u2")
    out[BEFORE + segment.astype(np.int64)] = bits
    return out


def spaces_of(size: int, percent: int) -> list[int]:
    band = int(np.searchsorted(bands(percent), size, side="right")) - 1
    return [band, band - 1] if band else [band]


def signature_rows(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a set with a tag each: 8 * segment, + 2 for a deletion key, + 1 for the space below the set's band."""
    values = mix(tokens + _A)
    keys, tags = [], []
    for lower, space in enumerate(spaces_of(len(tokens), percent)):
        found = space_keys(tokens, values, space, percent)
        keys += [found.subset, found.deletion]
        tags += [8 * found.subset_segment + lower, 8 * found.deletion_segment + (2 + lower)]
    return np.concatenate(keys), np.concatenate(tags)


def homes_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of the key space that a key lies in; it rises with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def named_key(low: np.ndarray, home: np.ndarray) -> np.ndarray:
    """A key as the tables hold it: its low ``KEY_BYTES`` and above them the number of its part."""
    bits = np.uint64(8 * KEY_BYTES)
    return ((low & ((_ONE << bits) - _ONE)) | (home.astype(np.uint64) << bits)).view(np.int64)


def packed(keys: np.ndarray, places: np.ndarray, tags: np.ndarray, names: np.ndarray, part_ids: np.ndarray) -> Iterator[tuple]:
    """The keys of a slice as one row per part of the key space: (part, keys, names, place of each key's name, tags in two halves, homes).

    The low ``KEY_BYTES`` of a key and its part name it: a clash only brings sets together that verification parts again.

    A key that is common in the slice goes to parts by salts of its names and is tagged (+ 4) as known to have company; ``homes`` are the
    parts that such keys have without salt. Its first two rows stay unsalted, so that a set that is alone with the key elsewhere
    still meets company.
    """
    parts = len(part_ids)
    order = np.argsort(keys, kind="stable")
    keys, places, tags = keys[order], places[order], tags[order]
    part = home = homes_of(keys, parts)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(np.append(first, len(keys)))
    if counts.max() > HOT_IN_SLICE:
        rank = np.arange(len(keys)) - np.repeat(first, counts)
        salted = np.flatnonzero((np.repeat(counts, counts) > HOT_IN_SLICE) & (rank > 1))
        salt = np.uint64(1) + (names[places[salted]] >> np.uint64(1)) % np.uint64(SALTS)
        tags[salted] += 4
        part = home.copy()
        part[salted] = homes_of(mix(keys[salted] + salt * _C), parts)
        order = np.argsort(part, kind="stable")
        keys, places, tags, part, home = keys[order], places[order], tags[order], part[order], home[order]
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    for start, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)]):
        order = start + np.argsort(tags[start:end], kind="stable")  # runs of equal tags take next to no room
        held, place = np.unique(places[order], return_inverse=True)
        tag = tags[order].astype(np.uint32)
        yield (
            int(part_ids[part[start]]),
            keys[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes(),
            names[held].tobytes(),
            place.astype(np.uint16).tobytes(),
            tag.astype(np.uint16).tobytes(),
            (tag >> np.uint32(16)).astype(np.uint16).tobytes(),
            part_ids[home[order[tag & np.uint32(4) > 0]]].tobytes(),
        )


def _keys(texts: DataFrame, size: int, percent: int, part_ids: list[int]) -> DataFrame:
    """The keys of all sets, packed by part of the key space (see ``packed``)."""
    ids = np.array(part_ids, dtype=np.uint32)
    columns = ["part", "keys", "names", "place", "low", "high", "homes"]

    def rows_of(keys: list[np.ndarray], tags: list[np.ndarray], names: list[int]) -> pa.RecordBatch:
        places = np.repeat(np.arange(len(names)), [len(k) for k in keys])
        own = np.array(names, dtype=np.int64).view(np.uint64)
        rows = [list(c) for c in zip(*packed(np.concatenate(keys), places, np.concatenate(tags), own, ids))]
        kinds = [pa.int32()] + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys, tags, names, held = [], [], [], 0
        for batch in batches:
            for text in utf8(batch.column(0)):
                tokens = shingle_set(text, size)
                if not len(tokens):
                    continue
                name = set_hash(tokens)
                if name in seen:
                    continue
                seen.add(name)
                key, tag = signature_rows(tokens, percent)
                keys.append(key)
                tags.append(tag)
                names.append(name)
                held += len(key)
                if held >= SLICE_ROWS or len(names) >= SLICE_NAMES:
                    yield rows_of(keys, tags, names)
                    keys, tags, names, held = [], [], [], 0
        if held:
            yield rows_of(keys, tags, names)

    return texts.mapInArrow(lean(run), "part int, keys binary, names binary, place binary, low binary, high binary, homes binary")


def _part_ids(spark: SparkSession) -> list[int]:
    """A number for each shuffle partition that Spark deals into it; there is room for 8 million beside the key."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbers = spark.range(20 * partitions + 100).select(F.col("id").cast("int").alias("number"))
    dealt = numbers.groupBy(F.pmod(F.hash("number"), F.lit(partitions)).alias("to")).agg(F.min("number").alias("number"))
    found = [r["number"] for r in dealt.orderBy("to").collect()]
    return found


def company(key: np.ndarray, name: np.ndarray, tag: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, name, tag, deletion), once each, of the keys that several sets have or that are known to have company."""
    if not len(key):
        return
    # a set can come from several tasks and is then still alone with the key
    order = np.lexsort((tag & 2, name, key))
    key, name, tag = key[order], name[order], tag[order]
    fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (name[1:] != name[:-1]) | ((tag[1:] ^ tag[:-1]) & 2 > 0)))
    key, name, tag = key[fresh], name[fresh], tag[fresh]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    counts = np.diff(np.append(first, len(key)))
    kept = (np.repeat(counts, counts) > 1) | (tag & 4 > 0)
    key, name, tag = key[kept], name[kept], tag[kept]
    for i in range(0, len(key), SLICE_ROWS):
        k, n, t = key[i : i + SLICE_ROWS], name[i : i + SLICE_ROWS], tag[i : i + SLICE_ROWS]
        yield pa.RecordBatch.from_arrays(
            [pa.array(k), pa.array(n), pa.array((t >> 3) * 2 + (t & 1)), pa.array(t & 2 > 0)],
            names=["key", "name", "tag", "deletion"],
        )


def _shared(keys: DataFrame, partitions: int) -> DataFrame:
    """(key, name, tag, deletion) of the keys that several sets have; salted ones are known to have company.

    A task holds the packed keys of its part and works them off in runs of about ``RUN_KEYS`` by their highest byte.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ranges, tables, places, tags = [], [], [], [], []
        for batch in batches:
            for part, k, n, place, low, high, homes in zip(*[c.to_pylist() for c in batch.columns]):
                wide = np.zeros((len(k) // KEY_BYTES, 8), dtype=np.uint8)
                wide[:, :KEY_BYTES] = np.frombuffer(k, dtype=np.uint8).reshape(-1, KEY_BYTES)
                ranges.append(wide[:, KEY_BYTES - 1].copy())
                tables.append(np.frombuffer(n, dtype=np.int64))
                places.append(np.frombuffer(place, dtype=np.uint16))
                halves = [np.frombuffer(h, dtype=np.uint16).astype(np.int32) for h in (low, high)]
                tags.append(halves[0] | (halves[1] << 16))
                home = np.full(len(wide), part, dtype=np.int64)
                home[tags[-1] & 4 > 0] = np.frombuffer(homes, dtype=np.uint32)
                keys.append(named_key(wide.view("<u8").ravel(), home))
        if not keys:
            return
        ends, starts = np.cumsum([len(p) for p in places]), np.cumsum([0] + [len(t) for t in tables])
        all_keys, in_range, all_tags, all_places, table = map(np.concatenate, (keys, ranges, tags, places, tables))
        for held in (keys, ranges, tags, places, tables):
            held.clear()
        runs = min(256, -(-len(all_keys) // RUN_KEYS))
        for i in range(runs):  # a key lies in one range of its highest byte
            mine = np.flatnonzero((in_range >= 256 * i // runs) & (in_range < 256 * (i + 1) // runs))
            key, tag = all_keys[mine], all_tags[mine]
            ordered = np.sort(key)
            twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
            at = np.searchsorted(twice, key)
            at[at == len(twice)] = 0
            kept = np.flatnonzero(((twice[at] == key) if len(twice) else np.zeros(len(key), dtype=bool)) | (tag & 4 > 0))
            name = table[starts[np.searchsorted(ends, mine[kept], side="right")] + all_places[mine[kept]]]
            yield from company(key[kept], name, tag[kept])

    return keys.repartition(partitions, "part").mapInArrow(lean(run), "key long, name long, tag int, deletion boolean").distinct()


def _sized(docs: DataFrame, size: int) -> DataFrame:
    """(id, n_shingles, name) of every document; a null name without words."""
    added = T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("name", T.LongType())])

    def compute():
        def slice_(texts: pa.Array) -> list[pa.Array]:
            sets = [shingle_set(t, size) for t in utf8(texts)]
            return [pa.array([len(s) for s in sets], pa.int64()), pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64())]

        return slice_

    return with_arrow_columns(docs, ["text"], added, compute).select("id", "n_shingles", "name")


def _token_table(docs: DataFrame, sized: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(name, n, tokens) of the wanted sets, from one document each."""
    ids = sized.filter("name IS NOT NULL").join(wanted, "name", "left_semi").groupBy("name").agg(F.min("id").alias("wanted_id"))
    ids = written(ids.select("wanted_id").distinct(), "wanted")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.filter("text IS NOT NULL").join(ids, F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    added = T.StructType([T.StructField("name", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType(), False))])

    def compute():
        def slice_(column: pa.Array) -> list[pa.Array]:
            sets = [shingle_set(t, size) for t in utf8(column)]
            flat = np.concatenate(sets) if sets else EMPTY
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
            return [pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()), lists]

        return slice_

    found = with_arrow_columns(texts, ["text"], added, compute).select("name", "tokens")
    if sized.groupBy("id").count().filter("count > 1").limit(1).count():
        # ids that are no names of one text: other texts may have come along, and the same more than once
        found = found.join(wanted, "name", "left_semi").dropDuplicates(["name"])
    return written(found.withColumn("n", F.size("tokens").cast("long")), "tokens")


def _only(sets: DataFrame, names: DataFrame) -> DataFrame:
    """The sets of some names; few names are broadcast, many are joined by a shuffle."""
    wanted = names.toDF("name").distinct()
    return sets.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, "name", "left_semi")


def _sketches(tokens: DataFrame, groups: int) -> DataFrame:
    """(name, n, sketch) of the sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            sets = [np.asarray(v.values).view(np.uint64) for v in part.column(1)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s, groups) for s in sets], pa.binary())],
                names=["name", "n", "sketch"],
            )

    return written(tokens.select("name", "tokens").mapInArrow(lean(run), "name long, n long, sketch binary"), "sketches")


def _possible(pairs: DataFrame, sketches: DataFrame, percent: int, groups: int) -> DataFrame:
    """The pairs (a, b) that may be linked by their sizes and the lower bound of their difference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            one, other = (np.frombuffer(b"".join(part.column(c).to_pylist()), dtype=np.uint8).reshape(-1, groups) for c in ("one", "other"))
            total = part.column("n_a").to_numpy() + part.column("n_b").to_numpy()
            kept = pa.array(least_difference(one, other) <= total - 2 * -(-percent * total // (100 + percent)))
            yield pa.RecordBatch.from_arrays([part.column(c).filter(kept) for c in ("a", "b")], names=["a", "b"])

    near = (
        pairs.join(sketches.toDF("a", "n_a", "one"), "a")
        .join(sketches.toDF("b", "n_b", "other"), "b")
        .filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    )
    return near.select("a", "b", "n_a", "n_b", "one", "other").mapInArrow(lean(run), "a long, b long")


def _verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked."""
    sets = tokens.select("name", "n", "tokens")
    left, right = (_only(sets, pairs.select(c)).toDF(c, f"n_{c}", f"tokens_{c}") for c in ("a", "b"))
    full = pairs.join(left, "a").join(right, "b")
    common = full.withColumn("common", F.size(F.array_intersect("tokens_a", "tokens_b")))
    return common.filter(F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent).select("a", "b")


def _heavy(rows: DataFrame, hot: DataFrame, tokens: DataFrame, percent: int, part_ids: list[int]) -> DataFrame:
    """(key, name) of hot keys that the set must use, having more useless segments in the space than its spare ones."""
    numbers = np.array(part_ids, dtype=np.uint32)
    schema = "name long, space int, key long, empty int, spare int"
    sets = tokens.join(rows.join(hot, "key", "left_semi").select("name").distinct(), "name", "left_semi").select("name", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            out = []
            for name, values in zip(part.column(0).to_pylist(), part.column(1)):
                own = np.asarray(values.values).view(np.uint64)
                for space in spaces_of(len(own), percent):
                    found, spare = space_keys(own, mix(own + _A), space, percent), allocation(space, percent).spare
                    keys = named_key(found.subset, numbers[homes_of(found.subset, len(numbers))])
                    out += [(name, space, k, found.empty, spare) for k in keys.tolist()]
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["name", "space", "key", "empty", "spare"]
            )

    mine = written(sets.mapInArrow(lean(run), schema).join(hot, "key", "left_semi"), "hot")
    over = mine.groupBy("name", "space").agg((F.count("*") + F.max("empty") > F.max("spare")).alias("over")).filter("over")
    return mine.join(over, ["name", "space"], "left_semi").select("key", "name").distinct()


def _tile_rows(rows: DataFrame, names: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Dealt ``rows`` with n, the sketch for the key's space, and ``marks``: those of the ``BEFORE`` segments before the key's.

    Sketches and marks are made where the tokens lie, so that these stay in place.
    """
    carried = ["key", "x", "y", "tag", "root", "deletion", "probe", "in_x", "in_y"]
    places = rows.groupBy("name").agg(F.collect_list(F.struct(*carried)).alias("places"))
    schema = "key long, x int, y int, tag int, root long, deletion boolean, probe boolean, in_x boolean, in_y boolean, name long, n long, sketch binary, marks binary"

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.asarray(v.values).view(np.uint64) for v in batch.column(1)]
            spaces = [spaces_of(len(s), percent) for s in sets]
            sketches = [[sketch(s, groups_of(space, percent)) for space in own] for s, own in zip(sets, spaces)]
            marks = [[segment_marks(s, space, percent).tobytes() for space in own] for s, own in zip(sets, spaces)]
            lists = pa.list_(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sketches, lists), pa.array(marks, lists)],
                names=["name", "n", "sketches", "segments"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, n, sketches, segments, held in zip(*[batch.column(i) for i in range(5)]):
                sketches, segments, held = sketches.as_py(), segments.as_py(), held.values
                for start in range(0, len(held), PLACES):
                    some = held.slice(start, PLACES)
                    tags = some.field("tag").to_pylist()
                    windows = [segments[t & 1][2 * (t >> 1) : 2 * ((t >> 1) + BEFORE)] for t in tags]
                    yield pa.RecordBatch.from_arrays(
                        [some.field(c) for c in carried]
                        + [pa.array([v.as_py()] * len(some), pa.int64()) for v in (name, n)]
                        + [pa.array([sketches[t & 1] for t in tags], pa.binary()), pa.array(windows, pa.binary())],
                        names=[*carried, "name", "n", "sketch", "marks"],
                    )

    kept = _only(tokens.select("name", "tokens"), names)
    described = kept.mapInArrow(lean(short), "name long, n long, sketches array<binary>, segments array<binary>")
    return described.join(places, "name").select("name", "n", "sketches", "segments", "places").mapInArrow(lean(run), schema)


def tile_pairs(tile: dict[str, list], percent: int, agreeing: int) -> list[tuple[int, int]]:
    """Pairs of sets of a tile that may be linked: of different roots, one of them of the key's band and probing for the other.

    A pair that agrees in ``agreeing`` of the segments just before the key's own comes from one of those.
    """
    name, root, size = (np.array(tile[c], dtype=np.int64) for c in ("name", "root", "n"))
    deletion, probe, in_x, in_y = (np.array(tile[c], dtype=bool) for c in ("deletion", "probe", "in_x", "in_y"))
    lower = np.array(tile["tag"], dtype=np.int64) % 2 == 1
    width = np.array([len(v) for v in tile["sketch"]])  # unequal only for keys of different spaces that clash
    table = np.frombuffer(b"".join(v.ljust(width.max(), b"\0") for v in tile["sketch"]), dtype=np.uint8).reshape(len(width), -1)
    marks = np.frombuffer(b"".join(tile["marks"]), dtype="<u2").reshape(-1, BEFORE)
    found = []
    for i in np.flatnonzero(~lower).tolist():
        wanted = ((in_x[i] & in_y) | (in_y[i] & in_x)) & (probe[i] | probe)
        wanted &= (root != root[i]) & ~(deletion & deletion[i]) & (width == width[i])
        wanted[: i + 1] &= lower[: i + 1]
        at = np.flatnonzero(wanted)
        if not len(at):
            continue
        total = size[at] + size[i]
        most = total - 2 * -(-percent * total // (100 + percent))
        before = (marks[at] == marks[i]) & (marks[i] != 0)
        near = (before.sum(axis=1) < agreeing) & (least_difference(table[i], table[at]) <= most)
        found += [(min(a, b), max(a, b)) for a, b in ((int(name[i]), j) for j in name[at[near]].tolist())]
    return found


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows of each key in tiles (x, y) of two chunks, with the side that a row is on: ``in_x``, ``in_y``.

    Rows that need no comparison among themselves, those of the key's largest root or those that don't probe, whichever are more, are
    ``idle``: a chunk of them meets only the chunks of the others. So a family of n linked texts beside few others is dealt out once, not n / TILE
    times, and rows grow with the square only of those that are of other roots and probe.
    """
    per_root = rows.groupBy("key", "root").agg(F.count("*").alias("n"), F.count_if(~F.col("probe")).alias("calm"))
    stats = per_root.groupBy("key").agg(F.sum("n").alias("n_key"), F.sum("calm").alias("n_calm"), F.max(F.struct("n", "root")).alias("largest"))
    calm = F.col("n_calm") >= F.col("largest.n")
    n_idle = F.greatest("n_calm", "largest.n")

    def chunks(count: Column) -> Column:
        return F.ceil(count / TILE).cast("int")

    sides = stats.select(
        "key", calm.alias("calm"), F.col("largest.root").alias("largest"), chunks(F.col("n_key") - n_idle).alias("busy_chunks"), chunks(n_idle).alias("idle_chunks")
    )
    idle = F.when(F.col("calm"), ~F.col("probe")).otherwise(F.col("root") == F.col("largest"))
    placed = rows.join(sides, "key").withColumn("idle", idle).filter("busy_chunks > 0")  # without others there is nothing to compare
    busy_chunk = F.pmod(F.xxhash64("name"), F.col("busy_chunks")).cast("int")
    idle_chunk = F.col("busy_chunks") + F.pmod(F.xxhash64("name"), F.col("idle_chunks")).cast("int")
    placed = placed.withColumn("chunk", F.when(F.col("idle"), idle_chunk).otherwise(busy_chunk))
    others = F.col("busy_chunks") + F.when(F.col("idle"), 0).otherwise(F.col("idle_chunks"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    x, y = F.least("chunk", "other"), F.greatest("chunk", "other")
    return dealt.withColumns({"x": x, "y": y, "in_x": F.col("chunk") == x, "in_y": F.col("chunk") == y})


def _tiled(rows: DataFrame, percent: int, agreeing: int) -> DataFrame:
    """Distinct pairs (a < b) that may be linked, of dealt rows (key, x, y, name, tag, root, deletion, probe, n, sketch, marks, in_x, in_y) of one tile."""
    fields = ["name", "tag", "root", "deletion", "probe", "n", "sketch", "marks", "in_x", "in_y"]
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tile = None, {}

        def finish() -> pa.RecordBatch:
            pairs = sorted(set(tile_pairs(tile, percent, agreeing)))
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            places = list(zip(*[batch.column(c).to_pylist() for c in ("key", "x", "y")]))
            columns = {c: batch.column(c).to_pylist() for c in fields}
            start = 0
            for i in range(1, len(places) + 1):
                if i < len(places) and places[i] == places[start]:
                    continue
                if places[start] != last:
                    if last is not None:
                        yield finish()
                    last, tile = places[start], {c: [] for c in fields}
                for c in fields:
                    tile[c] += columns[c][start:i]
                start = i
        if last is not None:
            yield finish()

    placed = rows.select("key", "x", "y", *fields).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return placed.mapInArrow(lean(run), "a long, b long").distinct()


def _crossing(shared: DataFrame, roots: DataFrame, tokens: DataFrame, percent: int, part_ids: list[int]) -> DataFrame:
    """Pairs (a < b) of sets of different components that meet in a key and may be linked."""
    named = roots.toDF("name", "root")
    own = shared.join(F.broadcast(named) if roots.count() <= BROADCAST_IDS else named, "name", "left").withColumn("root", F.coalesce("root", "name"))
    per_root = own.groupBy("key", "root").agg(F.count("*").alias("n"))
    per_key = per_root.groupBy("key").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside"), F.count("*").alias("roots")
    )
    open_keys = written(
        per_key.filter("roots > 1").select("key", ((F.col("n") * F.col("n") - F.col("inside")) > 2 * HOT * F.col("n")).alias("hot")), "open"
    )
    rows = written(own.join(open_keys, "key"), "open-rows").withColumn("probe", ~F.col("hot"))
    release(shared.sparkSession)
    hot = open_keys.filter("hot").select("key")
    agreeing = AGREEING
    if hot.limit(1).count():
        agreeing = 2**31 - 1  # the segments in which a pair agrees first may be of hot keys that it doesn't use
        used = _heavy(rows.filter("hot"), hot, tokens, percent, part_ids).withColumn("used", F.lit(True))
        rows = rows.join(used, ["key", "name"], "left").withColumn("probe", F.col("probe") | F.coalesce("used", F.lit(False)))
        probed = rows.groupBy("key").agg(F.bool_or("probe").alias("any")).filter("any").select("key")
        rows = rows.join(probed, "key", "left_semi")
    rows = rows.select("key", "name", "tag", "root", "deletion", "probe")
    marked = written(_tile_rows(_dealt(rows), rows.select("name"), tokens, percent), "tile-rows")
    release(shared.sparkSession)
    return _tiled(marked, percent, agreeing)


def _leaders(shared: DataFrame) -> DataFrame:
    """(key, leader): of the sets with a key the one that meets the most others over all its keys.

    In a group of near copies that is the text they were made from, so most members link with it directly.
    """
    subsets = shared.filter("NOT deletion").select("key", "name")
    met = shared.groupBy("key").agg(F.count("*").alias("n"))
    degree = subsets.join(met, "key").groupBy("name").agg(F.sum("n").alias("degree"))
    return subsets.join(degree, "name").groupBy("key").agg(F.max(F.struct("degree", "name")).getField("name").alias("leader"))


def _grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, n_shingles, name, group) of every document (id, text); linked sets have the same group, none a null."""
    sized = written(_sized(docs, size), "sets")
    part_ids = _part_ids(docs.sparkSession)
    keys = _keys(docs.select("text"), size, percent, part_ids)
    shared = written(_shared(keys, len(part_ids)), "shared")
    tokens = _token_table(docs, sized, shared.select("name").distinct(), size)
    leaders = _leaders(shared)
    stars = shared.join(leaders, "key").filter("name <> leader").select(F.col("leader").alias("a"), F.col("name").alias("b")).distinct()
    spark = docs.sparkSession
    release(spark)
    near = written(_possible(stars, _sketches(tokens, STAR_GROUPS), percent, STAR_GROUPS), "near")
    release(spark)
    links = written(_verified(near, tokens, percent), "stars")
    release(spark)
    roots = components(links)
    met = written(_crossing(shared, roots, tokens, percent, part_ids), "met")
    release(spark)
    fine = _sketches(_only(tokens, met.select("a").union(met.select("b"))), FINE_GROUPS)
    near = written(_possible(met, fine, percent, FINE_GROUPS), "near")
    crossing = written(_verified(near, tokens, percent), "crossing")
    release(spark)
    mapped = (
        crossing.join(roots.toDF("a", "root_a"), "a", "left")
        .join(roots.toDF("b", "root_b"), "b", "left")
        .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    )
    final = components(mapped.distinct())
    one = roots.join(final.toDF("root", "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    alone = final.join(roots.select("node"), "node", "left_anti")
    reach = one.unionByName(alone.select("node", "root"))
    return sized.join(reach.withColumnRenamed("node", "name"), "name", "left").select(
        "id", "n_shingles", "name", F.coalesce("root", "name").alias("group")
    )


def jaccard_components(docs: DataFrame, *, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles (size of its set), component_id, set_id.

    A set holds the distinct runs of ``size`` words of the whole text, A-Z in lower case; with fewer words, all of them as one run.
    Documents link when 100 * common >= percent * all shingles of both; ``component_id`` is the smallest id reachable by links.
    Without words or text the set is empty and the document is linked with nothing (set_id null). Documents with equal
    sets share a set_id, repeated rows stay repeated, a null id never names a component unless no other id is in it, other
    columns are not read and an empty table gives an empty one.
    """
    docs = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    named = _grouped(docs, size, percent)
    least = named.filter("group IS NOT NULL").groupBy("group").agg(F.min("id").alias("least"))
    result = named.join(least, "group", "left")
    return result.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
        F.col("name").alias("set_id"),
    )


def one_of_each(docs: DataFrame, *, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without the near copies: of each group of linked documents the one with the smallest id stays.

    Links are those of ``jaccard_components``. Of repeated rows one stays, a null id comes last, and texts without
    words, which link with nothing, all stay. All columns are kept.
    """
    narrow = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    named = written(_grouped(narrow, size, percent).filter("group IS NOT NULL"), "groups")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "name")).alias("first")
    kept = written(named.groupBy("group").agg(first).select("first.id", "first.name"), "kept")
    is_kept = named["id"].eqNullSafe(kept["id"]) & (named["name"] == kept["name"])
    repeated = named.join(kept, is_kept, "left_semi").groupBy("id", "name").count().filter("count > 1")
    id_column, name = free_name(docs, "copy_id"), free_name(docs, "copy_name")
    # the copies are far fewer than the texts that stay
    copies = written(named.join(kept, is_kept, "left_anti").select("id", "name").distinct().toDF(id_column, name), "copies")
    if copies.count() <= BROADCAST_IDS:
        copies = F.broadcast(copies)

    def compute():
        def slice_(texts: pa.Array) -> list[pa.Array]:
            sets = [shingle_set(t, size) for t in utf8(texts)]
            return [pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64())]

        return slice_

    own = free_name(docs, "own_name")
    coded = with_arrow_columns(docs, [text], T.StructType([T.StructField(own, T.LongType())]), compute)
    stays = coded.join(copies, F.col(f"`{doc_id}`").eqNullSafe(F.col(id_column)) & (F.col(own) == F.col(name)), "left_anti")
    if repeated.limit(1).count():
        stays = stays.filter(F.col(own).isNotNull()).dropDuplicates([doc_id, own]).unionByName(stays.filter(F.col(own).isNull()))
    return stays.select(*[f"`{c}`" for c in docs.columns])
