"""Near-duplicate embeddings: a subspace pigeonhole join.

Unit vectors u, v have cosine >= c just when their squared distance is at most 2 - 2c. After a fixed random rotation the
coordinates are split into blocks, and each block gets a share of that budget in proportion to its dimensions; a linked pair
keeps to its share in at least one block. The vectors of a label are dealt into chunks, and a task compares two chunks: in each block it looks for
the pairs that keep to the share, and verifies the union of these candidates exactly, on the given vectors in double precision.

A vector travels once to each tile of its chunk, with all its blocks, and not once for each block. A label has at most ``PARTS`` chunks, so that what
travels grows with the vectors, until a chunk reaches the size that a task can hold. A pair meets in one tile only, so no list of pairs
is needed to count links.

Equal vectors of a label are one class; a class counts with all its members. A task hands on numbers of links and a spanning
forest of its pairs, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.components import components
from ratelens.llm.frames import give_back, written

BLOCK = 8
SLACK = 1e-9
#: Rows of a chunk: so many at least, and more where a label would have over PARTS chunks, up to the rows and bytes that a task can hold.
CHUNK = 1024
PARTS = 8
MOST_ROWS = 16_384
MOST_BYTES = 16 << 20
#: Pairs of a tile that are looked at in one go, and that are verified in one go.
STRIP = 1 << 20
RUN = 100_000
#: Sums of a block are taken in single precision, and cosines of many pairs by a matrix product: within these limits the exact test decides.
WIDE = np.float32(1e-5)
UNSURE = 1e-9


@lru_cache(maxsize=64)
def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation of that many dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_edges(dims: int) -> np.ndarray:
    return np.append(np.arange(0, dims, BLOCK), dims)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def rotated(units: np.ndarray) -> np.ndarray:
    return units @ rotation(units.shape[1])


def shares(dims: int, cosine: float) -> np.ndarray:
    """Budget of squared distance of each block."""
    return (2 - 2 * cosine) * np.diff(block_edges(dims)) / dims + SLACK


def _blocks(a: np.ndarray, b: np.ndarray, cosine: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two matrices for each block, whose product is by how much a pair's squared distance in the block exceeds its share."""
    dims = a.shape[1]
    edges, out = block_edges(dims), []
    for first, end, share in zip(edges[:-1], edges[1:], shares(dims, cosine)):
        x, y = a[:, first:end], b[:, first:end]
        left = np.column_stack([x, (x**2).sum(1), np.ones(len(x))])
        right = np.column_stack([-2 * y, np.ones(len(y)), (y**2).sum(1) - share])
        out.append((left.astype(np.float32), np.ascontiguousarray(right.T, np.float32)))
    return out


def linked_pairs(left: np.ndarray, right: np.ndarray, cosine: float, *, same: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of pairs of rows (i of left, j of right) with at least that cosine; with ``same`` the tables are one, and i < j.

    Candidates are the pairs that keep to the share of any block.
    """
    a, b = unit(left), unit(right)
    blocks = _blocks(rotated(a), rotated(b), cosine)
    size_left, size_right = (np.sqrt(np.einsum("ij,ij->i", v, v)) for v in (left, right))
    step = max(1, STRIP // len(right))
    for start in range(0, len(left), step):
        rows, skipped = slice(start, start + step), start if same else 0
        near = np.zeros((len(a[rows]), len(right) - skipped), dtype=bool)
        for x, y in blocks:
            near |= x[rows] @ y[:, skipped:] <= WIDE
        sure = None
        if np.count_nonzero(near) > near.size // 20:  # many candidates: one product for all
            sure = a[rows] @ b[skipped:].T
            near &= sure >= cosine - UNSURE
        every_i, every_j = np.nonzero(near)
        for at in range(0, len(every_i), RUN):
            i, j = every_i[at : at + RUN], every_j[at : at + RUN]
            open_ = np.arange(len(i)) if sure is None else np.flatnonzero(sure[i, j] < cosine + UNSURE)
            i, j = i + start, j + skipped
            x, y = left[i[open_]], right[j[open_]]
            linked = np.ones(len(i), dtype=bool)
            linked[open_] = np.einsum("ij,ij->i", x, y) / (size_left[i[open_]] * size_right[j[open_]]) >= cosine
            if same:
                linked &= i < j
            if linked.any():
                yield i[linked], j[linked]


class _Forest:
    """Pairs that suffice to connect what all pairs connect, of numbered nodes."""

    def __init__(self, nodes: int) -> None:
        self.root = np.arange(nodes)
        self.pairs: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        p, q = self.root[a], self.root[b]
        apart = np.flatnonzero(p != q)
        if not len(apart):
            return
        _, first = np.unique(np.minimum(p, q)[apart] * len(self.root) + np.maximum(p, q)[apart], return_index=True)
        above: dict[int, int] = {}

        def find(x: int) -> int:
            while above.setdefault(x, x) != x:
                above[x] = above[above[x]]
                x = above[x]
            return x

        taken = apart[first]
        for x, y, r, s in zip(*(v[taken].tolist() for v in (a, b, p, q))):
            r, s = find(r), find(s)
            if r != s:
                above[max(r, s)] = min(r, s)
                self.pairs.append((x, y))
        moved = np.arange(len(self.root))
        moved[list(above)] = [find(r) for r in list(above)]
        self.root = moved[self.root]


FOUND = pa.schema([("h", pa.int64()), ("g", pa.int32()), ("links", pa.int64()), ("to_h", pa.int64()), ("to_g", pa.int32())])


def _compared(tile: pa.Table, cosine: float) -> pa.Table:
    """Numbers of links (to_h is null) and a spanning forest of a tile's pairs."""
    is_left = tile["left"].to_numpy()
    first, second = np.flatnonzero(is_left), np.flatnonzero(~is_left)
    same = tile["x"][0] == tile["y"][0]
    if not len(first) or not (same or len(second)):
        return FOUND.empty_table()
    given = pa.concat_arrays([part.flatten() for part in tile["vector"].chunks]).cast(pa.float64(), safe=False).to_numpy()
    given = given.reshape(tile.num_rows, -1)
    left, right, second = (given, given, first) if same else (given[first], given[second], second)
    sizes, links, forest = tile["size"].to_numpy(), np.zeros(tile.num_rows, dtype=np.int64), _Forest(tile.num_rows)
    for i, j in linked_pairs(left, right, cosine, same=same):
        i, j = first[i], second[j]
        links += np.bincount(i, sizes[j], len(links)).astype(np.int64) + np.bincount(j, sizes[i], len(links)).astype(np.int64)
        forest.add(i, j)
    linked = np.flatnonzero(links)
    x, y = np.array(forest.pairs, dtype=np.int64).reshape(-1, 2).T
    h, g = tile["h"].to_numpy(), tile["g"].to_numpy()
    none = pa.nulls(len(linked))
    counts = [h[linked], g[linked], links[linked], none.cast(pa.int64()), none.cast(pa.int32())]
    pairs = [h[x], g[x], np.zeros(len(x), dtype=np.int64), h[y], g[y]]
    return pa.concat_tables(pa.Table.from_arrays([pa.array(c) for c in part], schema=FOUND) for part in (counts, pairs))


#: What names a tile: the chunks x and y of a label, x <= y.
TILE = ["dims", "label", "x", "y"]


def _dealt(classes: DataFrame) -> DataFrame:
    """(dims, label, h, g, size, vector, x, y, left): one row per class and tile of its chunk; ``left`` says that its chunk is x."""
    grid = ["dims", "label"]
    placed = classes.withColumn("dims", F.size("vector"))
    held = F.least(F.lit(MOST_ROWS), F.greatest(F.lit(1), F.floor(F.lit(MOST_BYTES) / (8 * F.col("dims")))))
    rows = F.least(held, F.greatest(F.lit(CHUNK), F.ceil(F.col("n") / PARTS)))
    chunks = placed.groupBy(*grid).agg(F.count("*").alias("n")).select(*grid, F.ceil(F.col("n") / rows).cast("int").alias("chunks"))
    placed = placed.join(chunks, grid).withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    tile = lambda x, y, left: F.struct(x.alias("x"), y.alias("y"), F.lit(left).alias("left"))
    own = F.col("own")
    before = F.when(own > 0, F.sequence(F.lit(0), own - 1)).otherwise(F.array().cast("array<int>"))
    tiles = F.concat(
        F.transform(F.sequence(own, F.col("chunks") - 1), lambda y: tile(own, y, True)), F.transform(before, lambda x: tile(x, own, False))
    )
    dealt = placed.select(*grid, "node.h", "node.g", "size", "vector", F.explode(tiles).alias("t"))
    # else the tiles of a label would stay in the task of the join
    return dealt.select(*grid, "h", "g", "size", "vector", "t.*").repartition(*TILE)


def near_duplicates(
    vectors: DataFrame, *, cosine: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id, kept.

    Vectors link when their labels are equal and not null and their cosine, in double precision, is at least ``cosine``. Vectors that
    are null, empty, zero or hold null or non-finite components, and vectors of different lengths, link with nothing.
    ``component_id`` is the smallest id reachable by links, itself included; ``kept`` says whether it is the vector's own.
    Rows with the same id are different vectors with one name; rows with a null id link, but name no component unless
    all ids of it are null. Other columns are not read and an empty table gives an empty one.
    """
    given = vectors.select(
        F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{embedding}`").alias("vector")
    )
    doubles = F.transform("vector", lambda x: x.cast("double"))
    usable = (
        F.col("label").isNotNull()
        & (F.size("vector") > 0)
        & F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(doubles, lambda x: x != 0)
    )
    # two hash functions name a class of equal vectors: 96 bits
    node = F.when(F.coalesce(usable, F.lit(False)), F.struct(F.xxhash64("label", "vector").alias("h"), F.hash("vector").alias("g")))
    named = given.withColumn("node", node)
    sizes = named.filter("node IS NOT NULL").groupBy("node").agg(
        F.count("*").alias("size"), F.min("id").alias("least"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    classes = written(sizes.withColumn("node", F.struct("node.h", "node.g")), "classes")

    def compare(tile: pa.Table) -> pa.Table:
        try:
            return _compared(tile, cosine)
        finally:
            give_back()

    found = written(
        _dealt(classes).groupBy(*TILE).applyInArrow(compare, "h long, g int, links long, to_h long, to_g int"), "found"
    ).withColumn("node", F.struct("h", "g"))
    counts = found.filter("to_h IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.filter("to_h IS NOT NULL").select("node", F.struct(F.col("to_h").alias("h"), F.col("to_g").alias("g")).alias("to")))
    mine = (
        classes.select("node", "size", "least")
        .join(roots, "node", "left")
        .join(counts, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    smallest = mine.groupBy("root").agg(F.min("least").alias("component"))
    about = mine.join(smallest, "root").select("node", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component"))
    return named.join(about, "node", "left").select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )
