"""Near copies among embeddings: all pairs with a cosine of 0.9 or more, by a subspace pigeonhole join.

Unit vectors with that cosine are within a squared distance of 0.2.  They are
rotated (random signs, then a Walsh-Hadamard transform), which spreads what they
differ in over all coordinates, and cut into blocks.  The budget of 0.2 is
shared out among the blocks in proportion to their size: two linked vectors are
within the budget of at least one block, so a range join in each block finds
every pair.

For the range join a block's space is cut into cells by medians of a bounded
sample.  A vector is at home in one cell and is sent to all cells that come
after it in order and that its ball of the block's radius reaches.  Full cells
are cut into slices, so none grows with the data.  Pairs within the block's
budget are candidates and are checked at once by the whole vectors.  A link that
several blocks find counts in the first of them only, which every task can
tell for itself; so no pair leaves a task, only each vector's number of links and
one vector that it hangs together with.

On vectors without any structure, and with a budget as wide as this one, a ball
reaches most cells: the work there is all pairs' share of a block, done as
products of matrices.  Vectors in clusters meet only their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import column, connected_components, starts, united
from evenkeel.sources.workspace import written

LEAST = 0.9
BLOCKS = 4
#: Vectors at home in a cell, or a slice of it, about.
CELL = 8192
#: Vectors of the sample for each cell, and cells of a block at most.
SAMPLE_EACH, MOST_CELLS = 32, 1024
#: Vectors compared with a cell at once.
TILE = 512
#: Far more than double arithmetic loses, and single in a product.
SLACK, SINGLE_SLACK = 1e-9, 1e-5


class Rotation:
    """Vectors of one dimension as unit vectors in rotated coordinates, the same bits wherever it is done."""

    def __init__(self, dimension: int, blocks: int, least: float):
        self.dimension = dimension
        self.size = 1 << max(0, dimension - 1).bit_length()
        self.signs = np.random.default_rng(dimension).choice([-1.0, 1.0], dimension)
        edges = sorted({round(self.size * i / blocks) for i in range(blocks + 1)})
        self.blocks = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]
        whole = max(0.0, 2 - 2 * least) * (1 + SLACK) + SLACK
        self.budgets = [whole * (b.stop - b.start) / self.size for b in self.blocks]

    def unit(self, x: np.ndarray) -> np.ndarray:
        """Vectors of length one; neither large nor small components overflow."""
        x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
        return x / np.sqrt(np.add.reduce(x * x, axis=1))[:, None]

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        """Only sums and differences of whole columns, so a row's result does not depend on the others."""
        x = np.zeros((len(unit), self.size))
        x[:, : self.dimension] = unit * self.signs
        step = 1
        while step < self.size:
            pairs = x.reshape(len(x), -1, 2, step)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), -1)
            step *= 2
        return x / np.sqrt(self.size)


@dataclass
class Cells:
    """A block's space cut into ``2**depth`` cells: node i of the tree is cut at ``cut[i]`` on ``axis[i]``."""

    depth: int = 0
    axis: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)

    @classmethod
    def of(cls, sample: np.ndarray, depth: int) -> Cells:
        cells, level = cls(), [sample]
        while cells.depth < depth and all(len(p) > 1 for p in level):
            below = []
            for points in level:
                axis = int(np.argmax(points.var(axis=0)))
                cut = float(np.median(points[:, axis]))
                cells.axis.append(axis)
                cells.cut.append(cut)
                right = points[:, axis] >= cut
                below += [points[~right], points[right]]
            level, cells.depth = below, cells.depth + 1
        return cells

    def reached(self, x: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(home, vector, cell): each vector's own cell, and all cells within the squared distance of each."""
        axis, cut = np.array(self.axis, np.int64), np.array(self.cut)
        row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        home, away, apart = np.zeros(len(x), np.int64), np.zeros(len(x)), np.zeros_like(x)
        for level in range(self.depth):
            first = (1 << level) - 1
            a, c = axis[first + node], cut[first + node]
            offset = x[row, a] - c
            right = offset >= 0
            home = 2 * home + (x[np.arange(len(x)), axis[first + home]] >= cut[first + home])
            # the far side is at least as far away along this axis as the cut, and as it was before
            there = np.maximum(np.abs(offset), apart[np.arange(len(row)), a])
            far_away = away - apart[np.arange(len(row)), a] ** 2 + there**2
            far = np.flatnonzero(far_away <= budget * (1 + SLACK) + SLACK)
            far_apart = apart[far]
            far_apart[np.arange(len(far)), a[far]] = there[far]
            row, apart = np.concatenate([row, row[far]]), np.concatenate([apart, far_apart])
            node = np.concatenate([2 * node + right, 2 * node[far] + ~right[far]])
            away = np.concatenate([away, far_away[far]])
        return home, row, node


def _place(block, cell, part):
    return (np.int64(block) << np.int64(52)) | (np.asarray(cell, np.int64) << np.int64(32)) | np.asarray(part, np.int64)


def _vectors(x: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(x.flatten(), np.float64).reshape(-1, dimension)


def _of_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.asarray(batch.column(0))
    for d in np.unique(sizes).tolist():
        yield d, batch if (sizes == d).all() else batch.take(pa.array(np.flatnonzero(sizes == d)))


def _homes(trees: dict[int, list[Cells]], blocks: int, least: float):
    """(d, block, cell, vectors) that are at home in each cell, of one batch."""

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for d, part in _of_dimension(batch):
                rotation = Rotation(d, blocks, least)
                x = rotation(rotation.unit(_vectors(part.column(3), d)))
                for b, of in enumerate(rotation.blocks):
                    cell, n = np.unique(trees[d][b].reached(x[:, of], -1.0)[0] if d in trees else np.zeros(len(x), np.int64), return_counts=True)
                    rows += [(d, b, c, m) for c, m in zip(cell.tolist(), n.tolist(), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["d", "block", "cell", "n"])

    return homes


def _sent(trees: dict[int, list[Cells]], slices: dict[tuple[int, int, int], int], blocks: int, least: float):
    """Every vector at home in its place, and in all places after it that it reaches."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, whole in _of_dimension(batch):
                rotation = Rotation(d, blocks, least)
                for i in range(0, whole.num_rows, 1000):
                    part = whole.slice(i, 1000)
                    x = rotation(rotation.unit(_vectors(part.column(3), d)))
                    node = np.asarray(part.column(1))
                    for b, of in enumerate(rotation.blocks):
                        tree = trees[d][b] if d in trees else Cells()
                        home, row, cell = tree.reached(x[:, of], rotation.budgets[b])
                        n_slices = np.array([slices.get((d, b, c), 1) for c in range(1 << tree.depth)], np.int64)
                        own = _place(b, home, node % n_slices[home])
                        # all slices of each reached cell
                        each = n_slices[cell]
                        row, cell = np.repeat(row, each), np.repeat(cell, each)
                        place = _place(b, cell, np.arange(len(cell)) - np.repeat(np.cumsum(each) - each, each))
                        later = place > own[row]
                        row = np.concatenate([np.arange(len(x)), row[later]])
                        place = np.concatenate([own, place[later]])
                        role = (np.arange(len(row)) >= len(x)).astype(np.int32)
                        for j in range(0, len(row), 5000):
                            which = pa.array(row[j : j + 5000])
                            yield pa.RecordBatch.from_arrays(
                                [part.column(0).take(which), pa.array(place[j : j + 5000]), pa.array(role[j : j + 5000]),
                                 *(part.column(k).take(which) for k in (1, 2, 3))],
                                names=["d", "place", "role", "node", "n", "x"],
                            )

    return sent


class Side:
    """Some vectors with all that a comparison needs."""

    def __init__(self, rotation: Rotation, block: int, node: np.ndarray, n: np.ndarray, x: np.ndarray):
        self.node, self.n = node, n
        self.unit = rotation.unit(x)
        self.rotated = rotation(self.unit)
        part = self.rotated[:, rotation.blocks[block]]
        square, one = np.einsum("ij,ij->i", part, part)[:, None], np.ones((len(part), 1))
        # the product of the one with the other is the squared distance
        self.left = np.hstack([-2 * part, square, one]).astype(np.float32)
        self.right = np.hstack([part, one, square]).astype(np.float32)


def _linked(rotation: Rotation, block: int, least: float, a: Side, i: np.ndarray, b: Side, j: np.ndarray) -> np.ndarray:
    """Which of the candidate pairs are links that this block is the first to find."""
    found = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 15):
        p, q = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
        mine = np.add.reduce(a.unit[p] * b.unit[q], axis=1) >= least
        p, q = p[mine], q[mine]
        apart = (a.rotated[p] - b.rotated[q]) ** 2
        within = [np.add.reduce(np.ascontiguousarray(apart[:, of]), axis=1) <= most for of, most in zip(rotation.blocks[: block + 1], rotation.budgets, strict=False)]
        first = within[block].copy()
        for earlier in within[:block]:
            first &= ~earlier
        found[at + np.flatnonzero(mine)] = first
    return found


class Place:
    """What is at home in a place, and the links found there."""

    def __init__(self, rotation: Rotation, block: int, least: float, home: Side):
        self.rotation, self.block, self.least, self.home = rotation, block, least, home
        self.links = np.zeros(len(home.node), np.int64)
        self.labels = np.arange(len(home.node))
        self.linked = np.zeros(len(home.node), bool)
        for at in range(0, len(home.node), TILE):
            self._compare(home, slice(at, at + TILE), inside=True)

    def _compare(self, side: Side, of: slice, inside: bool = False) -> tuple[np.ndarray, np.ndarray]:
        home, budget = self.home, self.rotation.budgets[self.block]
        near = side.left[of] @ home.right.T <= np.float32(budget + SINGLE_SLACK)
        i, j = np.nonzero(near)
        i += of.start
        if inside:
            i, j = i[i < j], j[i < j]
        kept = _linked(self.rotation, self.block, self.least, side, i, home, j)
        i, j = i[kept], j[kept]
        self.links += np.bincount(j, side.n[i], len(self.links)).astype(np.int64)
        self.linked[j] = True
        if inside:
            self.links += np.bincount(i, home.n[j], len(self.links)).astype(np.int64)
            self.linked[i] = True
            self.labels = united(self.labels, i, j)
        else:  # all that one vector is linked with hangs together
            again = np.flatnonzero(i[1:] == i[:-1])
            self.labels = united(self.labels, j[again], j[again + 1])
        return i, j

    def meet(self, side: Side) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(side.node), TILE):
            i, j = self._compare(side, slice(at, at + TILE))
            if len(i):
                who, first = np.unique(i, return_index=True)
                links = np.bincount(i - at, self.home.n[j], TILE).astype(np.int64)[who - at]
                yield _found(side.node[who], links, self.home.node[j[first]])

    def own(self) -> Iterator[pa.RecordBatch]:
        who = np.flatnonzero(self.linked)
        if len(who):
            yield _found(self.home.node[who], self.links[who], self.home.node[self.labels[who]])


def _found(node: np.ndarray, links: np.ndarray, peer: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (node, links, peer)], names=["node", "links", "peer"])


def _joined(blocks: int, least: float):
    """Rows come sorted by dimension, place and role: those at home first."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, place, rotation = None, [], None, None

        def side(parts) -> Side:
            node, n = (np.concatenate([np.asarray(p.column(k)) for p in parts]) for k in (3, 4))
            return Side(rotation, now[1] >> 52, node, n, np.concatenate([_vectors(p.column(5), now[0]) for p in parts]))

        for batch in batches:
            if not batch.num_rows:
                continue
            d, at, role = (np.asarray(batch.column(k)) for k in range(3))
            begin = starts(d, at, role)
            for b, e in zip(begin.tolist(), np.append(begin[1:], batch.num_rows).tolist(), strict=True):
                rows, key = batch.slice(b, e - b), (int(d[b]), int(at[b]))
                if key != now:
                    if waiting:
                        place = Place(rotation, now[1] >> 52, least, side(waiting))
                    if place is not None:
                        yield from place.own()
                    now, waiting, place = key, [], None
                    rotation = Rotation(key[0], blocks, least)
                if role[b] == 0:
                    waiting.append(rows)
                    continue
                if waiting:
                    place, waiting = Place(rotation, now[1] >> 52, least, side(waiting)), []
                if place is not None:  # a cell that is nobody's home
                    yield from place.meet(side([rows]))
        if waiting:
            place = Place(rotation, now[1] >> 52, least, side(waiting))
        if place is not None:
            yield from place.own()

    return joined


def _trees(spark, distinct: DataFrame, total: int, blocks: int, least: float, cell: int) -> dict[int, list[Cells]]:
    """Cells for each dimension that the sample has, from at most ``SAMPLE_EACH * MOST_CELLS`` vectors."""
    depth = min(MOST_CELLS, max(1, -(-total // cell)) - 1).bit_length()
    if not depth:
        return {}
    sample = distinct.orderBy(F.xxhash64("node")).limit(SAMPLE_EACH << depth).select("d", "x").collect()
    by_dimension: dict[int, list] = {}
    for r in sample:
        by_dimension.setdefault(r.d, []).append(r.x)
    trees = {}
    for d, rows in by_dimension.items():
        rotation = Rotation(d, blocks, least)
        x = rotation(rotation.unit(np.array(rows, np.float64)))
        own = min(depth, max(0, len(rows) // SAMPLE_EACH).bit_length())
        trees[d] = [Cells.of(x[:, of], own) for of in rotation.blocks]
    return trees


def cosine_links(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *,
    least: float = LEAST, blocks: int = BLOCKS, cell: int = CELL,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Rows are linked if the cosine of their vectors, in double precision, is ``least`` or more.  ``n_links`` is the
    number of other rows a row is linked with, ``component_id`` the smallest id reachable over links, the row's own
    included, and ``kept`` whether that is its own.  No pair is left out: ``cell`` and ``blocks`` change the work only.

    A vector that is null, empty, zero, or holds a null or non-finite component has no links and is its own
    component.  Vectors of different lengths are never linked.  Rows with equal vectors, or equal ids, are rows of their
    own, linked if their vectors are.  A row with a null id takes part and is never the smallest; it is not kept, and
    its component is null if no other id is in it.  An empty table gives no rows; other columns are ignored.
    """
    spark, name = vectors.sparkSession, vectors.select(column(id_col)).columns[0]
    x = column(vector_col)
    if vectors.select(x.alias("x")).schema["x"].dataType.simpleString() != "array<float>":
        x = x.cast("array<double>")
    rows = vectors.select(column(id_col).cast("long").alias("id"), x.alias("x"))
    real = F.coalesce(
        F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0), F.lit(False)
    )
    distinct = written(
        rows.filter(real).groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
        .select(F.size("x").cast("long").alias("d"), F.monotonically_increasing_id().alias("node"), "n", "x", "low"),
        "vectors",
    )
    total = distinct.count()
    of = distinct.select("d", "node", "n", "x")
    trees = _trees(spark, distinct, total, blocks, least, cell)
    homes = of.mapInArrow(_homes(trees, blocks, least), "d long, block long, cell long, n long").groupBy("d", "block", "cell").agg(F.sum("n").alias("n"))
    # at most one number for each cell of each block
    slices = {(r.d, r.block, r.cell): -(-r.n // cell) for r in homes.filter(F.col("n") > cell).collect()}
    kind = of.schema["x"].dataType.simpleString()
    sent = of.mapInArrow(_sent(trees, slices, blocks, least), f"d long, place long, role int, node long, n long, x {kind}")
    dealt = sent.repartition("d", "place").sortWithinPartitions("d", "place", "role")
    found = written(dealt.mapInArrow(_joined(blocks, least), "node long, links long, peer long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(found.select("node", "peer"), "node", "peer")
    low = distinct.select("node", "low").join(components, "node")
    low = low.join(low.groupBy("component").agg(F.min("low").alias("component_id")), "component").select("node", "component_id")
    known = distinct.join(links, "node", "left").join(low, "node", "left").select(
        "x", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "low").alias("component_id")
    )
    alone = rows.filter(~real).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    both = rows.filter(real).join(known, "x").select("id", "n_links", "component_id").unionByName(alone)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return both.select(F.col("id").alias(name), "n_links", "component_id", kept.alias("kept"))
