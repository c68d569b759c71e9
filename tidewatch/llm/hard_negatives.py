"""Hard negatives from vectors: a multiway hyperplane tree searched by annuli around score windows.

An anchor's positives are the rows of its label with the highest scores; its hard negatives are the
highest-scoring rows of other labels whose score lies in a window below a positive's. A score is the
inner product of vectors of whole numbers (each component times ``scale``, rounded down).

The tree is that of geometric near-neighbour access: a node has ``FAN`` split points, a row belongs to
the nearest one, and each split point stores the least and greatest distance to the rows below every
sibling. As |q - x|^2 = |q|^2 + |x|^2 - 2 q.x, a window of scores is an annulus of distances around the
anchor, given the least and greatest length below a child. A child is left out when for some split point
the annulus, seen from there, does not meet its stored range. What is left is scored exactly in the
leaves, so results are exact whatever the tree looks like.

Split points come from a sample of ``SAMPLE`` rows (those of least hash), which bounds the tree that
tasks get and its ranges, which the driver gets; every row is put into the tree. Rows of a leaf lie in
tiles of ``TILE`` rows; a leaf of many rows, such as a vector that a third of all rows share, has many
tiles in several partitions. Anchors are a stated set of queries: they meet the tiles of the leaves
they need in blocks of ``BLOCK`` anchors. A task returns no more than the first few rows for each
anchor and tile. The sample's own scores narrow each window before the search.

Rows with a null label, a null vector, or any null or non-finite component take no part; neither do
rows whose squared length reaches 2 ** 62, as their scores have no 64-bit value. Vectors of unequal
length are filled up with zeros. Rows equal in id, label and vector are one row; rows that share only
the id are different rows. Of equal scores the smaller id comes first, a null id last, then the smaller
label and hash of the vector. A row without an id is no anchor. Further columns are not read. An empty
table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.shared import shuffle_tasks, write_once

SCALE = 256
SAMPLE = 2048
FAN = 8
#: a node of fewer sampled rows is a leaf
LEAF = 32
TILE = 1024
BLOCK = 256
#: tiles of a leaf that one task of the search gets together
TILES = 4
NO_ID = 2**63 - 1  # stands for a null id, and comes after all others
LENGTH_LIMIT = float(1 << 62)
#: what rounding may add to a distance, as a part of the lengths it comes from
SLACK = 1e-6


def whole_vectors(
    rows: DataFrame, scale: int = SCALE, id: str = "vec_id", label: str = "label", vector: str = "embedding"
) -> DataFrame:
    """(id, label, vector) of the rows that take part, with components as whole numbers."""
    usable = F.col(label).isNotNull() & F.col(vector).isNotNull() & ~F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))),
    )
    parts = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)))
    length = F.aggregate(
        "vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    found = rows.filter(usable).select(
        F.coalesce(F.col(id).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(label).cast("long").alias("label"),
        parts.alias("vector"),
    )
    return found.filter(length < F.lit(LENGTH_LIMIT))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of whole numbers as rows, filled up with zeros."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    found = np.zeros((len(sizes), width), np.int64)
    ends = np.cumsum(sizes)
    for n, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
        found[n, :size] = flat[end - size : end]
    return found


def _squares(rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", rows, rows)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products as 64-bit integers. Doubles are exact while no sum can reach 2 ** 53."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = float(np.sqrt(_squares(a.astype(float)).max(initial=0) * _squares(b.astype(float)).max(initial=0)))
    if most < 1 << 52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to points."""
    width = min(rows.shape[1], points.shape[1])
    rows, points = rows.astype(float), points.astype(float)
    square = _squares(rows)[:, None] + _squares(points)[None, :]
    return np.sqrt(np.maximum(square - 2 * rows[:, :width] @ points[:, :width].T, 0))


@dataclass
class Node:
    """Split points, and below each of them a node or the number of a leaf."""

    number: int
    points: np.ndarray
    below: list[Node | int] = field(default_factory=list)


@dataclass
class Tree:
    """The tree over a sample, with the sample itself (ids, labels, vectors)."""

    root: Node | int
    leaves: int
    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        found = np.zeros(len(rows), np.int32)
        todo: list[tuple[Node | int, np.ndarray]] = [(self.root, np.arange(len(rows)))]
        while todo:
            node, places = todo.pop()
            if isinstance(node, int):
                found[places] = node
            elif len(places):
                nearest = distances(rows[places], node.points).argmin(1)
                todo += [(child, places[nearest == n]) for n, child in enumerate(node.below)]
        return found

    def paths(self) -> dict[int, list[tuple[Node, int]]]:
        """For each leaf the nodes above it, and which child of each leads there."""
        found: dict[int, list[tuple[Node, int]]] = {}
        todo: list[tuple[Node | int, list[tuple[Node, int]]]] = [(self.root, [])]
        while todo:
            node, path = todo.pop()
            if isinstance(node, int):
                found[node] = path
            else:
                todo += [(child, [*path, (node, n)]) for n, child in enumerate(node.below)]
        return found


def split_points(rows: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: each next one is the farthest from those chosen."""
    chosen = [int(_squares(rows.astype(float)).argmax())]
    away = distances(rows, rows[chosen])[:, 0]
    while len(chosen) < count and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, distances(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def build_tree(ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, fan: int, leaf: int) -> Tree:
    tree, nodes = Tree(0, 0, ids, labels, rows), 0

    def grown(places: np.ndarray) -> Node | int:
        nonlocal nodes
        points = split_points(rows[places], fan) if len(places) >= leaf else rows[:0]
        if len(points) < 2:
            tree.leaves += 1
            return tree.leaves - 1
        node = Node(nodes, points)
        nodes += 1
        nearest = distances(rows[places], points).argmin(1)
        node.below = [grown(places[nearest == n]) for n in range(len(points))]
        return node

    tree.root = grown(np.arange(len(rows)))
    return tree


def sampled_tree(rows: DataFrame, sample: int, fan: int, leaf: int) -> Tree:
    """The tree over the ``sample`` rows of least hash."""
    order = F.xxhash64("id", "label", "vector")
    table = rows.orderBy(order, "id").limit(sample).toArrow().combine_chunks()
    if not table.num_rows:
        return Tree(0, 1, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0), np.int64))
    ids, labels = (table[c].to_numpy() for c in ("id", "label"))
    vectors = matrix(table["vector"].combine_chunks())
    _, first = np.unique(np.column_stack([ids, labels, vectors]), axis=0, return_index=True)
    return build_tree(ids[first], labels[first], vectors[first], fan, leaf)


def _packed(rows: np.ndarray) -> tuple[bytes, int]:
    """Integers in as few bytes as they need."""
    most = int(np.abs(rows).max(initial=0))
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return rows.astype(f"<i{width}").tobytes(), width


def _unpacked(data: bytes, width: int, count: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{width}").reshape(count, -1).astype(np.int64)


TILE_SCHEMA = (
    "leaf int, tile long, rows int, ids binary, labels binary, vectors binary, width int, "
    "least_square double, most_square double, least array<double>, most array<double>"
)


def tiled(rows: DataFrame, tree: Tree, size: int) -> DataFrame:
    """The rows of each leaf packed into tiles, with their distances to the split points above them."""

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = tree.leaf_of(matrix(batch["vector"]))
            columns = [pa.array(leaves), batch["id"], batch["label"], batch["vector"], batch["tie"]]
            yield pa.RecordBatch.from_arrays(columns, names=["leaf", "id", "label", "vector", "tie"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = tree.paths()
        made = TaskContext.get().partitionId() << 32
        leaf, ids, labels, vectors = None, [], [], []
        last = None

        def tile() -> pa.RecordBatch:
            nonlocal made
            made += 1
            width = max(len(v) for v in vectors)
            found = np.zeros((len(vectors), width), np.int64)
            for n, v in enumerate(vectors):
                found[n, : len(v)] = v
            points = [node.points for node, _ in paths[leaf]]
            away = np.concatenate([distances(found, p) for p in points], 1) if points else np.zeros((1, 0))
            squares = _squares(found.astype(float))
            data, bytes_each = _packed(found)
            row = {
                "leaf": leaf, "tile": made, "rows": len(ids),
                "ids": np.array(ids, "<i8").tobytes(), "labels": np.array(labels, "<i8").tobytes(),
                "vectors": data, "width": bytes_each,
                "least_square": squares.min(), "most_square": squares.max(),
                "least": away.min(0).tolist(), "most": away.max(0).tolist(),
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("leaf", "id", "label"))
            whole = matrix(batch["vector"])
            for now, id, label, vector in zip(*columns, whole, strict=True):
                row = (now, id, label, vector.tobytes().rstrip(b"\0"))
                if row == last:
                    continue  # sorted, so a repeated row comes after its like
                last = row
                if ids and (now != leaf or len(ids) >= size):
                    yield tile()
                    ids, labels, vectors = [], [], []
                leaf = now
                ids.append(id)
                labels.append(label)
                vectors.append(vector)
        if ids:
            yield tile()

    long_list, float_list = pa.list_(pa.int64()), pa.list_(pa.float64())
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    kinds["array<double>"], kinds["array<bigint>"] = float_list, long_list
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in TILE_SCHEMA.split(", ")])
    order = ["leaf", "id", "label", "tie"]
    keyed = rows.withColumn("tie", F.xxhash64("vector"))
    found = keyed.mapInArrow(routed, "leaf int, id long, label long, vector array<bigint>, tie long")
    found = found.repartitionByRange(shuffle_tasks(rows.sparkSession), *order)
    return found.sortWithinPartitions(*order).drop("tie").mapInArrow(packed, TILE_SCHEMA)


class Ranges:
    """What the split points store: distances to the rows below their siblings, and lengths there.

    Of a node and a child: ``least`` and ``most`` distance to each of the node's points, and the
    least and greatest squared length. A child below which no row lies is not there.
    """

    def __init__(self, tree: Tree, tiles: DataFrame):
        per_leaf = tiles.groupBy("leaf").agg(
            F.count("*").alias("tiles"),
            F.min("least_square").alias("least_square"),
            F.max("most_square").alias("most_square"),
        )
        at = tiles.select("leaf", F.posexplode(F.arrays_zip("least", "most")).alias("place", "seen"))
        at = at.groupBy("leaf", "place").agg(
            F.min("seen.least").alias("least"), F.max("seen.most").alias("most")
        )
        leaves = per_leaf.collect()  # a row per leaf
        self.tiles = {r["leaf"]: r["tiles"] for r in leaves}
        squares = {r["leaf"]: (r["least_square"], r["most_square"]) for r in leaves}
        seen = {(r["leaf"], r["place"]): (r["least"], r["most"]) for r in at.collect()}
        self.below: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, float, float]] = {}
        for leaf, path in tree.paths().items():
            start = 0
            for node, child in path:
                count = len(node.points)
                if leaf in squares:
                    some = np.array([seen[leaf, start + n] for n in range(count)])
                    old = self.below.get((node.number, child))
                    new = (some[:, 0], some[:, 1], *squares[leaf])
                    if old is not None:
                        new = tuple(f(a, b) for f, a, b in zip(self._joined, old, new, strict=True))
                    self.below[node.number, child] = new
                start += count

    _joined = (np.minimum, np.maximum, min, max)


def surviving(
    tree: Tree, ranges: Ranges, anchors: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray
) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, windows): the windows [low, high] of anchors ``of`` that may have a row in a leaf."""
    squares = _squares(anchors.astype(float))[of]
    low, high = low.astype(float), high.astype(float)
    todo: list[tuple[Node | int, np.ndarray]] = [(tree.root, np.arange(len(of)))]
    while todo:
        node, some = todo.pop()
        if not len(some):
            continue
        if isinstance(node, int):
            if node in ranges.tiles:
                yield node, some
            continue
        away = distances(anchors, node.points)[of[some]]
        for n, child in enumerate(node.below):
            if (node.number, n) not in ranges.below:
                continue
            least, most, short, long = ranges.below[node.number, n]
            lengths = max(squares.max(), long, _squares(node.points.astype(float)).max())
            slack = SLACK * (1 + np.sqrt(lengths))
            nearest = squares[some] + short - 2 * high[some]
            farthest = squares[some] + long - 2 * low[some]
            inner = np.sqrt(np.maximum(nearest, 0))[:, None] - slack
            outer = np.sqrt(np.maximum(farthest, 0))[:, None] + slack
            # how near to a split point the annulus comes, and how far from it it goes
            first = np.maximum(np.maximum(away - outer, inner - away), 0)
            met = (first <= most + slack) & (away + outer >= least - slack)
            todo.append((child, some[met.all(1) & (farthest >= -SLACK * (1 + lengths))]))


def first_of(of: np.ndarray, score: np.ndarray, *ties: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` rows of each query: highest score, then smallest ties."""
    order = np.lexsort((*reversed(ties), -score, of))
    start = np.flatnonzero(np.concatenate(([True], of[order][1:] != of[order][:-1]))[: len(order)])
    size = np.diff(np.concatenate((start, [len(order)])))
    rank = np.arange(len(order)) - np.repeat(start, size)
    return order[rank < count]


def _hashes(rows: np.ndarray) -> np.ndarray:
    found = [xxhash.xxh3_64_intdigest(r.tobytes().rstrip(b"\0")) >> 1 for r in rows]
    return np.array(found, np.int64).reshape(len(rows))


def nth_highest(scores: np.ndarray, usable: np.ndarray, count: int) -> np.ndarray:
    """Per row the ``count``-th highest usable score, the least integer if there are fewer."""
    least = np.iinfo(np.int64).min
    if scores.shape[1] < count:
        return np.full(len(scores), least)
    return np.partition(np.where(usable, scores, least), -count, axis=1)[:, -count]


def _same_rows(ids, labels, rows, other_ids, other_labels, others) -> np.ndarray:
    """Which pairs of rows are one and the same."""
    same = (ids[:, None] == other_ids[None, :]) & (labels[:, None] == other_labels[None, :])
    for a, b in zip(*np.nonzero(same), strict=True):
        x, y = rows[a], others[b]
        width = min(len(x), len(y))
        same[a, b] = (x[:width] == y[:width]).all() and not x[width:].any() and not y[width:].any()
    return same


BLOCK_SCHEMA = (
    "leaf int, anchors int, numbers binary, anchor_ids binary, anchor_labels binary, "
    "anchor_vectors binary, anchor_width int, of binary, window binary, low binary, high binary"
)
FOUND_SCHEMA = "number long, window int, id long, label long, tie long, score long"


class Search:
    """One pass over the tree: each anchor's windows of scores, among rows of its label or of others."""

    def __init__(self, tree: Tree, ranges: Ranges, same_label: bool, count: int):
        self.tree, self.ranges, self.same_label, self.count = tree, ranges, same_label, count

    def narrowed(self, ids, labels, rows, of, low, high) -> np.ndarray:
        """``low`` raised to the last score that can still be among the first, by the sample."""
        sample = self.tree
        if not len(sample.ids):
            return low
        scores = products(rows, sample.rows)
        usable = (labels[:, None] == sample.labels[None, :]) == self.same_label
        usable &= ~_same_rows(ids, labels, rows, sample.ids, sample.labels, sample.rows)
        scores, usable = scores[of], usable[of]
        usable &= (scores >= low[:, None]) & (scores <= high[:, None])
        return np.maximum(low, nth_highest(scores, usable, self.count))

    def blocks(self, anchors: DataFrame) -> DataFrame:
        """Anchors in blocks, a row for every leaf and share of its tiles that they have to see.

        ``anchors`` has number, id, label, vector, and lists low and high of its windows.
        """

        def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, BLOCK):
                    yield from one(whole.slice(start, BLOCK))

        def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            numbers, ids, labels = (batch[c].to_numpy() for c in ("number", "id", "label"))
            rows = matrix(batch["vector"])
            sizes = batch["low"].value_lengths().to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(len(ids)), sizes)
            window = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            low, high = (batch[c].flatten().to_numpy(zero_copy_only=False) for c in ("low", "high"))
            open_ = low <= high
            of, window, low, high = of[open_], window[open_], low[open_], high[open_]
            low = self.narrowed(ids, labels, rows, of, low, high)
            for leaf, some in surviving(self.tree, self.ranges, rows, of, low, high):
                needed, place = np.unique(of[some], return_inverse=True)
                data, width = _packed(rows[needed])
                row = {
                    "leaf": leaf, "anchors": len(needed), "numbers": numbers[needed].tobytes(),
                    "anchor_ids": ids[needed].tobytes(), "anchor_labels": labels[needed].tobytes(),
                    "anchor_vectors": data, "anchor_width": width,
                    "of": place.astype("<i8").tobytes(), "window": window[some].astype("<i8").tobytes(),
                    "low": low[some].tobytes(), "high": high[some].tobytes(),
                }
                yield pa.RecordBatch.from_pylist([row], schema=schema)

        kinds = {"int": pa.int32(), "binary": pa.binary()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in BLOCK_SCHEMA.split(", ")])
        rows = anchors.select("number", "id", "label", "vector", "low", "high")
        return rows.mapInArrow(blocked, BLOCK_SCHEMA)

    def found(self, anchors: DataFrame, tiles: DataFrame, per_task: int = TILES) -> DataFrame:
        """The first ``count`` rows of each window, ranked: number, window, id, label, score, rank."""

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield self._scored(row)

        spark = tiles.sparkSession
        parts = [(leaf, -(-n // per_task)) for leaf, n in self.ranges.tiles.items()]
        leaves = F.broadcast(spark.createDataFrame(parts, "leaf int, parts int"))  # a row per leaf
        blocks = self.blocks(anchors).join(leaves, "leaf")
        blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        dealt = tiles.select("leaf", "tile", "rows", "ids", "labels", "vectors", "width").join(leaves, "leaf")
        dealt = dealt.withColumn("part", F.pmod(F.xxhash64("tile"), F.col("parts")).cast("int"))
        pairs = dealt.drop("parts", "tile").join(blocks, ["leaf", "part"]).drop("leaf", "part")
        found = pairs.mapInArrow(scored, FOUND_SCHEMA)
        order = Window.partitionBy("number", "window").orderBy(F.desc("score"), "id", "label", "tie")
        ranked = found.withColumn("rank", F.row_number().over(order))
        return ranked.filter(F.col("rank") <= self.count).drop("tie")

    def _scored(self, row: dict) -> pa.RecordBatch:
        ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        rows = _unpacked(row["vectors"], row["width"], row["rows"])
        anchor_ids, anchor_labels, numbers, of, window, low, high = (
            np.frombuffer(row[c], "<i8")
            for c in ("anchor_ids", "anchor_labels", "numbers", "of", "window", "low", "high")
        )
        anchors = _unpacked(row["anchor_vectors"], row["anchor_width"], row["anchors"])
        scores = products(anchors, rows)
        usable = (anchor_labels[:, None] == labels[None, :]) == self.same_label
        if self.same_label:
            usable &= ~_same_rows(anchor_ids, anchor_labels, anchors, ids, labels, rows)
        seen = scores[of]
        wanted, place = np.nonzero(usable[of] & (seen >= low[:, None]) & (seen <= high[:, None]))
        score = seen[wanted, place]
        if len(wanted):
            kinds, which = np.unique(place, return_inverse=True)
            tie = _hashes(rows[kinds])[which]
            best = first_of(wanted, score, ids[place], labels[place], tie, count=self.count)
            wanted, place, score, tie = wanted[best], place[best], score[best], tie[best]
        else:
            tie = np.zeros(0, np.int64)
        columns = [
            numbers[of[wanted]], window[wanted].astype(np.int32), ids[place], labels[place], tie, score,
        ]
        names = [c.split()[0] for c in FOUND_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _share(tenths: int, up: bool) -> Column:
    """``tenths`` tenths of ``score`` as a whole number, rounded up or down, without overflow."""
    left = "pmod(score, 10)"
    return F.expr(f"(score - {left}) div 10 * {tenths} + ({left} * {tenths} + {9 * up}) div 10")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low_tenths: int = 3,
    high_tenths: int = 9,
    sample: int = SAMPLE,
    fan: int = FAN,
    leaf: int = LEAF,
    tile: int = TILE,
) -> DataFrame:
    """Hard negatives of each anchor and positive, ranked by score.

    ``vectors`` are rows as ``whole_vectors`` gives them; ``is_anchor`` is a condition on them. For each
    anchor and each of its first ``positives`` rows of the same label: the first ``negatives`` rows of
    other labels with a score from ``low_tenths`` to ``high_tenths`` tenths of the positive's. Columns:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    rows = write_once(vectors)
    tree = sampled_tree(rows, sample, fan, leaf)
    tiles = write_once(tiled(rows, tree, tile))
    ranges = Ranges(tree, tiles)
    anchors = rows.filter(is_anchor & (F.col("id") != NO_ID)).dropDuplicates()
    anchors = write_once(anchors.withColumn("number", F.monotonically_increasing_id()))
    least, most = (F.lit(x).cast("long") for x in (-(2**62), 2**62))
    open_ = anchors.withColumns({"low": F.array(least), "high": F.array(most)})
    near = Search(tree, ranges, True, positives).found(open_, tiles)
    near = write_once(near.select("number", "id", "score", "rank"))
    windows = near.groupBy("number").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "rank",
                    _share(low_tenths, True).alias("low"),
                    _share(high_tenths, False).alias("high"),
                )
            )
        ).alias("windows")
    )
    asked = anchors.join(windows, "number").withColumns({"low": F.col("windows.low"), "high": F.col("windows.high")})
    found = Search(tree, ranges, False, negatives).found(asked, tiles)
    known = near.select(
        "number", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    names = anchors.select("number", F.col("id").alias("anchor_id"))

    def given(id: str) -> Column:
        return F.nullif(F.col(id), F.lit(NO_ID)).alias(id)

    found = found.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score")
    return found.join(known, ["number", "window"]).join(names, "number").select(
        "anchor_id", given("positive_id"), F.col("rank").cast("int").alias("rank"), given("negative_id"),
        "positive_score", "negative_score",
    )
