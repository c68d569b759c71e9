"""SimHash near-dedup: fingerprints of word shingles, compared exactly in tiles.

Words are runs without white space, A-Z in lower case; a shingle is some consecutive words joined by
single spaces (all words, if there are fewer). A fingerprint bit is 1 if it is set in more than half
of the shingles' XXH64. Texts without words, null ones too, have fingerprint zero, which links
like any other. Fingerprints that differ in no more than ``radius`` bits are linked; documents that
are linked, directly or through others, form a group.

The comparison is exact. Two fingerprints within the radius agree in all but ``radius`` of the bands
the 64 bits are cut into, so each pair meets in a block: distinct fingerprints that share some
choice of the other bands. A block of more than one tile is laid out by population count; tiles
are compared by exclusive-or and bit counts, tile pairs whose population counts differ by more than the
radius are skipped. Of what it finds a task passes on a spanning forest, never all pairs.

Texts are read whole, however long. Ids may repeat or be null (a null id is nobody's smallest); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.components import components
from tidewatch.llm.rows import row_key, without
from tidewatch.llm.shared import attach, shuffle_tasks, write_once

SHINGLE = 3
RADIUS = 2
SEED = 42
BANDS = 4
TILE = 2048
#: shingles hashed at a time
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text, unsigned."""
    words = (text or "").encode().lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    width = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))
    joined = b" ".join(words)
    total = len(words) - width + 1
    first, last = starts[:total], starts[width:] - 1
    counts = np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        spans = zip(first[at : at + CHUNK].tolist(), last[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array(
            [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype="<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(counts * 2 > total, bitorder="little")
    return int(packed.view("<u8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, key, fp): each document with its row key and its fingerprint as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle) for t in batch["text"].to_pylist()]
            signed = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["key"], pa.array(signed)], names=["id", "key", "fp"]
            )

    rows = docs.select(
        F.col(id).cast("long").alias("id"), row_key(id, text).alias("key"), F.col(text).alias("text")
    )
    return rows.mapInArrow(hashed, "id long, key long, fp long")


def band_masks(radius: int = RADIUS, bands: int = BANDS) -> list[int]:
    """Signed bit masks of every choice of bands that two fingerprints within the radius share."""
    edges = [64 * b // bands for b in range(bands + 1)]
    parts = [((1 << (high - low)) - 1) << low for low, high in zip(edges, edges[1:], strict=False)]
    chosen = [sum(c) for c in combinations(parts, bands - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def link_pairs(blocks: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of the same block within the radius; rows are sorted by block."""
    left, right = [], []
    at, step = np.arange(len(prints)), 1
    while len(at):
        at = at[at + step < len(prints)]
        at = at[blocks[at] == blocks[at + step]]
        near = np.bitwise_count(prints[at] ^ prints[at + step]) <= radius
        left.append(at[near])
        right.append(at[near] + step)
        step += 1
    none = np.empty(0, np.int64)
    return np.concatenate([*left, none]), np.concatenate([*right, none])


def forest(prints: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For linked rows, the fingerprint and the smallest row's fingerprint of its component."""
    label = np.arange(len(prints))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(prints)))
    return prints[moved], prints[label[moved]]


def tiled(prints: DataFrame, radius: int = RADIUS, bands: int = BANDS, tile: int = TILE) -> DataFrame:
    """(tile_pair, fp): the fingerprints that are to be compared with each other.

    ``prints`` has the distinct fingerprints. A block within one tile is one set; of a larger one
    every pair of tiles whose population counts may be within the radius is a set.
    """
    masks = [
        F.struct(F.lit(n).alias("n"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
        for n, m in enumerate(band_masks(radius, bands))
    ]
    keyed = write_once(
        prints.select("fp", F.explode(F.array(*masks)).alias("band")).select(
            "fp", F.xxhash64("band.n", "band.bits").alias("block")
        )
    )
    sizes = write_once(keyed.groupBy("block").agg(F.count("*").alias("size")).filter("size > 1"))
    total = keyed.count()
    rows = attach(keyed, sizes, "block", "size", total)
    small = rows.filter(F.col("size") <= tile).select(F.col("block").alias("tile_pair"), "fp")

    large = rows.filter(F.col("size") > tile).withColumn("weight", F.bit_count("fp").cast("int"))
    counts = large.groupBy("block", "weight").agg(F.count("*").alias("rows"))
    tiles = counts.select("block", "weight", F.expr(f"cast(ceil(rows / {tile}) as int)").alias("tiles"))
    # 65 population counts at most: one small row per block lists its tiles
    layout = tiles.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("weight", "tiles"))).alias("tiles"),
        F.lit(0).alias("size"),
    )
    placed = large.drop("size").join(layout, "block").withColumn(
        "own", F.expr("named_struct('weight', weight, 'part', pmod(xxhash64(fp), tiles[weight]))")
    )
    partners = F.expr(
        f"flatten(transform(filter(sequence(weight - {radius}, weight + {radius}), "
        "w -> map_contains_key(tiles, w)), "
        "w -> transform(sequence(0, tiles[w] - 1), "
        "p -> named_struct('weight', w, 'part', cast(p as bigint)))))"
    )
    wide = placed.select("block", "own", "fp", F.explode(partners).alias("other")).select(
        F.xxhash64("block", F.least("own", "other"), F.greatest("own", "other")).alias("tile_pair"),
        "fp",
    )
    return small.unionByName(wide)


def links(prints: DataFrame, radius: int = RADIUS, bands: int = BANDS, tile: int = TILE) -> DataFrame:
    """(node, other): a spanning forest of the links within every set of tiles."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, np.int64), np.empty(0, np.uint64)

        def found(blocks: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            node, other = forest(values, *link_pairs(blocks, values, radius))
            return pa.RecordBatch.from_arrays(
                [pa.array(node.view(np.int64)), pa.array(other.view(np.int64))], names=["node", "other"]
            )

        for batch in batches:
            blocks = np.concatenate([held[0], batch["tile_pair"].to_numpy()])
            values = np.concatenate([held[1], batch["fp"].to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(blocks, blocks[-1])) if len(blocks) else 0
            if whole:
                yield found(blocks[:whole], values[:whole])
            held = blocks[whole:], values[whole:]  # the last set may go on: two tiles at most
        if len(held[0]):
            yield found(*held)

    sets = tiled(prints, radius, bands, tile)
    return sets.repartition(shuffle_tasks(prints.sparkSession), "tile_pair").sortWithinPartitions(
        "tile_pair"
    ).mapInArrow(compared, "node long, other long")


def near_groups(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, key, fp, first): every document with the first row of its group, stored rows.

    ``first`` is a struct (last, id, key): the smallest id of the group and that row's key.
    """
    rows = write_once(fingerprints(docs, shingle, id, text))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key"))
    prints = write_once(rows.groupBy("fp").agg(first.alias("first"), F.count("*").alias("size")))
    roots = components(links(prints.select("fp"), radius))
    rooted = write_once(
        prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "size", "first", F.coalesce("root", "fp").alias("root")
        )
    )
    groups = rooted.groupBy("root").agg(F.min("first").alias("first"), F.count("*").alias("prints"))
    named = attach(rooted.select("fp", "size", "root"), groups, "root", "prints", rooted.count())
    return attach(rows, named.select("fp", "size", "first"), "fp", "size", rows.count())


def near_report(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: its id, its fingerprint as 16 hex digits, the smallest id of its group."""
    return near_groups(docs, shingle, radius, id, text).select(
        F.col("id").alias(id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
    )


def near_dedup(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that are the first of their group, in the columns of ``docs``.

    Rows equal in id and text are one document and stay once.
    """
    rows = write_once(near_groups(docs, shingle, radius, id, text).select("key", "first.key").toDF("key", "keep"))
    removed = rows.filter("key <> keep").select("key")
    repeated = rows.groupBy("key").count().filter("count > 1").select("key")
    return without(docs, removed, repeated, id=id, text=text)
