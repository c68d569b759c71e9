"""Substring dedup: windows of words that another document has too, by level-wise doubling.

Words are runs without white space, unchanged. A window that repeats can only hold shorter windows
that repeat, so the short level comes first: of the 7-word windows inside each 13-word window the
one with the least hash is counted over all documents, and only 13-word windows whose short window
is seen in two documents go on. The next level, two short windows that share a word, is decided
exactly. ``length`` sets the last level; levels double from half of it.

A word is removed if a window over it also starts in a document with a smaller id; windows are judged
on the input. Texts of equal words are settled as a whole: all but the one with the smallest id lose all
words if they hold one window at all. A null text has no words; a null id counts as greater than
all others; rows with equal ids do not remove each other's words; rows equal in id and text get the
same result. An empty table gives an empty result. Windows are compared by 64-bit hashes.

Nothing grows with the number of copies of a window: windows are counted by an aggregate that
combines before its shuffle, and hot windows are looked up by broadcast. Texts are shuffled only
if words go from them. The filter of short windows has 16 bits for each repeated one and
``max_bits`` in all; beyond that more windows reach the next level, with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bloom import MAX_BITS, as_bytes, filter_bits, member_filter, passes
from tidewatch.llm.grams import gram_hashes, in_filter, least_per_window, word_hashes
from tidewatch.llm.rows import excluding, row_key
from tidewatch.llm.shared import attach, write_once

LENGTH = 13
NOTHING = hashlib.sha256(b"").hexdigest()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes split at ASCII white space only


class Levels:
    """Windows of a text at the short and the full level."""

    def __init__(self, length: int):
        self.length = length
        self.short = (length + 1) // 2

    def least(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of short windows, and for each full window the place of its least one."""
        grams = gram_hashes(hashes, self.short)
        return grams, least_per_window(grams, self.length - self.short + 1)


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(key, id, text) with null ids as the greatest."""
    last = F.lit(2**63 - 1)
    return docs.select(
        row_key(id, text).alias("key"),
        F.coalesce(F.col(id).cast("long"), last).alias("id"),
        F.col(text).alias("text"),
    )


def summaries(rows: DataFrame, length: int) -> DataFrame:
    """(key, id, n_words, words_sha, whole, shorts): a text's words as a whole, its short windows."""

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(length)
        for batch in batches:
            counts, shas, wholes, shorts = [], [], [], []
            for value in batch["text"]:
                words = words_of(value.as_py())
                joined = b" ".join(words)
                grams, places = levels.least(word_hashes(words))
                counts.append(len(words))
                shas.append(hashlib.sha256(joined).digest())
                wholes.append(xxhash.xxh3_128_digest(joined))
                shorts.append(np.unique(grams[np.unique(places)]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    batch["id"],
                    pa.array(counts, pa.int64()),
                    pa.array(shas, pa.binary()),
                    pa.array(wholes, pa.binary()),
                    pa.array(shorts, pa.list_(pa.int64())),
                ],
                names=["key", "id", "n_words", "words_sha", "whole", "shorts"],
            )

    schema = "key long, id long, n_words long, words_sha binary, whole binary, shorts array<long>"
    return rows.mapInArrow(summarised, schema)


def candidates(rows: DataFrame, length: int, bitmap: bytes, bits: int) -> DataFrame:
    """(key, id, places, windows): full windows whose least short window passes the filter."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, filter_ = Levels(length), np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            places, windows = [], []
            for value in batch["text"]:
                hashes = word_hashes(words_of(value.as_py()))
                grams, least = levels.least(hashes)
                at = np.flatnonzero(in_filter(grams, filter_, bits)[least])
                places.append(at.astype(np.int32))
                windows.append(gram_hashes(hashes, length)[at].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    batch["id"],
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array(windows, pa.list_(pa.int64())),
                ],
                names=["key", "id", "places", "windows"],
            )

    return rows.mapInArrow(chosen, "key long, id long, places array<int>, windows array<long>")


def kept_words(text: str | None, starts: list[int], length: int) -> list[bytes]:
    """The words of a text that no window from ``starts`` covers."""
    words = words_of(text)
    steps = np.zeros(len(words) + 1, np.int64)
    at = np.asarray(starts, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + length, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(steps)[:-1] == 0)]


def cut(rows: DataFrame, length: int) -> DataFrame:
    """(key, n_kept, kept_sha) of rows (key, text, starts)."""

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, shas = [], []
            for value, at in zip(batch["text"], batch["starts"], strict=True):
                kept = kept_words(value.as_py(), at.as_py(), length)
                counts.append(len(kept))
                shas.append(hashlib.sha256(b" ".join(kept)).digest())
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array(counts, pa.int64()), pa.array(shas, pa.binary())],
                names=["key", "n_kept", "kept_sha"],
            )

    return rows.mapInArrow(without, "key long, n_kept long, kept_sha binary")


def repeated_starts(
    rows: DataFrame, seen: DataFrame, copies: DataFrame, length: int, max_bits: int = MAX_BITS
) -> DataFrame:
    """(key, starts): where windows start that also start in a row with a smaller id.

    ``seen`` has the short windows of the rows, ``copies`` the keys of those settled as a whole.
    """
    counted = excluding(seen.select("key", "shorts"), copies).select(F.explode("shorts").alias("window")).groupBy("window").count()
    repeated = write_once(counted.filter("count > 1").select("window"))
    bits = filter_bits(repeated.count(), max_bits)
    bitmap = as_bytes(member_filter(repeated, "window", bits), bits)

    found = write_once(candidates(rows, length, bitmap, bits).filter("size(places) > 0"))
    found = excluding(found, copies)
    windows = found.select("key", "id", F.explode(F.arrays_zip("places", "windows")).alias("w"))
    windows = windows.select("key", "id", "w.places", F.col("w.windows").alias("window"))
    smallest = windows.groupBy("window").agg(F.min("id").alias("first"), F.count("*").alias("size"))
    smallest = write_once(smallest.filter("size > 1"))
    total = smallest.agg(F.sum("size")).first()[0] or 0
    later = attach(windows, smallest, "window", "size", total).filter("first < id")
    # the windows of one document, never more than it has words
    return later.groupBy("key").agg(F.sort_array(F.collect_set("places")).alias("starts"))


def deduplicated(
    docs: DataFrame,
    length: int = LENGTH,
    id: str = "doc_id",
    text: str = "text",
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Per document: id, n_words, n_removed, kept_sha256 of its kept words joined by spaces."""
    rows = _rows(docs, id, text)
    seen = write_once(summaries(rows, length))
    wholes = write_once(
        seen.groupBy("whole").agg(F.min("id").alias("first"), F.count("*").alias("size"))
    )
    settled = attach(seen.drop("shorts"), wholes, "whole", "size", seen.count())
    is_copy = (F.col("id") > F.col("first")) & (F.col("n_words") >= length)
    settled = write_once(settled.select("key", "id", "n_words", "words_sha", is_copy.alias("copy")))
    copies = settled.filter("copy").select("key")

    starts = write_once(repeated_starts(rows, seen, copies, length, max_bits))
    bits = filter_bits(starts.count(), max_bits)
    touched = passes(rows, "key", member_filter(starts, "key", bits), bits, "touched")
    touched = touched.filter("touched").select("key", "text").join(starts, "key")
    changed = cut(touched, length).dropDuplicates(["key"])

    def of(column: str, unchanged: Column, nothing: Column) -> Column:
        return F.when(F.col("copy"), nothing).otherwise(F.coalesce(F.col(column), unchanged))

    empty = F.unhex(F.lit(NOTHING))
    return settled.join(changed, "key", "left").select(
        F.expr(f"nullif(id, {2**63 - 1})").alias(id),
        "n_words",
        (F.col("n_words") - of("n_kept", F.col("n_words"), F.lit(0))).alias("n_removed"),
        F.lower(F.hex(of("kept_sha", F.col("words_sha"), empty))).alias("kept_sha256"),
    )
