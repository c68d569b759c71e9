"""Benchmark decontamination by winnowing.

Words are runs of a-z (A-Z in lower case), digits and characters beyond ASCII. A window is ``window``
consecutive words of a benchmark item; an item with fewer words, but at least one, is one window
itself. Of the ``gram``-word grams in every window the one with the least hash is its fingerprint,
in items and documents alike, so whatever window they share has the same fingerprint at the same
place. Fingerprints are joined, and every hit is extended to both sides as far as the words agree: it
counts if that reaches the length of a window. So every shared window is found, and nothing else
(words are compared by 64-bit hashes). Items shorter than a window are fingerprints as a whole,
looked for at every position.

Documents are read once. Their tasks drop fingerprints that the benchmark does not have by a Bloom
filter of 1 MB, whatever the benchmark's size; what passes is joined for certain. Benchmark
fingerprints are broadcast up to ``BROADCAST_ROWS``, beyond that the join shuffles.

A null text has no words; long texts are read whole. Null ids stay null in the result; an item without an id marks words but is
not listed; rows may repeat. Empty tables give empty results, or documents without hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bloom import as_bytes, member_filter
from tidewatch.llm.grams import gram_hashes, in_filter, least_per_window, word_hashes
from tidewatch.llm.rows import row_key, without
from tidewatch.llm.shared import write_once

WINDOW = 10
GRAM = 5
FILTER_BITS = 1 << 23
BROADCAST_ROWS = 200_000

#: bytes that are part of a word, in lower case; all others separate words
_LOWER = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32
    for c in range(256)
)

MARK = "array<struct<need:int,print:long,at:int,before:array<long>,after:array<long>>>"
_MARK = pa.list_(
    pa.struct(
        [
            ("need", pa.int32()),
            ("print", pa.int64()),
            ("at", pa.int32()),
            ("before", pa.list_(pa.int64())),
            ("after", pa.list_(pa.int64())),
        ]
    )
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()


class Winnow:
    """Fingerprints of texts: of their windows, and of given shorter lengths at every position."""

    def __init__(self, window: int, gram: int, short: list[int]):
        self.window, self.gram, self.short = window, gram, short

    def prints(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(needed run of words, fingerprints, their positions) of one text's word hashes."""
        grams = gram_hashes(hashes, self.gram)
        places = np.unique(least_per_window(grams, self.window - self.gram + 1))
        yield self.window, grams[places] ^ np.uint64(self.window), places
        for length in self.short:
            runs = gram_hashes(hashes, length)
            yield length, runs ^ np.uint64(length), np.arange(len(runs))

    def marks(self, hashes: np.ndarray, bitmap: np.ndarray | None, bits: int) -> list[dict]:
        """Fingerprints, those in the filter if there is one, with the words around them.

        ``before`` runs backwards. Both sides reach as far as a window with the fingerprint can.
        """
        signed, found = hashes.view(np.int64), []
        for need, prints, places in self.prints(hashes):
            if bitmap is not None:
                passed = in_filter(prints, bitmap, bits)
                prints, places = prints[passed], places[passed]
            back = self.window - self.gram if need == self.window else 0
            for value, at in zip(prints.view(np.int64).tolist(), places.tolist(), strict=True):
                found.append(
                    {
                        "need": need,
                        "print": value,
                        "at": at,
                        "before": signed[max(0, at - back) : at][::-1].tolist(),
                        "after": signed[at : at + need].tolist(),
                    }
                )
        return found


def marked(
    rows: DataFrame, keep: list[str], winnow: Winnow, bitmap: bytes | None, whole_if_short: bool
) -> DataFrame:
    """``keep``, n_words and marks of ``rows`` (with a text).

    ``whole_if_short`` is for items: a text shorter than a window is one mark, whatever lengths
    are asked for.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = None if bitmap is None else np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            counts, marks = [], []
            for text in batch["text"].to_pylist():
                hashes = word_hashes(words_of(text))
                counts.append(len(hashes))
                chosen = winnow
                if whole_if_short and 0 < len(hashes) < winnow.window:
                    chosen = Winnow(winnow.window, winnow.gram, [len(hashes)])
                marks.append(chosen.marks(hashes, filter_, FILTER_BITS))
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array(counts, pa.int64()), pa.array(marks, _MARK)],
                names=[*keep, "n_words", "marks"],
            )

    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(found, f"{kept}, n_words long, marks {MARK}")


def agreeing(a: str, b: str) -> str:
    """SQL: how many leading elements of two arrays are equal."""
    equal = f"zip_with({a}, {b}, (x, y) -> coalesce(x = y, false))"
    return f"cast(array_position(array_append({equal}, false), false) - 1 as int)"


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """All documents (row_no, key, id, n_words), and hits (row_no, start, end, item).

    A hit is a stretch of words that a document shares with an item, end exclusive.
    """
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text"))
    told = marked(items, ["item"], Winnow(window, gram, []), None, True)
    theirs = write_once(told.select("item", F.inline("marks")).drop("at").distinct())
    short = [r[0] for r in theirs.filter(F.col("need") < window).select("need").distinct().collect()]
    bitmap = as_bytes(member_filter(theirs, "print", FILTER_BITS), FILTER_BITS)

    rows = docs.select(
        F.col(id).alias("id"),
        row_key(id, text).alias("key"),
        F.monotonically_increasing_id().alias("row_no"),
        F.col(text).alias("text"),
    )
    told = marked(rows, ["id", "key", "row_no"], Winnow(window, gram, sorted(short)), bitmap, False)
    told = write_once(told)

    if theirs.count() <= BROADCAST_ROWS:
        theirs = F.broadcast(theirs)
    ours = told.select("row_no", F.inline("marks")).alias("d")
    joined = ours.join(theirs.alias("b"), ["need", "print"]).select(
        "row_no",
        "item",
        "need",
        "at",
        F.expr(agreeing("d.before", "b.before")).alias("back"),
        F.expr(agreeing("d.after", "b.after")).alias("ahead"),
    )
    found = joined.filter("back + ahead >= need").select(
        "row_no", F.expr("at - back").alias("start"), F.expr("at + ahead").alias("end"), "item"
    )
    return told.select("row_no", "key", "id", "n_words"), found


def contamination(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, found = hits(docs, benchmark, id=id, text=text, **options)
    found = write_once(found.distinct())
    words = found.select("row_no", "start", "end").distinct()
    words = words.select("row_no", F.explode(F.expr("sequence(start, end - 1)")).alias("at"))
    hit = words.distinct().groupBy("row_no").agg(F.count("*").alias("n_hit"))
    # a document's list holds each item of the benchmark once at most
    listed = found.groupBy("row_no").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return (
        rows.join(hit, "row_no", "left")
        .join(listed, "row_no", "left")
        .select(
            F.col("id").alias(id),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(none).cast("long").alias("n_items"),
            F.sha2(F.array_join(none, ","), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The documents that share no window with the benchmark, in the columns of ``docs``."""
    rows, found = hits(docs, benchmark, id=id, text=text, **options)
    bad = rows.select("row_no", "key").join(found.select("row_no").distinct(), "row_no", "left_semi")
    removed = write_once(bad.select("key").distinct())
    return without(docs, removed, id=id, text=text)
