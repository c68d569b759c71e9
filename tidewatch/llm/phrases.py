"""Phrase collocations from count streams in prefix and suffix order.

Words are runs without space and tab, A-Z in lower case, within pieces that end at ``. , ; : ! ?`` and
at line ends; phrases are runs of words within a piece, and everything is counted per language. The
layout is that of external stream estimation: for each length there is one stream of phrases and their
counts, which is put in two orders. By all words but the last (prefix order) it runs in step with the
stream of phrases one word shorter and takes over the counts of its left parts; by all words but the
first (suffix order) it takes over those of its right parts. Run the other way, the same steps give
each phrase the count of its most frequent extension by a word on the right and on the left. All of
these are sort-merge joins: both sides come sorted by the key, and no table of counts is held.

A phrase of n words occurs ``least`` times only if both phrases of n - 1 words in it do. So lengths are
counted one after the other, and phrases with a rarer part are left out: tasks test the parts against a
Bloom filter of the stream before (16 bits for each, ``MAX_BITS`` in all, which is what a task gets).
The filter decides nothing: what passes by chance is too rare to be a candidate, and once the filter is
full more phrases are counted with the same result. Tasks combine equal phrases by sorting them,
``HELD`` at a time, so memory is bounded and a phrase that holds a third of all rows reaches the shuffle
once per run. In a join, phrases that share a very frequent part are dealt to several tasks, and
the one row they need goes to each of these.

Scores are exact: products are decimals of 38 digits, which hold 1,000,000 * a * a for counts up to
10 ** 16, and are divided as integers.

A null text counts as empty, a null language as ``und``; ids are not read, repeated rows count as often
as they occur, further columns are not read. Equal scores and counts are ordered by phrase in UTF-8 byte
order. A text may be of any length, its words are numbered slice by slice. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.bloom import MAX_BITS, as_bytes, filter_bits, member_filter
from tidewatch.llm.grams import in_filter
from tidewatch.llm.shared import shuffle_tasks, text_of, write_once
from tidewatch.llm.words import numbered, numbering
from tidewatch.operators.lookup import hot_keys

LEAST = 10
MAX_WORDS = 3
TOP = 2000
COVERED = 50  # per cent
#: phrases that a task holds before it hands their counts on, words it numbers, bytes it splits at once
HELD = 1 << 22
NUMBERED = 1 << 20
BLOCK = 1 << 22
#: rows of one Arrow batch that a task returns
ROWS = 1 << 16
WORD_BITS = 21  # three words in an integer; a block has fewer new words than fill up NUMBERED to that
END = b"\xff"  # the end of a piece; no byte of UTF-8
_SEED = 42
_P1, _P2, _P3 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_P4, _P5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)


def _table() -> bytes:
    """Byte to byte: A-Z in lower case, ends of pieces as line feeds, tabs as spaces."""
    table = bytearray(range(256))
    for upper in range(ord("A"), ord("Z") + 1):
        table[upper] += 32
    for end in b".,;:!?\n\x0b\x0c\r":
        table[end] = ord("\n")
    table[ord("\t")] = ord(" ")
    return bytes(table)


TABLE = _table()


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def hash_next(numbers: np.ndarray, seeds: np.ndarray | int) -> np.ndarray:
    """XXH64 of 64-bit integers under seeds: what ``xxhash64`` of Spark does for each further column."""
    x = np.asarray(seeds, np.uint64) + _P5 + np.uint64(8)
    x = x ^ (_turned(numbers * _P2, 31) * _P1)
    x = _turned(x, 27) * _P1 + _P4
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def phrase_key(length: int) -> Column:
    """The hash by which tasks look for a phrase of a language in a filter."""
    words = F.split("phrase", " ")
    return F.xxhash64(F.xxhash64("lang"), *(F.xxhash64(F.get(words, n)) for n in range(length)))


class Filter:
    """Whether phrases of ``length`` words may be in a stream, by its Bloom filter."""

    def __init__(self, stream: DataFrame, length: int, max_bits: int = MAX_BITS):
        keys = stream.select(phrase_key(length).alias("key"))
        self.length, self.bits = length, filter_bits(stream.count(), max_bits)
        self.bitmap = as_bytes(member_filter(keys, "key", self.bits), self.bits)

    def holds(self, lang: str, hashes: np.ndarray) -> np.ndarray:
        """By the place of their first word, for the hashes of words in order."""
        places = max(0, len(hashes) - self.length + 1)
        start = np.array([xxhash.xxh64_intdigest(lang.encode(), _SEED)], np.uint64)
        found = np.broadcast_to(hash_next(start, _SEED), (places,))
        for at in range(self.length):
            found = hash_next(hashes[at : at + places], found)
        return in_filter(found, np.frombuffer(self.bitmap, np.uint8), self.bits)


class Runs:
    """The phrases of ``length`` words that a task holds, by language."""

    def __init__(self, length: int, parts: Filter | None):
        self.length, self.parts = length, parts
        self.forget()

    def forget(self) -> None:
        self.numbers = numbering()
        self.numbers[END]  # has number 0
        self.hashes = np.zeros(1, np.uint64)
        self.waiting: dict[str, list[np.ndarray]] = {}
        self.held = 0

    def full(self) -> bool:
        return self.held >= HELD or len(self.numbers) >= NUMBERED

    def add(self, lang: str, texts: list[bytes]) -> None:
        marked = b"\n".join(texts).translate(TABLE).replace(b"\n", b" " + END + b" ")
        words = numbered(marked, self.numbers)
        whole, size = words > 0, 1
        if self.parts is not None:
            size = self.parts.length
            new = list(self.numbers)[len(self.hashes) :]
            more = np.fromiter((xxhash.xxh64_intdigest(w, _SEED) for w in new), np.uint64, len(new))
            self.hashes = np.concatenate([self.hashes, more])
            known = self.parts.holds(lang, self.hashes[words])
            for at in range(size):
                known &= whole[at : at + len(known)]
            whole = known
        for _ in range(self.length - size):
            whole = whole[:-1] & whole[1:]
        places = np.flatnonzero(whole)
        columns = []
        for at in range(self.length):
            if at % 3 == 0:
                columns.append(words[places + at])
            else:
                columns[-1] = columns[-1] << WORD_BITS | words[places + at]
        self.waiting.setdefault(lang, []).append(np.stack(columns))
        self.held += len(places)

    def counted(self) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, f): equal phrases combined by sorting; nothing is held afterwards."""
        vocabulary = pa.array([b"", *list(self.numbers)[1:]], pa.binary()).cast(pa.string())
        for lang, parts in self.waiting.items():
            runs = np.concatenate(parts, axis=1)
            parts.clear()
            if len(runs) == 1:
                kinds, counts = np.unique(runs[0], return_counts=True)
                kinds = kinds[None, :]
            else:
                kinds, counts = np.unique(runs, axis=1, return_counts=True)
            for start in range(0, len(counts), ROWS):
                some = kinds[:, start : start + ROWS]
                words = [self._word(some, n) for n in range(self.length)]
                phrases = pc.binary_join_element_wise(*(vocabulary.take(w) for w in words), " ")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * some.shape[1]), phrases, pa.array(counts[start : start + ROWS])],
                    names=["lang", "phrase", "f"],
                )
        self.forget()

    def _word(self, kinds: np.ndarray, n: int) -> pa.Array:
        column = kinds[n // 3]
        inside = min(3, self.length - n // 3 * 3)
        shift = WORD_BITS * (inside - 1 - n % 3)
        return pa.array(column >> shift & ((1 << WORD_BITS) - 1))


def count_stream(
    docs: DataFrame, length: int, parts: Filter | None, lang: str, text: str
) -> DataFrame:
    """(lang, phrase, f): how often each phrase occurs; without those that ``parts`` rules out."""

    def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(length, parts)
        for batch in batches:
            texts: dict[str, list[bytes]] = {}
            sizes: dict[str, int] = {}
            for code, value in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                texts.setdefault(code, []).append(value.as_buffer().to_pybytes())
                sizes[code] = sizes.get(code, 0) + len(texts[code][-1])
                if sizes[code] >= BLOCK:
                    runs.add(code, texts.pop(code))
                    sizes.pop(code)
                    if runs.full():
                        yield from runs.counted()
            for code, some in texts.items():
                runs.add(code, some)
                if runs.full():
                    yield from runs.counted()
        yield from runs.counted()

    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    found = rows.mapInArrow(runs_of, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def in_step(stream: DataFrame, parts: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Sort-merge join of a stream to the one row per key of ``parts``.

    Phrases of a key that has more of them than a task's fair share are dealt to several tasks by a
    hash of the phrase; fewer keys than shuffle tasks are so frequent.
    """
    on = list(on)
    key = F.xxhash64(F.lit("part"), *(F.col(c) for c in on))
    hot = hot_keys(stream, part=[F.col(c) for c in on]).selectExpr("hash as _hash", "salts as _salts")
    hot = F.broadcast(hot)
    dealt = F.coalesce(F.pmod(F.xxhash64("phrase"), F.col("_salts")), F.lit(0)).cast("long")
    every = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1)
    left = stream.withColumn("_key", key).join(hot, F.col("_key") == F.col("_hash"), "left")
    right = parts.withColumn("_key", key).join(hot, F.col("_key") == F.col("_hash"), "left")
    helpers = ("_key", "_hash", "_salts")
    left = left.withColumn("_salt", dealt).drop(*helpers)
    right = right.withColumn("_salt", F.explode(every)).drop(*helpers)
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def _ends(stream: DataFrame, length: int) -> DataFrame:
    """Adds ``head`` and ``tail``: the phrase without its last and without its first word."""
    head = F.substring_index("phrase", " ", length - 1)
    tail = F.substring_index("phrase", " ", 1 - length)
    return stream.withColumns({"head": head, "tail": tail})


def with_parts(stream: DataFrame, shorter: DataFrame, length: int) -> DataFrame:
    """Adds ``lefts`` and ``rights``: the counts of the first and the last 1, 2, ... words."""

    def side(end: str, of: str) -> DataFrame:
        return shorter.select("lang", F.col("phrase").alias(end), F.array_append(of, F.col("f")).alias(of))

    both = in_step(_ends(stream, length), side("head", "lefts"), ["lang", "head"])  # prefix order
    both = in_step(both, side("tail", "rights"), ["lang", "tail"])  # suffix order
    return both.select("lang", "phrase", "f", "lefts", "rights")


def with_extension(stream: DataFrame, longer: DataFrame, length: int) -> DataFrame:
    """Adds ``longer_f``: the count of the most frequent phrase that is a word longer, 0 without one."""
    ends = _ends(longer, length + 1)
    for end, name in (("head", "_after"), ("tail", "_before")):
        most = ends.groupBy("lang", F.col(end).alias("phrase")).agg(F.max("f").alias(name))
        stream = stream.join(most.hint("merge"), ["lang", "phrase"], "left")
    return stream.withColumn(
        "longer_f", F.coalesce(F.greatest("_after", "_before"), F.lit(0))
    ).drop("_after", "_before")


def with_score(stream: DataFrame, length: int) -> DataFrame:
    """Adds ``cut`` (score, k, l, r) of the lowest-scoring cut, the first of equal ones."""

    def exact(column: Column) -> Column:
        return column.cast("decimal(38,0)")

    cuts = [
        f"named_struct('score', (_aa div (_l{k} * _r{k})), 'k', {k}, 'l', bigint(_l{k}), 'r', bigint(_r{k}))"
        for k in range(1, length)
    ]
    sides = {f"_l{k}": exact(F.get("lefts", k - 1)) for k in range(1, length)}
    sides |= {f"_r{k}": exact(F.get("rights", length - k - 1)) for k in range(1, length)}
    whole = exact(exact(F.col("f")) * exact(F.col("f"))) * exact(F.lit(1_000_000))
    scored = stream.withColumns({**sides, "_aa": whole})
    return scored.withColumn("cut", F.expr(f"array_min(array({', '.join(cuts)}))")).drop(*sides, "_aa")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    max_words: int = MAX_WORDS,
    covered: int = COVERED,
    max_bits: int = MAX_BITS,
) -> tuple[DataFrame, DataFrame]:
    """All candidates (lang, phrase, a, l, r, score) that no longer one covers, and (lang, n).

    A phrase is covered if one that holds it has at least ``covered`` per cent of its count. The count
    of a phrase is at least that of any longer one, so the longer by one word decide.
    """
    words = write_once(count_stream(docs, 1, None, lang, text))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    nothing = F.array().cast("array<bigint>")
    streams = [words.filter(F.col("f") >= least).withColumns({"lefts": nothing, "rights": nothing})]
    for length in range(2, max_words + 1):
        parts = Filter(streams[-1], length - 1, max_bits)
        counted = write_once(count_stream(docs, length, parts, lang, text).filter(F.col("f") >= least))
        streams.append(write_once(with_parts(counted, streams[-1], length)))
    found = None
    for length in range(max_words, 1, -1):
        stream = streams[length - 1]
        if length < max_words:
            longer = streams[length].select("lang", "phrase", "f")
            stream = with_extension(stream, longer, length).filter(
                F.lit(100) * F.col("longer_f") < F.lit(covered) * F.col("f")
            )
        scored = with_score(stream, length).selectExpr(
            "lang", "phrase", "f as a", "cut.l as l", "cut.r as r", "bigint(cut.score) as score"
        )
        found = scored if found is None else found.unionByName(scored)
    return found, totals


def top_per_group(rows: DataFrame, group: str, order: Sequence[Column], count: int) -> DataFrame:
    """The first rows of each group with their ``rank``, without a task that sorts a whole group.

    Each task first finds the first rows of its share of a group; only those meet.
    """
    share = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_tasks(rows.sparkSession)))
    rows = rows.withColumn("_share", share)
    in_share = F.row_number().over(Window.partitionBy(group, "_share").orderBy(*order))
    few = rows.withColumn("_in_share", in_share).filter(F.col("_in_share") <= count)
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return few.drop("_share", "_in_share").withColumn("rank", rank).filter(F.col("rank") <= count)


def phrase_report(
    docs: DataFrame, top: int = TOP, lang: str = "lang", text: str = "text", **options
) -> DataFrame:
    """Per language the first phrases: lang, rank, phrase, a, l, r, n, score."""
    found, totals = collocations(docs, lang, text, **options)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    first = top_per_group(found, "lang", order, top)
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
