"""Byte-level BPE encoding and decoding.

A text is split by the tokenizer's pattern; within each match the neighbouring pair of lowest merge
rank, the leftmost of equal ones, is merged until no pair has a rank. The pairs wait in a rank queue:
buckets per rank hold positions in a linked list of symbols, a hierarchical bitmap of the ranks in
use gives the next rank by find-first-set on each level, and entries whose pair has changed
meanwhile are skipped when they come up. Each merge costs a constant number of steps, so a match
of very many bytes is no problem. The words that a slice of texts brings anew share one queue, so
that a step of the bitmap serves all pairs of one rank.

There are no special tokens: their strings are ordinary text. A null text counts as empty and has no
ids. Ids of documents may repeat or be null, every row gets its result; an empty table gives an
empty result. Decoding gives back the text's UTF-8 bytes exactly.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import accumulate
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.pieces import StretchEncoder, parts_of

FAN = 9  # a word of the bitmap has 2**FAN bits
_LOW = (1 << FAN) - 1
FEW = 256  # bytes below which the queue is filled without numpy


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


class Bpe:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        count = max(ranks.values()) + 1
        self.buckets: dict[int, list[int]] = {}
        self.words = [0] * ((count >> FAN) + 1)
        self.tokens = [b""] * count
        for token, rank in ranks.items():
            self.tokens[rank] = token
        single = (ranks.get(bytes([byte]), -1) for byte in range(256))
        self.byte_list = list(single)
        self.byte_ranks = np.array(self.byte_list, np.int64)
        double = (ranks.get(pair.to_bytes(2), -1) for pair in range(1 << 16))
        self.pair_ranks = np.fromiter(double, np.int64, 1 << 16)
        self.stretches = StretchEncoder(self._packed_match, self.split, self._packed_matches)

    def _packed_match(self, match: str) -> bytes:
        ids = self.merge(match.encode())
        return pack(f"<{len(ids)}I", *ids)

    def _packed_matches(self, matches: list[str]) -> list[bytes]:
        found, left, pieces = [b""] * len(matches), [], []
        for n, match in enumerate(matches):
            piece = match.encode()
            whole = self.ranks.get(piece)
            if whole is None:
                left.append(n)
                pieces.append(piece)
            else:
                found[n] = pack("<I", whole)
        for n, packed in zip(left, self._merged(pieces), strict=True):
            found[n] = packed
        return found

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return np.frombuffer(self._merged([piece])[0], "<u4").tolist() if piece else []

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each of these pieces, none empty, as little-endian unsigned 32-bit integers.

        All pieces share one queue: no pair goes over the edge of a piece, so what is merged in one
        does not matter to another, and a step of the queue serves all pairs of its rank. ``buckets`` holds
        heaps of positions by rank, a bit of ``words`` stands for each rank in use, a bit of ``top`` for each
        word in use. All of them are empty again at the end. The queue's steps are written out, as
        they are the inner loop.
        """
        if not pieces:
            return []
        text, rank_of = b"".join(pieces), self.ranks.get
        size, bounds = len(text), [0, *accumulate(map(len, pieces))]
        buckets, words, top = self.buckets, self.words, 0
        edge = bytearray(size + 1)  # 1 where a piece starts
        for at in bounds:
            edge[at] = 1
        end = list(range(1, size + 1))  # where the symbol that starts here ends
        before = list(range(-1, size - 1))  # where the symbol before it starts
        if size < FEW:
            queued: dict[int, list[int]] = {}
            token = list(map(self.byte_list.__getitem__, text))
            waiting = [-1] * size
            for at in range(size - 1):
                rank = -1 if edge[at + 1] else rank_of(text[at : at + 2], -1)
                if rank >= 0:
                    waiting[at] = rank
                    queued.setdefault(rank, []).append(at)
        else:
            symbols = np.frombuffer(text, np.uint8).astype(np.int64)
            pairs = np.append(self.pair_ranks[symbols[:-1] << 8 | symbols[1:]], -1)
            pairs[np.array(bounds[1:]) - 1] = -1
            token = self.byte_ranks[symbols].tolist()  # of the symbol that starts here, -1 once merged away
            waiting = pairs.tolist()  # rank of the pair that starts here
            places = np.argsort(pairs, kind="stable")[np.count_nonzero(pairs < 0) :]
            used, starts = np.unique(pairs[places], return_index=True)
            split = np.split(places, starts[1:])
            queued = {r: b.tolist() for r, b in zip(used.tolist(), split, strict=False)}
        for rank in queued:
            words[rank >> FAN] |= 1 << (rank & _LOW)
            top |= 1 << (rank >> FAN)
        buckets.update(queued)
        while top:
            word = (top & -top).bit_length() - 1
            lowest = words[word] & -words[word]
            rank = word << FAN | (lowest.bit_length() - 1)
            bucket = buckets.pop(rank)
            words[word] ^= lowest
            if not words[word]:
                top ^= 1 << word
            while bucket:
                at = heappop(bucket)
                if waiting[at] != rank:
                    continue  # stale: the pair was merged or has changed
                right = end[at]
                stop = end[at] = end[right]
                waiting[right] = waiting[at] = token[right] = -1
                token[at] = next_rank = rank
                if not edge[stop]:
                    before[stop] = at
                    new = rank_of(text[at : end[stop]])
                    if new is not None:
                        waiting[at] = new
                        if new in buckets:
                            heappush(buckets[new], at)
                        else:
                            buckets[new] = [at]
                            words[new >> FAN] |= 1 << (new & _LOW)
                            top |= 1 << (new >> FAN)
                        if new < next_rank:
                            next_rank = new
                if not edge[at]:
                    left = before[at]
                    new = rank_of(text[left:stop])
                    if new is None:
                        waiting[left] = -1
                    else:
                        waiting[left] = new
                        if new in buckets:
                            heappush(buckets[new], left)
                        else:
                            buckets[new] = [left]
                            words[new >> FAN] |= 1 << (new & _LOW)
                            top |= 1 << (new >> FAN)
                        if new < next_rank:
                            next_rank = new
                if next_rank < rank and bucket:
                    buckets[rank] = bucket  # a lower rank has come up, the rest waits
                    words[rank >> FAN] |= 1 << (rank & _LOW)
                    top |= 1 << (rank >> FAN)
                    break
        if len(pieces) == 1:
            found = [t for t in token if t >= 0]
            return [pack(f"<{len(found)}I", *found)]
        ids = np.array(token, np.int64)
        kept = ids >= 0
        packed = ids[kept].astype("<u4").tobytes()
        stops = (np.concatenate(([0], np.cumsum(kept)))[bounds] * 4).tolist()
        return [packed[a:b] for a, b in zip(stops, stops[1:], strict=False)]

    def learn(self, texts: list[str]) -> None:
        """Merges the new words of texts that are about to be encoded in one queue."""
        self.stretches.learn(texts)

    def encode_packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.stretches.packed(text)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> Bpe:
    """The encoder of a rank file; a Python worker keeps it, with what it remembers."""
    return Bpe(read_ranks(path), pattern)


def encoded(
    docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, ids): every text as an array of token ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            bpe.learn(texts)
            ids = [np.frombuffer(bpe.encode_packed(t), "<u4").astype(np.int32) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"]
            )

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "id long, ids array<int>").withColumnRenamed("id", id)


def decoded(rows: DataFrame, path: str, pattern: str, id: str = "doc_id") -> DataFrame:
    """(id, bytes): what arrays of ids stand for; null ids give no bytes."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            found = [bpe.decode(ids or []) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(found, pa.binary())], names=["id", "bytes"]
            )

    rows = rows.select(F.col(id).cast("long").alias("id"), "ids")
    return rows.mapInArrow(decode, "id long, bytes binary").withColumnRenamed("id", id)


def round_trip(
    docs: DataFrame,
    path: str,
    pattern: str,
    id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Per document: id, n_tokens, ids_sha256, decoded_sha256 after encoding and decoding.

    ``with_ids`` adds the ids themselves as an array of integers.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            for part in parts_of(batch, "text"):
                yield digested(bpe, part)

    def digested(bpe: Bpe, batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, ids_sha, text_sha, arrays = [], [], [], []
        texts = [t or "" for t in batch["text"].to_pylist()]
        bpe.learn(texts)
        for text in texts:
            packed = bpe.encode_packed(text)
            numbers = np.frombuffer(packed, "<u4")
            counts.append(len(numbers))
            ids_sha.append(hashlib.sha256(packed).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(numbers.tolist())).hexdigest())
            if with_ids:
                arrays.append(numbers.astype(np.int32))
        columns = [batch["id"], pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
        if with_ids:
            columns.append(pa.array(arrays, pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids
    names = [column.split()[0] for column in schema.split(", ")]
    return rows.mapInArrow(digest, schema).withColumnRenamed("id", id)
