"""Token-id files: raw id payloads in shards, with a minimal perfect hash index over document keys.

A text is encoded by a tokenizer file of the tokenizers library, every document gets an end id, and
documents are written in ascending order of their key, null keys last. Each shard is one file:

    payload      ids of all documents, one after the other, as 16- or 32-bit unsigned integers
    keys         the key of each document, as 64-bit integers (0 where it is null)
    stops        the number of ids up to the end of each document, as 64-bit integers
    levels       the hash function's bits, and the number of bits set before each 64-bit word
    slots        per key its fingerprint and the number of its document, as 32-bit integers
    footer       the sections' places as JSON, its length as 32-bit integer, and the magic bytes

all little-endian. The hash function maps n keys to n slots: each level has bits for keys that no
other key of the level collides with, the rest go to the next one; a key's slot is the number of bits
set before its own. A stored fingerprint tells absent keys, so a lookup reads a constant number of
places. Of documents with the same key the index leads to the first, the others follow it.

Nothing of a shard but its index is held in memory by readers; writers hold one shard of at most
``MAX_IDS`` ids. Files are written under another name and renamed, so a task that runs again
replaces its file by the same one. A null text counts as empty; texts are encoded whole,
however long; an empty table gives no shards.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.pieces import StretchEncoder
from tidewatch.llm.shared import shared_folder, text_of

MAGIC = b"TWTOKEN1"
MAX_IDS = 1 << 24
SHARD_BYTES = 64 << 20
GAMMA = 2
END_ID = 0


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys.view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit integers: bits by level, and their running count."""

    def __init__(self, words: np.ndarray, before: np.ndarray, sizes: list[int]):
        self.words, self.before, self.sizes = words, before, sizes
        self.starts = [0, *accumulate(sizes)]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], np.asarray(keys, np.int64)
        while len(left):
            size = -(-max(64, GAMMA * len(left)) // 64) * 64
            place = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[place]]
        words = np.concatenate([*levels, np.empty(0, "<u8")])
        before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1]
        return cls(words, before.astype("<u4"), [len(x) * 64 for x in levels])

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot or -1 for a key that is not in the set."""
        keys = np.asarray(keys, np.int64)
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            place = (mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            place += self.starts[level]
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            here = (self.words[word] >> bit) & np.uint64(1) == 1
            lower = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.before[word].astype(np.int64) + np.bitwise_count(lower)
            found[open_[here]] = rank[here]
            open_ = open_[~here]
        return found


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(np.asarray(keys, np.int64), 1 << 20) >> np.uint64(32)).astype("<u4")


def shard_bytes(payload: bytes, width: int, keys: list[int | None], stops: list[int]) -> bytes:
    """One file: payload, tables, index and footer."""
    present = np.array([k is not None for k in keys], bool)
    numbers = np.array([0 if k is None else k for k in keys], "<i8")
    order = np.flatnonzero(present)
    distinct, first = np.unique(numbers[order], return_index=True)
    index = PerfectHash.build(distinct)
    slots = np.zeros((len(distinct), 2), "<u4")
    place = index.slots(distinct)
    slots[place, 0], slots[place, 1] = fingerprints(distinct), order[first]
    sections = {
        "payload": payload,
        "keys": numbers.tobytes(),
        "stops": np.array(stops, "<i8").tobytes(),
        "words": index.words.tobytes(),
        "before": index.before.tobytes(),
        "slots": slots.tobytes(),
    }
    ends = list(accumulate(len(s) for s in sections.values()))
    places = {n: [e - len(s), len(s)] for (n, s), e in zip(sections.items(), ends, strict=True)}
    footer = {"sections": places, "width": width, "sizes": index.sizes, "nulls": int((~present).sum())}
    tail = json.dumps(footer).encode()
    return b"".join([*sections.values(), tail, len(tail).to_bytes(4, "little"), MAGIC])


class Shard:
    """A shard file: its tables and index in memory, its payload read where it is asked for."""

    def __init__(self, path: str):
        store, at = pafs.FileSystem.from_uri(path)
        self.file = store.open_input_file(at)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is not a token file")
        length = int.from_bytes(tail[:4], "little")
        self.footer = json.loads(self.file.read_at(length, size - 12 - length))
        self.keys = self._section("keys", "<i8")
        self.stops = self._section("stops", "<i8")
        self.index = PerfectHash(
            self._section("words", "<u8"), self._section("before", "<u4"), self.footer["sizes"]
        )
        self.entries = self._section("slots", "<u4").reshape(-1, 2)

    def _section(self, name: str, kind: str) -> np.ndarray:
        start, length = self.footer["sections"][name]
        return np.frombuffer(self.file.read_at(length, start), kind)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of the first document of each key, -1 for keys that are not here."""
        slots = self.index.slots(keys)
        found = np.full(len(slots), -1, np.int64)
        maybe = np.flatnonzero(slots >= 0)
        entry = self.entries[slots[maybe]]
        same = entry[:, 0] == fingerprints(np.asarray(keys, np.int64)[maybe])
        found[maybe[same]] = entry[same, 1]
        return found

    def start(self, document: int) -> int:
        return int(self.stops[document - 1]) if document else 0

    def ids(self, document: int) -> np.ndarray:
        """All ids of one document, the end id with them."""
        width, start = self.footer["width"], self.start(document)
        count = int(self.stops[document]) - start
        return np.frombuffer(self.file.read_at(count * width, start * width), f"<u{width}")


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself if it can be seen."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class AddedTokenEncoder:
    """Encodes a text around the added tokens in it: their ids, and the parts between them.

    Of tokens that begin at one place the longest counts. Tokens that ask for more than their string
    (white space around them, whole words, normalized texts) leave texts with any of them to ``whole``.
    """

    def __init__(
        self,
        parts: StretchEncoder,
        added: dict[str, bytes],
        whole: Callable[[str], bytes] | None = None,
    ):
        self.parts, self.added, self.whole = parts, added, whole
        longest_first = sorted(added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split

    def packed(self, text: str) -> bytes:
        parts = self.split(text)
        if len(parts) == 1:
            return self.parts.packed(text)
        if self.whole:
            return self.whole(text)
        return b"".join(
            self.added[part] if n % 2 else self.parts.packed(part) for n, part in enumerate(parts)
        )


@lru_cache(maxsize=2)
def load_encoder(
    path: str, pattern: str, encode_special_tokens: bool = True
) -> StretchEncoder | AddedTokenEncoder:
    """Encodes by the tokenizers library, as it would the whole text without adding special tokens.

    ``encode_special_tokens`` is the library's switch: if it is set, strings of special tokens are
    ordinary text; if not, as the library has it by default, they are their tokens. Texts are split at
    added tokens and by the tokenizer's pattern here, and the library's model encodes each distinct
    match once per Python worker.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = encode_special_tokens
    model, width = tokenizer.model, id_width(tokenizer.get_vocab_size())
    letters, split = byte_letters(), regex.compile(pattern).findall
    kind = {2: "H", 4: "I"}[width]
    listed = tokenizer.get_added_tokens_decoder()
    added = {n: t for n, t in listed.items() if not (encode_special_tokens and t.special)}
    strict = any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values())

    space, formats = letters[ord(" ")], [f"<{n}{kind}" for n in range(64)]

    def encoded(match: str) -> bytes:
        if match[0] == " " and match.isascii() and match[1:].isalpha():
            written = space + match[1:]
        else:
            written = match.encode().decode("latin-1").translate(letters)
        ids = [t.id for t in model.tokenize(written)]
        return pack(formats[len(ids)] if len(ids) < 64 else f"<{len(ids)}{kind}", *ids)

    def whole(text: str) -> bytes:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}{kind}", *ids)

    encoder = StretchEncoder(encoded, split)
    if not added:
        return encoder
    ids = {t.content: pack(f"<{kind}", n) for n, t in added.items()}
    return AddedTokenEncoder(encoder, ids, whole if strict else None)


def id_width(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


@dataclass(frozen=True)
class Stored:
    """A written shard: its file, how much is in it and in those before it."""

    path: str
    documents: int
    ids: int
    first_key: int | None
    last_key: int | None
    ids_before: int


class TokenStore:
    """Keyed access to written shards."""

    def __init__(self, shards: list[Stored]):
        self.shards = shards
        self.opened = lru_cache(maxsize=16)(Shard)

    def ids(self, key: int) -> np.ndarray | None:
        """The ids of the first document with a key, None if there is none."""
        keyed = [s for s in self.shards if s.first_key is not None]
        at = bisect_right([s.first_key for s in keyed], key) - 1
        while at > 0 and keyed[at - 1].last_key == key:
            at -= 1  # documents of one key may go over several shards
        if at < 0:
            return None
        shard = self.opened(keyed[at].path)
        document = int(shard.find(np.array([key]))[0])
        return None if document < 0 else shard.ids(document)


def write_shards(
    docs: DataFrame,
    tokenizer: str,
    pattern: str,
    vocabulary: int,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    shard_size: int = SHARD_BYTES,
    encode_special_tokens: bool = True,
) -> list[Stored]:
    """Encodes all documents and writes them to the shared folder in ascending order of their key.

    One row per shard comes back to the driver. Rows are ranged by key and a hash of the text, so
    that many rows with one key do not meet in one task.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    store, at = pafs.FileSystem.from_uri(folder)
    store.create_dir(at)
    width = id_width(vocabulary)
    size = docs.agg(F.sum(F.octet_length(text_of(text)))).first()[0] or 0
    rows = docs.select(
        F.col(id).cast("long").alias("key"),
        text_of(text).alias("text"),
        F.xxhash64(text_of(text)).alias("tie"),
    )
    order = [F.col("key").asc_nulls_last(), F.col("tie")]
    ranged = rows.repartitionByRange(-(-size // shard_size) or 1, *order).sortWithinPartitions(*order)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(tokenizer, pattern, encode_special_tokens)
        task = TaskContext.get().partitionId()
        store, _ = pafs.FileSystem.from_uri(folder)
        end = np.array([end_id], f"<u{width}").tobytes()
        parts: list[bytes] = []
        keys: list[int | None] = []
        stops: list[int] = []
        part = 0

        def flush() -> pa.RecordBatch:
            name = f"{at}/{task:07d}-{part:04d}.tokens"
            draft = f"{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(shard_bytes(b"".join(parts), width, keys, stops))
            store.move(draft, name)
            known = [k for k in keys if k is not None]
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "task": task,
                        "part": part,
                        "documents": len(keys),
                        "ids": stops[-1],
                        "first_key": known[0] if known else None,
                        "last_key": known[-1] if known else None,
                    }
                ],
                schema=manifest,
            )

        for batch in batches:
            for key, value in zip(batch["key"].to_pylist(), batch["text"], strict=True):
                ids = encoder.packed(value.as_py()) + end
                parts.append(ids)
                keys.append(key)
                stops.append((stops[-1] if stops else 0) + len(ids) // width)
                if stops[-1] >= MAX_IDS:
                    yield flush()
                    parts, keys, stops, part = [], [], [], part + 1
        if keys:
            yield flush()

    manifest = pa.schema(
        [(c, pa.int64()) for c in ("task", "part", "documents", "ids", "first_key", "last_key")]
    )
    schema = ", ".join(f"{c} long" for c in manifest.names)
    found = sorted(
        ranged.select("key", "text").mapInArrow(written, schema).collect(),
        key=lambda r: (r["task"], r["part"]),
    )
    before = [0, *accumulate(r["ids"] for r in found)]
    return [
        Stored(
            f"{folder}/{r['task']:07d}-{r['part']:04d}.tokens",
            r["documents"],
            r["ids"],
            r["first_key"],
            r["last_key"],
            start,
        )
        for r, start in zip(found, before, strict=False)
    ]


def read_report(spark: SparkSession, shards: list[Stored], id: str = "doc_id") -> DataFrame:
    """Per document, from the files: its key, start among all ids, n_tokens, ids_crc32.

    Documents are found through the index; those that repeat a key or have none follow in order.
    """
    schema = f"`{id}` long, start long, n_tokens long, ids_crc32 long"
    listed = spark.createDataFrame([(s.path, s.ids_before) for s in shards], "path string, base long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"])
                null_from = len(shard) - shard.footer["nulls"]
                starts, counts, sums = [], [], []
                documents = shard.find(shard.keys)
                again = np.concatenate(([False], shard.keys[1:] == shard.keys[:-1]))
                again[null_from:] = True
                documents = np.where(again, np.arange(len(shard)), documents)
                for document in documents.tolist():
                    ids = shard.ids(document)
                    starts.append(row["base"] + shard.start(document))
                    counts.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                keys = pa.array(shard.keys, mask=np.arange(len(shard)) >= null_from)
                yield pa.RecordBatch.from_arrays(
                    [keys, *(pa.array(x, pa.int64()) for x in (starts, counts, sums))],
                    names=[id, "start", "n_tokens", "ids_crc32"],
                )

    return listed.repartition(max(1, len(shards))).mapInArrow(read, schema)
