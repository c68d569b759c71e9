import random
import zlib

import numpy as np
import pytest
from public_tokenizers import PATTERN
from tokenizers import AddedToken, Tokenizer

from tests.llm.cases import frame, multiset, order, rows_of, texts
from tidewatch.llm import token_files as tf
from tidewatch.llm.queries import QUERIES, TOKENIZER, VOCABULARY


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_against_the_library_on_whole_texts(library):
    rng = random.Random(5)
    encoder = tf.load_encoder(TOKENIZER, PATTERN)
    letters = " \n\t\x0b\x1c\x1f\x85\xa0 abcABC'std123²½Ⅷ一é̀!?*\x00<|endoftext|>😀"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        assert np.frombuffer(encoder.packed(text), "<u2").tolist() == library(text)[:-1]


@pytest.mark.parametrize("shard_size", [tf.SHARD_BYTES, 20_000])
def test_files_against_the_library(spark, library, shard_size):
    shards = tf.write_shards(frame(spark), TOKENIZER, PATTERN, VOCABULARY, shard_size=shard_size)
    got = rows_of(tf.read_report(spark, shards))
    want = [(i, len(library(t)), crc(library(t))) for i, t in texts()]
    assert multiset((i, n, c) for i, _, n, c in got) == multiset(want)
    at = 0
    ordered = sorted(got, key=lambda r: r[1])
    for i, start, count, _ in ordered:
        assert start == at
        at += count
    keys = [order(r[0]) for r in ordered]
    assert keys == sorted(keys)
    assert sum(s.ids for s in shards) == at


def test_keyed_access(spark, library):
    rows = [(i, t) for i, t in texts() if i is not None and i < 170]
    store = tf.TokenStore(tf.write_shards(frame(spark, rows), TOKENIZER, PATTERN, VOCABULARY, shard_size=20_000))
    assert len(store.shards) > 1
    for i, t in rows:
        assert store.ids(i).tolist() == library(t)
    assert store.ids(99) is None and store.ids(-5) is None and store.ids(10**12) is None


def test_perfect_hash_is_minimal_and_tells_absent_keys():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(-(2**62), 2**62, size))
        index = tf.PerfectHash.build(keys)
        assert sorted(index.slots(keys)) == list(range(len(keys)))
    absent = rng.integers(-(2**62), 2**62, 10_000)
    slots = index.slots(absent)
    prints = np.zeros(len(keys), "<u4")
    prints[index.slots(keys)] = tf.fingerprints(keys)
    taken = (slots >= 0) & (prints[slots] == tf.fingerprints(absent))
    assert taken.sum() <= 1


def test_empty_table(spark):
    assert tf.write_shards(frame(spark, []), TOKENIZER, PATTERN, VOCABULARY) == []
    assert tf.read_report(spark, []).collect() == []


def default_ids(text, path=TOKENIZER):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_added_tokens_against_the_library_with_its_defaults():
    rng = random.Random(6)
    encoder = tf.load_encoder(TOKENIZER, PATTERN, encode_special_tokens=False)
    whole = Tokenizer.from_file(TOKENIZER)
    parts = ["<|endoftext|>", "<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "ab", "it's", "é😀", "1"]
    texts_ = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", ""]
    texts_ += ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]
    for text in texts_:
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.packed(text), "<u2").tolist() == want
    assert np.frombuffer(encoder.packed("a <|endoftext|> b"), "<u2").tolist() == [64, 220, 50256, 275]


def test_added_tokens_that_ask_for_more_than_their_string(tmp_path):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.add_tokens([AddedToken("<x>", lstrip=True), AddedToken("<xy", single_word=True)])
    tokenizer.save(path := str(tmp_path / "tokenizer.json"))
    encoder = tf.load_encoder(path, PATTERN, encode_special_tokens=False)
    for text in ("a  <x> b", "a <xy b", "a <xyz", "no <|endoftext|> <x", "<x><|endoftext|>"):
        assert np.frombuffer(encoder.packed(text), "<u2").tolist() == default_ids(text, path)


def test_query_against_the_library_with_its_defaults(spark, tmp_path):
    rows = [(1, "a <|endoftext|> b"), (2, "plain"), (3, "<|endoftext|>"), (4, None)]
    frame(spark, rows, clashing=False).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(QUERIES["op3_token_files"](spark, str(tmp_path)))
    ids = {i: [*default_ids(t), 0] for i, t in rows}
    starts = {i: sum(len(ids[j]) for j in ids if j < i) for i in ids}
    assert sorted(got) == [(i, starts[i], len(ids[i]), crc(ids[i])) for i in sorted(ids)]
