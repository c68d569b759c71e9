"""Cutting texts where a byte-level BPE tokenizer starts a new piece anyway.

The split pattern of these tokenizers lets a piece hold a space only as its first character or among
white space. So a cut before a space that follows a character other than white space never goes
through a piece, and neither side depends on the other. Between such cuts texts repeat a lot:
each distinct stretch is encoded once and remembered.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa

#: bytes of text whose results are handed on together
PART_BYTES = 1 << 21

#: stretches remembered by each table of a Python worker, and the longest that is
REMEMBERED = 1 << 19
LONGEST = 48

#: characters of new words that are encoded together
LEARNED = 1 << 18

#: \s of this module is wider than that of any tokenizer, so that a cut is safe in all of them
_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


#: marks that end a word and are a piece of their own
_MARKS = frozenset(".,;:!?")


def matches_of(stretch: str, split: Callable[[str], list[str]]) -> list[str]:
    """What ``split`` (all matches of the pattern) gives, without it for the commonest stretches.

    In patterns of this family letters, with a space before them or not, are one match, and a mark
    after them another.
    """
    word = stretch[1:] if stretch[:1] == " " else stretch
    if word.isalpha():
        return [stretch]
    if word[-1:] in _MARKS and word[:-1].isalpha():
        return [stretch[:-1], word[-1]]
    return split(stretch)


class Remembered(dict):
    """stretch -> what ``make`` gives for ``prefix`` + stretch.

    When it is full it forgets the later half, as frequent stretches come early.
    """

    def __init__(self, make: Callable[[str], bytes], prefix: str = ""):
        self.make, self.prefix = make, prefix

    def __missing__(self, stretch: str) -> bytes:
        value = self.make(self.prefix + stretch)
        if len(stretch) <= LONGEST:
            self.room(1)
            self[stretch] = value
        return value

    def room(self, more: int) -> None:
        if len(self) + more > REMEMBERED:
            for late in list(islice(reversed(self), REMEMBERED // 2)):
                del self[late]


class StretchEncoder:
    """Encodes texts stretch by stretch; ``encode`` gives the ids of one match of ``split`` as bytes.

    A stretch of one match is remembered as such; of others the words are looked up among these and
    the rest among ``matches``, so each match is encoded and remembered once. ``encode_all``, if there
    is a way to encode many matches at once, is what ``learn`` uses.
    """

    def __init__(
        self,
        encode: Callable[[str], bytes],
        split: Callable[[str], list[str]],
        encode_all: Callable[[list[str]], list[bytes]] | None = None,
    ):
        self.encode, self.split, self.encode_all = encode, split, encode_all
        self.matches = Remembered(encode)
        self.plain = Remembered(self._stretch)
        self.spaced = Remembered(self._stretch, " ")

    def _stretch(self, stretch: str) -> bytes:
        found = matches_of(stretch, self.split)
        if len(found) == 1:
            return self.encode(found[0])
        return b"".join(map(self._match, found))

    def _match(self, match: str) -> bytes:
        if match[0] == " " and match[1:].isalpha():
            return self.spaced[match[1:]]
        return self.matches[match]

    def learn(self, texts: Iterable[str]) -> None:
        """Encodes the words of ``texts`` that are not remembered yet together; ``packed`` finds them."""
        if self.encode_all is None:
            return
        known, new, size = self.spaced, set(), 0
        for text in texts:
            for stretch in text.split(" "):
                if stretch in known:
                    continue
                word = stretch[:-1] if stretch[-1:] in _MARKS else stretch
                if word not in known and len(word) <= LONGEST and word.isalpha() and word not in new:
                    new.add(word)
                    size += len(word)
            if size >= LEARNED:
                self._learned(list(new))
                new, size = set(), 0
        self._learned(list(new))

    def _learned(self, words: list[str]) -> None:
        if words:
            self.spaced.room(len(words))
            found = self.encode_all([" " + word for word in words])
            self.spaced.update(zip(words, found, strict=True))

    def packed(self, text: str) -> bytes:
        if _AFTER_SPACE.search(text):
            return b"".join(map(self.plain.__getitem__, _CUT.split(text)))
        first, *rest = text.split(" ")
        return self.plain[first] + b"".join(map(self.spaced.__getitem__, rest))


def parts_of(batch: pa.RecordBatch, text: str, size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``size`` bytes of text, so that few results are held at once."""
    start = taken = 0
    for row, value in enumerate(batch[text]):
        taken += value.as_buffer().size if value.is_valid else 0
        if taken >= size:
            yield batch.slice(start, row + 1 - start)
            start, taken = row + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)
