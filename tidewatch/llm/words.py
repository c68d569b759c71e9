"""Words of texts as numbers, for operators that count within a text or a task.

Words are runs of bytes other than ASCII white space. Texts are split slice by slice, so that a very
long one is never held as a list of words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np

SLICE = 1 << 20
_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def slices(text: bytes, size: int = SLICE) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes, cut at white space."""
    start = 0
    while len(text) - start > size:
        white = _WHITE.search(text, start + size)
        if white is None:
            break
        yield text[start : white.start()]
        start = white.start()
    yield text[start:]


def numbering() -> defaultdict[bytes, int]:
    """Gives each new word the next number."""
    return defaultdict(count().__next__)


def numbered(text: bytes, numbers: defaultdict[bytes, int]) -> np.ndarray:
    """The numbers of the words of a text, in order."""
    parts = [
        np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        for words in map(bytes.split, slices(text))  # bytes split at ASCII white space only
    ]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)
