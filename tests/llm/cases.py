"""A small corpus with the odd cases, and brute-force versions of what the operators return."""

from __future__ import annotations

import random
import re

#: extra columns whose names the operators use themselves
CLASHING = [
    *("id", "key", "kept", "keep_id", "size", "shard", "slot", "fp", "first", "words", "start"),
    *("row_no", "found", "bucket", "bitmap", "stats", "score", "Text_", "__key", "__maybe", "html"),
]


def sentence(rng: random.Random, count: int, vocabulary: int = 400) -> str:
    words = [f"w{rng.randrange(vocabulary)}" if rng.random() < 0.9 else "The" for _ in range(count)]
    return " ".join(words)


def texts() -> list[tuple[int | None, str | None]]:
    """(id, text): copies, near copies, shared passages, empty, null, long and odd texts."""
    rng = random.Random(7)
    passage = sentence(rng, 40)
    rows: list[tuple[int | None, str | None]] = []
    for n in range(40):
        rows.append((n, sentence(rng, rng.choice([1, 2, 12, 13, 14, 60, 200]))))
    rows += [(100 + n, "one copied text\twith  white space") for n in range(12)]
    rows += [(120, "one copied text with white space"), (121, "One copied text with white space")]
    rows += [(130 + n, f"{sentence(rng, 20)} {passage} {sentence(rng, 20)}") for n in range(8)]
    rows += [(140, passage), (141, passage.replace(" ", "\n")), (142, passage.upper())]
    long = sentence(rng, 30_000, 3_000)
    rows += [(150, long), (151, long + " and"), (152, "x" * 50_000), (153, "ab" * 20_000)]
    rows += [(160, None), (161, ""), (162, " \n\t"), (163, " "), (164, "\x1c a \x85 b")]
    rows += [(170, "é ü 漢字 😀 ½ Ⅷ ²"), (171, "aaaa " * 30), (172, "<|endoftext|> it's we'll")]
    rows += [(180, passage), (180, passage), (181, "same id"), (181, "other text"), (181, "same id")]
    rows += [(None, passage), (None, None), (None, "no id"), (None, "no id")]
    return rows


def frame(spark, rows=None, clashing: bool = True):
    """The rows as documents, with further columns of clashing names."""
    rows = texts() if rows is None else rows
    names = CLASHING if clashing else []
    data = [(i, t, "en", "src0", None if t is None else len(t), *names) for i, t in rows]
    extra = "".join(f", `{c}` string" for c in names)
    schema = f"doc_id long, text string, lang string, source string, n_chars long{extra}"
    return spark.createDataFrame(data, schema).repartition(3)


def plain_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def order(id: int | None) -> float:
    return float("inf") if id is None else id


def rows_of(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def multiset(rows) -> dict:
    found: dict = {}
    for row in rows:
        found[row] = found.get(row, 0) + 1
    return found
