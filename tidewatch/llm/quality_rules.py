"""Quality rules combined by weak supervision.

Each rule looks at one statistic of a text and votes that it is bad, that it is good, or abstains. How
far a rule can be trusted is not set by hand: expectation-maximisation over the votes of all documents
estimates how often each rule, when it votes, is right about good and about bad documents, and how many
are good; no labels are read. The probability that a document is good, given its votes, then takes the place of a
filter that asks for every rule to pass. Documents below the base limits (``MIN_WORDS`` words, more
than half of the words in repeated windows) are dropped whatever the votes say.

Statistics are counted in one pass over whole texts. Votes depend on them by integer comparisons in
SQL. The estimation needs only how often each combination of votes occurs: one aggregate over all
documents whose result has at most ``3 ** len(rules)`` rows (59,049 for ten rules), whatever the
number of documents; this is what the driver gets. Nothing else is collected and no text shuffles.

A null text counts as empty: no words, no lines, all counts 0, and below the base limits. A very long
text is counted slice by slice and may be of any length. Ids may repeat or be null, every row has its
own result. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.rows import row_key, without
from tidewatch.llm.shared import write_once
from tidewatch.llm.words import numbered, numbering

MIN_WORDS = 50
WINDOW = 3
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
#: what a line of prose ends with
ENDS = tuple(c.encode() for c in ".!?:;\"')]”’»…。！？")
#: fixed values: frequent function words of four languages
FUNCTION_WORDS = (
    *("the", "of", "and", "to", "in", "is", "that", "for", "was", "on", "with", "as", "it", "be"),
    *("der", "die", "das", "und", "zu", "den", "mit", "von", "auf", "ist", "ein", "eine", "nicht"),
    *("le", "la", "les", "de", "des", "du", "et", "en", "un", "une", "dans", "pour", "que"),
    *("el", "los", "y", "una", "por", "con", "para", "del", "se", "las"),
)
_LETTER = re.compile(r"[^\W\d_]").search
_FUNCTION_BYTES = tuple(w.encode() for w in FUNCTION_WORDS)

COUNTS = (
    *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
    *("n_lines", "n_ended", "n_lettered", "n_capitals", "n_distinct", "n_most", "n_function"),
)


@dataclass(frozen=True)
class Rule:
    """Two SQL conditions over the counts of a text; where neither holds the rule abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words",
         "2 * word_chars >= 7 * n_words and word_chars <= 8 * n_words and n_words > 0"),
    Rule("symbols", "10 * n_symbols > n_words", "100 * n_symbols <= n_words and n_words >= 20"),
    Rule("repeated_lines", "n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 and n_lines >= 3"),
    Rule("repeated_words", "10 * n_repeat_words > 3 * n_words", "20 * n_repeat_words <= n_words and n_words >= 20"),
    Rule("letters", "5 * n_lettered < 4 * n_words", "20 * n_lettered >= 19 * n_words and n_words >= 20"),
    Rule("capitals", "10 * n_capitals > 3 * word_chars", "10 * n_capitals <= word_chars and n_words >= 20"),
    Rule("line_ends", "n_lines >= 3 and 2 * n_ended < n_lines", "10 * n_ended >= 9 * n_lines and n_lines > 0"),
    Rule("variety", "n_words >= 50 and n_distinct * n_distinct < 9 * n_words",
         "n_words >= 50 and n_distinct * n_distinct >= 36 * n_words"),
    Rule("commonest_word", "n_words >= 20 and 5 * n_most > n_words", "n_words >= 20 and 8 * n_most <= n_words"),
    Rule("function_words", "n_words >= 50 and 100 * n_function < n_words",
         "n_words >= 50 and 20 * n_function >= n_words"),
)

ABSTAINS, BAD, GOOD = 0, 1, 2
PRIOR_VOTES = 0.1


def repeated_words(words: np.ndarray, distinct: int, window: int = WINDOW) -> int:
    """Words in windows that occur twice or more; ``words`` are numbers below ``distinct``."""
    windows = len(words) - window + 1
    if windows < 2:
        return 0
    runs, kinds = words[:windows], distinct
    for at in range(1, window):
        if kinds * distinct >= 1 << 62:  # so long a text that its runs are numbered anew
            kept, runs = np.unique(runs, return_inverse=True)
            kinds = len(kept)
        runs = runs * distinct + words[at : at + windows]
        kinds *= distinct
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    covered = np.zeros(len(words) + 1, np.int64)
    for starts in (order[1:][same], order[:-1][same]):
        for at in range(window):
            covered[starts + at] = 1
    return int(covered.sum())


def capitals(text: str) -> int:
    """Characters that lower-casing changes."""
    found = 0
    for start in range(0, len(text), 1 << 20):
        part = text[start : start + (1 << 20)]
        lower = part.lower()
        if lower == part:
            continue
        if len(lower) != len(part):  # a letter whose lower case is two
            found += sum(c != c.lower() for c in part)
        else:
            a, b = (np.frombuffer(x.encode("utf-32-le"), "<u4") for x in (part, lower))
            found += int((a != b).sum())
    return found


def counts_of(data: bytes) -> tuple[int, ...]:
    """``COUNTS`` of one text in UTF-8."""
    text = data.decode("utf-8", "replace")
    numbers = numbering()
    words = numbered(data, numbers)
    often = np.bincount(words, minlength=len(numbers)) if len(words) else np.zeros(0, np.int64)
    lettered = np.fromiter(
        (_LETTER(w.decode("utf-8", "replace")) is not None for w in numbers), bool, len(numbers)
    )
    function = sum(int(often[numbers[w]]) for w in _FUNCTION_BYTES if w in numbers)
    lines = [x for x in (line.strip(SPACES) and line for line in data.split(b"\n")) if x]
    return (
        len(words),
        len(text) - (len(data) - len(data.translate(None, SPACES))),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words, len(numbers)),
        len(lines),
        sum(x.rstrip(SPACES).endswith(ENDS) for x in lines),
        int(often[lettered].sum()),
        capitals(text),
        len(numbers),
        int(often.max()) if len(often) else 0,
        function,
    )


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key, counts): the counts of every text; ``key`` tells documents apart (see rows.py)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array(
                [counts_of((t.as_py() or "").encode("utf-8", "replace")) for t in batch["text"]], np.int64
            ).reshape(-1, len(COUNTS))
            columns = [pa.array(np.ascontiguousarray(found[:, n])) for n in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["key"], *columns], names=names)

    names = ["id", "key", *COUNTS]
    rows = docs.select(
        F.col(id).cast("long").alias("id"), row_key(id, text).alias("key"), F.col(text).alias("text")
    )
    schema = ", ".join(f"{n} long" for n in names)
    return rows.mapInArrow(counted, schema)


def votes(rules: Sequence[Rule] = RULES) -> Column:
    """All votes of a text as one number, a digit of base three for each rule."""
    code = F.lit(0)
    for n, rule in enumerate(rules):
        vote = F.when(F.expr(rule.bad), BAD).when(F.expr(rule.good), GOOD).otherwise(ABSTAINS)
        code = code + vote * F.lit(3**n)
    return code


@dataclass(frozen=True)
class Accuracies:
    """Share of good documents, and of bad and good votes among those a rule gives to either kind.

    Both tables have a row for each rule; abstaining (column 0) says nothing, so it is 1 in both.
    """

    prior: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def logits(self) -> tuple[float, np.ndarray]:
        """Log odds of being good: of any document, and what each vote adds."""
        return float(np.log(self.prior / (1 - self.prior))), np.log(self.on_good / self.on_bad)


def estimate(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 500, within: float = 1e-10
) -> Accuracies:
    """Expectation-maximisation over vote patterns (a row of digits each) and how often they occur.

    It starts from a soft form of the filter that asks for all rules to pass (0.9 without a bad vote, a
    third of it for each one), so that the class with few bad votes is the good one, and ends when no probability moves by more than ``within``.
    Where a rule abstains it is left out. ``PRIOR_VOTES`` more votes of each kind than were seen keep
    probabilities off 0 and 1.
    """
    chance = 0.9 / 3.0 ** (patterns == BAD).sum(1)
    total = counts.sum()
    for _ in range(rounds):
        shares = []
        for weight in (counts * chance, counts * (1 - chance)):
            seen = np.stack([((patterns == v) * weight[:, None]).sum(0) + PRIOR_VOTES for v in (BAD, GOOD)], 1)
            said = seen / seen.sum(1, keepdims=True)
            shares.append(np.concatenate([np.ones((len(said), 1)), said], 1))
        prior = float(((counts * chance).sum() + 1) / (total + 2))
        model = Accuracies(prior, *shares)
        start, steps = model.logits()
        odds = start + steps[np.arange(patterns.shape[1]), patterns].sum(1)
        moved = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        done = np.abs(moved - chance).max(initial=0) <= within
        chance = moved
        if done:
            break
    return model


def fit(stats: DataFrame, rules: Sequence[Rule] = RULES) -> Accuracies:
    """Estimates from the votes on all documents of ``stats``."""
    found = stats.groupBy(votes(rules).alias("code")).count().orderBy("code").collect()
    codes = np.array([r["code"] for r in found], np.int64)
    counts = np.array([r["count"] for r in found], float)
    patterns = codes[:, None] // 3 ** np.arange(len(rules))[None, :] % 3
    return estimate(patterns, counts)


def probability(model: Accuracies, rules: Sequence[Rule] = RULES) -> Column:
    """The probability of being good, given the votes."""
    start, steps = model.logits()
    odds = F.lit(start)
    for rule, step in zip(rules, steps.tolist(), strict=True):
        odds = odds + (
            F.when(F.expr(rule.bad), step[BAD]).when(F.expr(rule.good), step[GOOD]).otherwise(step[ABSTAINS])
        )
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def judged(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    min_words: int = MIN_WORDS,
    threshold: float = 0.5,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per document: id, key, all counts, base_failed, score (probability of being good), kept."""
    stats = write_once(statistics(docs, id, text))
    score = probability(fit(stats, rules), rules)
    failed = (F.col("n_words") < min_words) | F.expr("100 * n_repeat_words > 50 * n_words")
    return stats.withColumns({"base_failed": failed, "score": score}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold)
    )


def rule_report(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: id, the counts of the base rules, base_failed, kept, score."""
    found = judged(docs, id=id, text=text, **options)
    return found.select(F.col("id").alias(id), *COUNTS[:5], "base_failed", "kept", "score")


def passing_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are kept, in the columns of ``docs``; rows equal in id and text go together."""
    removed = write_once(judged(docs, id=id, text=text, **options).filter("not kept").select("key"))
    return without(docs, removed, id=id, text=text)
