import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.cases import CLASHING, frame, multiset, rows_of, texts
from tidewatch.llm import phrases
from tidewatch.llm.bloom import BITMAP_BITS

LOWER = {c: chr(c + 32) for c in range(ord("A"), ord("Z") + 1)}


def expected(rows, least=10, max_words=3, top=2000, covered=50):
    """``rows`` are (lang, text)."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, max_words + 1):
                for at in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[at : at + size])] += 1
    found = []
    for lang, count in counts.items():
        n = sum(c for run, c in count.items() if len(run) == 1)
        candidates = {run: a for run, a in count.items() if len(run) > 1 and a >= least}
        gone = set()
        for run, f in candidates.items():
            for size in range(2, len(run)):
                for at in range(len(run) - size + 1):
                    part = run[at : at + size]
                    if 100 * f >= covered * candidates[part]:
                        gone.add(part)
        scored = []
        for run, a in candidates.items():
            if run in gone:
                continue
            score, _, left, right = min(
                (1_000_000 * a * a // (count[run[:k]] * count[run[k:]]), k, count[run[:k]], count[run[k:]])
                for k in range(1, len(run))
            )
            scored.append((-score, -a, " ".join(run).encode(), left, right))
        for rank, (score, a, run, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, run.decode(), -a, left, right, n, -score))
    return found


def corpus(seed=1, count=80):
    rng = random.Random(seed)
    words = ["The", "the", "a", "É", "é", "new", "york", "city", "x\x0bq", "b-c", "Ünder", "𝄞", "ﬀ"]
    rows = []
    for n in range(count):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))
        text += rng.choice([". ", ", ", "\t", "!\n", " "]) + "New York City" * (n % 3 == 0) + " in new york"
        rows.append((rng.choice(["en", "de", None, "en"]), text))
    return rows + [("en", None), (None, ""), ("de", "., ;"), ("en", "new york city " * 30)]


def documents(spark, rows, clashing=True):
    names = [c for c in CLASHING if clashing]
    extra = "".join(f", `{c}` string" for c in [*names, "phrase", "f", "lefts", "_salt", "cut"])
    data = [(n, lang, text, *names, "x", "x", "x", "x", "x") for n, (lang, text) in enumerate(rows)]
    schema = f"doc_id long, lang string, text string{extra}"
    return spark.createDataFrame(data, schema).repartition(4)


@pytest.mark.parametrize("least,max_words", [(10, 3), (2, 3), (3, 2), (2, 5), (4, 4)])
def test_against_brute_force(spark, least, max_words):
    rows = corpus()
    got = rows_of(phrases.phrase_report(documents(spark, rows), least=least, max_words=max_words))
    want = expected(rows, least, max_words)
    assert want and multiset(got) == multiset(want)


def test_odd_texts(spark):
    docs = frame(spark)
    got = rows_of(phrases.phrase_report(docs, least=3, top=50))
    assert multiset(got) == multiset(expected([("en", t) for _, t in texts()], 3, top=50))


def test_top_and_ties(spark):
    rows = [("en", f"a{n:02} b{n:02}") for n in range(30)] * 10
    got = sorted(rows_of(phrases.phrase_report(documents(spark, rows), top=7)), key=lambda r: r[1])
    assert [r[2] for r in got] == [f"a{n:02} b{n:02}" for n in range(7)]
    assert {r[3:] for r in got} == {(10, 10, 10, 600, 1_000_000)}


def test_a_full_filter_changes_nothing(spark):
    rows = corpus(2)
    got = rows_of(phrases.phrase_report(documents(spark, rows), least=2, max_bits=BITMAP_BITS))
    assert multiset(got) == multiset(expected(rows, 2))


def test_a_word_in_most_phrases(spark):
    """A first word of all phrases is dealt to several tasks, with the same result."""
    rng = random.Random(4)
    rows = [("en", "the " + f"w{rng.randrange(60)}, " + f"w{rng.randrange(60)} the") for _ in range(900)]
    got = rows_of(phrases.phrase_report(documents(spark, rows), least=2))
    assert multiset(got) == multiset(expected(rows, 2))


def test_tasks_hand_on_counts_early(monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 50)
    runs = phrases.Runs(2, None)
    total, early = Counter(), 0
    rng = random.Random(5)
    lines = [" ".join(rng.choice("abcd") for _ in range(12)) for _ in range(40)]

    def take():
        for batch in runs.counted():
            for row in batch.to_pylist():
                total[row["phrase"]] += row["f"]

    for line in lines:
        runs.add("en", [line.encode()])
        if runs.full():
            early += 1
            take()
    take()
    assert early > 3
    want = Counter()
    for line in lines:
        words = line.split()
        want.update(" ".join(p) for p in zip(words, words[1:], strict=False))
    assert total == want


def test_hashes_are_those_of_spark(spark):
    runs = ["a b", "é ü", "the 𝄞"]
    df = spark.createDataFrame([("en", r) for r in runs], "lang string, phrase string")
    want = [r[0] for r in df.select(phrases.phrase_key(2)).collect()]
    start = np.array([phrases.xxhash.xxh64_intdigest(b"en", 42)], np.uint64)
    for run, key in zip(runs, want, strict=True):
        found = phrases.hash_next(start, 42)
        for word in run.split():
            found = phrases.hash_next(
                np.array([phrases.xxhash.xxh64_intdigest(word.encode(), 42)], np.uint64), found
            )
        assert found.view(np.int64)[0] == key


def test_joins_are_merged(spark):
    found, _ = phrases.collocations(documents(spark, corpus()), least=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "ShuffledHashJoin" not in plan


@pytest.mark.parametrize("rows", [[], [(None, None)], [("en", "one")]])
def test_few_rows(spark, rows):
    assert phrases.phrase_report(documents(spark, rows)).collect() == []


def test_a_very_long_text(spark):
    text = "alpha beta gamma " * 200_000
    got = rows_of(phrases.phrase_report(documents(spark, [("en", text)])).select("phrase", "a"))
    assert ("alpha beta gamma", 200_000) in got
