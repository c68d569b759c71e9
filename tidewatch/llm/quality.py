"""Quality classifier: ridge regression on random Fourier features, with isotonic calibration.

Each text becomes a few statistics of its characters, words and lines, standardised over all
documents. Random Fourier features of these approximate a Gaussian kernel; tasks sum the normal
equations of their labelled rows, the sums are added per matrix row, and the ridge weights follow
from them. The sums are kept by fold: models that leave out one fold score its rows, and from those
scores, counted in bins, isotonic regression (pool adjacent violators) makes the scores
probabilities. The model in the end is fitted on all training rows, of which none is left out.

A document is held out, and its label never read, if crc32 of its id as text mod 5 is 0. A null text
counts as empty and has statistics of zero; a null id is held out; rows may repeat. Labels without
a quality do not count, several labels of a document count each. Without any labelled row every
score is one half. Texts are read whole, however long. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.rows import row_key, without
from tidewatch.llm.shared import write_once

FEATURES = 256
BANDWIDTH = 4.0
RIDGE = 1e-3
FOLDS = 4
BINS = 400
SEED = 20
THRESHOLD = 0.3

#: bytes by kind; what is beyond ASCII counts as a letter
_KIND = np.zeros(256, np.int64)
for _kind, _bytes in enumerate(
    [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n",
     b".,;:'\"-()", b"!?", b"*#$%&@^~+=<>\\/_`", b"|{}[]"], start=1
):
    _KIND[list(_bytes)] = _kind
_KIND[128:] = 1
KINDS = 10
STATISTICS = KINDS + 11


def statistics(text: str | None) -> np.ndarray:
    """Numbers that describe a text, each of moderate size at any length of the text."""
    raw = (text or "").encode()
    found = np.zeros(STATISTICS)
    if not raw:
        return found
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=histogram, minlength=KINDS)
    found[:KINDS] = np.sqrt(kinds / len(raw))
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    if not words:
        return found
    share = histogram[histogram > 0] / len(raw)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    same = sum(map(bytes.__eq__, words, words[1:]))
    found[KINDS:] = [
        np.log1p(len(words)),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        -(share * np.log(share)).sum(),
        np.log(distinct) / np.log(len(words) + 1),
        pairs / max(1, len(words) - 1),
        same / len(words),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(len(words) / max(1, len(lines))),
        raw.count(b". ") / len(words),
        sum(map(bytes.isupper, words)) / len(words),
    ]
    return found


def described(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, key, stats) of each document."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(value.as_py()) for value in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["key"], pa.array(stats, pa.list_(pa.float64()))],
                names=["id", "key", "stats"],
            )

    rows = docs.select(
        F.col(id).cast("long").alias("id"), row_key(id, text).alias("key"), F.col(text).alias("text")
    )
    return rows.mapInArrow(describe, "id long, key long, stats array<double>")


@dataclass(frozen=True)
class Kernel:
    """Standardisation and random Fourier features, with a constant in front."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @classmethod
    def over(cls, stats: DataFrame, features: int, bandwidth: float) -> Kernel:
        moments = [F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(STATISTICS)]
        moments += [F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(STATISTICS)]
        row = np.array([x or 0.0 for x in stats.agg(*moments).first()])
        scale = np.where(row[STATISTICS:] > 1e-9, row[STATISTICS:], 1.0)
        draw = np.random.default_rng(SEED)
        directions = draw.normal(size=(STATISTICS, features)) / bandwidth
        return cls(row[:STATISTICS], scale, directions, draw.uniform(0, 2 * np.pi, features))

    def features(self, stats: np.ndarray) -> np.ndarray:
        # standardised values are bounded, so that one odd text is not beyond every other
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([np.ones((len(x), 1)), waves], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(-1, STATISTICS)


def equations(labelled: DataFrame, kernel: Kernel) -> dict[int, np.ndarray]:
    """Normal equations by fold: the matrix, and the right-hand side as its last column.

    Every task adds up its rows; sums of a matrix row meet in one group, one from each task. What
    comes to the driver is the folds' matrices, whatever the number of rows.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = kernel.features(_matrix(batch["stats"]))
            folds = batch["fold"].to_numpy()
            both = np.column_stack([x, batch["quality"].to_numpy()])
            for fold in np.unique(folds).tolist():
                own = folds == fold
                sums[fold] = sums.get(fold, 0) + x[own].T @ both[own]
        for fold, total in sums.items():
            count = len(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([fold] * count, pa.int32()),
                    pa.array(range(count), pa.int32()),
                    pa.array(list(total), pa.list_(pa.float64())),
                ],
                names=["fold", "row", "sums"],
            )

    def added(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("sums", key=lambda s: s.map(lambda v: float(v[-1])))
        total = np.sum(np.stack(group["sums"].to_list()), axis=0)
        return group.iloc[:1].assign(sums=[total])

    schema = "fold int, row int, sums array<double>"
    parts = labelled.select("stats", "fold", "quality").mapInArrow(summed, schema)
    found: dict[int, np.ndarray] = {}
    for r in parts.groupBy("fold", "row").applyInPandas(added, schema).collect():
        size = len(kernel.phases) + 1
        found.setdefault(r["fold"], np.zeros((size, size + 1)))[r["row"]] = r["sums"]
    return found


def ridge(total: np.ndarray, penalty: float) -> np.ndarray:
    """Weights that solve the equations; the constant is not penalised."""
    matrix = total[:, :-1] + np.diag([0.0, *[penalty * max(1.0, total[0, 0])] * (len(total) - 1)])
    return np.linalg.lstsq(matrix, total[:, -1], rcond=None)[0]


def pool(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Isotonic regression: the nearest non-decreasing sequence, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for value, weight in zip(values.tolist(), weights.tolist(), strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u, x, m = blocks.pop()
            blocks.append([(u * x + v * w) / (x + w), x + w, m + n])
    return np.concatenate([np.full(n, v) for v, _, n in blocks])


@dataclass(frozen=True)
class Model:
    """Scores texts by their statistics; ``steps`` maps raw scores to probabilities."""

    kernel: Kernel
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]

    def scores(self, stats: np.ndarray) -> np.ndarray:
        raw = self.kernel.features(stats) @ self.weights
        return np.clip(np.interp(raw, *self.steps), 0, 1)


def held_out(id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def fit(
    stats: DataFrame,
    labels: DataFrame,
    features: int = FEATURES,
    bandwidth: float = BANDWIDTH,
    penalty: float = RIDGE,
) -> Model | None:
    """The model learnt from the labels of documents that are not held out; None without any.

    ``stats`` is a stored table (id, key, stats), ``labels`` has the columns doc_id and quality.
    """
    kernel = Kernel.over(stats, features, bandwidth)
    told = labels.filter("quality is not null and doc_id is not null").filter(
        ~held_out(F.col("doc_id"))
    )
    told = told.select(
        F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("double").alias("quality")
    )
    fold = F.floor(F.crc32(F.encode(F.col("id").cast("string"), "UTF-8")) / 5) % FOLDS
    labelled = write_once(stats.join(told, "id").withColumn("fold", fold.cast("int")))
    sums = equations(labelled, kernel)
    if not sums:
        return None
    total = sum(sums.values())
    weights = {f: ridge(total - s, penalty) for f, s in sums.items() if len(sums) > 1}
    final = ridge(total, penalty)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, folds = kernel.features(_matrix(batch["stats"])), batch["fold"].to_numpy()
            raw = np.array([row @ weights.get(f, final) for row, f in zip(x, folds, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(raw, pa.float64()), batch["quality"]], names=["raw", "quality"]
            )

    outside = labelled.select("stats", "fold", "quality").mapInArrow(
        scored, "raw double, quality double"
    )
    place = F.least(F.greatest(F.floor((F.col("raw") + 0.5) * (BINS / 2)), F.lit(0)), F.lit(BINS - 1))
    bins = outside.groupBy(place.alias("bin")).agg(
        F.avg("raw").alias("raw"), F.avg("quality").alias("quality"), F.count("*").alias("rows")
    )
    table = np.array(bins.orderBy("bin").select("raw", "quality", "rows").collect(), float)
    return Model(kernel, final, (table[:, 0], pool(table[:, 1], table[:, 2])))


def scored(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """(id, key, score) of each document: how likely its quality label is 1."""
    stats = write_once(described(docs, id, text))
    model = fit(stats, labels, **options)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.full(len(batch), 0.5)
            if model is not None and len(batch):
                found = model.scores(_matrix(batch["stats"]))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["key"], pa.array(found, pa.float64())],
                names=["id", "key", "score"],
            )

    return stats.mapInArrow(score, "id long, key long, score double")


def quality_report(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id: str = "doc_id",
    text: str = "text",
    **options,
) -> DataFrame:
    """Per document: id, held_out, score, predicted (1 from the threshold on)."""
    return scored(docs, labels, id, text, **options).select(
        F.col("id").alias(id),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id: str = "doc_id",
    text: str = "text",
    **options,
) -> DataFrame:
    """The documents whose score reaches the threshold, in the columns of ``docs``."""
    rows = scored(docs, labels, id, text, **options)
    removed = write_once(rows.filter(F.col("score") < threshold).select("key").distinct())
    return without(docs, removed, id=id, text=text)
