"""A regularised quadratic discriminant over transformed document statistics.

Every document gives a vector of statistics of its characters, words and lines, each brought to a
scale on which classes look roughly normal. Spark sums the vectors and their products by class; the
driver receives these sums only, whose number depends on the statistics alone. Each class covariance
is shrunk towards the covariance both classes share and then towards its own diagonal, and factored
once (Cholesky). The score is the logistic of the difference of the two log densities, Mahalanobis distances
solved with the factors, plus the log odds of the classes.

Statistics of few words vary widely. They are drawn towards their mean over the labelled rows, by the
weight ``n_words / (n_words + SMOOTHING)``; only the length itself is left as it is.

Null text counts as empty; an empty text has statistics like any other and so has a score. Rows that
repeat are scored one by one, a null id is kept. Training uses rows with label 0 or 1 only; a document
labelled several times counts each time. Without rows of both classes the score is the share of
label 1, or 0.5 without any. Other columns are not read.
"""

from __future__ import annotations

import functools
import math
import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from marketfold.llm.common import staged, whole_text

# Weight of the shared covariance, and then of the diagonal.
TO_POOLED = 0.02
TO_DIAGONAL = 0.02
# Words at which a text's own statistics weigh as much as the mean.
SMOOTHING = 20
# Added to every variance, so that a statistic which never varies does no harm.
FLOOR = 1e-4

_KIND = np.zeros(256, np.int64)  # 0: beyond ASCII, 1 lower, 2 upper, 3 digit, 4 blank, 5 stop, 6 other
_KIND[:128] = 6
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[0x20, *range(9, 14)]] = 4
_KIND[[ord(c) for c in ".,;:'\"-?()"]] = 5

STATISTICS = 18


def statistics(text: str) -> list[float]:
    """The vector of a document."""
    data = np.frombuffer(text.encode(), np.uint8)
    bytes_of = np.bincount(data, minlength=256)
    kinds = np.bincount(_KIND, weights=bytes_of, minlength=7)
    size = max(1.0, float(kinds.sum()))
    beyond, lower, upper, digit, blank, stop, other = (kinds / size).tolist()
    share = bytes_of[bytes_of > 0] / size
    entropy = float(-(share * np.log2(share)).sum())

    words = text.split()
    n = max(1, len(words))
    seen = Counter(words)
    twice = sum(map(operator.eq, words, islice(words, 1, None)))
    pairs = len(set(zip(words, islice(words, 1, None), strict=False)))
    shouted = sum(map(str.isupper, words))
    titled = sum(map(str.istitle, words))
    lines = text.count("\n") + 1
    length = sum(map(len, words)) / n
    plain = sum(map(str.isalpha, words))
    most = max(seen.values(), default=0)
    return [
        math.log1p(len(words)),
        length,
        math.sqrt(beyond),
        lower,
        math.sqrt(upper),
        math.sqrt(digit),
        blank,
        math.sqrt(stop),
        math.log(other + 1e-3),
        entropy,
        # Distinct words fall with length about as its square root.
        math.log(max(1, len(seen)) / n) + 0.3 * math.log(n),
        math.log(max(1, pairs) / n),
        math.log(twice / n + 1e-2),
        math.log(shouted / n + 1e-2),
        math.sqrt(titled / n),
        math.log(most / n + 1e-2),
        math.log(len(words) / lines + 1),
        math.log((n - plain) / n + 1e-2),
    ]


@dataclass(frozen=True)
class Model:
    """Means, Cholesky factors and log weights of both classes."""

    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()
    weights: tuple[float, ...] = ()
    center: np.ndarray | None = None
    share: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), self.share)
        x = smoothed(x, self.center)
        density = []
        for mean, factor, weight in zip(self.means, self.factors, self.weights, strict=True):
            solved = np.linalg.solve(factor, (x - mean).T)
            density.append(weight - 0.5 * (solved**2).sum(axis=0) - np.log(np.diag(factor)).sum())
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def smoothed(x: np.ndarray, center: np.ndarray) -> np.ndarray:
    words = np.expm1(x[:, :1])
    drawn = center + (x - center) * (words / (words + SMOOTHING))
    return np.concatenate((x[:, :1], drawn[:, 1:]), axis=1)


def document_statistics(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, x): the statistics of every document, staged as they are read twice."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return staged(texts.mapInArrow(_statistics, f"id {kind}, x array<double>"))


def fit(
    labelled: DataFrame, to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL
) -> Model:
    """The model of (label, x) rows."""
    labelled = labelled.filter("label IN (0, 1)").select(F.col("label").cast("int"), "x")
    d = STATISTICS
    total = _class_sums(labelled, None)
    counts = total[:, 0]
    if not counts.all():
        return Model(share=float(counts[1] / counts.sum()) if counts.sum() else 0.5)
    center = total[:, 1 : d + 1].sum(axis=0) / counts.sum()
    total = _class_sums(labelled, center)
    means = total[:, 1 : d + 1] / counts[:, None]
    products = total[:, d + 1 :].reshape(2, d, d) / counts[:, None, None]
    own = products - means[:, :, None] * means[:, None, :]
    pooled = np.average(own, axis=0, weights=counts)
    factors = []
    for cov in own:
        shrunk = (1 - to_pooled) * cov + to_pooled * pooled
        diagonal = np.diag(np.diag(shrunk))
        shrunk = (1 - to_diagonal) * shrunk + to_diagonal * diagonal + FLOOR * np.eye(d)
        factors.append(np.linalg.cholesky(shrunk))
    weights = np.log(counts / counts.sum())
    return Model(tuple(means), tuple(factors), tuple(weights.tolist()), center)


def _class_sums(labelled: DataFrame, center: np.ndarray | None) -> np.ndarray:
    """By class: rows, sums and sums of products of the (smoothed) statistics, flat."""
    sums = (
        labelled.mapInArrow(functools.partial(_sums, center=center), "label int, sums array<double>")
        .select("label", F.posexplode("sums").alias("place", "value"))
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"))
    )
    total = np.zeros((2, 1 + STATISTICS + STATISTICS**2))
    for label, place, value in sums.collect():
        total[label, place] = value
    return total


def held_out(id_col: str = "doc_id"):
    """Rows that no label may be learnt from: crc32 of the id as text leaves 1 divided by 3."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def fit_labels(stats: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> Model:
    """The model of all labelled documents that are not held out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    labelled = stats.join(known, "id").filter(~held_out("id"))
    return fit(staged(labelled.select("label", "x")))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` with a score of one half or more. Texts are read twice, never shuffled."""
    model = fit_labels(document_statistics(docs, id_col, text_col), labels, id_col, label_col)
    return docs.filter(_scorer(model)(whole_text(text_col)) >= 0.5)


def _scorer(model: Model):
    def score(text: pd.Series) -> pd.Series:
        x = np.array([statistics(each) for each in text]).reshape(-1, STATISTICS)
        return pd.Series(model.score(x), dtype=float)

    return F.pandas_udf(score, DoubleType())


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """One row per document: its id, ``held_out``, ``score`` and ``predicted``."""
    stats = document_statistics(docs, id_col, text_col)
    model = fit_labels(stats, labels, id_col, label_col)
    kind = docs.schema[id_col].dataType.simpleString()
    scored = stats.mapInArrow(functools.partial(_score, model=model), f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(text) for text in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(rows, pa.list_(pa.float64()))], ["id", "x"]
        )


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)


def _sums(
    batches: Iterator[pa.RecordBatch], center: np.ndarray | None
) -> Iterator[pa.RecordBatch]:
    """Of a whole task, by class: rows, sums of the statistics and of their products."""
    total = np.zeros((2, 1 + STATISTICS + STATISTICS**2))
    for batch in batches:
        x, label = _matrix(batch), batch["label"].to_numpy(zero_copy_only=False)
        x = x if center is None else smoothed(x, center)
        for c in (0, 1):
            own = x[label == c]
            total[c] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([0, 1], pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
        ["label", "sums"],
    )


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            score = model.score(_matrix(batch))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(score)], ["id", "score"])
