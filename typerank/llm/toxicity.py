"""Severity of toxic language by cumulative-link ordinal regression on sparse features.

Features are whole words and word beginnings of four to six letters, which also meet
inflected forms. Each chosen feature counts by its presence and by its share of the words.
One weight a feature is shared by all grades; ordered thresholds part them:
P(grade > k) = logistic(score - threshold k). The output is the expected grade.

Labels say toxic or not. The grades of toxic training documents are the thirds of their
share of words with a toxic feature; clean ones are grade 0. (Shares by features that were
chosen on other folds of the training documents were tried: on few labels their noise lifts
clean documents above the threshold.)
"""

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from typerank.llm.common import slices
from typerank.llm.quality import sampled

#: Labelled documents the model is fitted on, at most, and characters that they may have
#: together; they bound the number of features and what the driver holds.
SAMPLE, CHARACTERS = 20_000, 100_000_000
GRADES = 4
#: Expected grade from which a document is toxic; the clean ones lie near 0.
THRESHOLD = 0.25
_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)


def _features(word: str):
    """A word, and its beginnings marked by a hyphen."""
    yield word
    for n in PREFIXES:
        if len(word) >= n:
            yield word[:n] + "-"


@dataclass
class Severity:
    """Expected grade of a text; ``index`` numbers the features, in two columns each."""

    index: dict
    weights: np.ndarray
    thresholds: np.ndarray

    def columns(self, text: str | None) -> dict:
        """Values of a text by column: presence, then twenty times the share of words, up to 1."""
        return sparse(text, self.index)

    def expected(self, texts: list[str | None]) -> np.ndarray:
        score = np.array([sum(self.weights[c] * v for c, v in sparse(t, self.index).items()) for t in texts])
        return _above(score, self.thresholds).sum(axis=1)


def sparse(text: str | None, index: dict) -> dict:
    gate = index.get(None)
    if gate is None:
        gate = index[None] = {f[:4].rstrip("-") if len(f) < 5 else f[:4] for f in index if f}
    words = _WORD.findall((text or "").lower())
    hits = Counter()
    for word, n in Counter(words).items():
        if word[:4] in gate:
            for f in _features(word):
                if f in index:
                    hits[index[f]] += n
    n_features = len(index) - 1
    out = {}
    for i, n in hits.items():
        out[i] = 1.0
        out[n_features + i] = min(1.0, 20.0 * n / len(words))
    return out


def _above(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade > k) for each threshold."""
    return 1.0 / (1.0 + np.exp(np.clip(thresholds[None, :] - score[:, None], -40, 40)))


def fit(rows: list[dict], grades: np.ndarray, n_columns: int, steps: int = 300, ridge: float = 1e-5):
    """(weights, thresholds) of the proportional-odds model, by Adam; deterministic."""
    n = np.array([len(r) for r in rows])
    row = np.repeat(np.arange(len(rows)), n)
    column = np.array([c for r in rows for c in r], dtype=np.int64)
    value = np.array([v for r in rows for v in r.values()], dtype=np.float64)
    k = GRADES - 1
    # Thresholds: the first, then the logarithms of the steps between them.
    theta = np.concatenate([np.zeros(n_columns), [1.0], np.zeros(k - 1)])
    mean, var = np.zeros_like(theta), np.zeros_like(theta)
    low, high = np.maximum(grades - 1, 0), np.minimum(grades, k - 1)
    is_low, is_high = grades > 0, grades < k
    for i in range(1, steps + 1):
        gaps = np.exp(theta[n_columns + 1 :])
        cuts = theta[n_columns] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(row, value * theta[:n_columns][column], minlength=len(rows))
        above = _above(score, cuts)
        at = np.arange(len(rows))
        # P(grade) = P(> grade - 1) - P(> grade)
        a = np.where(is_low, above[at, low], 1.0)
        b = np.where(is_high, above[at, high], 0.0)
        p = np.maximum(a - b, 1e-12)
        da, db = np.where(is_low, a * (1 - a), 0.0) / p, np.where(is_high, b * (1 - b), 0.0) / p
        slope = np.zeros_like(theta)
        slope[:n_columns] = np.bincount(column, value * (da - db)[row], minlength=n_columns)
        cut = np.zeros(k)
        np.add.at(cut, low, -da)
        np.add.at(cut, high, db)
        slope[n_columns] = cut.sum()
        slope[n_columns + 1 :] = gaps * np.cumsum(cut[::-1])[::-1][1:]
        slope = slope / len(rows) - ridge * np.concatenate([theta[:n_columns], np.zeros(k)])
        mean, var = 0.9 * mean + 0.1 * slope, 0.99 * var + 0.01 * slope**2
        theta = theta + 0.05 * (mean / (1 - 0.9**i)) / (np.sqrt(var / (1 - 0.99**i)) + 1e-10)
    return theta[:n_columns], theta[n_columns] + np.concatenate([[0.0], np.cumsum(np.exp(theta[n_columns + 1 :]))])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, characters: int = CHARACTERS) -> Severity:
    """The model, from at most ``sample`` labelled documents that are not held out, with at
    most ``characters`` characters together.

    Every feature that is in three toxic documents and has log-odds above 2 is used. Rows
    with a null id, text or label are not learnt from. Without toxic rows nothing is toxic.
    """
    rows = sampled(docs, labels, "toxic", sample, F.length("text"), characters)

    def counted(batches):
        # Documents a feature is in, added up over the task.
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = set(_WORD.findall(text.lower()))
                seen[toxic].update({f for w in words for f in _features(w)})
        for toxic, counts in enumerate(seen):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array([toxic] * len(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())],
                ["feature", "toxic", "n"],
            )

    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not totals.get(1) or not totals.get(0):
        return Severity({}, np.zeros(0), np.full(GRADES - 1, 20.0) + np.arange(GRADES - 1))
    rate = lambda kind: (F.col(f"n{kind}") + 0.5) / (totals[kind] + 1.0)
    chosen = (
        rows.select("text", "toxic").mapInArrow(counted, "feature string, toxic int, n long")
        .groupBy("feature")
        .agg(*(F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)))
        .where("n1 >= 3").withColumn("odds", F.log(rate(1) / rate(0))).where("odds > 2")
        .orderBy((F.col("n1") * F.col("odds")).desc(), "feature")
    )
    index = {r.feature: i for i, r in enumerate(chosen.select("feature").collect())}
    if not index:
        return Severity({}, np.zeros(0), np.full(GRADES - 1, 20.0) + np.arange(GRADES - 1))
    n = len(index)

    def vectors(batches):
        for batch in batches:
            found = [sparse(t, index) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array([list(f) for f in found], pa.list_(pa.int32())),
                 pa.array([list(f.values()) for f in found], pa.list_(pa.float64()))],
                ["doc_id", "toxic", "at", "value"],
            )

    found = rows.mapInArrow(vectors, "doc_id long, toxic int, at array<int>, value array<double>").toPandas()
    found = found.sort_values("doc_id")
    data = [dict(zip(list(a), list(v), strict=True)) for a, v in zip(found["at"], found["value"], strict=True)]
    toxic = found.toxic.to_numpy()
    share = np.array([sum(v for c, v in d.items() if c >= n) for d in data])
    cuts = np.quantile(share[toxic == 1], [1 / 3, 2 / 3])
    grades = np.where(toxic == 1, 1 + np.searchsorted(cuts, share, side="left"), 0)
    weights, thresholds = fit(data, grades, 2 * n)
    return Severity(index, weights, thresholds)


def score(docs: DataFrame, model: Severity, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``_severity``, the expected grade, 0 to 3; it replaces a
    column of that name.

    Null and empty texts have no features and so the lowest value. Rows are scored one by
    one over the whole text: no shuffle, repeated rows stay.
    """
    from pyspark.sql import types as T

    docs = docs.drop("_severity")

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text_col):
                value = model.expected(batch.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*batch.schema.names, "_severity"])

    schema = T.StructType([*docs.schema.fields, T.StructField("_severity", T.DoubleType())])
    return docs.mapInArrow(run, schema)
