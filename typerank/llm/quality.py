"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. Its features are bins of shape measures (letters in
upper case, marks, digits, repeated words, length, ...) of the line and of the lines before
and after it; a 2 x 2 table scores neighbouring labels. Forward-backward gives each line's
probability to be good, and their mean, weighted by length, is the document's quality.

Labels are known for documents only. The field is fitted first with the label of its
document on every line, then once more with lines of bad documents relabelled good where
their own features say so, so that the table of neighbouring labels is learnt from mixed
documents.
"""

import functools
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typerank.llm.common import mix, slices, span_hashes, staged

#: Labelled documents the field is fitted on, at most; those with the smallest hash of the id.
SAMPLE = 8_000
#: Lines that these documents may have together: what the driver holds, some 700 bytes each.
LINES = 200_000
#: Bytes of text whose lines a task looks at together; the measures take some 100 times that.
SLICE = 1 << 19
THRESHOLD = 0.3
_CUTS = {
    "upper": (0.02, 0.1, 0.3, 0.6), "marks": (0.01, 0.03, 0.06, 0.1, 0.15, 0.25, 0.4), "digits": (0.01, 0.05, 0.2),
    "odd": (0.005, 0.02, 0.05, 0.1, 0.2), "bang": (0.005, 0.02, 0.05, 0.1), "bar": (0.005, 0.02, 0.05),
    "word": (3.0, 4.5, 6.0, 8.0, 12.0), "distinct": (0.1, 0.25, 0.4, 0.55, 0.7, 0.85), "again": (0.02, 0.1, 0.3, 0.6),
    "words": (1.5, 3.5, 7.5, 15.5, 40.5), "stops": (0.005, 0.02, 0.06, 0.12), "copy": (0.5,), "end": (0.5,), "head": (0.5,),
}
_OWN = sum(map(len, _CUTS.values())) + 1
WIDTH = 3 * _OWN


@functools.lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Bits of each character below 2**16: 1 letter, 2 upper, 4 digit, 8 mark, 16 space."""
    kinds = np.zeros(1 << 16, dtype=np.uint8)
    for c in range(1 << 16):
        category = unicodedata.category(chr(c))
        kinds[c] = (
            (category[0] == "L") + 2 * (category == "Lu") + 4 * (category[0] == "N")
            + 8 * (category[0] in "PS") + 16 * (category[0] == "Z" or c in range(9, 14))
        )
    return kinds


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines of each text, their lengths, features of each line and its neighbours).

    A text always has a line; null is an empty one.
    """
    codes = np.frombuffer(("\n".join(t or "" for t in texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    end = np.flatnonzero(codes == 10)
    start = np.concatenate([[0], end[:-1] + 1])
    length = end - start
    lines = np.array([(t or "").count("\n") + 1 for t in texts], dtype=np.int64)
    kind = _kinds()[np.minimum(codes, (1 << 16) - 1)]

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[end] - total[start]

    space = kind & 16 > 0
    before = np.concatenate([[True], space[:-1]])
    after = np.concatenate([space[1:], [True]])
    first, last = np.flatnonzero(before & ~space), np.flatnonzero(after & ~space) + 1
    words = span_hashes(codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), first, last, 7)
    line = np.searchsorted(end, first)
    n_words = np.bincount(line, minlength=len(end))
    _, at = np.unique(mix(line.astype(np.uint64)) ^ words, return_index=True)
    distinct = np.bincount(line[at], minlength=len(end))
    again = np.zeros(len(first), dtype=bool)
    again[1:] = (words[1:] == words[:-1]) & (line[1:] == line[:-1])
    doc = np.repeat(np.arange(len(texts)), lines)
    whole = mix(doc.astype(np.uint64)) ^ span_hashes(codes.astype(np.uint64), start, end, 9)
    _, inverse, times = np.unique(whole, return_inverse=True, return_counts=True)
    full = np.maximum(length, 1)
    letters = np.maximum(count(kind & 1 > 0), 1)
    some = np.maximum(n_words, 1)
    tail = codes[np.maximum(end - 1, 0)]
    measure = {
        "upper": count(kind & 2 > 0) / letters,
        "marks": count(kind & 8 > 0) / full,
        "digits": count(kind & 4 > 0) / full,
        "odd": count(np.isin(codes, [ord(c) for c in "#$%&*@^~=<>{}[]\\_"])) / full,
        "bang": count(codes == ord("!")) / full,
        "bar": count(codes == ord("|")) / full,
        "word": count(~space) / some,
        "distinct": np.where(n_words > 0, distinct / some, 1.0),
        "again": np.bincount(line[again], minlength=len(end)) / some,
        "words": n_words,
        "stops": count(np.isin(codes, [ord(c) for c in ".,;:?"])) / full,
        "copy": (times[inverse] > 1) & (length > 0),
        "end": (length > 0) & np.isin(tail, [ord(c) for c in ".!?"]),
        "head": (length > 0) & (kind[np.minimum(start, len(codes) - 1)] & 2 > 0),
    }
    own = [measure[name] > cut for name, cuts in _CUTS.items() for cut in cuts] + [length > 0]
    own = np.stack(own, axis=1).astype(np.float32)
    # Short lines have one distinct word share whatever they are; the bins above part them by words.
    first_line = np.concatenate([[0], np.cumsum(lines)[:-1]])
    back, ahead = np.zeros_like(own), np.zeros_like(own)
    back[1:], ahead[:-1] = own[:-1], own[1:]
    back[first_line] = 0
    ahead[np.cumsum(lines) - 1] = 0
    return lines, length, np.concatenate([own, back, ahead], axis=1)


@dataclass
class Field:
    """Log-odds of a good line are features @ weights + bias; pairs[i, j] scores i then j."""

    weights: np.ndarray
    bias: float
    pairs: np.ndarray

    def marginals(self, lines: np.ndarray, x: np.ndarray) -> np.ndarray:
        return _forward_backward(lines, x @ self.weights + np.float32(self.bias), self.pairs)[0]


def _forward_backward(lines: np.ndarray, odds: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability of a good line, expected counts of neighbouring labels in each chain's sum).

    All chains advance together, the longest first, so that the active ones are a prefix.
    """
    order = np.argsort(-lines, kind="stable")
    first = (np.cumsum(lines) - lines)[order]
    size = lines[order]
    score = np.zeros((len(odds), 2))
    score[:, 1] = odds
    ahead, back = np.empty_like(score), np.zeros_like(score)
    ahead[first] = score[first]
    active = [int(np.searchsorted(-size, -t, side="left")) for t in range(int(size[0]))] if len(size) else []
    for t in range(1, len(active)):
        now = first[: active[t]] + t
        step = ahead[now - 1][:, :, None] + pairs
        ahead[now] = np.logaddexp(step[:, 0], step[:, 1]) + score[now]
    for t in range(len(active) - 2, -1, -1):
        now = first[: active[t + 1]] + t
        step = pairs + (score[now + 1] + back[now + 1])[:, None, :]
        back[now] = np.logaddexp(step[:, :, 0], step[:, :, 1])
    joint = ahead + back
    total = np.logaddexp(joint[:, 0], joint[:, 1])
    good = np.exp(joint[:, 1] - total)
    inner = np.ones(len(odds), dtype=bool)
    inner[first] = False
    now = np.flatnonzero(inner)
    p = np.exp(ahead[now - 1][:, :, None] + pairs + (score[now] + back[now])[:, None, :] - total[now][:, None, None])
    return good, p.sum(axis=0)


def fit(lines: np.ndarray, x: np.ndarray, quality: np.ndarray, steps: int = 120, ridge: float = 1e-3) -> Field:
    """Maximum conditional likelihood by Adam; deterministic."""
    label = np.repeat(quality, lines).astype(np.float64)
    doc = np.repeat(np.arange(len(lines)), lines)
    first = np.cumsum(lines) - lines
    inner = np.ones(len(label), dtype=bool)
    inner[first] = False
    weights = np.zeros(x.shape[1] + 5)
    for part in range(2):
        if part:
            # Lines of bad documents that look good by themselves; the worst line stays bad.
            odds = x @ weights[:-5].astype(np.float32) + weights[-5]
            worst = np.minimum.reduceat(odds, first) if len(first) else odds
            label = np.where((label == 0) & (odds > 0) & (odds > worst[doc]), 1.0, label)
        now = np.flatnonzero(inner)
        seen = np.zeros((2, 2))
        np.add.at(seen, (label[now - 1].astype(int), label[now].astype(int)), 1)
        mean, var = np.zeros_like(weights), np.zeros_like(weights)
        for i in range(1, steps + 1):
            good, pairs = _forward_backward(lines, x @ weights[:-5].astype(np.float32) + weights[-5], weights[-4:].reshape(2, 2))
            miss = label - good
            slope = np.concatenate([(miss.astype(np.float32) @ x), [miss.sum()], (seen - pairs).ravel()]) / len(lines)
            slope -= ridge * weights
            mean, var = 0.9 * mean + 0.1 * slope, 0.99 * var + 0.01 * slope**2
            weights = weights + 0.1 * (mean / (1 - 0.9**i)) / (np.sqrt(var / (1 - 0.99**i)) + 1e-8)
    return Field(weights[:-5].astype(np.float32), float(weights[-5]), weights[-4:].reshape(2, 2))


def held_out(id_col: str):
    """Whether a document is kept out of the fit: crc32 of its id as text, modulo 5, is 0."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def sampled(docs: DataFrame, labels: DataFrame, label: str, sample: int, size, most: int) -> DataFrame:
    """(doc_id, text, label) of labelled documents that are not held out, staged.

    At most ``sample`` documents, in the order of the hashes of their ids, as long as their
    ``size`` adds up to at most ``most``; one document an id (its first text, its lowest
    label), and none that takes more than a fiftieth of ``most``. So neither repeated ids
    nor very long texts make the sample larger. Rows with a null id, text or label are left
    out.
    """
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    known = (
        labels.select("doc_id", label).where(f"doc_id IS NOT NULL AND {label} IN (0, 1)").where(~held_out("doc_id"))
        .groupBy("doc_id").agg(F.min(label).cast("int").alias(label)).orderBy(*order).limit(sample)
    )
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(known), "doc_id")
    rows = staged(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first(label).alias(label)), "sample")
    # One row a document of the bounded sample.
    so_far = F.sum("size").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    fits = rows.select("doc_id", size.alias("size")).where(F.col("size") <= most / 50)
    fits = fits.withColumn("so_far", so_far).where(F.col("so_far") <= most)
    return rows.join(F.broadcast(fits.select("doc_id")), "doc_id", "left_semi")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines: int = LINES) -> Field:
    """The field, from at most ``sample`` labelled documents that are not held out, with at
    most ``lines`` lines together.

    Rows with a null id, text or label are not learnt from. Without rows of both labels
    every line counts as good.
    """
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    rows = sampled(docs, labels, "quality", sample, n_lines, lines)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                lines, _, x = line_features(batch.column("text").to_pylist())
                cuts = np.concatenate([[0], np.cumsum(lines)])
                packed = np.packbits(x.astype(bool)[:, :_OWN], axis=1)
                blobs = [packed[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("quality"), pa.array(lines, pa.int64()), pa.array(blobs, pa.binary())],
                    ["doc_id", "quality", "lines", "bits"],
                )

    found = rows.mapInArrow(run, "doc_id long, quality int, lines long, bits binary").toPandas()
    found = found.sort_values(["doc_id", "lines", "bits"])
    if found.quality.nunique() < 2:
        return Field(np.zeros(WIDTH, dtype=np.float32), 5.0, np.zeros((2, 2)))
    lines = found.lines.to_numpy()
    bits = np.frombuffer(b"".join(found.bits), dtype=np.uint8).reshape(int(lines.sum()), -1)
    own = np.unpackbits(bits, axis=1, count=_OWN).astype(np.float32)
    back, ahead = np.zeros_like(own), np.zeros_like(own)
    back[1:], ahead[:-1] = own[:-1], own[1:]
    back[np.cumsum(lines) - lines] = 0
    ahead[np.cumsum(lines) - 1] = 0
    return fit(lines, np.concatenate([own, back, ahead], axis=1), found.quality.to_numpy())


def score(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``_quality``, 0 to 1, over the whole text; it replaces a
    column of that name.

    Null and empty texts are one empty line. Rows are scored one by one: no shuffle,
    repeated rows stay.
    """
    from pyspark.sql import types as T

    docs = docs.drop("_quality")

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text_col, SLICE):
                lines, length, x = line_features(batch.column(text_col).to_pylist())
                good = field.marginals(lines, x)
                first = np.cumsum(lines) - lines
                weight = np.maximum(length, 1e-3)
                value = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.clip(value, 0.0, 1.0))], [*batch.schema.names, "_quality"]
                )

    schema = T.StructType([*docs.schema.fields, T.StructField("_quality", T.DoubleType())])
    return docs.mapInArrow(run, schema)
