"""Helpers shared by the operators: shared tables, words, hashes, components."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typerank.sources import stage

#: Bytes of text that a task looks at together.
SLICE_BYTES = 2 << 20
WORD = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of the cluster and read it back.

    Cuts the lineage; the table outlives lost executors and is among those that
    ``stage.clear`` deletes.
    """
    return stage.staged(df, f"llm-{name}")


def dropped(*tables: DataFrame | None) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        if table is not None:
            stage.drop(table)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch with about ``size`` bytes of text, one row at least."""
    offsets = np.concatenate([[0], np.cumsum(text_lengths(batch.column(column)))])
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def text_lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each string; null counts as empty."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all strings in a row, n + 1 offsets); null counts as empty."""
    lengths = text_lengths(column)
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int32)
    start, data = int(bounds[column.offset]), column.buffers()[2]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    if data is None or not offsets[-1]:
        return np.zeros(0, dtype=np.uint8), offsets
    return np.frombuffer(data, dtype=np.uint8)[start : start + int(offsets[-1])], offsets


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _odd(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(0, 1 << 61)) * 8 + 3


#: Values that are hashed at a time, so that no table is as long as a text.
BLOCK = 1 << 16
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < BLOCK."""
    if base not in _POWERS:
        tables = []
        for factor in (base, pow(base, -1, 1 << 64)):
            table = np.full(BLOCK, factor, dtype=np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _POWERS[base] = tables[0], tables[1]
    return _POWERS[base]


def _places(at: np.ndarray, n: int):
    """(block, which of ``at``) for the blocks that places 0..n fall in, in ascending order."""
    order = None if len(at) < 2 or (at[1:] >= at[:-1]).all() else np.argsort(at, kind="stable")
    ordered = at if order is None else at[order]
    cuts = np.searchsorted(ordered, np.arange(0, n + 1 + BLOCK, BLOCK))
    return [slice(a, b) if order is None else order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def span_hashes(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int, table: np.ndarray | None = None
) -> np.ndarray:
    """64-bit hash of each values[start:end], by one running sum over all values, or over
    what ``table`` has for them. The sum is taken block by block and kept at the starts and
    ends only, so memory grows with the spans and not with the values."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    base = _odd(seed)
    power, inverse = _powers(base)
    step, back = np.uint64(pow(base, BLOCK, 1 << 64)), np.uint64(pow(base, -BLOCK, 1 << 64))
    n = len(values)
    first, last = _places(starts, n), _places(ends, n)
    hashes = np.empty(len(starts), dtype=np.uint64)
    total = np.zeros(BLOCK + 1, dtype=np.uint64)
    # The sum before a block, base to the place of the block, and its inverse.
    before, scale, unscale = np.zeros(1, dtype=np.uint64), np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)
    undo = np.empty(len(starts), dtype=np.uint64)
    at_end = np.empty(len(starts), dtype=np.uint64)
    for block, (some, others) in enumerate(zip(first, last, strict=True)):
        low = block * BLOCK
        part = values[low : low + BLOCK]
        part = (part if table is None else table[part]) * power[: len(part)]
        total[0] = before[0]
        np.cumsum(part * scale, out=total[1 : len(part) + 1])
        total[1 : len(part) + 1] += before
        place = starts[some] - low
        hashes[some] = total[place]
        undo[some] = inverse[place] * unscale
        at_end[others] = total[ends[others] - low]
        before = total[len(part) : len(part) + 1].copy()
        scale, unscale = scale * step, unscale * back
    np.subtract(at_end, hashes, out=hashes)
    hashes *= undo
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]


class Words:
    """Words of a column of texts: byte spans, hashes, and the text each belongs to.

    A word is a longest run of bytes other than 0x20 and 0x09 to 0x0D. ``lower`` makes
    A-Z and a-z alike in the hashes.
    """

    def __init__(self, column: pa.Array, lower: bool = False, seed: int = 1):
        self.data, self.offsets = text_bytes(column)
        space = np.ones(len(self.data) + 1, dtype=bool)
        space[:-1] = _SPACE[self.data]
        before = np.ones(len(self.data), dtype=bool)
        before[1:] = space[:-2]
        inner = self.offsets[:-1][self.offsets[:-1] < len(self.data)]
        before[inner] = True
        after = space[1:].copy()
        after[self.offsets[1:][self.offsets[1:] > 0] - 1] = True
        self.starts = np.flatnonzero(before & ~space[:-1])
        self.ends = np.flatnonzero(after & ~space[:-1]) + 1
        self.hashes = span_hashes(self.data, self.starts, self.ends, seed, _LOWER if lower else _BYTE)
        #: Words before each text, n + 1 values.
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def windows(self, width: int, seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each run of ``width`` words inside one text."""
        n = len(self.starts)
        if n < width:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        last = np.repeat(self.bounds[1:], np.diff(self.bounds))
        first = np.flatnonzero(np.arange(n) + width <= last)
        return first, span_hashes(self.hashes, first, first + width, seed)

    def shingles(self, width: int, seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, n + 1 bounds): the runs of ``width`` words of each text; the whole
        sequence if a text has fewer words; none if it has none."""
        counts = np.diff(self.bounds)
        first, hashes = self.windows(width, seed)
        number = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
        bounds = np.concatenate([[0], np.cumsum(number)])
        out = np.empty(bounds[-1], dtype=np.uint64)
        short = np.flatnonzero((counts > 0) & (counts < width))
        full = np.ones(len(out), dtype=bool)
        full[bounds[short]] = False
        out[full] = hashes
        out[bounds[short]] = span_hashes(self.hashes, self.bounds[short], self.bounds[short + 1], seed)
        return out, bounds


def set_digest(hashes: np.ndarray) -> bytes:
    """Name of a set of shingle hashes, given in order and without repeats."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def with_set_hash(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` (.., text) with ``set_hash``, the name of the set of lower-cased shingles."""

    def named(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text", 1 << 20):
            hashes, bounds = Words(part.column("text"), lower=True).shingles(width)
            out += [set_digest(np.unique(hashes[i:j])) for i, j in zip(bounds, bounds[1:])]
        return pa.array(out, pa.binary())

    # Else a filter on the result is pushed below other steps, and it is worked out twice.
    once = F.arrow_udf(named, "binary").asNondeterministic()
    return rows.withColumn("set_hash", once("text"))


def class_texts(classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, text): one text of each class (node, set_hash, id) of ``docs`` (id, text), staged.

    The texts of the ids are looked up, in one exchange at most; an id that repeats with
    other texts is told by the set hash, and repeated rows are reduced before the shuffle.
    """
    # Stored, so that few of them are sent to the texts.
    wanted = staged(classes.select("node", "set_hash", F.col("id").alias("of")), "wanted")
    mine = docs.join(wanted.select(F.col("of").alias("id")).distinct(), "id", "left_semi")
    if wanted.where("of IS NULL").limit(1).count():
        mine = mine.union(docs.where("id IS NULL"))
    found = with_set_hash(mine.select("text"), width).join(wanted, "set_hash")
    texts = staged(found.groupBy("node").agg(F.min("text").alias("text")), "class-texts")
    dropped(wanted)
    return texts


def connected(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); component is the smallest id.

    Each round hooks every tree to the smallest label next to it and then halves the
    paths; the rounds grow with the logarithm of the size. The tables of a round are
    staged, so a tree that holds most ids is split by the adaptive planner; those of the
    round before are deleted. No links on the driver.
    """
    edges = staged(
        links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct(), "edges"
    )
    labels = staged(
        edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component")),
        "labels",
    )
    while True:
        at = labels.select(F.col("id").alias("b"), F.col("component").alias("there"))
        # The smallest label next to a tree is put on its root, then each node takes its root's.
        near = edges.join(at, "b").groupBy(F.col("a").alias("id")).agg(F.min("there").alias("near"))
        hooked = labels.join(near, "id").select(
            "id", "component", F.least("near", "component").alias("low")
        )
        hooked = staged(hooked, "hooked")
        roots = hooked.groupBy("component").agg(F.min("low").alias("root"))
        roots = staged(roots, "roots")
        lower = hooked.join(roots, "component").select(
            "id", F.least("low", "root").alias("component"), F.col("component").alias("old")
        )
        jumped = lower.join(
            lower.select(F.col("id").alias("component"), F.col("component").alias("up")),
            "component",
        ).select("id", F.least("up", "component").alias("component"), "old")
        new = staged(jumped, "labels")
        changed = new.where("component != old").limit(1).count()
        dropped(labels, hooked, roots)
        labels = new.select("id", "component")
        if not changed:
            dropped(edges)
            return labels


def joined_components(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (id, component) after further ``links`` (a, b), staged. Only the
    components that the new links touch are worked on."""
    if labels is None:
        return connected(links)

    def at(end: str) -> DataFrame:
        return labels.select(F.col("id").alias(end), F.col("component").alias(f"at_{end}"))

    ends = links.join(at("a"), "a", "left").join(at("b"), "b", "left")
    ends = staged(
        ends.select(
            "a", "b", F.coalesce("at_a", "a").alias("at_a"), F.coalesce("at_b", "b").alias("at_b")
        ),
        "ends",
    )
    over = connected(ends.select(F.col("at_a").alias("a"), F.col("at_b").alias("b")))
    new = ends.select(F.col("a").alias("id"), F.col("at_a").alias("component")).union(
        ends.select("b", "at_b")
    )
    every = labels.union(new).distinct().join(
        over.select(F.col("id").alias("component"), F.col("component").alias("up")), "component", "left"
    )
    found = staged(every.select("id", F.coalesce("up", "component").alias("component")), "labels")
    dropped(ends, over, labels)
    return found
