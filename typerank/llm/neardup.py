"""Near-duplicate groups by min-max hashing.

Each permutation of the shingle hashes is evaluated once and gives two signature values,
its minimum and its maximum; both agree between two sets with (about) the probability of
their Jaccard similarity, and the pair estimates it with a lower variance than two
independent minima. Bands of signature values become join keys.

Sets that are equal are one class with a number. Classes that share a band are
candidates; every link is confirmed on the full sets. A band value that many classes
share is not expanded into pairs: its classes are compared with hubs first, those already
connected need no further comparison, and only classes that are still apart are compared
with each other, in blocks, by bit maps that bound the similarity from above. So every
candidate pair is either confirmed, refuted, or inside one component already; no bucket
is capped. One text of each class that shares a band is stored once, and only these texts
are moved to confirm pairs.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from typerank.llm.common import (
    Words,
    class_texts,
    dropped,
    joined_components,
    mix,
    set_digest,
    slices,
    staged,
    with_set_hash,
)


@dataclass(frozen=True)
class MinMax:
    """``percent``: least similarity, 100 * intersection >= percent * union.

    ``permutations`` yield twice as many signature values, cut into bands of ``rows``.
    At a similarity of 0.85 a pair shares no band with a probability of 4e-7, and at 0.8
    of 2e-9 with the values of :data:`STAGE`.
    """

    width: int = 3
    percent: int = 85
    permutations: int = 64
    rows: int = 5

    @property
    def bands(self) -> int:
        return 2 * self.permutations // self.rows


QUERY = MinMax()
#: Five words, 0.8 or more.
STAGE = MinMax(width=5, percent=80, permutations=76, rows=4)

SIGNATURES = "id long, n_shingles long, set_hash binary, bands array<long>, bits binary"
#: Bits of the map of each set, and members of a bucket that are compared as one block.
BITS, BLOCK = 2048, 256


def _bands(hashes: np.ndarray, bounds: np.ndarray, p: MinMax) -> np.ndarray:
    """Band keys of each set, one row a set; rows of empty sets are meaningless."""
    rng = np.random.default_rng(20_250_101)
    xor = rng.integers(0, 1 << 63, p.permutations, dtype=np.uint64)
    odd = rng.integers(0, 1 << 63, p.permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    out = np.zeros((len(bounds) - 1, p.bands), dtype=np.uint64)
    if not len(filled):
        return out
    starts = bounds[filled]
    values = np.empty((2 * p.permutations, len(filled)), dtype=np.uint64)
    for i in range(p.permutations):
        y = (hashes ^ xor[i]) * odd[i]
        # The minimum and the maximum of one permutation stand half a signature apart,
        # so that a band rarely holds both.
        values[i] = np.minimum.reduceat(y, starts)
        values[p.permutations + i] = np.maximum.reduceat(y, starts)
    with np.errstate(over="ignore"):
        for b in range(p.bands):
            key = np.full(len(filled), b + 1, dtype=np.uint64)
            for v in values[b * p.rows : (b + 1) * p.rows]:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + v)
            out[filled, b] = key
    return out


def signatures(docs: DataFrame, p: MinMax) -> DataFrame:
    """(id, text) -> (id, n_shingles, set_hash, bands, bits). Null text: an empty set.

    ``bits`` has a bit for each shingle hash modulo its length.
    """

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                hashes, bounds = Words(batch.column("text"), lower=True).shingles(p.width)
                keys = _bands(hashes, bounds, p)
                sizes, digests = [], []
                for i in range(batch.num_rows):
                    own = np.unique(hashes[bounds[i] : bounds[i + 1]])
                    sizes.append(len(own))
                    digests.append(set_digest(own))
                marked = np.zeros((batch.num_rows, BITS), dtype=bool)
                marked[np.repeat(np.arange(batch.num_rows), np.diff(bounds)), hashes % np.uint64(BITS)] = True
                bits = pa.array([x.tobytes() for x in np.packbits(marked, axis=1)], pa.binary())
                flat = pa.array(keys.view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * p.bands), flat
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists, bits],
                    ["id", "n_shingles", "set_hash", "bands", "bits"],
                )

    return docs.select("id", "text").mapInArrow(run, SIGNATURES)


def confirmed(pairs: DataFrame, texts: DataFrame, p: MinMax) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar enough, staged.

    ``pairs`` and ``texts`` (node, text) are stored tables: few pairs are sent to the
    texts, many are shuffled, each text with the pairs in which it is the second, and
    then to the first. A first text that most pairs share is split by the planner.
    """

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                left, at = Words(batch.column("text"), lower=True).shingles(p.width)
                right, to = Words(batch.column("other"), lower=True).shingles(p.width)
                keep = []
                for i in range(batch.num_rows):
                    one, two = np.unique(left[at[i] : at[i + 1]]), np.unique(right[to[i] : to[i + 1]])
                    low, high = sorted((len(one), len(two)))
                    if 100 * low < p.percent * high:
                        keep.append(False)
                        continue
                    both = np.concatenate([one, two])
                    both.sort()
                    same = int(np.count_nonzero(both[1:] == both[:-1]))
                    keep.append(100 * same >= p.percent * (len(both) - same))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    right = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    left = texts.select(F.col("node").alias("a"), "text")
    left = left.join(pairs.select("a").distinct(), "a", "left_semi")
    joined = pairs.select("a", "b").join(right, "b").join(left, "a")
    return staged(joined.select("a", "b", "text", "other").mapInArrow(run, "a long, b long"), "links")


def _similar_size(one: str, two: str, percent: int):
    low, high = F.least(one, two), F.greatest(one, two)
    return low * 100 >= high * percent


def _still_possible(apart: DataFrame, p: MinMax) -> DataFrame:
    """Pairs (a, b) of a bucket with different components that may be similar enough.

    ``apart``: (key, id, n_shingles, component, bits, n) with ``n`` members of ``key``. The
    members of a bucket are dealt into blocks, and each block meets each other once. A bit
    that only one of two maps has stands for at least one shingle that only its set has,
    so the bound that the maps give never rejects a pair that is similar enough.
    """
    member = F.struct("id", "n_shingles", "component", "bits")
    blocks = (
        apart.withColumn("block", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK)))
        .groupBy("key", "block")
        .agg(F.collect_list(member).alias("one"))
    )
    others = blocks.select("key", F.col("block").alias("block2"), F.col("one").alias("two"))

    def columns(cell):
        ids, sizes, components, bits = (cell.field(i) for i in range(4))
        words = np.frombuffer(b"".join(bits.to_pylist()), dtype=np.uint64).reshape(len(ids), -1)
        return (*(x.to_numpy(zero_copy_only=False) for x in (ids, sizes, components)), words)

    def run(batches):
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                id1, n1, c1, w1 = columns(batch.column("one")[i].values)
                id2, n2, c2, w2 = columns(batch.column("two")[i].values)
                for j in range(len(id1)):
                    at = np.flatnonzero(
                        (c2 != c1[j]) & (id2 != id1[j])
                        & (100 * np.minimum(n1[j], n2) >= p.percent * np.maximum(n1[j], n2))
                    )
                    if not len(at):
                        continue
                    only1 = np.bitwise_count(w1[j] & ~w2[at]).sum(axis=1, dtype=np.int64)
                    only2 = np.bitwise_count(w2[at] & ~w1[j]).sum(axis=1, dtype=np.int64)
                    same = np.minimum(n1[j] - only1, n2[at] - only2)
                    at = at[100 * same >= p.percent * (n1[j] + n2[at] - same)]
                    found.append(np.stack([np.minimum(id1[j], id2[at]), np.maximum(id1[j], id2[at])]))
            if found:
                pairs = np.unique(np.concatenate(found, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    met = blocks.join(others, "key").where("block <= block2").select("one", "two")
    return met.mapInArrow(run, "a long, b long")


def links(classes: DataFrame, marks: DataFrame, docs: DataFrame, p: MinMax) -> DataFrame:
    """(id, component): components of the nodes that confirmed links hold together.

    ``classes``: (node, set_hash, n_shingles, id, bands), one row per set, stored;
    ``marks`` holds the bit maps by set hash. Several links of a component are not looked
    for once it is held together.
    """
    keys = classes.select("node", "n_shingles", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("node", "n_shingles")).alias("hub")
    ).where("n > 1")
    shared = staged(shared, "shared")
    members = staged(keys.join(shared, "key"), "members")
    dropped(shared)
    # Every class with the first one of its bucket: one pair a member at most.
    first = members.where("node != hub.node").where(
        _similar_size("n_shingles", "hub.n_shingles", p.percent)
    )
    pairs = staged(first.select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    in_buckets = members.select("node").distinct()
    texts = class_texts(classes.join(in_buckets, "node", "left_semi"), docs, p.width)
    found = confirmed(pairs, texts, p)
    labels = joined_components(None, found)
    dropped(found)
    for last in (False, True):
        # Buckets that still hold several components.
        at = members.select("key", "node", "n_shingles", "n").join(
            labels.withColumnRenamed("id", "node"), "node", "left"
        )
        at = staged(at.withColumn("component", F.coalesce("component", "node")), "at")
        mixed = at.groupBy("key").agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.min_by(F.struct("node", "n_shingles", "component"), F.xxhash64("node")).alias("hub"),
        ).where("low != high")
        mixed = staged(mixed.select("key", "hub"), "mixed")
        apart = staged(at.join(mixed, "key"), "apart")
        dropped(at, mixed)
        if last:
            named = classes.join(apart.select("node").distinct(), "node", "left_semi").select("node", "set_hash")
            maps = marks.select("set_hash", "bits").join(named, "set_hash").groupBy("node").agg(
                F.first("bits").alias("bits")
            )
            more = _still_possible(apart.join(maps, "node").withColumnRenamed("node", "id"), p)
        else:
            # Each component with a second hub of the bucket.
            more = apart.where("component != hub.component").where(
                _similar_size("n_shingles", "hub.n_shingles", p.percent)
            ).select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))
        more = staged(more.distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
        found = confirmed(more, texts, p)
        labels = joined_components(labels, found)
        dropped(apart, more, found)
    dropped(members, pairs, texts)
    return labels


def _judged(docs: DataFrame, p: MinMax) -> DataFrame:
    """(id, n_shingles, set_hash, component_id): one row per row of ``docs`` (id, text)."""
    marks = staged(signatures(docs, p), "signatures")
    sets = marks.where("n_shingles > 0").groupBy("set_hash", "n_shingles")
    classes = sets.agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    labels = links(classes, marks, docs, p)
    at = classes.select("node", "set_hash", "id").join(
        labels.withColumnRenamed("id", "node"), "node", "left"
    )
    at = staged(at.withColumn("component", F.coalesce("component", "node")), "at")
    lowest = staged(at.groupBy("component").agg(F.min("id").alias("component_id")), "lowest")
    of_set = staged(at.join(lowest, "component").select("set_hash", "component", "component_id"), "of-set")
    dropped(labels, at, lowest, classes)
    return marks.select("id", "n_shingles", "set_hash").join(of_set, "set_hash", "left")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: MinMax = QUERY) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row.

    Every row is a document: one that repeats an id with another text is linked through
    its own text only, and rows that repeat both get the same verdict. Empty or null texts
    have no shingles and stand alone. A text with fewer words than ``width`` has its whole
    sequence as the one shingle. A row without an id takes part; its ``component_id`` is
    the smallest id of its group, null if the group has none. ``kept``: the two are the
    same. Other columns are not read. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = _judged(docs, p).select(
        "id",
        "n_shingles",
        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return rows.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: MinMax = STAGE) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all columns as they are.

    The row with the smallest id stays (one without an id only if no row of the group has
    one); of rows that share it, the smallest set hash and then the smallest text. Rows
    without words are no copies of each other: all stay. Only copies that share id and
    words are shuffled with their texts, reduced to one a task before.
    """
    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))
    rows = rows.select(
        "row", F.col("row")[id_col].cast("long").alias("id"), F.col("row")[text_col].alias("text")
    )
    judged = _judged(rows.select("id", "text"), p).where("component IS NOT NULL")
    sets = judged.groupBy("component", "id", "set_hash").agg(F.count(F.lit(1)).alias("copies"))
    sets = staged(sets, "sets")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "set_hash")
    best = staged(sets.groupBy("component").agg(F.min(order).alias("best")), "best")
    # What needs an answer other than "the only row of its group": gone, or one of several.
    told = sets.join(best, "component").withColumn("gone", order != F.col("best"))
    told = staged(
        told.where("gone OR copies > 1").select(F.col("id").alias("_id"), F.col("set_hash").alias("_set"), "gone"),
        "told",
    )
    dropped(sets, best)
    found = with_set_hash(rows, p.width).select("row", "id", "set_hash").join(
        told, F.col("id").eqNullSafe(F.col("_id")) & (F.col("set_hash") == F.col("_set")), "left"
    )
    single = found.where("gone IS NULL").select("row")
    if not told.where("NOT gone").limit(1).count():
        return single.select("row.*")
    several = found.where("NOT gone").groupBy("id", "set_hash").agg(
        F.min_by("row", F.col("row")[text_col]).alias("row")
    )
    return single.union(several.select("row")).select("row.*")
