"""Exact Jaccard join on word n-grams by a blocked sparse matrix product.

The documents are rows and the n-grams columns of a sparse 0/1 matrix; the product with its
transpose holds the overlaps of all pairs. Sizes bound what has to be multiplied:

* A document of n grams that is similar enough to another lacks at most
  m = n - ceil(t n) of its grams there. So of any chosen columns it may own at most m that
  no other document has, else it has no partner; and among its m + 1 rarest chosen columns
  (its head) at least one also is in the head of the partner.
* Similar documents have at least ceil(t (n1 + n2) / (1 + t)) grams in common.

For longer documents one column in ``every`` is chosen, by hash; that no common gram of a
similar pair is chosen has a probability below 1e-13. Sets that are equal are one row.

The product is not expanded where it need not be: the rows of a column of the heads are
first multiplied with one of them, then with a second, and links found so far join rows into
components. What remains are columns that hold several components. They are gathered into
patches (columns with the same first row), whose full rows are dealt into blocks; pairs of
blocks are multiplied, overlaps are added up column block by column block, and pairs below
the bound of their sizes are discarded. Of the links between two components one is kept.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typerank.llm.common import Words, class_texts, dropped, joined_components, set_digest, slices, staged

#: Grams of the rows that are multiplied as one block, about, and columns at a time.
BLOCK, COLUMNS = 1 << 17, 4096


@dataclass(frozen=True)
class Join:
    """Least similarity in ``percent``; n-grams of ``width`` words. All columns are chosen
    for documents of fewer than ``cut`` grams, one in ``every`` for others."""

    width: int = 3
    percent: int = 90
    cut: int = 128
    every: int = 4

    @property
    def least_long(self) -> int:
        """Smallest row that can be similar enough to one of ``cut`` grams."""
        return -(-self.percent * self.cut // 100)

    def missing(self, n):
        """Grams that a row of n may have and a similar row not."""
        return n * (100 - self.percent) // 100

    def overlap(self, n1, n2):
        """Least overlap of similar rows of n1 and n2 grams."""
        return -(-self.percent * (n1 + n2) // (100 + self.percent))


ROWS = "id long, n int, set_hash binary"


def matrix_rows(docs: DataFrame, p: Join, chosen: bool = False) -> DataFrame:
    """(id, n, set_hash) of ``docs`` (id, text), and the ``chosen`` columns of each row:
    ``dense`` all of a row below ``cut``, ``sampled`` one in ``every`` of a row that may be
    similar to one of ``cut`` grams or more. The two kinds share no columns."""
    apart = np.uint64(0x9E3779B97F4A7C15)

    def run(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                hashes, bounds = Words(batch.column("text"), lower=True).shingles(p.width)
                sizes, digests, dense, sampled = [], [], [], []
                for i, j in zip(bounds, bounds[1:]):
                    own = np.unique(hashes[i:j])
                    sizes.append(len(own))
                    digests.append(set_digest(own))
                    if chosen:
                        dense.append((own ^ apart if len(own) < p.cut else own[:0]).view(np.int64))
                        one_in = own[own % np.uint64(p.every) == 0] if len(own) >= p.least_long else own[:0]
                        sampled.append(one_in.view(np.int64))
                columns = [batch.column("id"), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary())]
                names = ["id", "n", "set_hash"]
                if chosen:
                    columns += [pa.array(x, pa.list_(pa.int64())) for x in (dense, sampled)]
                    names += ["dense", "sampled"]
                yield pa.RecordBatch.from_arrays(columns, names)

    more = ", dense array<long>, sampled array<long>" if chosen else ""
    return docs.select("id", "text").mapInArrow(run, ROWS + more)


def heads(classes: DataFrame, p: Join) -> DataFrame:
    """(part, gram, node, n) of the columns in the heads of the rows, staged.

    ``part`` is a row and a kind of columns. Columns that no other row has are left out.
    ``classes``: (node, n, dense, sampled), stored.
    Each gram is counted once and looked up once; a gram that most rows have is added up
    before the shuffle and split by the planner in the look-up.
    """
    m = F.floor(F.col("n") * (100 - p.percent) / 100).cast("int")

    def entries(kind: int, name: str) -> DataFrame:
        rows = classes.where(F.size(name) > 0)
        # A row that no row of another content can be similar to.
        rows = rows.where((m > 0) | (F.floor(F.col("n") * 100 / p.percent) > F.col("n")))
        return rows.select(
            (F.col("node") * 2 + kind).alias("part"),
            (F.size(name) - m - 1).cast("int").alias("slack"),
            F.explode(name).alias("gram"),
        )

    every = entries(0, "dense").union(entries(1, "sampled"))
    shared = every.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = staged(shared, "shared")
    own = W.partitionBy("part")
    placed = every.join(shared, "gram").select(
        "part",
        "gram",
        "slack",
        F.row_number().over(own.orderBy("df", "gram")).alias("place"),
        F.count(F.lit(1)).over(own).alias("shared"),
    )
    # The head holds the m + 1 rarest columns; those with one row come first.
    found = staged(placed.where("place <= shared - slack").select("part", "gram"), "heads")
    sizes = classes.select("node", "n")
    rows = found.withColumn("node", F.shiftright("part", 1)).join(sizes, "node")
    rows = staged(rows.select("part", "gram", "node", "n"), "head-rows")
    dropped(shared, found)
    return rows


def _similar_size(one: str, two: str, p: Join):
    return F.least(one, two) * 100 >= F.greatest(one, two) * p.percent


def multiplied(pairs: DataFrame, texts: DataFrame, p: Join) -> DataFrame:
    """Links (a, b): the ``pairs`` whose full rows overlap enough, staged.

    Both tables are stored. Few pairs are sent to the texts; many are shuffled with the
    second text, and then to the first, which the planner splits if most pairs share it.
    The rows of a slice that have the same first text are multiplied with it together.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for batch in slices(whole, "other", 1 << 20):
                a = batch.column("a").to_numpy()
                right, to = Words(batch.column("other"), lower=True).shingles(p.width)
                of = np.repeat(np.arange(len(a)), np.diff(to))
                order = np.lexsort((right, of))
                right, of = right[order], of[order]
                first = np.ones(len(right), dtype=bool)
                first[1:] = (right[1:] != right[:-1]) | (of[1:] != of[:-1])
                right, of = right[first], of[first]
                n2 = np.bincount(of, minlength=len(a))
                to = np.searchsorted(of, np.arange(len(a) + 1))
                keep = np.zeros(len(a), dtype=bool)
                starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
                for i, j in zip(starts, [*starts[1:], len(a)]):
                    row = np.unique(Words(batch.column("text").slice(i, 1), lower=True).shingles(p.width)[0])
                    mine = right[to[i] : to[j]]
                    at = np.minimum(np.searchsorted(row, mine), len(row) - 1)
                    same = np.bincount(of[to[i] : to[j]][row[at] == mine] - i, minlength=j - i)
                    keep[i:j] = 100 * same >= p.percent * (len(row) + n2[i:j] - same)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    right = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    left = texts.select(F.col("node").alias("a"), "text")
    left = left.join(pairs.select("a").distinct(), "a", "left_semi")
    joined = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text", "other")
    return staged(joined.mapInArrow(run, "a long, b long"), "links")


def full_rows(texts: DataFrame, p: Join) -> DataFrame:
    """(node, grams): all grams of each text (node, text), in order, staged."""

    def run(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                hashes, bounds = Words(batch.column("text"), lower=True).shingles(p.width)
                rows = [np.unique(hashes[i:j]).view(np.int64) for i, j in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), pa.array(rows, pa.list_(pa.int64()))], ["node", "grams"]
                )

    return staged(texts.select("node", "text").mapInArrow(run, "node long, grams array<long>"), "full-rows")


def patches(mixed: DataFrame, full: DataFrame) -> DataFrame:
    """(patch, block, lo, hi, rows) of ``mixed`` (gram, part, node, n, component), staged.

    A patch is the columns with the same smallest row. Its rows are dealt into blocks by
    component, and those of a large component among further blocks, by the number of
    their grams, so that a block has a bounded size unless a single row exceeds it.
    """
    patch = staged(mixed.groupBy("gram").agg(F.min("part").alias("patch")), "patch-of")
    rows = mixed.join(patch, "gram").groupBy("patch", "node").agg(
        F.first("n").alias("n"), F.first("component").alias("component")
    )
    rows = staged(rows, "patch-rows")
    sizes = rows.groupBy("patch", "component").agg(F.sum("n").alias("alike"))
    whole = sizes.groupBy("patch").agg(F.sum("alike").alias("k"))
    sizes = staged(sizes.join(whole, "patch"), "sizes")
    block = F.struct(
        F.pmod(F.xxhash64("component"), F.ceil(F.col("k") / BLOCK)).alias("one"),
        F.pmod(F.xxhash64("node"), F.ceil(F.col("alike") / BLOCK)).alias("two"),
    )
    dealt = rows.join(sizes, ["patch", "component"]).withColumn("block", block)
    row = F.struct("node", "n", "component", "grams")
    blocks = dealt.join(full, "node").groupBy("patch", "block").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.collect_list(row).alias("rows")
    )
    blocks = staged(blocks, "blocks")
    dropped(patch, rows, sizes)
    return blocks


def _overlaps(g1: np.ndarray, at1: np.ndarray, k1: int, g2: np.ndarray, at2: np.ndarray, k2: int) -> np.ndarray:
    """Product (k1 x k2) of two blocks of rows, given as (gram, row) each, added up over
    blocks of the columns that both have."""
    common = np.intersect1d(g1, g2)
    overlap = np.zeros((k1, k2), dtype=np.float32)
    if not len(common):
        return overlap
    found = []
    for g, at in ((g1, at1), (g2, at2)):
        to = np.minimum(np.searchsorted(common, g), len(common) - 1)
        there = common[to] == g
        found.append((to[there], at[there]))
    for low in range(0, len(common), COLUMNS):
        width = min(COLUMNS, len(common) - low)
        parts = []
        for (to, at), k in zip(found, (k1, k2)):
            use = (to >= low) & (to < low + width)
            part = np.zeros((k, width), dtype=np.float32)
            part[at[use], to[use] - low] = 1
            parts.append(part)
        overlap += parts[0] @ parts[1].T
    return overlap


def block_products(blocks: DataFrame, p: Join) -> DataFrame:
    """Links (a, b) between rows of different components: of each pair of blocks, one link
    for each two components that any of its links join.

    Each pair of blocks of a patch is multiplied once, two blocks of one and the same
    component not at all. The pairs are dealt out by their own key, so the blocks of a
    large patch do not meet in one task.
    """
    names = blocks.select("patch", "block", "lo", "hi")
    others = names.select("patch", *(F.col(c).alias(f"{c}2") for c in ("block", "lo", "hi")))
    met = names.join(others, "patch").where("block <= block2").where(
        "NOT (lo = hi AND lo2 = hi2 AND lo = lo2)"
    )
    met = staged(met.select("patch", "block", "block2"), "met")
    one = blocks.select("patch", "block", F.col("rows").alias("one"))
    two = blocks.select("patch", F.col("block").alias("block2"), F.col("rows").alias("two"))

    def read(cell):
        rows = cell.values
        node, n, component = (rows.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        size = np.diff(rows.field(3).offsets.to_numpy())
        return node, n.astype(np.int64), component, rows.field(3).flatten().to_numpy(), np.repeat(np.arange(len(node)), size)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                node1, n1, c1, g1, at1 = read(batch.column("one")[i])
                node2, n2, c2, g2, at2 = read(batch.column("two")[i])
                overlap = _overlaps(g1, at1, len(node1), g2, at2, len(node2))
                x, y = np.nonzero((overlap >= p.overlap(n1[:, None], n2)) & (c1[:, None] != c2))
                if not len(x):
                    continue
                joined = np.sort(np.stack([c1[x], c2[y]]), axis=0)
                _, first = np.unique(joined, axis=1, return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node1[x[first]]), pa.array(node2[y[first]])], ["a", "b"]
                )

    spread = met.join(one, ["patch", "block"]).join(two, ["patch", "block2"])
    return spread.select("one", "two").mapInArrow(run, "a long, b long")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The ``members`` (gram, part, node, n) of the columns that hold several components,
    with their component and a row of the column as ``hub``, staged."""
    at = members.join(labels.withColumnRenamed("id", "node"), "node", "left")
    at = staged(at.withColumn("component", F.coalesce("component", "node")), "at")
    several = at.groupBy("gram").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.min_by(F.struct("node", "n", "component"), F.xxhash64("node")).alias("hub"),
    ).where("low != high")
    several = staged(several.select("gram", "hub"), "several")
    mixed = staged(at.join(several, "gram"), "mixed")
    dropped(at, several)
    return mixed


def components(classes: DataFrame, docs: DataFrame, p: Join) -> DataFrame:
    """(id, component) of the nodes that links hold together. ``classes``: (node, set_hash,
    id, n, dense, sampled), stored."""
    rows = heads(classes, p)
    hub = F.min(F.struct("node", "n")).alias("hub")
    columns = staged(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), hub).where("k > 1"), "columns")
    members = staged(rows.join(columns, "gram").drop("k"), "members")
    dropped(columns, rows)
    texts = class_texts(classes.join(members.select("node").distinct(), "node", "left_semi"), docs, p.width)
    first = members.where("node != hub.node").where(_similar_size("n", "hub.n", p))
    first = staged(first.select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    members = members.drop("hub")

    def linked(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
        found = multiplied(pairs, texts, p)
        labels = joined_components(labels, found)
        dropped(found)
        return labels

    labels = linked(first, None)
    mixed = _mixed(members, labels)
    second = mixed.where("component != hub.component").where(_similar_size("n", "hub.n", p))
    second = second.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))
    second = staged(second.distinct().join(first, ["a", "b"], "left_anti"), "pairs")
    dropped(mixed)
    labels = linked(second, labels)
    mixed = _mixed(members, labels)
    full = full_rows(texts.join(mixed.select("node").distinct(), "node", "left_semi"), p)
    blocks = patches(mixed.drop("hub"), full)
    found = staged(block_products(blocks, p), "links")
    labels = joined_components(labels, found)
    dropped(mixed, full, blocks, found, members, texts, first, second)
    return labels


def ngram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Join = Join()) -> DataFrame:
    """(id, n_shingles, component_id) for each row.

    Every row is a document, also one that repeats an id. Null or empty texts and texts
    without words have an empty set and stand alone; a text with fewer words than
    ``width`` has its whole sequence as the one shingle. A row without an id takes part;
    ``component_id`` is the smallest id that links reach, null if none is there. Other
    columns are not read. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    marks = staged(matrix_rows(docs, p), "rows")
    sets = matrix_rows(docs, p, chosen=True).where("n > 0").groupBy("set_hash", "n").agg(
        F.min("id").alias("id"), F.first("dense").alias("dense"), F.first("sampled").alias("sampled")
    )
    classes = staged(sets.withColumn("node", F.monotonically_increasing_id()), "classes")
    labels = components(classes, docs, p)
    at = classes.select("node", "set_hash", "id").join(labels.withColumnRenamed("id", "node"), "node", "left")
    at = staged(at.withColumn("component", F.coalesce("component", "node")), "at")
    lowest = staged(at.groupBy("component").agg(F.min("id").alias("component_id")), "lowest")
    of_set = staged(at.join(lowest, "component").select("set_hash", "component", "component_id"), "of-set")
    dropped(labels, at, lowest, classes)
    return marks.join(of_set, "set_hash", "left").select(
        "id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
