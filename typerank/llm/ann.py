"""Nearest neighbours by multiprobe p-stable hashing, for the largest inner product.

Vectors are lifted by one component so that all have the same length; then the largest
inner product is the smallest distance. Each table hashes a vector by the cells of a few
Gaussian projections. A query visits, in every table, its own cell and those next to it
in the order of their estimated success: the squared distances to the cell borders that a
perturbation crosses, smallest sum first. The candidates of all tables are merged and
ranked by the exact inner product of the original vectors.

Cells are packed while they are read, one row for the vectors of a cell in an Arrow batch,
and so are the queries that probe a cell; a join meets them block by block. A cell that
holds most vectors is many rows. Each task keeps the best candidates of its queries only.
"""

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from typerank.llm.common import mix, staged


@dataclass(frozen=True)
class Index:
    """``cell`` is the width of a cell in units of the longest vector's length."""

    tables: int = 4
    projections: int = 4
    cell: float = 1.5
    probes: int = 30
    seed: int = 3


_CELLS = "key long, ids binary, vectors binary"
#: Candidates a task holds before it keeps the best of each query, and vectors of a block.
HELD, BLOCK = 1_000_000, 4096
#: Vectors for each of the tasks that a cell is dealt to.
SPREAD = 100_000
#: Numbers that are multiplied together at a time.
CELLS = 1 << 22
#: Vectors for each part of the queries whose candidates one task merges.
PART = 256


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): rows with an id whose vector is not null, not zero, and all finite."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
        .where("id IS NOT NULL AND v IS NOT NULL")
        .where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    )


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _projected(x: np.ndarray, longest: float, p: Index, query: bool) -> np.ndarray:
    """(vector, table, projection) positions in cell widths."""
    size = np.linalg.norm(x, axis=1)
    if query:
        # Only the direction of a query counts; its lift is zero.
        x, lift = x / size[:, None], np.zeros(len(x))
    else:
        x = x / longest
        lift = np.sqrt(np.maximum(0.0, 1.0 - (size / longest) ** 2))
    rng = np.random.default_rng(p.seed)
    a = rng.normal(size=(x.shape[1] + 1, p.tables * p.projections))
    b = rng.uniform(0, 1, p.tables * p.projections)
    at = np.concatenate([x, lift[:, None]], axis=1) @ a / p.cell + b
    return at.reshape(len(x), p.tables, p.projections)


def _key(cells: np.ndarray, tables: np.ndarray) -> np.ndarray:
    key = mix(tables.astype(np.uint64) + np.uint64(1))
    key = np.broadcast_to(key, cells.shape[:-1]).copy()
    for i in range(cells.shape[-1]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cells[..., i].astype(np.int64).view(np.uint64))
    return key


def _packed(keys: np.ndarray, ids: np.ndarray, x: np.ndarray):
    """One row for the vectors of each key, of at most BLOCK vectors."""
    order = np.argsort(keys, kind="stable")
    keys, ids, x = keys[order], ids[order], x[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    cuts = [c for a, b in zip(first, [*first[1:], len(keys)]) for c in range(a, b, BLOCK)] + [len(keys)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(keys[cuts[:-1]].view(np.int64)),
            pa.array([ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.array([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        ],
        ["key", "ids", "vectors"],
    )


def _blocks(vectors: DataFrame, keys_of) -> DataFrame:
    """``keys_of``: vectors -> (row numbers, keys)."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("v")).astype(np.float64)
                rows, keys = keys_of(x)
                yield from _packed(keys, batch.column("id").to_numpy()[rows], x[rows])

    return vectors.select("id", "v").mapInArrow(run, _CELLS)


def _merged(blocks: DataFrame, parts: int) -> DataFrame:
    """The rows of a key put together, up to BLOCK vectors a row, so that a join of many small
    rows is one of few. ``parts``: a key is dealt to as many tasks."""
    salt = F.pmod(F.xxhash64("ids"), F.lit(parts)).alias("salt")
    placed = blocks.select("key", salt, "ids", "vectors").repartition("key", "salt").sortWithinPartitions("key", "salt")

    def run(batches):
        now, ids, vectors, n, done = None, [], [], 0, []

        def packed():
            columns = zip(*done, strict=True)
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["key", "ids", "vectors"])

        size = 0
        for batch in batches:
            for k, s, i, v in zip(*(batch.column(c).to_pylist() for c in ("key", "salt", "ids", "vectors")), strict=True):
                if (k, s) != now or n + len(i) // 8 > BLOCK:
                    if n:
                        done.append((now[0], b"".join(ids), b"".join(vectors)))
                        size += n
                    if size > BLOCK:
                        yield packed()
                        done, size = [], 0
                    now, ids, vectors, n = (k, s), [], [], 0
                ids.append(i)
                vectors.append(v)
                n += len(i) // 8
        if n:
            done.append((now[0], b"".join(ids), b"".join(vectors)))
        if done:
            yield packed()

    return placed.mapInArrow(run, _CELLS)


def index_blocks(vectors: DataFrame, longest: float, p: Index) -> DataFrame:
    def keys_of(x):
        cells = np.floor(_projected(x, longest, p, query=False))
        keys = _key(cells, np.arange(p.tables))
        return np.repeat(np.arange(len(x)), p.tables), keys.ravel()

    return _blocks(vectors, keys_of)


def probe_blocks(queries: DataFrame, longest: float, p: Index) -> DataFrame:
    moves = np.array(list(itertools.product((-1, 0, 1), repeat=p.projections)))
    probes = min(p.probes, len(moves))

    def keys_of(x):
        at = _projected(x, longest, p, query=True)
        cells = np.floor(at)
        over = at - cells
        cost = over**2 @ (moves == -1).T + (1 - over) ** 2 @ (moves == 1).T
        best = np.argsort(cost, axis=-1, kind="stable")[..., :probes]
        keys = _key(cells[:, :, None, :] + moves[best], np.arange(p.tables)[:, None])
        return np.repeat(np.arange(len(x)), p.tables * probes), keys.ravel()

    return _blocks(queries, keys_of)


def _best(query: np.ndarray, other: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k best different candidates of each query; ties to the smaller id."""
    if not len(query):
        return np.zeros(0, dtype=np.int64)
    order = np.lexsort((other, -score, query))
    q, o = query[order], other[order]
    new = np.concatenate([[True], (q[1:] != q[:-1]) | (o[1:] != o[:-1])])
    order, q = order[new], q[new]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[place < k]


def _may_repeat(x: np.ndarray) -> bool:
    """Whether rows may be equal: of those that are, a sum in one order is the same."""
    sums = (x * np.random.default_rng(1).normal(size=x.shape[1])).sum(axis=1)
    return len(np.unique(sums)) < len(sums)


def _floor(score: np.ndarray, k: int) -> np.ndarray:
    """For each row a score that its k-th best one reaches: the k-th best of the maxima of some
    groups of columns."""
    n, m = score.shape
    groups = min(m, 32 * k)
    wide = m // groups
    most = score[:, : groups * wide].reshape(n, wide, groups).max(axis=1)
    return np.partition(most, groups - k, axis=1)[:, groups - k]


def _met(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """(query, candidate, score) of the k best of the block for its queries, some queries
    at a time. Blocks may hold any number of equal vectors: of those only the k + 1
    smallest ids can be among the k best, as one of them may be the query's own."""
    if _may_repeat(x):
        whole = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
        same = np.unique(whole, return_inverse=True)[1]
        few = np.sort(_best(same, ids, np.zeros(len(ids)), k + 1))
        ids, x = ids[few], x[few]
    rows, pairs = max(1, CELLS // max(1, len(ids))), max(1, CELLS // x.shape[1])
    longest = np.sqrt((x * x).sum(axis=1).max(initial=0.0))
    for a in range(0, len(q), rows):
        own, some = qids[a : a + rows], q[a : a + rows]
        about = some @ x.T
        mine = np.flatnonzero(np.isin(own, ids))
        about[mine] = np.where(own[mine, None] == ids[None, :], -np.inf, about[mine])
        if len(ids) > k:
            # Products are wrong by their last digits, so a little less will do.
            wrong = 4 * x.shape[1] * np.finfo(float).eps * np.sqrt((some * some).sum(axis=1)) * longest
            least = _floor(about, k) - wrong - 1e-12
            i, j = np.divmod(np.flatnonzero((about >= least[:, None]) & (about > -np.inf)), len(ids))
        else:
            i, j = np.nonzero(about > -np.inf)
        # The score is summed in one fixed order, so equal vectors tie exactly.
        score = np.empty(len(i))
        for b in range(0, len(i), pairs):
            at = slice(b, b + pairs)
            score[at] = (some[i[at]] * x[j[at]]).sum(axis=1)
        best = _best(own[i], ids[j], score, k)
        yield own[i][best], ids[j][best], score[best]


_FOUND = "part int, qids binary, ids binary, scores binary"


def _ranked(met: DataFrame, k: int, dimension: int, parts: int) -> DataFrame:
    """The k best candidates of each query in each task, one row for each part of the
    queries."""

    def run(batches):
        held, n = [], 0

        def kept():
            query, other, score = (np.concatenate(c) for c in zip(*held, strict=True))
            best = _best(query, other, score, k)
            return query[best], other[best], score[best]

        def packed(columns):
            part = (mix(columns[0].view(np.uint64)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            full, first = np.unique(part[order], return_index=True)
            cuts = [*first, len(part)]
            blobs = (
                pa.array([c[order][x:y].tobytes() for x, y in zip(cuts, cuts[1:])], pa.binary()) for c in columns
            )
            return pa.RecordBatch.from_arrays([pa.array(full), *blobs], ["part", "qids", "ids", "scores"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("qids", "queries", "ids", "vectors")), strict=True):
                qids, ids = np.frombuffer(row[0], np.int64), np.frombuffer(row[2], np.int64)
                q = np.frombuffer(row[1], np.float64).reshape(-1, dimension)
                x = np.frombuffer(row[3], np.float64).reshape(-1, dimension)
                for found in _met(qids, q, ids, x, k):
                    held.append(found)
                    n += len(found[0])
                    if n > HELD:
                        held = [kept()]
                        n = len(held[0][0])
                        if n > HELD // 2:
                            yield packed(held.pop())
                            n = 0
        if n:
            yield packed(kept())

    return met.select("qids", "queries", "ids", "vectors").mapInArrow(run, _FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) from the candidates of all tasks, part by part."""

    def merge(table):
        blob = lambda name, of: np.frombuffer(b"".join(table.column(name).to_pylist()), of)
        query, other, score = blob("qids", np.int64), blob("ids", np.int64), blob("scores", np.float64)
        best = _best(query, other, score, k)
        query = query[best]
        first = np.flatnonzero(np.concatenate([[len(query) > 0], query[1:] != query[:-1]]))
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query)))) + 1
        return pa.table(
            [pa.array(query), pa.array(rank, pa.int32()), pa.array(other[best]), pa.array(score[best])],
            names=["query_id", "rank", "vec_id", "score"],
        )

    return found.groupBy("part").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")


def nearest(
    rows: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", p: Index = Index()
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row where ``is_query``
    holds (SQL on ``id``), among all other rows, nearest first, ties to the smaller id.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor
    rows without an id, nor vectors of another dimension than most. Candidates that share
    the query's id are the query itself. Repeated rows count once. A query whose probes
    meet fewer than ``k`` candidates is compared with all vectors, in blocks, so that it
    gets ``k`` whenever there are as many. An empty table gives an empty result. Other
    columns are not read.
    """
    vectors = usable(rows, id_col, vector_col)
    shape = (
        vectors.groupBy(F.size("v").alias("dimension"))
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.reduce("v", F.lit(0.0), lambda s, x: s + x * x)).alias("square"))
        .orderBy(F.col("n").desc(), "dimension").limit(1).collect()
    )
    dimension, n, square = shape[0] if shape else (1, 0, 1.0)
    longest = float(np.sqrt(square))
    vectors = vectors.where(F.size("v") == dimension)
    queries = vectors.where(is_query)
    dealt = max(1, n // SPREAD)
    cells = _merged(index_blocks(vectors, longest, p), dealt)
    probes = _merged(probe_blocks(queries, longest, p), dealt).select("key", F.col("ids").alias("qids"), F.col("vectors").alias("queries"))
    parts = max(1, n // PART)
    candidates = staged(_ranked(cells.join(probes, "key"), k, dimension, parts), "candidates")
    found = staged(_top(candidates, k), "neighbours")
    # Queries that met too few candidates.
    count = found.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("met"))
    short = queries.join(count, "id", "left").where(F.coalesce("met", F.lit(0)) < min(k, max(n - 1, 0)))
    alone = lambda x: (np.arange(len(x)), np.zeros(len(x), dtype=np.uint64))
    few = staged(_blocks(short, alone).select(F.col("ids").alias("qids"), F.col("vectors").alias("queries")), "short")
    if few.limit(1).count():
        every = _blocks(vectors, alone).select("ids", "vectors")
        found = _top(candidates.union(_ranked(every.crossJoin(few), k, dimension, parts)), k)
    return found
