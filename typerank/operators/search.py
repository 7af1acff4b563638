"""Query analysis and exact BM25 top-k for whole tables of questions.

The direct plan lays a grid over documents and queries: a cell holds the postings of one
shard of the documents and the terms of one block of the queries. Both tables are shuffled
once, to the cells, with the terms of a document or a query packed into one row. A cell is a
product of two sparse matrices with a bounded number of entries, taken for a bounded number
of pairs at a time, whatever terms are frequent on either side; its scores are added up in
one array and cut to the best k of each query there. So matches, of which there may be nearly
as many as pairs, are never rows, and at most k rows of a cell and query are shuffled again.
"""

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typerank.functions.scoring import bm25_idf, bm25_impact
from typerank.functions.text import word_tokens
from typerank.operators.index import Index
from typerank.operators.stems import stem_table
from typerank.schemas import BASELINE_DEPTH, FIRST_PASS_DEPTH
from typerank.sources.stage import staged

# The function of a cell travels with its tasks, so executors need no copy of this package.
for module in (__name__, bm25_impact.__module__):
    cloudpickle.register_pickle_by_value(sys.modules[module])

# Scores are compared after rounding to this many digits; pruning keeps a margin
# of several units of the last digit, so rounding cannot change a result.
DIGITS = 6
MARGIN = 1e-5
# More postings of a term than this made it frequent in an earlier plan; kept for callers.
SPLIT_ABOVE = 10_000
# The pruned plan adds the frequent terms to the candidates one by one, if no more than this
# share of the documents of a cell are candidates of a query.
FEW = 0.03
# Pairs of a query and a document that are scored at a time, and matches that are added to
# them at a time.
SCORED = 500_000
MATCHES = 2_000_000
# There is a cell for so many pairs, but no more than CELLS, since each copies rows, unless
# a cell would hold more than HELD postings or query terms.
PAIRS = 200_000_000
CELLS = 50
HELD = 6_000_000
# A term is multiplied as a dense row where more than this share of the pairs of a cell
# match in it: a match costs some hundred times a pair of a dense row. These rows have at
# most DENSE_CELLS entries together.
DENSE_SHARE = 0.002
DENSE_CELLS = 8_000_000
# Terms that are asked for, if no more than these, are sent to the postings.
SENT = 500_000


def query_tokens(questions: DataFrame) -> DataFrame:
    """(id, question) -> (id, pos, token) in position order, repeats kept."""
    return questions.select(
        "id", F.posexplode(word_tokens(F.col("question"))).alias("pos", "token")
    )


def analyze_queries(questions: DataFrame, index: Index) -> DataFrame:
    """(id, pos, token, term): the tokens of each question that the index has.

    ``term`` is the token as the index stores it: the stem, in a stemmed index.
    """
    known = index.term_stats.select("term")
    return (
        _indexed_tokens(questions, index).join(known, "term", "left_semi")
        .select("id", "pos", "token", "term")
    )


def _indexed_tokens(questions: DataFrame, index: Index) -> DataFrame:
    """The tokens of each question with their terms, those that the index lacks included."""
    tokens = query_tokens(questions)
    if index.stems is None:
        tokens = tokens.withColumn("term", F.col("token"))
    else:
        # Each distinct token is stemmed once.
        stems = stem_table(tokens.select(F.col("token").alias("term")))
        stems = staged(stems.select(F.col("term").alias("token"), F.col("stem").alias("term")), "stems")
        tokens = tokens.join(stems, "token")
    return tokens.select("id", "pos", "token", "term")


def field_value(index: Index, name: str) -> Column:
    """A statistic of the field, as a scalar subquery on its one-row table."""
    return index.field_stats.select(name).scalar()


def weighted_query(query_terms: DataFrame, index: Index) -> DataFrame:
    """(id, term, df, weight), weight = number of occurrences in the query x idf."""
    counts = query_terms.groupBy("id", "term").agg(F.count(F.lit(1)).alias("qtf"))
    doc_count = field_value(index, "doc_count")
    return counts.join(index.term_stats, "term").select(
        "id", "term", "df", (F.col("qtf") * bm25_idf(doc_count, F.col("df"))).alias("weight")
    )


def impacts(index: Index, *more: Column) -> DataFrame:
    """(doc_id, term, impact) of every posting, and ``more``."""
    impact = bm25_impact(F.col("tf"), F.col("dl"), field_value(index, "avgdl"))
    return index.postings.select("doc_id", "term", impact.alias("impact"), *more)


def contribution() -> Column:
    """What one posting adds to the score of its document."""
    return F.col("weight") * F.col("impact")


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """(id, doc_id, score) -> (id, rank, doc_id, score), ties by doc_id."""
    best = W.partitionBy("id").orderBy(F.desc(_units("score")), "doc_id")
    return (
        scores.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("id", "rank", "doc_id", F.round("score", DIGITS).alias("score"))
    )


def _units(score: str) -> Column:
    """The score in units of the last digit that counts."""
    return F.floor(F.col(score) * 10**DIGITS + 0.5)


@dataclass(frozen=True)
class Grid:
    """Documents in ``shards``, queries in ``blocks``. Every posting is copied to each
    block and every query term to each shard."""

    shards: int = 1
    blocks: int = 1


def grid(weighted: DataFrame, index: Index) -> Grid:
    """Cells in the proportion that copies the fewest rows."""
    docs = index.field_stats.select("doc_count").first()[0]
    postings = index.term_stats.agg(F.sum("df")).first()[0]
    terms, queries = weighted.agg(F.count(F.lit(1)), F.count_distinct("id")).first()
    if not postings or not terms:
        return Grid()
    cells = min(CELLS, max(1, math.ceil(docs * queries / PAIRS)))
    shards = min(cells, docs, max(1, round(math.sqrt(cells * postings / terms))))
    blocks = max(math.ceil(cells / shards), math.ceil(terms / HELD))
    return Grid(min(docs, max(shards, math.ceil(postings / HELD))), max(1, min(queries, blocks)))


def _numbered(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in ascending order, null first, and the place of each row's."""
    found = column.combine_chunks()
    if not pa.types.is_dictionary(found.type):
        found = found.dictionary_encode(null_encoding="encode")
    order = pc.array_sort_indices(found.dictionary, null_placement="at_start").to_numpy()
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    return found.dictionary.take(pa.array(order)), place[found.indices.to_numpy()]


def _expanded(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each run, one run after the other."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


def _floor(score: np.ndarray, k: int | None) -> np.ndarray:
    """For each row a score that its k-th best one reaches: the k-th best of the maxima of some
    groups of columns; 0 where all are among the ``k`` best."""
    n, m = score.shape
    if k is None or k >= m:
        return np.zeros(n)
    groups = min(m, 32 * k)
    wide = m // groups
    most = score[:, : groups * wide].reshape(n, wide, groups).max(axis=1)
    return np.partition(most, groups - k, axis=1)[:, groups - k]


def _reaching(score: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the positive scores that reach the least one of their row, but
    for the last digits."""
    least = np.maximum(least - MARGIN, np.nextafter(0, 1))
    return np.divmod(np.flatnonzero(score >= least[:, None]), score.shape[1])


def _best(x: np.ndarray, y: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the ``k`` best scores at the places (x, y) of each row; of equal ones the
    first count."""
    units = np.floor(score * 10**DIGITS + 0.5)
    order = np.lexsort((y, -units, x))
    x = x[order]
    return order[np.arange(len(x)) - np.searchsorted(x, x) < k]


def cell_scores(asked: pa.Table, postings: pa.Table, k: int | None, prune: bool = False) -> pa.Table:
    """(id, doc_id, score) of the queries ``asked`` (id, term, weight) on ``postings``
    (doc_id, term, impact): the ``k`` best of each query, or all. ``prune``: the frequent terms
    of a query are added only to the documents that the others bring so far that these can lift
    them among the ``k`` best. With two more columns of
    ``asked``, ``weak`` and ``cut``, the other terms of a query come first, and weak ones
    count only for the documents whose scores have reached the cut by then; only these
    documents are returned."""
    (ids, query), (docs, doc) = _numbered(asked.column("id")), _numbered(postings.column("doc_id"))
    terms = pc.unique(asked.column("term"))
    wanted, held = (pc.index_in(t.column("term"), value_set=terms).combine_chunks() for t in (asked, postings))
    there = np.flatnonzero(held.is_valid())
    held = held.fill_null(0).to_numpy()[there]
    n, m = len(ids), len(docs)
    order = np.argsort(held, kind="stable")
    held, order = held[order], there[order]
    doc, impact = doc[order], postings.column("impact").to_numpy()[order]
    least = np.zeros(n)
    weak = np.zeros(len(query), bool)
    if "cut" in asked.column_names:
        least[query] = asked.column("cut").to_numpy()
        weak = asked.column("weak").combine_chunks().to_numpy(zero_copy_only=False)
    order = np.argsort(query, kind="stable")
    query, wanted, weight, weak = query[order], wanted.to_numpy()[order], asked.column("weight").to_numpy()[order], weak[order]
    counts = np.bincount(held, minlength=len(terms))
    first = np.cumsum(counts) - counts
    # Terms that many queries share with many documents are dense rows.
    matches = counts * np.bincount(wanted, minlength=len(terms))
    often = np.argsort(-matches, kind="stable")[: DENSE_CELLS // max(1, m)]
    often = often[matches[often] > DENSE_SHARE * n * m]
    row = np.full(len(terms), -1)
    row[often] = np.arange(len(often))
    dense = np.zeros((m, len(often)))
    at = np.flatnonzero(row[held] >= 0)
    np.add.at(dense, (doc[at], row[held[at]]), impact[at])
    frequent = row[wanted] >= 0
    rare = ~frequent & (counts[wanted] > 0)
    strong = ~weak
    # The products of the dense rows are taken in single precision and again, in double
    # precision, for the pairs that can be among the best; no sum of as many positive numbers
    # is wrong by more than this share of it.
    cut = "cut" in asked.column_names
    rough = k is not None and not cut and not (weight < 0).any() and not (impact < 0).any()
    wrong = (len(often) + 4) * 2.0**-23 if rough else 0.0
    kind = np.float32 if rough else np.float64
    columns = np.ascontiguousarray(dense.T.astype(kind))

    def some(start, stop, part, taken):
        """The weights of the dense rows for the queries of ``part``."""
        found = np.zeros((stop - start, len(often)))
        these = part.start + np.flatnonzero(taken[part] & frequent[part])
        np.add.at(found, (query[these] - start, row[wanted[these]]), weight[these])
        return found

    def add(score, start, part, taken, reached=None):
        """Adds the rarer ones of the ``taken`` entries of ``part``, whose queries begin with
        ``start``, to the scores, where ``reached``."""
        these = part.start + np.flatnonzero(taken[part] & rare[part])
        q, t, w = query[these] - start, wanted[these], weight[these]
        flat = score.reshape(-1)
        ends = np.cumsum(counts[t])
        low = 0
        while low < len(t):
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + MATCHES, side="right")))
            each = counts[t[low:high]]
            place = _expanded(first[t[low:high]], each)
            pair = np.repeat(q[low:high].astype(np.int64) * m, each) + doc[place]
            value = np.repeat(w[low:high], each) * impact[place]
            if reached is not None:
                kept = reached.reshape(-1)[pair]
                pair, value = pair[kept], value[kept]
            np.add.at(flat, pair, value)
            low = high

    def reaching(score, weights):
        """Places of the pairs that can be among the best, of the rarer terms' scores."""
        whole = np.arange(len(score))
        found = []
        if prune:
            # What the others reach, and the most that the frequent terms can add.
            least = _floor(score, k) - weights @ dense.max(axis=0, initial=0) * (1 + 1e-9)
            candidates = (score >= (least - MARGIN)[:, None]) & (least > MARGIN)[:, None]
            count = candidates.sum(axis=1)
            few = (count > 0) & (count <= max(k, FEW * m))
            found.append(np.nonzero(candidates & few[:, None]))
            whole = np.flatnonzero(~few)
        product = weights[whole].astype(kind) @ columns
        wrongest = 2 * wrong * product.max(axis=1, initial=0)
        rough = score[whole] + product
        x, y = _reaching(rough, _floor(rough, k) - wrongest)
        found.append((whole[x], y))
        return tuple(np.concatenate(c) for c in zip(*found))

    found = []
    step = max(1, min(PAIRS, SCORED) // max(1, m))
    for start in range(0, n, step) if m else []:
        stop = min(n, start + step)
        low, high = np.searchsorted(query, (start, stop))
        part = slice(low, high)
        score = np.zeros((stop - start, m))
        add(score, start, part, strong)
        weights = some(start, stop, part, strong)
        if rough:
            x, y = reaching(score, weights)
            exact = np.empty(len(x))
            each = max(1, SCORED // max(1, len(often)))
            for a in range(0, len(x), each):
                at = slice(a, a + each)
                exact[at] = score[x[at], y[at]] + np.einsum("ij,ij->i", weights[x[at]], dense[y[at]])
        else:
            score += weights @ columns
            if weak[part].any() or least[start:stop].any():
                reached = (score >= least[start:stop, None]) & (score > 0)
                add(score, start, part, weak, reached)
                score += (some(start, stop, part, weak) @ columns) * reached
                score *= reached
            x, y = _reaching(score, _floor(score, k))
            exact = score[x, y]
        if k is not None:
            best = _best(x, y, exact, k)
            x, y, exact = x[best], y[best], exact[best]
        found.append((x + start, y, exact))
    x, y, score = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    return pa.table({"id": ids.take(pa.array(x)), "doc_id": docs.take(pa.array(y)), "score": score})


def _packed(rows: DataFrame, keys: list[str], values: list[str], near: bool = False) -> DataFrame:
    """One row for the keys: the numbers of its terms and the values of each, as lists.
    ``near``: the rows of a key are put together where they stand close to each other, as
    those of a document in a stored table, without a shuffle; a key may be several rows."""
    if near:
        return _packed_near(rows, keys, values)
    pairs = F.sort_array(F.collect_list(F.struct("number", *values))).alias("pairs")
    lists = (F.col("pairs")[c].alias("term" if c == "number" else c) for c in ("number", *values))
    return rows.groupBy(*keys).agg(pairs).select(*keys, *lists)


def _packed_near(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    listed = ["number", *values]
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keys]
            codes = [c.dictionary_encode(null_encoding="encode").indices.to_numpy() for c in columns]
            order = np.lexsort((batch.column(batch.schema.get_field_index("number")).to_numpy(), *codes))
            new = np.zeros(len(order), bool)
            new[0] = True
            for c in codes:
                new[1:] |= c[order][1:] != c[order][:-1]
            first = np.flatnonzero(new)
            ends = pa.array(np.append(first, len(order)), pa.int32())
            order = pa.array(order)
            lists = [pa.ListArray.from_arrays(ends, batch.column(batch.schema.get_field_index(c)).take(order)) for c in listed]
            heads = [c.take(order.take(pa.array(first))) for c in columns]
            yield pa.RecordBatch.from_arrays([*heads, *lists], [*keys, "term", *values])

    fields = [f"{c} {types[c]}" for c in keys]
    fields += [f"{'term' if c == 'number' else c} array<{types[c]}>" for c in listed]
    return rows.select(*keys, *listed).mapInArrow(run, ", ".join(fields))


def _unpacked(rows: pa.Table, avgdl: float | None = None) -> pa.Table:
    """Packed rows as one row a term, without the column of the cell; the impacts of postings
    are worked out here, from the two numbers that they depend on."""
    term = rows.column("term").combine_chunks()
    times = np.repeat(np.arange(len(rows), dtype=np.int32), pc.list_value_length(term).to_numpy(zero_copy_only=False))
    columns = {}
    for name in rows.column_names:
        column = rows.column(name).combine_chunks()
        if pa.types.is_list(column.type):
            columns[name] = column.flatten()
        elif name in ("id", "doc_id"):
            columns[name] = column.dictionary_encode(null_encoding="encode").take(pa.array(times))
        elif name == "cut":
            columns[name] = column.take(pa.array(times))
    if "tf" in columns:
        tf, dl = columns.pop("tf").to_numpy(), rows.column("dl").to_numpy()
        columns["impact"] = bm25_impact(tf, dl[times], avgdl)
    return pa.table(columns)


def _term_numbers(asking: DataFrame) -> DataFrame:
    """(term, number, blocks), stored, since both tables read them: the numbers have no gaps,
    and so are ints, which halves what each posting takes, unless there are too many."""
    part, place = F.shiftright("number", 33), F.col("number").bitwiseAND((1 << 33) - 1)
    listed = staged(asking.select("term", F.monotonically_increasing_id().alias("number"), "blocks"), "numbers")
    sizes = listed.groupBy(part.cast("int").alias("part")).agg((F.max(place) + 1).alias("n")).orderBy("part").collect()
    first, total = [], 0
    for r in sizes:
        first += [F.lit(r.part), F.lit(total)]
        total += r.n
    if not first or total >= 1 << 31:
        return listed
    number = (place + F.create_map(*first)[part.cast("int")]).cast("int")
    return listed.select("term", number.alias("number"), "blocks")


def direct_scores(weighted: DataFrame, index: Index, k: int | None = None, cells: Grid | None = None, prune: bool = False) -> DataFrame:
    """(id, doc_id, score), cell by cell: of every document with any query term or, with
    ``k``, of the best of each shard for each query. ``weighted`` may have the columns
    ``weak`` and ``cut``, one value a query (see ``cell_scores``, also for ``prune``)."""
    cells = cells or grid(weighted, index)
    spark = weighted.sparkSession
    # Fewer than the default would be exchanged again by the planner; so many that hardly
    # any task has several cells.
    default = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(default, 4 * cells.shards * cells.blocks)
    average = index.field_stats.select("avgdl").first()
    avgdl = average[0] if average else None

    def part(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(n))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    cell = (F.col("shard") * cells.blocks + F.col("block")).alias("cell")
    # Terms travel as numbers, with the blocks whose queries have the term, or null where at
    # least half of the blocks do.
    asking = weighted.select("term", part("id", cells.blocks).cast("int").alias("block")).distinct()
    asking = asking.groupBy("term").agg(F.sort_array(F.collect_list("block")).alias("blocks"))
    rare = F.when(F.size("blocks") * 2 < cells.blocks, F.col("blocks"))
    numbers = _term_numbers(asking.select("term", rare.alias("blocks")))
    keys = [c for c in ("id", "cut") if c in weighted.columns]
    values = [c for c in ("weight", "weak") if c in weighted.columns]
    asked = _packed(weighted.join(numbers.drop("blocks"), "term"), keys, values)
    asked = asked.select("*", part("id", cells.blocks).alias("block"), every(cells.shards).alias("shard"))
    asked = asked.select(cell, *keys, "term", *values).repartition(tasks, "cell")
    few = numbers.limit(SENT + 1).count() <= SENT
    postings = index.postings.join(F.broadcast(numbers) if few else numbers, "term")
    # A posting of a rarer term goes to the blocks that ask for it, the others to each block.
    postings = postings.select("*", F.explode_outer("blocks").alias("only"))
    postings = _packed(postings, ["doc_id", "dl", "only"], ["tf"], True)
    blocks = F.when(F.col("only").isNull(), F.sequence(F.lit(0), F.lit(cells.blocks - 1))).otherwise(F.array("only"))
    postings = postings.withColumn("shard", part("doc_id", cells.shards)).withColumn("block", F.explode(blocks))
    postings = postings.select(cell, "doc_id", "dl", "term", "tf").repartition(tasks, "cell")
    types = {c: t.simpleString() for df in (asked, postings) for c, t in ((f.name, f.dataType) for f in df.schema)}

    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        return cell_scores(_unpacked(one), _unpacked(two, avgdl), k, prune)

    both = asked.groupBy("cell").cogroup(postings.groupBy("cell"))
    return both.applyInArrow(run, f"id {types['id']}, doc_id {types['doc_id']}, score double")


def pruned_scores(weighted: DataFrame, index: Index, k: int) -> DataFrame:
    """(id, doc_id, score): of the documents that can be among the ``k`` best, the best of
    each shard.

    Exact, without scoring every document of every frequent term. In a cell, the rarer terms
    of a query give each document a score; the k-th best is a floor that k documents surely
    reach. The frequent terms can add so much at most, so only the documents that are no
    farther below the floor are candidates, and only to them are these terms added. All that
    is known inside the cell: no candidate is a row, and nothing more is shuffled.
    """
    return direct_scores(weighted, index, k, prune=True)


def scores(query_terms: DataFrame, index: Index, k: int, plan: str = "direct") -> DataFrame:
    """(id, doc_id, score) with at least the ``k`` best documents of each query.

    'direct' scores all documents with a query term and keeps the best of each shard,
    'pruned' adds frequent terms only to those that can be among the best; both are exact, at
    every size. The weighted terms are stored first, since both plans read them several times.
    """
    weighted = staged(weighted_query(query_terms, index), "weighted")
    if plan == "direct":
        return direct_scores(weighted, index, k)
    return pruned_scores(weighted, index, k)


def bm25_topk(
    query_terms: DataFrame, index: Index, k: int = BASELINE_DEPTH, plan: str = "direct"
) -> DataFrame:
    """(id, rank, doc_id, score): the ``k`` best documents of each query."""
    return top_k(scores(query_terms, index, k, plan), k)


def retrieve(
    questions: DataFrame, index: Index, k: int = BASELINE_DEPTH, plan: str = "direct"
) -> DataFrame:
    """Baseline retrieval: any-term match on the text field, ``k`` best documents. Texts are
    shuffled by id and their terms counted where they are; the weights drop unknown terms."""
    placed = questions.select("id", "question").repartition("id")
    return bm25_topk(_indexed_tokens(placed, index), index, k, plan)


def first_pass(
    query_terms: DataFrame, index: Index, k: int = FIRST_PASS_DEPTH, plan: str = "direct"
) -> DataFrame:
    """Candidate retrieval of the learning-to-rank method."""
    return bm25_topk(query_terms, index, k, plan)


def multi_field_topk(
    query_terms: dict[str, DataFrame], indexes: dict[str, Index], k: int = FIRST_PASS_DEPTH
) -> DataFrame:
    """Retrieval over several fields: a document scores its best field.

    A document among the ``k`` best is so in its best field as well, so each field needs
    to give its ``k`` best only.
    """
    per_field = None
    for field, index in indexes.items():
        hits = bm25_topk(query_terms[field], index, k).drop("rank")
        per_field = hits if per_field is None else per_field.unionByName(hits)
    return top_k(per_field.groupBy("id", "doc_id").agg(F.max("score").alias("score")), k)
