"""What the tables of terms add to packed rows, block by block.

A row of numbers that many ids need, by term, is not joined to each (id, term): the ids are
dealt out to blocks, and a block gets each row that its ids need once. Its share of the
result is a sparse product inside one task, so no (id, term) is shuffled after it was packed.
"""

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The function of a block travels with its tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Entries of packed rows that a block holds, about.
ENTRIES = 500_000


def in_blocks(packed: DataFrame, size: Column, key: str = "id") -> DataFrame:
    """``packed``, a stored table, with ``block``, all rows of a block and key in one task;
    ``size`` is the number of entries of a row."""
    entries = packed.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, math.ceil(entries / ENTRIES))
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")
    default = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packed.select(block, "*").repartition(max(default, 4 * blocks), "block")


def _flat(rows: pa.Table, name: str) -> tuple[pa.Array, np.ndarray]:
    """The entries of a column of lists, and the length of each list."""
    column = rows.column(name).combine_chunks()
    return column.flatten(), pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _codes(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    found = values.dictionary_encode(null_encoding="encode")
    return found.dictionary, found.indices.to_numpy()


def label_sums(asked: pa.Table, model: pa.Table) -> pa.Table:
    """(id, category, value): what the terms of ``asked`` (id, term.., n..) add to each label
    that has any of them, by ``model`` (term, category.., value..), and without a label the
    number of terms that the model has."""
    terms, size = _flat(asked, "term")
    n = _flat(asked, "n")[0].to_numpy().astype(float)
    row = np.repeat(np.arange(len(asked)), size)
    at = pc.index_in(terms, value_set=model.column("term").combine_chunks())
    known = np.flatnonzero(at.is_valid())
    row, n, at = row[known], n[known], at.take(pa.array(known)).to_numpy()
    names, each = _flat(model, "category")
    names, label = _codes(names)
    value = _flat(model, "value")[0].to_numpy()
    first = np.cumsum(each) - each
    times = each[at]
    place = np.arange(times.sum()) + np.repeat(first[at] - (np.cumsum(times) - times), times)
    pair, inverse = np.unique(np.repeat(row, times) * max(1, len(names)) + label[place], return_inverse=True)
    sums = np.bincount(inverse, weights=np.repeat(n, times) * value[place], minlength=len(pair))
    counted = np.unique(row)
    totals = np.bincount(row, weights=n, minlength=len(asked))[counted]
    who, which = np.divmod(pair, max(1, len(names)))
    ids = asked.column("id").combine_chunks().take(pa.array(np.concatenate([who, counted])))
    category = pa.concat_arrays([names.take(pa.array(which)).cast(pa.string()), pa.nulls(len(counted), pa.string())])
    return pa.table({"id": ids, "category": category, "value": np.concatenate([sums, totals])})


def pair_matches(asked: pa.Table, found: pa.Table) -> pa.Table:
    """(id, doc_id, matched, total, most, n) of the pairs in ``asked`` (id, doc_id.., term..,
    n..), by the postings ``found`` (doc_id, term, tf): the occurrences of the query that match
    a posting, the sum of their frequencies, the greatest one, and all occurrences, as counts
    of the rows of a join. A pair or a posting that repeats counts as often."""
    docs, size = _flat(asked, "doc_id")
    docs, doc = _codes(docs)
    pair, copies = np.unique(np.repeat(np.arange(len(asked)), size) * max(1, len(docs)) + doc, return_counts=True)
    row, doc = np.divmod(pair, max(1, len(docs)))
    terms, size = _flat(asked, "term")
    n = _flat(asked, "n")[0].to_numpy()
    terms, term = _codes(terms)
    first = np.cumsum(size) - size

    def place_in(values: pa.Array, name: str) -> np.ndarray:
        return pc.index_in(found.column(name).combine_chunks(), value_set=values).to_numpy(zero_copy_only=False)

    width = max(1, len(terms))
    key = place_in(docs, "doc_id").astype(np.int64) * width + place_in(terms, "term").astype(np.int64)
    order = np.argsort(key, kind="stable")
    tf = found.column("tf").to_numpy()[order]
    key, start, times = np.unique(key[order], return_index=True, return_counts=True)
    # A last key that nothing has takes what is beyond the others.
    key = np.append(key, np.iinfo(np.int64).max)
    times = np.append(times, 0)
    total = np.append(np.add.reduceat(tf, start) if len(start) else start, 0)
    most = np.append(np.maximum.reduceat(tf, start) if len(start) else start, 0)
    each = size[row]
    place = np.arange(each.sum()) + np.repeat(first[row] - (np.cumsum(each) - each), each)
    wanted = np.repeat(doc.astype(np.int64) * width, each) + term[place]
    at = np.searchsorted(key, wanted)
    at[key[at] != wanted] = len(key) - 1
    weight = n[place] * np.repeat(copies, each)
    begin = np.cumsum(each) - each

    def sums(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, begin) if len(begin) else values

    return pa.table({
        "id": asked.column("id").combine_chunks().take(pa.array(row)),
        "doc_id": docs.take(pa.array(doc)),
        "matched": sums(weight * times[at]).astype(np.int64),
        "total": sums(weight * total[at]).astype(np.int64),
        "most": (np.maximum.reduceat(most[at], begin) if len(begin) else begin).astype(np.int64),
        "n": sums(weight * np.maximum(times[at], 1)).astype(np.int64),
    })
