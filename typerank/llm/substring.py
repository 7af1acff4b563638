"""Removal of long repeated passages by compaction of a De Bruijn graph of word windows.

Edges are windows of ``width`` words, nodes the ``width - 1`` words that two windows in a
row share. An edge that starts at two places of the corpus is repeated. Repeated edges
whose inner node has one way in and one way out are compacted into paths, every occurrence
of a path gets its source coordinates, and the words there are compared before the passage
is removed.

How it runs: texts are dealt once into chunks of a few MB, stored bucketed by chunk, so
that later steps read them in place. A task hashes the windows of a chunk with numpy and
sends each distinct hash once, packed by hash range; the task of a range counts over all
chunks and answers each chunk with a few bits a hash. Three such exchanges are made, each a
grouping by range and a join by chunk: of anchors (minimizers, a twelfth of the positions),
of the edges whose anchor is repeated, with the hashes before and after them, and of the
compacted paths, with a digest of the words at their source coordinates. Group sizes are
bounded by the chunk and range sizes, whatever the number of copies of a passage.
"""

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from typerank.llm.common import Words, mix, span_hashes, staged
from typerank.sources.stage import new_folder

WIDTH = 35
#: Words of an anchor, bytes of text in a chunk.
ANCHOR, CHUNK_BYTES = 11, 4 << 20
MAX_BUCKETS = 100_000

_PACKED = "bucket int, chunk long, hashes binary, before binary, after binary, flags binary"
_ANSWER = "chunk long, kind int, bucket int, bits binary"
_MANY, _IN, _OUT = 1, 2, 4


def _chunks(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Texts dealt into chunks: (chunk, id, text, row), with all columns of a row in ``row``."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(8, -(-size // CHUNK_BYTES))
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    dealt = docs.select(
        F.pmod(F.xxhash64(id_, F.octet_length(text)), F.lit(n)).alias("chunk"),
        F.coalesce(id_.cast("string"), F.lit("")).alias("id"),
        text.alias("text"),
        F.struct(*rest).alias("row"),
    )
    name = f"llm_chunks_{uuid.uuid4().hex}"
    buckets = min(n, MAX_BUCKETS)
    (
        dealt.repartition(buckets, "chunk")
        .write.bucketBy(buckets, "chunk")
        .option("path", new_folder(spark, "llm-chunks"))
        .saveAsTable(name)
    )
    return spark.table(name), n


class _Chunk:
    """Windows of one chunk in a fixed order, and what the answers say about them."""

    def __init__(self, table: pa.Table, width: int, n: int):
        self.n, self.width = n, width
        self.number = table.column("chunk")[0].as_py()
        table = table.sort_by([("id", "ascending"), ("text", "ascending")]).combine_chunks()
        self.rows = table.column("row").combine_chunks()
        self.words = Words(table.column("text").combine_chunks())
        bounds = self.words.bounds
        #: First word and hash of each window; windows of a text stand in a row.
        self.first, self.hashes = self.words.windows(width)
        self.row = np.searchsorted(bounds, self.first, side="right") - 1
        self.starts_text = np.ones(len(self.first), dtype=bool)
        self.starts_text[1:] = self.row[1:] != self.row[:-1]
        self.ends_text = np.roll(self.starts_text, -1)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(smallest short-window hash of each window, hashes at all such places)."""
        k = min(ANCHOR, self.width)
        span = self.width - k + 1
        at, short = self.words.windows(k, seed=5)
        g = np.full(len(self.words.starts), ~np.uint64(0), dtype=np.uint64)
        g[at] = np.maximum(short, np.uint64(1))
        low = _slide(g, span, np.minimum)
        least = np.zeros(len(g) + span, dtype=np.uint64)
        least[self.first + span - 1] = low[self.first]
        chosen = _slide(least, span, np.maximum)[: len(g)] == g
        return low[self.first], g[chosen & (g != ~np.uint64(0))]

    def told(self, answers: dict, kind: int, hashes: np.ndarray, n_bits: int) -> list[np.ndarray]:
        """Bits of the sorted distinct ``hashes``, as answered range by range."""
        bucket = _bucket(hashes, self.n)
        cuts = np.searchsorted(bucket, np.arange(self.n + 1))
        out = [np.zeros(len(hashes), dtype=bool) for _ in range(n_bits)]
        for b in np.flatnonzero(np.diff(cuts)):
            size = cuts[b + 1] - cuts[b]
            bits = np.unpackbits(np.frombuffer(answers[kind, int(b)], dtype=np.uint8))
            for i in range(n_bits):
                out[i][cuts[b] : cuts[b + 1]] = bits[i * size : (i + 1) * size]
        return out

    def candidates(self, answers: dict) -> np.ndarray:
        """Numbers of the windows whose anchor stands at two places or more."""
        least, chosen = self.anchors()
        chosen = np.unique(chosen)
        (many,) = self.told(answers, 0, chosen, 1)
        return np.flatnonzero(many[np.searchsorted(chosen, least)]) if len(least) else np.zeros(0, np.int64)


def _slide(x: np.ndarray, span: int, op) -> np.ndarray:
    """op over x[i : i + span] for each i; shorter at the end."""
    out, size = x.copy(), 1
    while size * 2 <= span:
        out[:-size] = op(out[:-size], out[size:])
        size *= 2
    rest = span - size
    if rest:
        out[:-rest] = op(out[:-rest], out[rest:])
    return out


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _packed(chunk: _Chunk, hashes, before=None, after=None):
    """Distinct hashes of a chunk, a row for each range."""
    order = np.argsort(hashes)
    values = hashes[order]
    first = np.flatnonzero(np.concatenate([[len(values) > 0], values[1:] != values[:-1]]))
    if not len(first):
        return
    count = np.diff(np.append(first, len(values)))
    flags = np.where(count > 1, _MANY, 0).astype(np.uint8)
    values = values[first]
    sides = []
    for side, bit in ((before, _IN), (after, _OUT)):
        if side is not None:
            side = side[order]
            flags |= np.where(np.minimum.reduceat(side, first) != np.maximum.reduceat(side, first), bit, 0).astype(np.uint8)
            sides.append(side[first])
    cuts = np.searchsorted(_bucket(values, chunk.n), np.arange(chunk.n + 1))
    full = np.flatnonzero(np.diff(cuts))
    part = lambda x: pa.array([x[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary())
    none = pa.nulls(len(full), pa.binary())
    yield pa.table(
        [
            pa.array(full, pa.int32()), pa.array([chunk.number] * len(full), pa.int64()), part(values),
            *((part(s) for s in sides) if sides else (none, none)), part(flags),
        ],
        names=["bucket", "chunk", "hashes", "before", "after", "flags"],
    )


def _answers(kind: int, table: pa.Table) -> pa.Table:
    """Counts the hashes of one range over all chunks; the answers to each chunk."""
    blob = lambda name, of: [np.frombuffer(x, dtype=of) for x in table.column(name).to_pylist()]
    parts = blob("hashes", np.uint64)
    hashes, flags = np.concatenate(parts), np.concatenate(blob("flags", np.uint8))
    order = np.argsort(hashes)
    ordered = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    many = np.diff(np.append(first, len(ordered))) > 1
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ordered))))
    back = np.empty(len(order), dtype=np.int64)
    back[order] = group
    seen = np.bitwise_or.reduceat(flags[order], first)
    told = [many | (seen & _MANY > 0)]
    if kind:
        for name, bit in (("before", _IN), ("after", _OUT)):
            side = np.concatenate(blob(name, np.uint32 if kind == 1 else np.uint64))[order]
            told.append((np.minimum.reduceat(side, first) != np.maximum.reduceat(side, first)) | (seen & bit > 0))
    bits, at = [], 0
    for x in parts:
        own = back[at : at + len(x)]
        bits.append(np.packbits(np.concatenate([t[own] for t in told])).tobytes())
        at += len(x)
    n = table.num_rows
    return pa.table(
        [table.column("chunk").cast(pa.int64()), pa.array([kind] * n, pa.int32()), table.column("bucket").cast(pa.int32()), pa.array(bits, pa.binary())],
        names=["chunk", "kind", "bucket", "bits"],
    )


def _replies(table: pa.Table) -> dict:
    columns = (table.column(c).to_pylist() for c in ("kind", "bucket", "bits"))
    return {(kind, bucket): bits for kind, bucket, bits in zip(*columns, strict=True)}


def _path_starts(chunk: _Chunk, answers: dict) -> tuple[np.ndarray, np.ndarray]:
    """(repeated windows, whether each begins a path)."""
    at = chunk.candidates(answers)
    distinct = np.unique(chunk.hashes[at])
    many, way_in, way_out = (
        x[np.searchsorted(distinct, chunk.hashes[at])] for x in chunk.told(answers, 1, distinct, 3)
    )
    at, way_in, way_out = at[many], way_in[many], way_out[many]
    begins = np.ones(len(at), dtype=bool)
    begins[1:] = (np.diff(at) > 1) | chunk.starts_text[at[1:]] | way_in[1:] | way_out[:-1]
    return at, begins


def _lengths(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the windows that begin a path, windows of each path)."""
    start = np.flatnonzero(begins)
    return start, np.diff(np.append(start, len(begins)))


def _verified(chunk: _Chunk, answers: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, path) of each path whose words were the same at
    all its places."""
    at, begins = _path_starts(chunk, answers)
    start, length = _lengths(begins)
    path = chunk.hashes[at[start]]
    distinct = np.unique(path)
    many, one, two = chunk.told(answers, 2, distinct, 3)
    good = (many & ~one & ~two)[np.searchsorted(distinct, path)]
    return at[start[good]], length[good], path[good]


def _answered(chunks: DataFrame, n: int, width: int) -> DataFrame:
    """The answers to each chunk about its anchors, edges and paths."""

    def anchors(table):
        chunk = _Chunk(table, width, n)
        return next(_packed(chunk, chunk.anchors()[1]), _EMPTY)

    def edges(table, told):
        chunk = _Chunk(table, width, n)
        at, h = chunk.candidates(_replies(told)), chunk.hashes
        high = (h >> np.uint64(32)).astype(np.uint32)
        before = np.where(chunk.starts_text, np.uint32(0), np.roll(high, 1))[at]
        after = np.where(chunk.ends_text, np.uint32(0), np.roll(high, -1))[at]
        return next(_packed(chunk, h[at], before, after), _EMPTY)

    def compact(table, told):
        chunk = _Chunk(table, width, n)
        at, begins = _path_starts(chunk, _replies(told))
        start, length = _lengths(begins)
        words, first = chunk.words, chunk.first[at[start]]
        # The words at the source coordinates, one space between them.
        data, digests = words.data.tobytes(), []
        for a, b in zip(first, first + length + width - 1, strict=True):
            span = data[words.starts[a] : words.ends[b - 1]]
            digests.append(hashlib.blake2b(b" ".join(span.split()), digest_size=16).digest())
        digest = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)
        return next(_packed(chunk, chunk.hashes[at[start]], digest[:, 0], digest[:, 1]), _EMPTY)

    by_chunk = chunks.select("chunk", "id", "text", "row").groupBy("chunk")
    answer = lambda kind, packed: staged(
        packed.groupBy("bucket").applyInArrow(lambda table: _answers(kind, table), _ANSWER), "answers"
    )
    told = answer(0, by_chunk.applyInArrow(anchors, _PACKED))
    told = told.union(answer(1, by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(edges, _PACKED)))
    return told.union(answer(2, by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(compact, _PACKED)))


def repeated_paths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, first_word, n_words, path): all verified occurrences of the compacted paths.

    ``path`` names a path; its occurrences in a text overlap where a graph node branches.
    """
    chunks, n = _chunks(docs, id_col, text_col)

    def rows(table, told):
        chunk = _Chunk(table, width, n)
        first, length, path = _verified(chunk, _replies(told))
        row, word = chunk.row[first], chunk.first[first]
        return pa.table(
            [
                chunk.rows.take(pa.array(row)), pa.array(word - chunk.words.bounds[row], pa.int32()),
                pa.array(length + width - 1, pa.int32()), pa.array(path.view(np.int64)),
            ],
            names=["row", "first_word", "n_words", "path"],
        )

    texts = chunks.select("chunk", "id", "text", "row").groupBy("chunk")
    out = texts.cogroup(_answered(chunks, n, width).groupBy("chunk")).applyInArrow(
        rows, f"row {chunks.schema['row'].dataType.simpleString()}, first_word int, n_words int, path long"
    )
    return out.select(F.col(f"row.`{id_col}`").alias("id"), "first_word", "n_words", "path")


_EMPTY = pa.table(
    {"bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int64())}
    | {c: pa.array([], pa.binary()) for c in ("hashes", "before", "after", "flags")}
)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """All columns of ``docs``, with the repeated words gone from the text, plus
    ``_n_words`` and ``_n_removed``, which replace columns of these names.

    A word goes if a window of ``width`` words covers it whose words also start anywhere
    else, in the same text or another; windows are judged on the input. Kept words are
    joined by one space. Null and empty texts become empty, with no words. Rows that repeat
    an id are texts of their own, so their shared windows go from all of them. Texts
    shorter than ``width`` words are never cut. An empty table gives an empty result.
    """
    docs = docs.drop("_n_words", "_n_removed")
    chunks, n = _chunks(docs, id_col, text_col)
    answers = _answered(chunks, n, width)
    names = [c for c in docs.columns if c != text_col]

    def cut(table, told):
        chunk = _Chunk(table, width, n)
        words = chunk.words
        window, length, _ = _verified(chunk, _replies(told))
        first = chunk.first[window]
        change = np.zeros(len(words.starts) + 1, dtype=np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, first + length + width - 1, -1)
        keep = np.cumsum(change[:-1]) == 0
        text_no = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
        kept = np.flatnonzero(keep)
        left = np.bincount(text_no[kept], minlength=len(words.bounds) - 1)
        # Kept words and the byte after each but the last of a text, made a space.
        inside = np.zeros(len(words.data) + 1, dtype=np.int8)
        inside[words.starts[kept]] += 1
        inside[words.ends[kept]] -= 1
        use = np.cumsum(inside[:-1]) > 0
        gap = words.ends[kept[:-1][text_no[kept[1:]] == text_no[kept[:-1]]]]
        data = words.data.copy()
        data[gap] = 0x20
        use[gap] = True
        offsets = np.concatenate([[0], np.cumsum(use)])[words.offsets]
        text = pa.Array.from_buffers(
            pa.string(), len(left), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[use])]
        )
        n_words = np.diff(words.bounds)
        return pa.table(
            [chunk.rows, text, pa.array(n_words, pa.int64()), pa.array(n_words - left, pa.int64())],
            names=["row", "text", "_n_words", "_n_removed"],
        )

    row_type = chunks.schema["row"].dataType.simpleString()
    texts = chunks.select("chunk", "id", "text", "row")
    out = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        cut, f"row {row_type}, text string, _n_words long, _n_removed long"
    )
    columns = {c: F.col(f"row.`{c}`") for c in names} | {text_col: F.col("text")}
    return out.select(*(columns[c].alias(c) for c in docs.columns), "_n_words", "_n_removed")
