"""Byte-level BPE in recursive DuckDB queries, one database inside each task.

Texts are cut into words by the pattern of the vocabulary. A task keeps the tokens of
words it has met; new words begin as (word, position, token) rows of single bytes. Each
step of a recursive query joins the rows of neighbouring tokens with the merge table and
contracts the leftmost pair of minimum rank of every word, until no word has a pair left.
Decoding joins the tokens with the vocabulary and aggregates their bytes in order.
"""

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from typerank.llm.common import slices

#: Words a task keeps, and new words of one recursive query.
KEPT_WORDS, QUERY_WORDS = 300_000, 50_000

_CONTRACT = """
WITH RECURSIVE state(word, tokens, live) AS (
  SELECT word, list(tok ORDER BY pos), true FROM bytes_of GROUP BY word
  UNION ALL (
    WITH pairs AS (
      SELECT word, unnest(tokens[:-2]) AS lhs, unnest(tokens[2:]) AS rhs,
        generate_subscripts(tokens[2:], 1) AS pos
      FROM state WHERE live AND len(tokens) > 1
    ), lowest AS (
      SELECT p.word, min((m.merged::BIGINT << 32) + p.pos) AS best
      FROM pairs p JOIN merges m ON p.lhs = m.lhs AND p.rhs = m.rhs GROUP BY p.word
    )
    SELECT s.word,
      CASE WHEN best IS NULL THEN tokens ELSE list_concat(
        list_append(tokens[:(best & 4294967295) - 1], (best >> 32)::INT),
        tokens[(best & 4294967295) + 2:]) END,
      best IS NOT NULL
    FROM state s LEFT JOIN lowest b ON b.word = s.word WHERE s.live
  )
)
SELECT unnest(tokens) AS tok, word FROM (SELECT word, tokens FROM state WHERE NOT live ORDER BY word)
"""
_DECODE = """
SELECT unhex(string_agg(v.hex, '' ORDER BY t.pos)) AS bytes, t.doc
FROM tokens t JOIN vocabulary v ON v.tok = t.tok GROUP BY t.doc ORDER BY t.doc
"""


@dataclass(frozen=True)
class Vocabulary:
    """``path``: a rank file (base64 bytes, rank); ``pattern`` cuts texts into words."""

    path: str
    pattern: str


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(name), public_tokenizers.PATTERN)


def _ranks(vocabulary: Vocabulary) -> dict[bytes, int]:
    import base64

    with open(vocabulary.path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def _database():
    import duckdb

    return duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB"})


def _table(db, name: str, columns: dict) -> None:
    db.register("given", pa.table(columns))
    db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
    db.unregister("given")


class _Coder:
    def __init__(self, vocabulary: Vocabulary):
        import regex

        ranks = _ranks(vocabulary)
        self.words = regex.compile(vocabulary.pattern)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        #: Words met so far; words that are tokens as they stand.
        self.known = {token: np.int32(rank).tobytes() for token, rank in ranks.items()}
        self.base = dict(self.known)
        merges = [
            (left, right, rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None
        ]
        self.db = _database()
        columns = zip(*merges, strict=True) if merges else ((), (), ())
        _table(self.db, "merges", dict(zip(("lhs", "rhs", "merged"), (pa.array(c, pa.int32()) for c in columns), strict=True)))

    def learn(self, words: list[str]) -> None:
        """Tokens of new words, into ``known``."""
        coded = [w.encode() for w in words]
        self.known.update((w, self.base[c]) for w, c in zip(words, coded, strict=True) if c in self.base)
        rest = [(w, c) for w, c in zip(words, coded, strict=True) if c not in self.base]
        for first in range(0, len(rest), QUERY_WORDS):
            names, part = zip(*rest[first : first + QUERY_WORDS], strict=True)
            size = np.array([len(w) for w in part])
            start = np.cumsum(size) - size
            data = np.frombuffer(b"".join(part), dtype=np.uint8)
            rows = {
                "word": np.repeat(np.arange(len(part), dtype=np.int32), size),
                "pos": (np.arange(len(data)) - np.repeat(start, size)).astype(np.int32),
                "tok": self.byte[data],
            }
            _table(self.db, "bytes_of", {k: pa.array(v) for k, v in rows.items()})
            found = self.db.execute(_CONTRACT).fetchnumpy()
            blob = np.asarray(found["tok"], dtype=np.int32).tobytes()
            cuts = (np.searchsorted(found["word"], np.arange(len(part) + 1)) * 4).tolist()
            self.known.update(zip(names, (blob[a:b] for a, b in zip(cuts, cuts[1:])), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        words = [self.words.findall(t) if t else [] for t in texts]
        every = dict.fromkeys(w for ws in words for w in ws)
        if len(self.known) > KEPT_WORDS:
            self.known = {w: self.known[w] for w in every if w in self.known}
        self.learn([w for w in every if w not in self.known])
        return [b"".join(map(self.known.__getitem__, ws)) for ws in words]


class _Decoder:
    def __init__(self, vocabulary: Vocabulary):
        ranks = _ranks(vocabulary)
        self.valid = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.valid[list(ranks.values())] = True
        self.db = _database()
        _table(self.db, "vocabulary", {"tok": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})

    def decode(self, tokens: np.ndarray, counts: np.ndarray) -> list[bytes]:
        doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        pos = np.arange(len(tokens), dtype=np.int32)
        self.db.register("tokens", pa.table({"doc": doc, "pos": pos, "tok": tokens}))
        found = self.db.sql(_DECODE).to_arrow_table()
        self.db.unregister("tokens")
        out = [b""] * len(counts)
        for d, x in zip(found.column("doc").to_pylist(), found.column("bytes").to_pylist(), strict=True):
            out[d] = x
        return out


@functools.lru_cache(maxsize=2)
def _coder(vocabulary: Vocabulary) -> _Coder:
    return _Coder(vocabulary)


@functools.lru_cache(maxsize=2)
def _decoder(vocabulary: Vocabulary) -> _Decoder:
    return _Decoder(vocabulary)


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), column], [*kept, name])


def _schema(df: DataFrame, name: str, kind: str):
    from pyspark.sql import types as T

    fields = [f for f in df.schema.fields if f.name != name]
    return T.StructType([*fields, T.StructField(name, T.DataType.fromDDL(kind))])


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All columns of ``docs`` and the token ids of the whole text in ``ids_col``.

    Null and empty texts give an empty list. A column with the name of ``ids_col`` is
    replaced. Rows are encoded one by one: no shuffle, repeated rows stay.
    """

    def run(batches):
        coder = _coder(vocabulary)
        for whole in batches:
            for batch in slices(whole, text_col, 2 << 20):
                coded = coder.encode(batch.column(text_col).to_pylist())
                cuts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(coded), dtype=np.int32))
                yield _with_column(batch, ids_col, pa.ListArray.from_arrays(pa.array(cuts), values))

    return docs.mapInArrow(run, _schema(docs, ids_col, "array<int>"))


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the bytes of the tokens in ``bytes_col``.

    Null and empty lists give no bytes. An id that the vocabulary lacks is an error.
    """

    def run(batches):
        coder = _decoder(vocabulary)
        for batch in batches:
            lists = batch.column(ids_col)
            size = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], dtype=np.int64)
            first = 0
            while first < len(size):
                last = first + max(1, int(np.searchsorted(np.cumsum(size[first:]), 500_000)))
                part = batch.slice(first, last - first)
                ids = part.column(ids_col).flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                if len(ids) and not (coder.valid[np.clip(ids, 0, len(coder.valid) - 1)] & (ids >= 0) & (ids < len(coder.valid))).all():
                    raise ValueError("a token id is not in the vocabulary")
                out = coder.decode(ids, size[first:last])
                yield _with_column(part, bytes_col, pa.array(out, pa.binary()))
                first = last

    return rows.mapInArrow(run, _schema(rows, bytes_col, "binary"))


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each text."""
    coded = decode(encode(docs.select("doc_id", "text"), vocabulary).select("doc_id", "ids"), vocabulary)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
