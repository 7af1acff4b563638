"""Sum-of-squares online packing of token sequences.

Documents arrive one by one. Full windows are cut off a document; its rest goes to the
fill level for which the sum of the squared counts of partially filled windows, over all
levels, is smallest afterwards. The counts stand in an array with one cell a level. What is
still open at the end of a partition is joined and cut into full windows and at last into
windows of a power of two, which need no padding.
"""

import functools
import os
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from typerank.llm.common import slices, text_bytes

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


@dataclass(frozen=True)
class Tokens:
    """``path``: a tokenizer file; ``ranks``: the same vocabulary as ranks, which gives
    the same ids faster for texts of Latin letters (code points below U+0280)."""

    path: str
    ranks: str | None
    pattern: str
    end_id: int = 1


def public_tokens() -> Tokens:
    import public_tokenizers as p

    return Tokens(p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)


@functools.lru_cache(maxsize=2)
def _encoders(tokens: Tokens):
    import base64

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(tokens.path)
    added = [t.content for t in exact.get_added_tokens_decoder().values()]
    if not tokens.ranks:
        return exact, None, added
    with open(tokens.ranks, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=tokens.pattern, mergeable_ranks=ranks, special_tokens={})
    return exact, fast, added


def token_ids(column: pa.Array, tokens: Tokens) -> list[np.ndarray]:
    """Ids of each text with the end id after them; null is an empty text.

    An added token of the tokenizer file that stands in a text has its own id; the ranks
    do not know it, so such texts go to the tokenizer.
    """
    exact, fast, added = _encoders(tokens)
    texts = [t or "" for t in column.to_pylist()]
    out: list = [None] * len(texts)
    if fast is not None:
        data, offsets = text_bytes(column)
        high = np.concatenate([[0], np.cumsum(data >= 0xCA)])[offsets]
        for i in np.flatnonzero(np.diff(high) == 0):
            if not any(a in texts[i] for a in added):
                out[i] = fast.encode_ordinary(texts[i])
    rest = [i for i, ids in enumerate(out) if ids is None]
    coded = exact.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)
    for i, ids in zip(rest, coded, strict=True):
        out[i] = ids.ids
    return [np.array([*ids, tokens.end_id], dtype="<u4") for ids in out]


class Packer:
    """Windows of one partition. A piece is [doc_id, start, ids, doc_tokens]."""

    def __init__(self, size: int, first_id: int):
        self.size, self.next_id = size, first_id
        #: Open windows of each fill level, and their counts; level 0 is a new window.
        self.open: list[list] = [[] for _ in range(size)]
        self.counts = np.zeros(size + 1, dtype=np.int64)
        self.rows: list[tuple] = []

    def close(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), doc_tokens, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.size:
            self.close([[doc_id, start, ids[start : start + self.size], total]])
            start += self.size
        if start < total:
            self.place([doc_id, start, ids[start:], total])

    def place(self, piece: list) -> None:
        """The level with the least change of the sum of squares takes the piece."""
        n, counts = len(piece[2]), self.counts
        levels = np.concatenate([[0], np.flatnonzero(counts[: self.size - n + 1])])
        left = np.where(levels > 0, 1 - 2 * counts[levels], 0)
        joined = np.where(levels + n < self.size, 1 + 2 * counts[levels + n], 0)
        # Of equal changes the fuller window is taken.
        change = left + joined
        level = int(levels[np.flatnonzero(change == change.min())[-1]])
        window = self.open[level].pop() if level else []
        if level:
            counts[level] -= 1
        window.append(piece)
        if level + n == self.size:
            self.close(window)
        else:
            self.open[level + n].append(window)
            counts[level + n] += 1

    def finish(self) -> None:
        """Joins the open windows, fullest first, and cuts full windows and then windows
        of falling powers of two."""
        pieces = [p for level in reversed(self.open) for window in level for p in window]
        left, window, room = sum(len(p[2]) for p in pieces), [], 0
        for doc_id, start, ids, total in pieces:
            while len(ids):
                if not room:
                    room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
                part = ids[:room]
                window.append([doc_id, start, part, total])
                start, ids, room, left = start + len(part), ids[len(part) :], room - len(part), left - len(part)
                if not room:
                    self.close(window)
                    window = []
        self.open, self.counts[:] = [[] for _ in range(self.size)], 0


def pack(docs: DataFrame, tokens: Tokens, size: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every text, null and empty ones too, ends with the end id and so has a piece. Rows that
    repeat an id are documents of their own. Each partition packs its own rows; the high
    bits of ``sequence_id`` are the partition. Other columns are not read. Open windows are
    the only state: their number grows far more slowly than the documents.
    """

    def run(batches):
        packer = Packer(size, TaskContext.get().partitionId() << 40)

        def rows():
            columns, packer.rows = list(zip(*packer.rows, strict=True)), []
            if columns:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )

        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                ids = batch.column("id").to_pylist()
                for doc_id, coded in zip(ids, token_ids(batch.column("text"), tokens), strict=True):
                    packer.add(doc_id, coded)
                yield from rows()
        packer.finish()
        yield from rows()

    chosen = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS id", f"`{text_col}` AS text")
    return chosen.mapInArrow(run, PIECES)
