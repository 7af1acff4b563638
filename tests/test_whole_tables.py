"""Queries read their tables to the end, beyond the sizes of the given ones."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from typerank.catalog import queries
from typerank.catalog.oracle import SQL
from typerank.schemas import TRAIN_QUESTIONS


def test_ltr_weights_learns_from_all_items(spark, tmp_path):
    """The items beyond the first thousand are the only ones with resource types."""
    n = TRAIN_QUESTIONS + 4
    words = "oak elm fir ash yew box".split()
    texts = [" ".join(words[(i + j) % 6] for j in range(1 + i % 4)) for i in range(12)]
    items = {"item_id": [*range(n)], "text": [f"{words[i % 6]} {words[i % 5]}" for i in range(n)]}
    # Two toxic documents make a literal question; only the last items have resource ones.
    labelled = [d for i in range(n) for d in ([i, i + n] if i < TRAIN_QUESTIONS else [i])]
    tables = {
        "benchmark": items,
        "documents": {"doc_id": [*range(12)], "text": texts, "lang": ["en"] * 12, "source": ["web"] * 12},
        "labels": {"doc_id": labelled, "toxic": [int(d % n < TRAIN_QUESTIONS) for d in labelled]},
    }
    db = duckdb.connect()
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), tmp_path / f"{name}.parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    got = dict(queries.QUERIES["ltr_weights"](spark, str(tmp_path)).collect())
    assert any(got.values())  # the first thousand have no label but 0
    want = dict(db.sql(SQL["ltr_weights"]).fetchall())
    assert {k: round(v, 6) for k, v in got.items()} == {k: round(v, 6) for k, v in want.items()}
