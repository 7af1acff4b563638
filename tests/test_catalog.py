import duckdb
import pytest

import __spark_entry__ as entry
from typerank.catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ROWS_ONLY = {
    "ltr_rerank_forest",
}
# The slower half of the queries is left to the driver's own comparison.
COMPARED = [
    "triples_entity_types",
    "triples_entity_abstracts",
    "type_entity_lists",
    "type_documents",
    "type_postings",
    "index_documents",
    "index_reloaded",
    "html_preprocess",
    "clean_query",
    "nonempty_questions",
    "literal_types_blanked",
    "postings",
    "field_stats",
    "analyzed_query_terms",
    "bm25_top10",
    "bm25_top10_pruned",
    "ltr_training_set",
    "stemmed_postings",
    "index_upserted",
    "word_breaks",
    "ltr_weights",
    "count_features",
    "tfidf_l2",
    "nb_predict",
    "type_path",
    "question_scores",
    "evaluation_diagnostics",
    "end_to_end_baseline",
]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_every_query_has_sql_or_says_why_not():
    assert set(QUERIES) - set(entry.oracle_sql()) == ROWS_ONLY
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, db, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    want = db.sql(entry.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns

    def plain(frame):
        return frame[columns].astype(str).sort_values(columns).values.tolist()

    assert plain(got) == plain(want)


def test_orders_reach_every_rule(spark):
    scores = entry.queries()["question_scores"](spark, "/root/testdata/sf0.01")
    assert {r.rule for r in scores.select("rule").distinct().collect()} == set(range(1, 7))


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "rank", "doc_id", "score"]
