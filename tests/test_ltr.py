import json

import pytest
from pyspark.sql import functions as F

from typerank.operators import index, ltr, questions, search
from typerank.plans import runs
from typerank.schemas import FEATURES
from typerank.sources import readers, writers

DOCS = [("city", "red fox red city"), ("river", "fox river"), ("lake", "blue whale fox lake")]
QUESTIONS = [
    ("a", "red fox", "resource", ["lake", "new", "city", "lake"]),
    ("b", "fox fox", "literal", ["date"]),
    ("c", None, "resource", ["city"]),
    ("d", "nothing known", "resource", ["city"]),
    ("e", "blue lake", "boolean", ["boolean"]),
]
SCHEMA = "id string, question string, category string, type array<string>"


@pytest.fixture(scope="module")
def built(spark):
    return index.build_index(spark.createDataFrame(DOCS, "doc_id string, catch_all string"))


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(QUESTIONS, SCHEMA).withColumn("ord", F.monotonically_increasing_id())


def test_candidates_keep_order(spark, rows):
    hits = spark.createDataFrame([("q", 1, "x"), ("q", 2, "y")], "id string, rank int, doc_id string")
    gold = spark.createDataFrame(
        [("q", 0, "y"), ("q", 1, "n"), ("q", 2, "m"), ("other", 0, "x")],
        "id string, pos int, doc_id string",
    )
    assert rows(ltr.candidates(hits, gold)) == [
        ("q", 1, "x"), ("q", 2, "y"), ("q", 3, "n"), ("q", 4, "m"),
    ]


def test_training_set(train, built):
    by_query = ltr.training_set(train, built)
    assert by_query.columns == ["id", "doc_id", *FEATURES, "label"]
    labels = {(r.id, r.doc_id): r.label for r in by_query.collect()}
    assert set(labels) == {
        ("a", "city"), ("a", "river"), ("a", "lake"), ("a", "new"),
        ("b", "city"), ("b", "river"), ("b", "lake"), ("e", "lake"),
    }
    assert {k for k, v in labels.items() if v} == {k for k in labels if k[0] == "a"}
    by_document = ltr.training_set(train, built, label_mode="document")
    relevant = {(r.id, r.doc_id) for r in by_document.where("label = 1").collect()}
    assert relevant == {("a", "city"), ("a", "lake"), ("a", "new")}


@pytest.mark.parametrize(
    "fit",
    [
        ltr.fit_ranker,
        lambda t: ltr.fit_ranker(t, loss="squaredError"),
        lambda t: ltr.fit_forest_ranker(t, trees=10),
    ],
)
def test_rerank_permutes_first_pass(spark, train, built, fit, tmp_path):
    model = fit(ltr.training_set(train, built))
    writers.save_model(model, str(tmp_path / "model"))
    model = readers.load_model(str(tmp_path / "model"))
    asked = train.select("id", "question")
    first = ltr.rankings(None, asked, built)
    again = ltr.rankings(model, asked, built, use_model=True)
    assert {(r.id, r.doc_id) for r in first.collect()} == {(r.id, r.doc_id) for r in again.collect()}
    by_id = {}
    for r in again.orderBy("id", "rank").collect():
        assert r.score == r.score
        by_id.setdefault(r.id, []).append((r.rank, r.score))
    for ranked in by_id.values():
        assert [rank for rank, _ in ranked] == list(range(1, len(ranked) + 1))
        assert [s for _, s in ranked] == sorted((s for _, s in ranked), reverse=True)


def test_equal_scores_reverse_the_first_pass(spark, rows):
    class Constant:
        def transform(self, features):
            return features.withColumn("prediction", F.lit(1.0))

    hits = spark.createDataFrame([("q", 1, "x"), ("q", 2, "y")], "id string, rank int, doc_id string")
    assert rows(ltr.rerank(Constant(), hits, hits.select("id", "doc_id"))) == [
        ("q", 1, "y", 1.0), ("q", 2, "x", 1.0),
    ]


def test_question_projections(spark, train, rows):
    blank = questions.blank_literal_types(train).select("id", "type")
    assert dict(blank.collect())["b"] == [] and dict(blank.collect())["c"] == ["city"]
    only = questions.resource_types(train).select("id", "type")
    assert dict(only.collect())["e"] == [] and dict(only.collect())["d"] == ["city"]


def test_question_files(spark, rows, tmp_path):
    path = tmp_path / "train.json"
    records = [dict(zip(("id", "question", "category", "type"), q)) for q in QUESTIONS]
    records.append({**records[0], "question": "again"})
    path.write_text(json.dumps(records))
    read = readers.read_questions(spark, str(path), array=True)
    assert dict(rows(read.select("id", "question")))["a"] == "again"
    assert readers.read_labelled_questions(spark, str(path), array=True).count() == 5
    first, rest = readers.train_split(read, 2)
    assert [r.id for r in first.orderBy("ord").collect()] == ["b", "c"]
    assert rest.count() == 0


def test_system_output_and_files(spark, rows, tmp_path):
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    predicted = spark.createDataFrame(
        [("a", "resource"), ("b", "literal"), ("c", "resource")], "id string, category string"
    )
    ranked = spark.createDataFrame(
        [("a", 2, "y", 1.0), ("a", 1, "x", 2.0), ("b", 1, "x", 2.0)],
        "id string, rank int, doc_id string, score double",
    )
    writers.write_rankings(ranked, str(tmp_path / "rankings"))
    ranked = readers.read_rankings(spark, str(tmp_path / "rankings"))
    writers.write_system_output(asked, predicted, ranked, str(tmp_path / "output"))
    back = spark.read.schema("id string, category string, type array<string>").json(
        str(tmp_path / "output")
    )
    assert rows(back) == [
        ("a", "resource", ["x", "y"]),
        ("b", "literal", []),
        ("c", "resource", []),
        ("d", None, []),
    ]
    writers.write_ranking_lists(ranked, str(tmp_path / "lists"))
    assert spark.read.json(str(tmp_path / "lists")).count() == 2


def test_runs(spark, train, built):
    test = spark.createDataFrame([("t", "where is the red fox"), ("u", "blue whale")], "id string, question string")
    predicted = spark.createDataFrame([("t", "resource"), ("u", "literal")], "id string, category string")
    baseline = {r.id: r.type for r in runs.baseline_output(test, predicted, built).collect()}
    assert baseline == {"t": ["city", "river", "lake"], "u": []}
    output = {r.id: r.type for r in runs.ltr_output(train, test, predicted, built).output.collect()}
    assert sorted(output["t"]) == ["city", "lake", "river"] and output["u"] == []


def test_first_pass_over_further_fields(spark):
    docs = spark.createDataFrame(
        [("fox", "fox", "red hound"), ("dog", "dog", "blue fox")], "doc_id string, type string, catch_all string"
    )
    text = index.build_index(docs.select("doc_id", "catch_all"), unique=True)
    names = index.build_index(docs.select("doc_id", "type"), text="type", unique=True)
    asked = spark.createDataFrame([("q", "fox")], "id string, question string")
    assert [r.doc_id for r in ltr.rankings(None, asked, text).collect()] == ["dog"]
    both = ltr.rankings(None, asked, text, fields={"type": names})
    assert {r.doc_id for r in both.collect()} == {"dog", "fox"}


def test_registered_run_searches_the_names_too(spark, monkeypatch):
    from typerank.catalog import inputs, queries

    folder, asked = "/root/testdata/sf0.001", []
    hits = ltr.field_hits

    def field_hits(questions, terms, index, k, fields=None):
        asked.append((index, fields))
        return hits(questions, terms, index, k, fields)

    monkeypatch.setattr(ltr, "field_hits", field_hits)
    queries.QUERIES["end_to_end_ltr"](spark, folder).count()
    # The training set and the ranking.
    text, names = inputs.type_index(spark, folder), inputs.type_name_index(spark, folder)
    assert asked == [(text, {"type": names})] * 2
