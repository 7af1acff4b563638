"""How often the rows of large tables are shuffled."""

import pytest
from pyspark.sql import functions as F

from typerank.operators import blocks, classify, evaluation, features, hierarchy, index, search
from typerank.sources.stage import staged


@pytest.fixture
def exchanges(spark):
    """Shuffles of a plan in which no join side is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def count(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")

    yield count
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def tree(spark):
    types = [("A", 1, "T"), ("B", 2, "A"), ("C", 2, "A"), ("D", 3, "B")]
    found = {"A": ["A"], "B": ["B", "A"], "C": ["C", "A"], "D": ["D", "B", "A"]}
    return spark.createDataFrame([(t, d, found[t]) for t, d, _ in types], "type string, depth int, path array<string>")


def test_most_specific_shuffles_types_once_by_id(spark, tree, exchanges, rows):
    listed = [("p", "A"), ("p", "D"), ("p", "C"), ("p", "C"), ("q", "B"), ("q", "X"), ("r", None), (None, "A"), (None, "B")]
    types = spark.createDataFrame(listed, "id string, type string")
    found = hierarchy.most_specific(types, tree)
    # Both sides to the paths, then the rows with theirs.
    assert exchanges(found) <= 3
    want = [("p", "D"), ("p", "C"), ("q", "B"), ("q", "X"), ("r", None), (None, "A"), (None, "B")]
    assert rows(found) == sorted(want, key=repr)


def test_predictions_and_gold_are_shuffled_once_by_question(spark, tree, exchanges, rows):
    predicted = [("p", 0, "A"), ("p", 1, "D"), ("p", 1, "D"), ("p", 2, "C"), ("p", 3, None), ("q", 0, "X"), ("z", 0, "A"), (None, 0, "A")]
    predicted = spark.createDataFrame(predicted, "id string, pos int, type string")
    gold = spark.createDataFrame([("p", "B"), ("q", "X"), (None, "A")], "id string, type string")
    found = evaluation.predicted_distances(predicted, gold, tree)
    assert exchanges(found) <= 6
    want = [("p", 0, "A", 1), ("p", 1, "D", 1), ("p", 2, "C", None), ("p", 3, None, None), ("q", 0, "X", None)]
    assert rows(found) == sorted(want, key=repr)


def test_ideal_gains_shuffle_related_types_once(spark, tree, exchanges, rows):
    gold = spark.createDataFrame([("p", "B"), ("p", "C"), ("q", "A")], "id string, type string")
    for depth in (None, 2):
        found = evaluation.ideal_gains(gold, tree, F.lit(3), depth)
        assert exchanges(found) <= 3
        places = {(i, pos) for i, pos, _ in rows(found)}
        most = {"p": 4, "q": 4} if depth is None else {"p": 2, "q": 2}
        assert places == {(i, pos) for i, n in most.items() for pos in range(n)}


def test_all_ideal_gains_shuffle_no_related_type(spark, tree, exchanges, rows):
    """Where gold types are apart in a tree; any other gold types give the same gains."""
    listed = [("p", "B"), ("p", "C"), ("q", "A"), ("r", "X"), ("s", "D"), ("s", "C")]
    gold = spark.createDataFrame(listed, "id string, type string")
    found = evaluation.ideal_gains(gold, tree, F.lit(3))
    assert exchanges(found) == 0
    assert found.schema == evaluation._related_gains(gold, tree, F.lit(3)).schema
    assert rows(found) == rows(evaluation._related_gains(gold, tree, F.lit(3)))
    more = spark.createDataFrame([*listed, ("t", "A"), ("t", "D"), ("u", "C"), ("u", "C"), (None, "B"), (None, "A")], gold.schema)
    found = evaluation.ideal_gains(more, tree, F.lit(3))
    assert rows(found) == rows(evaluation._related_gains(more, tree, F.lit(3)))
    twice = tree.union(tree).union(spark.createDataFrame([("D", 3, ["D", "C", "A"])], tree.schema))
    found = evaluation.ideal_gains(more, twice, F.lit(3))
    assert rows(found) == rows(evaluation._related_gains(more, twice, F.lit(3)))


def test_postings_are_counted_where_the_texts_are(spark, exchanges, rows):
    listed = [("1", "ox cow ox"), ("1", "ox cow ox"), ("1", "hen"), ("2", "the"), ("3", None), (None, "owl")]
    documents = spark.createDataFrame(listed, "doc_id string, catch_all string")
    plain = index.document_postings(documents)
    placed = index.document_postings(index.by_document(documents))
    # Only the texts are shuffled, and tokens are taken once, after that.
    assert exchanges(plain) == exchanges(placed) == 1
    assert "regexp_extract_all" not in below_exchange(placed)
    want = [("1", "ox", 4, 3), ("1", "cow", 2, 3), ("1", "hen", 1, 1), (None, "owl", 1, 1)]
    assert rows(plain) == rows(placed) == sorted(want, key=repr)


def test_term_counts_shuffle_texts_only(spark, exchanges, rows):
    listed = [(1, "a", "ox cow ox"), (1, "a", "ox"), (1, "b", "cow"), (2, "a", None), (None, "a", "owl"), (3, "a", "")]
    asked = spark.createDataFrame(listed, "id int, category string, question string")
    found = classify.term_counts(asked, keep=("category",))
    assert exchanges(found) == 1
    assert "regexp_extract_all" not in below_exchange(found)
    want = [(1, "a", "ox", 3), (1, "a", "cow", 1), (1, "b", "cow", 1), (None, "a", "owl", 1)]
    assert rows(found) == sorted(want, key=repr)


def test_bayes_shuffles_no_entry_by_term(spark, exchanges, rows, monkeypatch):
    """Where the model is not broadcast, packed rows go to blocks, and a block gets each term
    once; the result does not depend on the number of blocks."""
    listed = [(f"d{i}", f"ox{i % 7} cow cow hen{i % 5}", "abc"[i % 3], i % 2 == 0) for i in range(40)]
    listed += [("d1", "ox3 cow", "a", True), (None, "cow", "b", False), ("e", "", "c", False)]
    asked = spark.createDataFrame(listed, "id string, question string, category string, annotated boolean")
    whole = rows(classify.nb_predict_together(asked, "annotated"))
    monkeypatch.setattr(blocks, "ENTRIES", 20)
    found = classify.nb_predict_together(asked, "annotated")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "hashpartitioning(id" in plan
    assert "Generate inline" not in plan
    assert len(whole) == 42 and rows(found) == whole


def test_pair_features_count_rows_that_repeat(spark, exchanges, rows, monkeypatch):
    """In blocks of any size, as the rows of a join of pairs, terms and postings would."""
    postings = [("d", "ox", 2, 3), ("d", "cow", 1, 3), ("d", "cow", 4, 5), ("e", "hen", 1, 1)]
    postings = spark.createDataFrame(postings, "doc_id string, term string, tf long, dl long")
    built = index.Index(postings, None, None, None)
    terms = [("p", "ox"), ("p", "cow"), ("p", "cow"), ("p", "no"), ("q", "hen"), (None, "ox")]
    terms = spark.createDataFrame(terms, "id string, term string")
    pairs = [("p", "d"), ("p", "d"), ("p", "e"), ("q", "e"), ("q", None), (None, "d"), ("r", "d")]
    pairs = spark.createDataFrame(pairs, "id string, doc_id string")
    want = [("p", "d", 10.0, 24.0, 4.0, 2.0), ("p", "e", 0.0, 0.0, 0.0, 0.0), ("q", "e", 1.0, 1.0, 1.0, 1.0), ("q", None, 0.0, 0.0, 0.0, 0.0)]
    for n in (2, 1000):
        monkeypatch.setattr(blocks, "ENTRIES", n)
        found = features.query_doc_features(pairs, terms, built)
        assert "hashpartitioning(id" not in found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == sorted(want, key=repr)


def test_postings_go_only_to_the_blocks_that_ask_for_them(spark, rows, monkeypatch):
    docs = spark.createDataFrame([(f"d{i}", f"hot x{i}") for i in range(30)], "doc_id string, catch_all string")
    built = index.build_index(docs)
    asked = spark.createDataFrame([(f"q{i}", f"hot x{i}") for i in range(30)], "id string, question string")
    weighted = staged(search.weighted_query(search.analyze_queries(asked, built), built))
    one = rows(search.direct_scores(weighted, built, None, search.Grid(2, 1)))
    seen = []
    packed = search._packed
    monkeypatch.setattr(search, "_packed", lambda *a: seen.append(packed(*a)) or seen[-1])
    assert rows(search.direct_scores(weighted, built, None, search.Grid(2, 8))) == one
    copies = seen[1].select("doc_id", "only", F.size("term").alias("n")).collect()
    # The rare term of a document goes to one block, the frequent one to each.
    assert sorted((r.doc_id, r.n) for r in copies if r.only is not None) == sorted((f"d{i}", 1) for i in range(30))
    assert sorted((r.doc_id, r.n) for r in copies if r.only is None) == sorted((f"d{i}", 1) for i in range(30))


def below_exchange(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("Exchange hashpartitioning"):]


@pytest.mark.parametrize("stem", [False, True])
def test_postings_are_packed_where_they_are_stored(spark, rows, monkeypatch, stem):
    """Without a shuffle by term or document, in an index of stems too."""
    docs = spark.createDataFrame([(f"d{i}", f"hot cold runs w{i}") for i in range(30)], "doc_id string, catch_all string")
    built = index.build_index(docs, stem=stem)
    asked = spark.createDataFrame([(f"q{i}", f"hot running w{i}") for i in range(9)], "id string, question string")
    weighted = staged(search.weighted_query(search.analyze_queries(asked, built), built))
    seen, packed = [], search._packed
    monkeypatch.setattr(search, "_packed", lambda *a: seen.append(packed(*a)) or seen[-1])
    whole = rows(search.direct_scores(weighted, built, None, search.Grid(3, 2)))
    assert "Exchange hashpartitioning" not in seen[1]._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(search, "SENT", 0)
    assert rows(search.direct_scores(weighted, built, None, search.Grid(3, 2))) == whole
    together = built.postings.select("doc_id", F.monotonically_increasing_id().alias("at")).groupBy("doc_id")
    widths = together.agg((F.max("at") - F.min("at") + 1 - F.count("at")).alias("gaps")).select("gaps").distinct()
    assert rows(widths) == [(0,)]


def test_the_pruned_plan_stores_no_more_than_the_direct_one(spark, monkeypatch):
    docs = spark.createDataFrame([(f"d{i}", f"hot x{i % 9} y{i % 4}") for i in range(60)], "doc_id string, catch_all string")
    built = index.build_index(docs)
    asked = spark.createDataFrame([("q", "hot x3 y1"), ("r", "hot")], "id string, question string")
    terms = search.analyze_queries(asked, built)
    names, kept = [], search.staged
    monkeypatch.setattr(search, "staged", lambda df, name="table": names.append(name) or kept(df, name))
    one = search.scores(terms, built, 5, "pruned").count()
    pruned, names[:] = sorted(names), []
    assert search.scores(terms, built, 5, "direct").count() == one and pruned == sorted(names)


def test_postings_of_other_documents_are_not_shuffled(spark, exchanges):
    """Few documents are sent to the postings, also where no join side counts as small."""
    docs = spark.createDataFrame([(f"d{i}", f"hot x{i}") for i in range(9)], "doc_id string, catch_all string")
    built = index.build_index(docs)
    terms = search.analyze_queries(spark.createDataFrame([("q", "hot x1")], "id string, question string"), built)
    pairs = spark.createDataFrame([("q", "d1"), ("q", "d3")], "id string, doc_id string")
    found = features.query_doc_features(pairs, terms, built)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [doc_id" in plan and "LeftSemi" in plan
    assert found.count() == 2
