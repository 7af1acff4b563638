"""The plans have the form that holds at scale."""

import contextlib

from pyspark.sql import functions as F

from typerank.operators import features, index, search, typedocs
from typerank.sources.stage import staged


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@contextlib.contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_hot_entity_is_split(spark, capsys):
    """One entity in a third of all rows: its partition is divided by the planner."""
    listed = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), "id")).alias("entity"),
        F.concat(F.lit("t"), F.hash("id")).alias("type"),
        F.shiftright("id", 12).alias("block"),
        F.col("id").alias("ord"),
    )
    abstracts = staged(listed.select("entity", F.lit("text").alias("abstract")).distinct())
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="2KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        pieces = typedocs.type_pieces(listed.repartition(8, "ord"), abstracts)
        total = pieces.agg(F.max(F.xxhash64(*pieces.columns)), F.count("piece"))
        assert total.collect()[0][1] == 300_000
        assert "SortMergeJoin(skew=true)" in plan_of(total, capsys)


def test_top_k_is_cut_before_the_shuffle(spark, capsys):
    docs = spark.createDataFrame([("d1", "red fox"), ("d2", "fox")], "doc_id string, catch_all string")
    built = index.build_index(docs)
    asked = spark.createDataFrame([("q", "red fox")], "id string, question string")
    terms = search.analyze_queries(asked, built)
    plan = plan_of(search.bm25_topk(terms, built, 5), capsys)
    # Below the cells the two tables; above them one exchange, of the lists that are cut.
    above, below = plan.split("FlatMapCoGroupsInArrow")
    assert above.count("Exchange") == 1 and above.count("WindowGroupLimit") == 2
    assert below.count("REPARTITION_BY_NUM") == 2 and "hashpartitioning(cell" in below


def test_a_cell_sends_the_best_only(spark, monkeypatch):
    monkeypatch.setattr(search, "PAIRS", 200)
    docs = [(f"d{i:03}", f"hot w{i % 7}") for i in range(100)]
    built = index.build_index(spark.createDataFrame(docs, "doc_id string, catch_all string"))
    asked = spark.createDataFrame([(f"q{i}", f"hot w{i % 5}") for i in range(40)], "id string, question string")
    weighted = staged(search.weighted_query(search.analyze_queries(asked, built), built))
    cells = search.grid(weighted, built)
    assert cells.shards > 2 and cells.blocks > 1
    assert search.direct_scores(weighted, built).count() == 4000
    assert search.direct_scores(weighted, built, 3).count() <= 40 * 3 * cells.shards


def test_only_the_postings_of_asked_documents_are_shuffled(spark, capsys):
    docs = spark.createDataFrame([("d1", "red fox"), ("d2", "fox")], "doc_id string, catch_all string")
    built = index.build_index(docs)
    terms = search.analyze_queries(spark.createDataFrame([("q", "fox")], "id string, question string"), built)
    pairs = spark.createDataFrame([("q", "d1")], "id string, doc_id string")
    plan = plan_of(features.query_doc_features(pairs, terms, built), capsys)
    assert "LeftSemi" in plan


def test_scans_read_only_what_they_need(spark, capsys):
    docs = spark.createDataFrame([("d1", "red fox")], "doc_id string, catch_all string")
    built = index.build_index(docs)
    plan = plan_of(built.postings.select("doc_id", "dl").distinct(), capsys)
    assert "ReadSchema: struct<doc_id:string,dl:bigint>" in plan
