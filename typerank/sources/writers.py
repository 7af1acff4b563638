"""Sinks. Large lists are written as bounded parts, one row per part."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from typerank.operators.questions import ordered_list, system_output

PART = 10_000


def write_type_entities(type_entity_lists: DataFrame, path: str) -> None:
    """(type, pos, entity) -> JSON rows (type, part, entities), file order kept.

    A type may own a third of all entities, so no list holds more than ``PART``.
    """
    (
        type_entity_lists.withColumn("part", F.floor(F.col("pos") / PART))
        .groupBy("type", "part")
        .agg(ordered_list("pos", "entity").alias("entities"))
        .write.mode("overwrite")
        .json(path)
    )


def write_entity_abstracts(abstracts: DataFrame, path: str) -> None:
    abstracts.select("entity", "abstract").write.mode("overwrite").json(path)


def write_type_documents(documents: DataFrame, path: str) -> None:
    documents.select("type", "catch_all").write.mode("overwrite").json(path)


def write_categories(categories: DataFrame, path: str) -> None:
    categories.select("id", "category").write.mode("overwrite").parquet(path)


def write_category_lines(categories: DataFrame, path: str, order: str = "id") -> None:
    """One label per line, sorted by ``order`` over all part files."""
    categories.orderBy(order).select("category").write.mode("overwrite").text(path)


def write_rankings(rankings: DataFrame, path: str) -> None:
    (
        rankings.select("id", F.col("rank").cast("int"), "doc_id", "score")
        .write.mode("overwrite")
        .parquet(path)
    )


def write_ranking_lists(rankings: DataFrame, path: str) -> None:
    """JSON rows (id, type), best type first."""
    (
        rankings.groupBy("id")
        .agg(ordered_list("rank", "doc_id").alias("type"))
        .write.mode("overwrite")
        .json(path)
    )


def write_system_output(
    questions: DataFrame, categories: DataFrame, rankings: DataFrame, path: str
) -> None:
    """JSON rows (id, category, type) for the evaluator."""
    system_output(questions, categories, rankings).write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
