"""Filters, projections and keyed joins on questions, categories and rankings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from typerank.schemas import LITERAL_LABELS


def ordered_list(order: str, value: str) -> Column:
    """Aggregate: the values of a bounded group as a list in the given order."""
    pair = F.struct(F.col(order).alias("place"), F.col(value).alias("value"))
    return F.transform(F.sort_array(F.collect_list(pair)), lambda p: p["value"])


def nonempty(questions: DataFrame) -> DataFrame:
    """Questions that have a text."""
    return questions.where("coalesce(question, '') <> ''")


def last_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last in order; combined before the shuffle."""
    others = [c for c in rows.columns if c != key]
    return (
        rows.groupBy(key)
        .agg(F.max_by(F.struct(*others), order).alias("last"))
        .select(key, *[F.col("last")[c].alias(c) for c in others])
        .select(*rows.columns)
    )


def blank_literal_types(questions: DataFrame) -> DataFrame:
    """A type list that is a single literal label becomes empty."""
    literal = (F.size("type") == 1) & F.get("type", F.lit(0)).isin(LITERAL_LABELS)
    return questions.withColumn(
        "type", F.when(literal, F.array().cast("array<string>")).otherwise(F.col("type"))
    )


def resource_types(questions: DataFrame) -> DataFrame:
    """Type lists of resource questions; empty for other categories."""
    return questions.withColumn(
        "type",
        F.when(F.col("category") == "resource", F.col("type")).otherwise(
            F.array().cast("array<string>")
        ),
    )


def known_gold_types(questions: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Drop gold types of resource questions that the hierarchy does not have.

    The lists travel as rows; a question whose list becomes empty keeps its row.
    """
    resource = F.col("category") == "resource"
    listed = questions.where(resource).select("id", F.posexplode("type").alias("pos", "type"))
    known = (
        listed.join(hierarchy.select("type"), "type", "left_semi")
        .groupBy("id")
        .agg(ordered_list("pos", "type").alias("known"))
    )
    return (
        questions.join(known, "id", "left")
        .withColumn(
            "type",
            F.when(
                resource, F.coalesce("known", F.array().cast("array<string>"))
            ).otherwise(F.col("type")),
        )
        .drop("known")
    )


def with_category(questions: DataFrame, categories: DataFrame) -> DataFrame:
    """Questions with their predicted category, joined by id, in place of a gold one."""
    return questions.drop("category").join(categories.select("id", "category"), "id", "left")


def to_retrieve(questions: DataFrame) -> DataFrame:
    """Only resource questions are sent to the retrieval."""
    return questions.where(F.col("category") == "resource")


def ranking_lists(rankings: DataFrame) -> DataFrame:
    """(id, rank, doc_id) -> (id, type), best first. The lists are top-k, so bounded."""
    return rankings.groupBy("id").agg(ordered_list("rank", "doc_id").alias("type"))


def system_output(
    questions: DataFrame, categories: DataFrame, rankings: DataFrame
) -> DataFrame:
    """(id, category, type) of every question: its ranked types where the predicted
    category is resource, else an empty list."""
    lists = ranking_lists(rankings)
    gated = F.when(F.col("category") == "resource", F.col("type"))
    return (
        with_category(questions.select("id"), categories)
        .join(lists, "id", "left")
        .select(
            "id",
            "category",
            F.coalesce(gated, F.array().cast("array<string>")).alias("type"),
        )
    )
