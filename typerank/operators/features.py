"""The nine ranking features of (query, document) pairs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from typerank.functions.scoring import idf
from typerank.functions.text import counted
from typerank.operators.blocks import in_blocks, pair_matches
from typerank.operators.index import Index
from typerank.operators.search import SENT, field_value
from typerank.schemas import FEATURES
from typerank.sources.stage import staged


def term_counts_per_query(query_terms: DataFrame, raw_lookup: bool = False) -> DataFrame:
    """(id, term, n): repeats in a query become a count before any join.

    ``raw_lookup`` looks up the query tokens as they are, unstemmed, in a stemmed
    index, so only terms that are their own stem count.
    """
    term = F.col("token") if raw_lookup else F.col("term")
    return query_terms.groupBy("id", term.alias("term")).agg(F.count(F.lit(1)).alias("n"))


def query_features(
    query_terms: DataFrame, index: Index, raw_lookup: bool = False
) -> DataFrame:
    """Length and idf statistics of each query. The average is over all kept tokens,
    also those without statistics."""
    known = term_counts_per_query(query_terms, raw_lookup).join(
        index.term_stats, "term", "left"
    )
    value = idf(field_value(index, "doc_count"), F.col("df"))
    return (
        known.withColumn("idf", value)
        .groupBy("id")
        .agg(
            F.sum("n").cast("double").alias("query_length"),
            F.coalesce(F.sum(F.col("n") * F.col("idf")), F.lit(0.0)).alias("query_sum_idf"),
            F.coalesce(F.max("idf"), F.lit(0.0)).alias("query_max_idf"),
        )
        .withColumn("query_avg_idf", F.col("query_sum_idf") / F.col("query_length"))
    )


def doc_features(doc_ids: DataFrame, index: Index) -> DataFrame:
    """Length of each document, 0 where the index does not have it."""
    return (
        doc_ids.select("doc_id")
        .distinct()
        .join(index.doc_stats, "doc_id", "left")
        .select("doc_id", F.coalesce("dl", F.lit(0)).cast("double").alias("doc_length_catch_all"))
    )


def query_doc_features(
    pairs: DataFrame, query_terms: DataFrame, index: Index, raw_lookup: bool = False
) -> DataFrame:
    """Match statistics of each (id, doc_id) pair; repeats of a query term count.

    The documents and terms of a query travel as one row, in blocks; a block gets each
    posting that its pairs need once. No (pair, term) is a row.
    """
    term = F.col("token") if raw_lookup else F.col("term")
    terms = query_terms.groupBy("id").agg(counted(F.collect_list(term)).alias("entries"))
    listed = pairs.groupBy("id").agg(F.collect_list(F.struct("doc_id")).alias("pairs"))
    asked = listed.join(terms, "id").select(
        "id", F.col("pairs.doc_id"), F.col("entries.term"), F.col("entries.n")
    )
    placed = in_blocks(staged(asked, "asked"), F.size("doc_id") * F.size("term"))
    needed = (
        placed.select("block", "term", F.explode("doc_id").alias("doc_id"))
        .select("block", "doc_id", F.explode("term").alias("term"))
        .distinct()
    )
    # Only the postings of the documents asked for are shuffled; so many documents are sent to
    # where the postings are stored.
    wanted = staged(pairs.select("doc_id").distinct(), "wanted")
    if wanted.limit(SENT + 1).count() <= SENT:
        wanted = F.broadcast(wanted)
    postings = index.postings.select("doc_id", "term", "tf").join(wanted, "doc_id", "left_semi")
    found = needed.join(postings, ["doc_id", "term"]).select(F.col("block").alias("to"), "doc_id", "term", "tf")
    types = {c: pairs.schema[c].dataType.simpleString() for c in ("id", "doc_id")}
    both = placed.groupBy("block").cogroup(found.groupBy("to"))
    matched = both.applyInArrow(
        pair_matches,
        f"id {types['id']}, doc_id {types['doc_id']}, matched long, total long, most long, n long",
    )
    total = F.col("total").cast("double")
    return matched.select(
        "id",
        "doc_id",
        F.col("matched").cast("double").alias("unique_query_terms_in_catch_all"),
        total.alias("sum_TF_catch_all"),
        F.col("most").cast("double").alias("max_TF_catch_all"),
        (total / F.col("n")).alias("avg_TF_catch_all"),
    )


def ltr_features(
    pairs: DataFrame, query_terms: DataFrame, index: Index, raw_lookup: bool = False
) -> DataFrame:
    """All nine features in their fixed order. Query features are computed once per
    query and document features once per document, not once per pair."""
    return (
        query_doc_features(pairs, query_terms, index, raw_lookup)
        .join(query_features(query_terms, index, raw_lookup), "id")
        .join(doc_features(pairs, index), "doc_id")
        .select("id", "doc_id", *FEATURES)
    )
