"""One query per operator, over its whole table, with production parameters."""

from pyspark.sql import functions as F

from typerank.llm import (
    ann,
    bpe,
    centroids,
    fingerprint,
    neardup,
    ngram_join,
    packing,
    quality,
    substring,
    toxicity,
    trie,
    urls,
    warc,
)
from typerank.llm.common import read, staged


def url_filter(spark, sf):
    """Host rules and the weighted vocabulary on every page."""
    judged = urls.judge_urls(read(spark, sf, "pages").select("page_id", "url"))
    return judged.drop("url")


def near_duplicates(spark, sf):
    """MinHash near-duplicate classes of all documents."""
    found = neardup.near_duplicates(read(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def substring_dedup(spark, sf):
    """Long repeated passages removed from all documents."""
    cut = substring.remove_repeats(read(spark, sf, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2(F.col("text"), 256).alias("kept_sha256"),
    )


def bpe_round_trip(spark, sf):
    """All documents encoded and decoded again."""
    return bpe.round_trip(read(spark, sf, "documents"), bpe.public_vocabulary())


def document_quality(spark, sf):
    """Quality of all documents by the line field, fitted on labelled ones not held out."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    field = quality.train(docs, read(spark, sf, "labels"))
    return quality.score(docs, field).select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        F.col("_quality").alias("score"),
        F.when(F.col("_quality") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def nearest_vectors(spark, sf):
    """The 20 nearest of every twentieth embedding among all others."""
    return ann.nearest(read(spark, sf, "embeddings"), "id % 20 = 0", k=20)


def warc_round_trip(spark, sf):
    """All pages written as WARC archives and read back."""
    return warc.round_trip(read(spark, sf, "pages"))


def document_toxicity(spark, sf):
    """Expected severity of all documents, fitted on labelled ones not held out."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf, "labels"))
    severity = F.col("_severity")
    return toxicity.score(docs, model).select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        severity.alias("severity"),
        F.round(severity).cast("int").alias("grade"),
        F.when(severity >= toxicity.THRESHOLD, 1).otherwise(0).alias("toxic"),
    )


def packed_sequences(spark, sf):
    """All documents packed into windows of 2048 tokens."""
    return packing.pack(read(spark, sf, "documents"), packing.public_tokens())


def fingerprints(spark, sf):
    """One-permutation fingerprints of all documents and of their edited texts."""
    found = fingerprint.edited_fingerprints(read(spark, sf, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def ngram_components(spark, sf):
    """Components of the documents that share nine tenths of their word triples."""
    return ngram_join.ngram_links(read(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


def centroid_clusters(spark, sf):
    """All embeddings clustered around eight centroids."""
    return centroids.described(*centroids.clusters(read(spark, sf, "embeddings")))


def conversation_trie(spark, sf):
    """The prefix trie of all conversations with shared histories."""
    turns = staged(trie.ordered_turns(read(spark, sf, "conversations")), "turns")
    return trie.described(trie.prefix_trie(*trie.shared_histories(turns)))


QUERIES = {
    "op1_url_filter": url_filter,
    "op2_near_duplicates": near_duplicates,
    "op3_substring_dedup": substring_dedup,
    "op4_bpe_round_trip": bpe_round_trip,
    "op5_quality": document_quality,
    "op6_nearest_vectors": nearest_vectors,
    "op7_warc_round_trip": warc_round_trip,
    "op8_packing": packed_sequences,
    "op9_toxicity": document_toxicity,
    "op10_fingerprints": fingerprints,
    "op11_ngram_join": ngram_components,
    "op12_centroids": centroid_clusters,
    "op13_prefix_trie": conversation_trie,
}
