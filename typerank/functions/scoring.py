"""Scoring formulas, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from typerank.schemas import BM25_B, BM25_K1


def idf(doc_count: Column, df: Column) -> Column:
    """Plain inverse document frequency, as the ranking features use it."""
    return F.ln(doc_count / df)


def bm25_idf(doc_count: Column, df: Column) -> Column:
    return F.ln(1 + (doc_count - df + 0.5) / (df + 0.5))


def bm25_impact(
    tf: Column, dl: Column, avgdl: Column, k1: float = BM25_K1, b: float = BM25_B
) -> Column:
    """Length-normalised share of a term in a document, between 0 and 1."""
    return tf / (tf + k1 * (1 - b + b * dl / avgdl))


def smooth_idf(n_docs: Column, df: Column) -> Column:
    return F.ln((1 + n_docs) / (1 + df)) + 1


def discount(pos: Column) -> Column:
    """DCG discount of a zero-based position."""
    return 1 / F.log2(pos + 2)


def linear_gain(distance: Column, max_depth: Column) -> Column:
    return 1 - distance / max_depth
