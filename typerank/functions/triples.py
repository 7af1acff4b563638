"""Parsing of space-separated triple lines, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from typerank.schemas import PUNCTUATION


def is_comment(line: Column) -> Column:
    return F.startswith(line, F.lit("#"))


def iri(token: Column) -> Column:
    """The token without its angle brackets."""
    return F.substring(token, F.lit(2), F.greatest(F.length(token) - 2, F.lit(0)))


def local_name(token: Column) -> Column:
    """Last path segment of a bracketed IRI, underscores as spaces."""
    last = F.element_at(F.split(iri(token), "/"), -1)
    return F.replace(F.replace(last, F.lit("_"), F.lit(" ")), F.lit("  "), F.lit(" "))


def literal_text(tokens: Column) -> Column:
    """Object literal of a split line: everything between predicate and final dot."""
    return F.array_join(
        F.slice(tokens, F.lit(3), F.greatest(F.size(tokens) - 3, F.lit(0))), " "
    )


def abstract_text(tokens: Column, n_words: int | None = None) -> Column:
    """An object literal, or its first words, without quotes, language tag and punctuation."""
    text = F.replace(
        F.replace(literal_text(tokens), F.lit('"'), F.lit("")), F.lit("@en"), F.lit("")
    )
    if n_words is not None:
        text = F.array_join(F.slice(F.split(text, " "), 1, n_words), " ")
    return F.translate(text, PUNCTUATION, "")
