"""Cleaning and tokenizing of text, as column expressions that stay in the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from typerank.schemas import PUNCTUATION_WITHOUT_PERIOD, QUESTION_WORDS, STOP_WORDS

TAG = "<[^>]+>"
# Unicode white space, spelled out because regex engines differ on \s.
SPACES = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
LONG_WORD = r"[\p{L}\p{N}_]{2,}"
# Word breaks as in the text segmentation of Unicode: apostrophes and periods stay inside a
# word between two letters, these and commas and semicolons between two digits.
APOSTROPHES = r"'\x{2019}\x{ff07}"
MIDDLE = rf"{APOSTROPHES}\x{{2018}}."
PART = r"[\p{L}\p{N}_]+"
WORD = rf"{PART}(?:(?:(?<=\p{{L}})[{MIDDLE}](?=\p{{L}})|(?<=\p{{N}})[{MIDDLE},;](?=\p{{N}})){PART})*"
# An apostrophe and s at the end of a word.
POSSESSIVE = rf"(?<=\p{{L}})[{APOSTROPHES}][sS](?![\p{{L}}\p{{N}}_]|[{MIDDLE}]\p{{L}})"


def strip_tags(text: Column) -> Column:
    """Replace every markup tag by a space."""
    return F.regexp_replace(text, TAG, " ")


def punctuation_to_space(text: Column) -> Column:
    """Replace ASCII punctuation, except the period, by spaces."""
    return F.translate(
        text, PUNCTUATION_WITHOUT_PERIOD, " " * len(PUNCTUATION_WITHOUT_PERIOD)
    )


def words(text: Column) -> Column:
    """Lower-case and split on white space; no empty strings."""
    return F.filter(F.split(F.lower(text), SPACES), lambda w: w != "")


def without(tokens: Column, stop_words: list[str]) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(stop_words))


def clean_words(text: Column, stop_words: list[str]) -> Column:
    return without(words(punctuation_to_space(strip_tags(text))), stop_words)


def preprocess(text: Column) -> Column:
    """Question text as the category classifier sees it."""
    return F.array_join(clean_words(text, STOP_WORDS), " ")


def clean_query(text: Column) -> Column:
    """Question text as the baseline retrieval sees it: question words go too."""
    return F.array_join(clean_words(text, STOP_WORDS + QUESTION_WORDS), " ")


def vectorizer_tokens(text: Column) -> Column:
    """Lower-cased words of two or more characters (classifier features)."""
    return F.regexp_extract_all(F.lower(text), F.lit(LONG_WORD), F.lit(0))


def word_tokens(text: Column) -> Column:
    """Lower-cased words in position order, possessives removed: the analysis of queries and
    of documents. "O'Neil's 3.14 U.S. dollars" -> o'neil, 3.14, u.s, dollars."""
    plain = F.regexp_replace(text, POSSESSIVE, "")
    return F.regexp_extract_all(F.lower(plain), F.lit(WORD), F.lit(0))


def index_tokens(text: Column) -> Column:
    """Document analysis before stemming: possessives and stop words removed."""
    return without(word_tokens(text), STOP_WORDS)


def counted(tokens: Column) -> Column:
    """The distinct tokens of a list in ascending order, each with its number, as structs
    (term, n): the sorted list is cut where the run of a token ends."""

    def run_ends(ordered: Column) -> Column:
        after = F.slice(ordered, F.lit(2), F.size(ordered))
        last = F.zip_with(ordered, after, lambda a, b: F.when(b.isNull() | (a != b), a))
        ends = F.transform(last, lambda t, i: F.struct(t.alias("term"), (i + 1).alias("end")))
        return F.filter(ends, lambda e: e["term"].isNotNull())

    def run_lengths(ends: Column) -> Column:
        before = F.slice(F.concat(F.array(F.lit(0)), ends["end"]), F.lit(1), F.size(ends))
        return F.zip_with(
            ends, before, lambda e, b: F.struct(e["term"].alias("term"), (e["end"] - b).cast("bigint").alias("n"))
        )

    # A list of one list, so that the steps before are taken once.
    ends = F.get(F.transform(F.array(F.sort_array(tokens)), run_ends), F.lit(0))
    return F.get(F.transform(F.array(ends), run_lengths), F.lit(0))
