"""Porter stems of a vocabulary, as column expressions.

The distinct terms are stemmed once and the stems are joined back to the postings. A word
is a string of vowels and consonants, where y is a vowel after a consonant. Such a y is
written Y while a word is worked on, so the measure of a stem (its number of vowel runs
followed by consonants) and the other conditions are regular expressions, and each step of
the algorithm is one case expression that stays in generated code.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The suffix rules of the published Porter algorithm.
STEP_2 = (
    "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent "
    "eli:e ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful "
    "ousness:ous aliti:al iviti:ive biliti:ble logi:log"
)
STEP_3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
STEP_4 = (
    "al: ance: ence: er: ic: able: ible: ant: ement: ment: ent: ion: ou: ism: ate: "
    "iti: ous: ive: ize:"
)

VOWEL, CONSONANT = "[aeiouY]", "[^aeiouY]"
HAS_VOWEL = VOWEL
MEASURE_ABOVE_0 = f"^{CONSONANT}*{VOWEL}+{CONSONANT}"
MEASURE_1 = f"^{CONSONANT}*{VOWEL}+{CONSONANT}+{VOWEL}*$"
MEASURE_ABOVE_1 = f"^{CONSONANT}*{VOWEL}+{CONSONANT}+{VOWEL}+{CONSONANT}"
SHORT_END = f"{CONSONANT}{VOWEL}[^aeiouYwxy]$"
DOUBLE_END = f"{CONSONANT}{CONSONANT}$"


def _without(word: Column, n: int | Column) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _plural(w: Column) -> Column:
    return (
        F.when(w.rlike("(sses|ies)$"), _without(w, 2))
        .when(w.rlike("[^s]s$"), _without(w, 1))
        .otherwise(w)
    )


def _past(w: Column) -> Column:
    """The word cut by -ed or -ing, with a mark ``+`` where the stem is to be mended."""
    return (
        F.when(w.rlike("eed$"), F.when(_without(w, 3).rlike(MEASURE_ABOVE_0), _without(w, 1)).otherwise(w))
        .when(w.rlike("ed$"), F.when(_without(w, 2).rlike(HAS_VOWEL), F.concat(_without(w, 2), F.lit("+"))).otherwise(w))
        .when(w.rlike("ing$"), F.when(_without(w, 3).rlike(HAS_VOWEL), F.concat(_without(w, 3), F.lit("+"))).otherwise(w))
        .otherwise(w)
    )


def _mended(w: Column) -> Column:
    stem = F.regexp_replace(w, r"\+$", "")
    double = stem.rlike(DOUBLE_END) & (F.substring(stem, -1, 1) == F.substring(stem, -2, 1))
    mended = (
        F.when(stem.rlike("(at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(double & ~stem.rlike("[lsz]$"), _without(stem, 1))
        .when(stem.rlike(MEASURE_1) & stem.rlike(SHORT_END), F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )
    return F.when(w.endswith("+"), mended).otherwise(w)


def _last_y(w: Column) -> Column:
    return F.when(w.rlike(f"{VOWEL}.*[yY]$"), F.concat(_without(w, 1), F.lit("i"))).otherwise(w)


def _suffix_step(text: str, measure: str) -> Callable[[Column], Column]:
    """The longest suffix of the list that the word has is replaced, if what is before it
    has the measure."""
    rules = dict(rule.split(":") for rule in text.split())

    def step(w: Column) -> Column:
        suffix = F.regexp_extract(w, f"({'|'.join(rules)})$", 0)
        stem = _without(w, F.length(suffix))
        new = F.lit("")
        for old, put in rules.items():
            if put:
                new = F.when(suffix == old, put).otherwise(new)
        fits = (suffix != "") & stem.rlike(measure)
        if "ion" in rules:
            fits &= (suffix != "ion") | stem.rlike("[st]$")
        return F.when(fits, F.concat(stem, new)).otherwise(w)

    return step


def _last_e(w: Column) -> Column:
    stem = _without(w, 1)
    goes = stem.rlike(MEASURE_ABOVE_1) | (stem.rlike(MEASURE_1) & ~stem.rlike(SHORT_END))
    return F.when(w.endswith("e") & goes, stem).otherwise(w)


def _last_ll(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(MEASURE_ABOVE_1), _without(w, 1)).otherwise(w)


STEPS = [
    _plural,
    _past,
    _mended,
    _last_y,
    _suffix_step(STEP_2, MEASURE_ABOVE_0),
    _suffix_step(STEP_3, MEASURE_ABOVE_0),
    _suffix_step(STEP_4, MEASURE_ABOVE_1),
    _last_e,
    _last_ll,
]


def with_stems(terms: DataFrame) -> DataFrame:
    """``terms`` (term, ..) with their ``stem``. Words of one or two letters stay."""
    word = F.regexp_replace("term", "([^aeiou])y", "$1Y")
    found = terms.withColumn("stem", word)
    for step in STEPS:
        found = found.withColumn("stem", step(F.col("stem")))
    short = F.length("term") < 3
    return found.withColumn("stem", F.when(short, F.col("term")).otherwise(F.translate("stem", "Y", "y")))


def stem_table(terms: DataFrame) -> DataFrame:
    """(term) -> (term, stem) of the distinct terms."""
    return with_stems(terms.select("term").distinct())
