"""A plain Porter stemmer, to compare the column expressions with."""

import re

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


def _rules(text: str) -> list[tuple[str, str]]:
    pairs = [tuple(rule.split(":")) for rule in text.split()]
    return sorted(pairs, key=lambda p: -len(p[0]))


RULES_2, RULES_3, RULES_4 = _rules(STEP_2), _rules(STEP_3), _rules(STEP_4)


def _shape(stem: str) -> str:
    """The stem as a string of c and v; y is a vowel after a consonant."""
    shape = ""
    for ch in stem:
        vowel = ch in "aeiou" or (ch == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _double_consonant(word: str) -> bool:
    return word[-1:] == word[-2:-1] and _shape(word).endswith("cc")


def _short_end(word: str) -> bool:
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _replace(word: str, rules: list[tuple[str, str]], measure: int) -> str:
    for suffix, new in rules:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            if suffix == "ion" and stem[-1:] not in ("s", "t"):
                return word
            return stem + new if _measure(stem) > measure else word
    return word


def porter_stem(word: str) -> str:
    if len(word) < 3:
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        cut = 2 if word.endswith("ed") else 3 if word.endswith("ing") else 0
        if cut and "v" in _shape(word[:-cut]):
            word = word[:-cut]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif _double_consonant(word) and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _short_end(word):
                word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(word, RULES_2, 0)
    word = _replace(word, RULES_3, 0)
    word = _replace(word, RULES_4, 1)
    if word.endswith("e"):
        measure = _measure(word[:-1])
        if measure > 1 or (measure == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word
