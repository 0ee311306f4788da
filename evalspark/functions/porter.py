"""Porter's suffix-stripping stemmer (M. F. Porter, 1980) with the usual later extensions."""

from __future__ import annotations

from functools import lru_cache

# The suffix rules of the published algorithm, in the order in which they are tried
# (suffix, replacement); each applies when the measure of the stem exceeds the step's bound.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"))
STEP_3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")
# Words that keep a form of their own.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "innings": "inning", "inning": "inning",
    "outings": "outing", "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed",
    "succeed": "succeed"}


def _consonant(w: str, i: int) -> bool:
    if w[i] in "aeiou":
        return False
    return w[i] != "y" or i == 0 or not _consonant(w, i - 1)


def _measure(w: str) -> int:
    """Number of vowel-consonant sequences."""
    kinds = [_consonant(w, i) for i in range(len(w))]
    return sum(b and not a for a, b in zip(kinds, kinds[1:]))


def _has_vowel(w: str) -> bool:
    return any(not _consonant(w, i) for i in range(len(w)))


def _ends_short(w: str) -> bool:
    """consonant, vowel, consonant (not w, x or y); or a word of vowel and consonant."""
    if len(w) >= 3:
        return _consonant(w, len(w) - 3) and not _consonant(w, len(w) - 2) and _consonant(w, len(w) - 1) and w[-1] not in "wxy"
    return len(w) == 2 and not _consonant(w, 0) and _consonant(w, 1)


def _plural(w: str) -> str:
    if w.endswith("ies") and len(w) == 4:
        return w[:-1]
    for suffix, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(suffix):
            return w[:len(w) - len(suffix)] + new
    return w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        stem = w[:len(w) - len(suffix)]
        if w.endswith(suffix) and _has_vowel(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if len(stem) > 1 and stem[-1] == stem[-2] and _consonant(stem, len(stem) - 1):
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _ends_short(stem) else stem
    return w


def _replace(w: str, rules) -> str:
    for suffix, new in rules:
        if w.endswith(suffix):
            stem = w[:len(w) - len(suffix)]
            return stem + new if _measure(stem) > 0 else w
    return w


def _derivation(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _derivation(w[:-4] + "al")
    if w.endswith("logi"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _replace(w, STEP_2)


def _long_suffix(w: str) -> str:
    for suffix in STEP_4:
        if w.endswith(suffix):
            stem = w[:len(w) - len(suffix)]
            return stem if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))) else w
    return w


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    """The stem of a lower-case word."""
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    w = _past(_plural(word))
    if w.endswith("y") and len(w) > 2 and _consonant(w, len(w) - 2):
        w = w[:-1] + "i"
    w = _long_suffix(_replace(_derivation(w), STEP_3))
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _ends_short(w[:-1])):
            w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w
