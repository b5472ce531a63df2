"""Suffix stripping for English words (Porter, 1980), with the usual later additions.

Rules are (suffix, replacement) pairs; the first suffix that fits decides.
"""

from __future__ import annotations

from functools import lru_cache

# The published rules.
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
    "iti", "ous", "ive", "ize",
]
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning",
    "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


def _shape(word: str) -> str:
    """The word as c (consonant) and v (vowel); y is a vowel after a consonant."""
    shape = ""
    for i, letter in enumerate(word):
        vowel = letter in "aeiou" or (letter == "y" and i > 0 and shape[-1] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _short(word: str) -> bool:
    """Ends consonant-vowel-consonant, the last not w, x or y; or is a vowel and a consonant."""
    shape = _shape(word)
    return (shape[-3:] == "cvc" and word[-1] not in "wxy") or shape == "vc"


def _swap(word: str, rules: list[tuple[str, str]], least: int) -> str:
    for suffix, new in rules:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + new if _measure(stem) > least else word
    return word


def _plurals(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past_and_ing(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: len(word) - len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c":
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short(stem) else stem


def _double_suffix(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _double_suffix(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _swap(word, STEP_2, 0)


def _last_suffix(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            fits = _measure(stem) > 1 and (suffix != "ion" or stem[-1] in "st")
            return stem if fits else word
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _past_and_ing(_plurals(word))
    if word.endswith("y") and len(word) > 2 and _shape(word)[-2] == "c":
        word = word[:-1] + "i"
    return _tidy(_last_suffix(_swap(_double_suffix(word), STEP_3, 0)))
