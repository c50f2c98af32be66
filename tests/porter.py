"""Porter stemming of one word in plain Python: what the expressions are held against."""

from __future__ import annotations

# --- fixed values: irregular forms and suffix rules ---------------------------
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
]
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]
# ----------------------------------------------------------------------------


def _shape(stem: str) -> str:
    """'c' / 'v' per letter; y is a vowel after a consonant."""
    out = []
    for i, ch in enumerate(stem):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    shape = _shape(word)
    if len(word) == 2:
        return shape == "vc"
    return shape.endswith("cvc") and word[-1] not in "wxy"


def _plural(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith("ies"):
        return w[:-1] if len(w) == 4 else w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        if w.endswith(suffix):
            stem = w[:-len(suffix)]
            if not _has_vowel(stem):
                return w
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double_consonant(stem):
                return stem if stem[-1] in "lsz" else stem[:-1]
            if _measure(stem) == 1 and _short_end(stem):
                return stem + "e"
            return stem
    return w


def _final_y(w: str) -> str:
    if w.endswith("y") and len(w) > 2 and _shape(w[:-1])[-1] == "c":
        return w[:-1] + "i"
    return w


def _rules(w: str, rules: list[tuple[str, str]]) -> str:
    """The longest suffix in the list decides; it is replaced after a positive measure."""
    matching = [(s, r) for s, r in rules if w.endswith(s)]
    if not matching:
        return w
    suffix, repl = max(matching, key=lambda sr: len(sr[0]))
    stem = w[:-len(suffix)]
    return stem + repl if _measure(stem) > 0 else w


def _derived(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _derived(w[:-4] + "al")
    if w.endswith("logi"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _rules(w, STEP2)


def _bare(w: str) -> str:
    matching = [s for s in STEP4 if w.endswith(s)]
    if not matching:
        return w
    suffix = max(matching, key=len)
    stem = w[:-len(suffix)]
    if _measure(stem) <= 1 or (suffix == "ion" and stem[-1] not in "st"):
        return w
    return stem


def _tidy(w: str) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _short_end(stem)):
            w = stem
    if w.endswith("ll") and _measure(w[:-1]) > 1:
        w = w[:-1]
    return w


def porter_stem(word: str) -> str:
    w = word.lower()
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    w = _final_y(_past(_plural(w)))
    return _tidy(_bare(_rules(_derived(w), STEP3)))
