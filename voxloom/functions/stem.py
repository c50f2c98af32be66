"""Porter stemming of English tokens, in expressions.

The published 1980 suffix rules with the usual later extensions (short irregular forms,
``-ied``/``-ies`` on four-letter words, ``-logi``, ``-fulli``). Every step is one regular
expression over the tokens of a text, set apart by single blanks, so a text is stemmed where it
lies: no worker and no shuffle of tokens.

``learn_stems`` counts the tokens of a corpus and stems the most frequent ones once, into a bounded
table that is part of the expression. A text then looks its tokens up, and only those not in the
table, each once, go through the expressions: the result is the same, most of the work is not done.

Letters other than a, e, i, o, u are consonants; a ``y`` is a vowel after a consonant. A run of
three or more y at the end of a token is not told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.lookup import InlineTable, bound
from voxloom.functions.text import null_text, tokenize

STEM_MODES = ["unstemmed", "stemmed"]
KNOWN_TOKENS = 50_000

#: Set before tokens that stay as they are, and behind stems that lost ``-ed`` or ``-ing``.
DONE, CUT = "#", "~"
_NOT = f" {DONE}{CUT}"

# What a stem begins with. The classes leave no choice of where a run ends, so nothing backtracks.
_ANY = f"[^{_NOT}]*"
_TO_VOWEL = f"(?:[^aeiou{_NOT}][^aeiouy{_NOT}]*[aeiouy]|[aeiou])"
_M1 = f"{_TO_VOWEL}[aeiou]*[^aeiou{_NOT}]"  # measure of one or more
_M2 = f"{_M1}[^aeiouy{_NOT}]*[aeiouy][aeiou]*[^aeiou{_NOT}]"  # of two or more
#: A whole short stem: consonants, vowel, consonant other than w, x, y; or vowel, consonant.
_SHORT = f"(?:[^aeiou{_NOT}][^aeiouy{_NOT}]*[aeiouy][^aeiouwxy{_NOT}]|[aeiou][^aeiou{_NOT}])"


def _token(pattern: str, new: str) -> tuple[str, str]:
    """A step for whole tokens. The blank before is matched, not looked for: that is much faster."""
    return f" (?:{pattern})(?= )", f" {new}"


# --- fixed values: irregular forms and suffix rules ---------------------------
# The rules of M. F. Porter, "An algorithm for suffix stripping" (1980); the extensions and the irregular
# forms are those of the Porter stemmer of the Natural Language Toolkit in its default mode.
STEPS: list[tuple[str, str]] = [
    # Irregular forms and tokens of one or two letters.
    _token("(sk)ies", f"{DONE}$1y"),
    _token("(d|l|t)ying", f"{DONE}$1ie"),
    _token(f"([^{_NOT}]{{1,2}}|sky|news|howe|proceed|exceed|succeed)|(inning|outing|canning)s?", f"{DONE}$1$2"),
    # Plurals.
    _token(f"([^{_NOT}]ie)s|({_ANY}(?:ss|i))es|({_ANY}[^s{_NOT}])s", "$1$2$3"),
    # Past and progressive forms; what is left gets an e, loses a doubled consonant or stays.
    _token(f"([^{_NOT}]ie)d|({_ANY}i)ed|({_M1}{_ANY}ee)d", "$1$2$3"),
    _token(f"({_TO_VOWEL}{_ANY})(?:(?<!e)ed|ing)", f"$1{CUT}"),
    (f"(at|bl|iz| {_SHORT}){CUT}", "$1e"),
    (f"(?:([^aeiouylsz{_NOT}])\\1|(?<=[^aeiouy{_NOT}])(y)y){CUT}", "$1$2"),
    (CUT, ""),
    # A final y after a consonant.
    _token(f"([^{_NOT}]+[^aeiouy{_NOT}]|{_ANY}[aeiou]y)y", "$1i"),
    # Derived forms.
    _token(f"({_M1}{_ANY}al)li|(?={_M1}{_ANY}ogi )({_ANY}log)i", "$1$2"),
    _token(f"({_M1}{_ANY})(?:(at)(?:ional|or)|(?<!iz)(at)ion|(enc|anc|bl)i|(iz)ation|(iv)iti)", "$1$2$3$4$5$6e"),
    _token(f"({_M1}{_ANY})(?:(?<!a)(tion)al|(ize)r|(al)(?:ism|iti)|(ent|e|ous)li|(ive|ous|ful)ness|(ful)li)", "$1$2$3$4$5$6$7"),
    _token(f"({_M1}{_ANY}b)iliti", "$1le"),
    _token(f"({_M1}{_ANY})(?:(ic)(?:ate|iti|al)|ative|(al)ize|ful|ness)", "$1$2$3"),
    _token(f"({_M2}{_ANY})(?:al|[ae]nce|er|ic|[ai]ble|ant|ement|(?<!e)ment|(?<!m)ent|(?<=[st])ion|ou|ism|ate|iti|ous|ive|ize)", "$1"),
    # A final e, and one of two final l.
    _token(f"(?!{_SHORT}e )({_M1}{_ANY})e", "$1"),
    _token(f"(?={_M2}{_ANY}l )({_ANY}l)l", "$1"),
    (DONE, ""),
]
# ----------------------------------------------------------------------------


def stem_tokens(tokens: Column | str) -> Column:
    """Array of lower-case tokens -> their stems, joined by a blank."""
    out = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
    for pattern, new in STEPS:
        out = F.regexp_replace(out, pattern, new) if new else F.translate(out, pattern, "")
    return F.trim(out)


def learn_stems(df: DataFrame, text: str, limit: int = KNOWN_TOKENS) -> InlineTable:
    """The ``limit`` most frequent tokens of a corpus with their stems; ties to the smaller token."""
    tokens = df.select(F.explode(tokenize(text)).alias("token"))
    frequent = (tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.desc("n"), "token").limit(limit))
    return InlineTable(frequent.select("token", stem_tokens(F.array("token")).alias("stem")), "token", ["stem"], limit)


def stem_text(c: Column | str, known: InlineTable | None = None) -> Column:
    """Tokens of a text, stemmed and joined by a blank; ``known`` are stems found before."""
    if known is None or not known.size:
        return stem_tokens(tokenize(c))

    def looked_up(tokens: Column, places: Column) -> Column:
        others = F.array_distinct(F.filter(tokens, lambda t, i: F.get(places, i).isNull()))
        return bound(others, lambda rare: bound(F.split(stem_tokens(rare), " ", -1), lambda stems: F.array_join(
            F.transform(tokens, lambda t, i: F.coalesce(
                known.value(F.get(places, i), "stem"), F.get(stems, F.array_position(rare, t).cast("int") - 1))), " ")))

    return bound(tokenize(c), lambda tokens: bound(F.transform(tokens, known.find), lambda places: looked_up(tokens, places)))


def stem_variant(c: Column | str, mode: str, known: InlineTable | None = None) -> Column:
    if mode == "unstemmed":
        return null_text(c)
    if mode == "stemmed":
        return stem_text(c, known)
    raise ValueError(f"unknown stemming mode {mode!r}")
