"""Emoji expressions over code-point ranges and sequences; names come from the Unicode character table."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping
from functools import lru_cache
from string import ascii_lowercase

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions.text import null_text

# --- fixed values: characters with the published property Emoji_Presentation or Emoji ----------
# Shown as emoji by themselves.
SYMBOL_RANGES = [
    (0x231A, 0x231B), (0x23E9, 0x23EC), (0x23F0, 0x23F0), (0x23F3, 0x23F3), (0x25FD, 0x25FE),
    (0x2614, 0x2615), (0x2648, 0x2653), (0x267F, 0x267F), (0x2693, 0x2693), (0x26A1, 0x26A1),
    (0x26AA, 0x26AB), (0x26BD, 0x26BE), (0x26C4, 0x26C5), (0x26CE, 0x26CE), (0x26D4, 0x26D4),
    (0x26EA, 0x26EA), (0x26F2, 0x26F3), (0x26F5, 0x26F5), (0x26FA, 0x26FA), (0x26FD, 0x26FD),
    (0x2705, 0x2705), (0x270A, 0x270B), (0x2728, 0x2728), (0x274C, 0x274C), (0x274E, 0x274E),
    (0x2753, 0x2755), (0x2757, 0x2757), (0x2795, 0x2797), (0x27B0, 0x27B0), (0x27BF, 0x27BF),
    (0x2B1B, 0x2B1C), (0x2B50, 0x2B50), (0x2B55, 0x2B55), (0x1F004, 0x1F004), (0x1F0CF, 0x1F0CF),
    (0x1F18E, 0x1F18E), (0x1F191, 0x1F19A), (0x1F1E6, 0x1F1FF), (0x1F201, 0x1F202),
    (0x1F21A, 0x1F21A), (0x1F22F, 0x1F22F), (0x1F232, 0x1F23A), (0x1F250, 0x1F251),
    (0x1F300, 0x1F64F), (0x1F680, 0x1F6FF), (0x1F7E0, 0x1F7EB), (0x1F7F0, 0x1F7F0),
    (0x1F90C, 0x1F9FF), (0x1FA70, 0x1FAFF),
]
# Text signs that count as emoji too, with or without the selector.
SIGN_RANGES = [
    (0x00A9, 0x00A9), (0x00AE, 0x00AE), (0x203C, 0x203C), (0x2049, 0x2049), (0x2122, 0x2122),
    (0x2139, 0x2139), (0x2194, 0x2199), (0x21A9, 0x21AA), (0x2328, 0x2328), (0x23CF, 0x23CF),
    (0x23ED, 0x23EF), (0x23F1, 0x23F2), (0x23F8, 0x23FA), (0x24C2, 0x24C2), (0x25AA, 0x25AB),
    (0x25B6, 0x25B6), (0x25C0, 0x25C0), (0x25FB, 0x25FC), (0x2600, 0x2604), (0x260E, 0x260E),
    (0x2611, 0x2611), (0x2618, 0x2618), (0x261D, 0x261D), (0x2620, 0x2620), (0x2622, 0x2623),
    (0x2626, 0x2626), (0x262A, 0x262A), (0x262E, 0x262F), (0x2638, 0x263A), (0x2640, 0x2640),
    (0x2642, 0x2642), (0x265F, 0x2660), (0x2663, 0x2663), (0x2665, 0x2666), (0x2668, 0x2668),
    (0x267B, 0x267B), (0x267E, 0x267E), (0x2692, 0x2692), (0x2694, 0x2697), (0x2699, 0x2699),
    (0x269B, 0x269C), (0x26A0, 0x26A0), (0x26A7, 0x26A7), (0x26B0, 0x26B1), (0x26C8, 0x26C8),
    (0x26CF, 0x26CF), (0x26D1, 0x26D1), (0x26D3, 0x26D3), (0x26E9, 0x26E9), (0x26F0, 0x26F1),
    (0x26F4, 0x26F4), (0x26F7, 0x26F9), (0x2702, 0x2702), (0x2708, 0x2709), (0x270C, 0x270D),
    (0x270F, 0x270F), (0x2712, 0x2712), (0x2714, 0x2714), (0x2716, 0x2716), (0x271D, 0x271D),
    (0x2721, 0x2721), (0x2733, 0x2734), (0x2744, 0x2744), (0x2747, 0x2747), (0x2763, 0x2764),
    (0x27A1, 0x27A1), (0x2934, 0x2935), (0x2B05, 0x2B07), (0x3030, 0x3030), (0x303D, 0x303D),
    (0x3297, 0x3297), (0x3299, 0x3299), (0x1F170, 0x1F171), (0x1F17E, 0x1F17F), (0x1F237, 0x1F237),
]
SKIN_TONES = {
    0x1F3FB: "light skin tone", 0x1F3FC: "medium-light skin tone",
    0x1F3FD: "medium skin tone", 0x1F3FE: "medium-dark skin tone",
    0x1F3FF: "dark skin tone",
}
SELECTOR, JOINER, KEYCAP = 0xFE0F, 0x200D, 0x20E3
KEYCAP_BASES = "0-9#*"
# Regional indicators A to Z, in pairs a flag; tag characters behind a black flag, and their end.
INDICATORS, TAGS, TAG_BASE, TAG_END = (0x1F1E6, 0x1F1FF), (0xE0020, 0xE007E), 0x1F3F4, 0xE007F
PEOPLE = [0x1F466, 0x1F467, 0x1F468, 0x1F469, 0x1F476, 0x1F9D1, 0x1F9D2]
# ----------------------------------------------------------------------------------------------

EMOJI_MODES = ["raw", "demojize", "strip"]


def _char(cp: int) -> str:
    return rf"\x{{{cp:X}}}"


SYMBOL_CLASS = "".join(f"{_char(a)}-{_char(b)}" for a, b in SYMBOL_RANGES + SIGN_RANGES)
# Plain letters fail one look at three ranges before the many ranges of the class are tried.
SYMBOL_CHAR = rf"(?=[\x{{A9}}\x{{AE}}\x{{203C}}-\x{{10FFFF}}])[{SYMBOL_CLASS}]"
KEYCAP_RE = f"[{KEYCAP_BASES}]{_char(SELECTOR)}?{_char(KEYCAP)}"
# A symbol with what belongs to it: selectors, and joiners only between symbols. Joiners and
# selectors elsewhere are part of the words they stand in.
UNIT_RE = f"{SYMBOL_CHAR}(?:{_char(SELECTOR)}|{_char(JOINER)}(?=[{SYMBOL_CLASS}]))*"
SYMBOL_RE = f"{SYMBOL_CHAR}|{KEYCAP_RE}"
STRIP_RE = f"(?:{UNIT_RE}|{KEYCAP_RE})+"
# Sequences that are one emoji, the longest first.
TONE = f"[{_char(min(SKIN_TONES))}-{_char(max(SKIN_TONES))}]"
PERSON = f"[{''.join(map(_char, PEOPLE))}]{TONE}?"
INDICATOR, TAG = (f"[{_char(a)}-{_char(b)}]" for a, b in (INDICATORS, TAGS))
FLAG_RE = f"{INDICATOR}{{2}}"
TAGGED_RE = f"{_char(TAG_BASE)}{TAG}+{_char(TAG_END)}?"
ELEMENT_RE = f"{SYMBOL_CHAR}{_char(SELECTOR)}?{TONE}?"
SEQUENCE_RE = f"(?:{FLAG_RE}|{KEYCAP_RE}|{TAGGED_RE}|{ELEMENT_RE}(?:{_char(JOINER)}{ELEMENT_RE})*){_char(SELECTOR)}*"


@lru_cache(maxsize=1)
def emoji_names() -> dict[str, str]:
    """Character -> description words, derived from the Unicode character names."""
    names = {}
    for a, b in SYMBOL_RANGES + SIGN_RANGES:
        for cp in range(a, b + 1):
            name = unicodedata.name(chr(cp), "")
            if name:
                names[chr(cp)] = name.lower().removesuffix(" sign")
    names.update({chr(cp): words for cp, words in SKIN_TONES.items()})
    return names


def has_emoji(c: Column | str) -> Column:
    return null_text(c).rlike(SYMBOL_RE)


def emoji_strip(c: Column | str) -> Column:
    return F.regexp_replace(null_text(c), STRIP_RE, "")


def _translated(c: Column, first: int, letters: str) -> Column:
    """Characters from ``first`` on as the letters."""
    return F.translate(c, "".join(chr(first + i) for i in range(len(letters))), letters)


def emoji_demojize(c: Column | str, names: Mapping[str, str] | None = None, flags: Mapping[str, str] | None = None) -> Column:
    """Each emoji becomes its description words, set apart by blanks; ``_`` becomes a blank.

    A sequence is one emoji with one description, the longest that matches: a symbol with its skin
    tone, symbols joined into one (people make a ``family``), a flag (``flag`` and its code, or its
    name in ``flags``), a keycap and its key. Other sequences are described part by part, in order.

    Only rows that hold an emoji are cut into pieces, and only emoji pieces are looked up.
    """
    def literal_map(table: Mapping[str, str]) -> Column:
        # One foldable string: the optimizer turns it into a map literal once per query.
        return F.str_to_map(F.lit(";".join(f"{k}={v}" for k, v in table.items())), F.lit(";"), F.lit("="))

    mapping, text = literal_map(names or emoji_names()), null_text(c)

    def flag(code: Column) -> Column:
        return F.concat(F.lit("flag "), F.coalesce(F.try_element_at(literal_map(flags), code), code) if flags else code)

    def part(symbols: Column) -> Column:
        return F.array_join(F.transform(F.split(symbols, ""), lambda s: F.coalesce(F.try_element_at(mapping, s), s)), " ")

    def joined(sequence: Column) -> Column:
        parts = F.split(F.regexp_replace(sequence, _char(SELECTOR), ""), _char(JOINER))
        people = sequence.rlike(f"^{PERSON}(?:{_char(JOINER)}{PERSON})+$")
        words = F.array_join(F.transform(parts, part), " ")
        return F.when(people, F.concat(F.lit("family "), words)).otherwise(words)

    def described(sequence: Column) -> Column:
        letters = _translated(sequence, INDICATORS[0], ascii_lowercase)
        tags = _translated(F.substring(sequence, 2, 100), TAGS[0], "".join(map(chr, range(TAGS[0] - 0xE0000, TAGS[1] + 1 - 0xE0000))))
        return (F.when(sequence.rlike(f"^{FLAG_RE}$"), flag(letters))
                .when(sequence.rlike(f"^{TAGGED_RE}$"), flag(F.regexp_replace(tags, "[^ -~]", "")))
                .when(sequence.rlike(f"^{KEYCAP_RE}$"), F.concat(F.lit("keycap "), F.substring(sequence, 1, 1)))
                .otherwise(joined(sequence)))

    found = F.transform(F.regexp_extract_all(text, F.lit(SEQUENCE_RE), F.lit(0)), lambda s: F.concat(F.lit(" "), described(s), F.lit(" ")))
    # One piece of text more than there are emoji.
    pieces = F.zip_with(F.split(text, SEQUENCE_RE, -1), found, lambda piece, words: F.concat(piece, F.coalesce(words, F.lit(""))))
    return F.replace(F.when(text.rlike(SYMBOL_RE), F.array_join(pieces, "")).otherwise(text), F.lit("_"), F.lit(" "))


def emoji_variant(c: Column | str, mode: str) -> Column:
    if mode == "raw":
        return null_text(c)
    if mode == "strip":
        return emoji_strip(c)
    if mode == "demojize":
        return emoji_demojize(c)
    raise ValueError(f"unknown emoji mode {mode!r}")
