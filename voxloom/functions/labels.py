"""Label, map and array expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions.text import _c, strip_space
from voxloom.schema import LABEL_IDS, LABELS

# --- fixed values: display names of language codes ---------------------------
LANGUAGE_NAMES = {
    "en": "English", "ms": "Bahasa Melayu", "id": "Indonesian",
    "zh-cn": "Chinese", "zh-tw": "Chinese", "ta": "Tamil",
}
LANGUAGE_NOTES = {
    "id": " — note: likely Bahasa Melayu (langdetect conflates BM with Indonesian)",
}
NO_ASPECT_TEXT = "(no aspect keywords detected)"
NO_VALUE = "—"
# ----------------------------------------------------------------------------


def lookup(c: Column | str, mapping: Mapping) -> Column:
    """Map literal lookup; null when the key is absent."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def star_label(rating: Column | str) -> Column:
    """No star -> '', then truncated: up to 2 negative, 3 neutral, above positive."""
    r = _c(rating).cast("int")
    return (F.when(r.isNull(), F.lit(""))
            .when(r <= 2, F.lit("negative"))
            .when(r == 3, F.lit("neutral"))
            .otherwise(F.lit("positive")))


def label_id(label: Column | str) -> Column:
    return lookup(label, LABEL_IDS)


def id_label(idx: Column | str) -> Column:
    return lookup(idx, {v: k for k, v in LABEL_IDS.items()})


def norm_label(c: Column | str) -> Column:
    return F.lower(strip_space(F.coalesce(_c(c).cast("string"), F.lit(""))))


def is_label(c: Column | str) -> Column:
    return _c(c).isin(LABELS)


def final_label(final: Column | str, first: Column | str) -> Column:
    """A valid final label wins over the first annotator's label."""
    fl = norm_label(final)
    return F.when(fl.isin(LABELS), fl).otherwise(norm_label(first))


def language_name(code: Column | str) -> Column:
    name = F.coalesce(lookup(code, LANGUAGE_NAMES), _c(code))
    return F.concat(name, F.coalesce(lookup(code, LANGUAGE_NOTES), F.lit("")))


def argmax_label(scores: Column | str, labels: Sequence) -> Column:
    """Label of the highest score; the first one on a tie. Null for an empty array."""
    s = _c(scores)
    position = F.array_position(s, F.array_max(s)).cast("int")
    return F.when(F.size(s) > 0, F.get(F.array(*[F.lit(x) for x in labels]), position - 1))


def argmax_id(scores: Column | str) -> Column:
    s = _c(scores)
    return F.when(F.size(s) > 0, F.array_position(s, F.array_max(s)).cast("int") - 1)


def score_map(labels: Sequence[str], scores: Column | str) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), _c(scores))


def cell_note(accuracy: Column | str, n: Column | str, low_support: Column | str) -> Column:
    """Text of one accuracy cell: 'n/a' for low support or no value."""
    masked = _c(low_support) | _c(accuracy).isNull()
    return F.when(masked, F.format_string("n/a\nn=%d", _c(n))).otherwise(
        F.format_string("%.2f\nn=%d", _c(accuracy), _c(n)))
