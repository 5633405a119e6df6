"""Expressions over note text and over lists of mentions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Generic words that are never kept as a mention, the marker of a
# split sub-word, and the shortest mention.
GENERIC_MENTIONS = ["well", "sore", "con", "app", "bad", "low", "high"]
SUBWORD_MARK = "##"
MIN_MENTION_LENGTH = 3

# Names under which a tagger may report medications, best first.
MEDICATION_LABELS = [
    "Medication", "medication", "B-Medication", "B-medication",
    "Chemical", "chemical", "B-Chemical",
    "Drug", "drug", "B-Drug",
    "MEDICINE", "B-MEDICINE",
]

# Tag groups of the two kinds that have one name only.
SYMPTOM_LABEL = "Sign_symptom"
DISEASE_LABEL = "Disease_disorder"

# Fixed value: words of a note that a model with a limited input length gets to see.
NOTE_WINDOW_WORDS = 350


def words(text: Column) -> Column:
    """Split on Unicode whitespace, without empty words."""
    return F.array_remove(F.split(text, r"(?U)\s+"), "")


def first_words(text: Column, n: int = NOTE_WINDOW_WORDS) -> Column:
    return F.array_join(F.slice(words(text), 1, n), " ")


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.regexp_replace(text, r"(?U)\s+", "") == "")


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits of the whole text."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def token_runs(token_list: Column, n: int) -> Column:
    """For each token the struct of itself and the ``n - 1`` tokens after it (null past the end).

    Built by zipping the list with its shifted copies: a lambda that looks into the whole
    list would evaluate it once per token.
    """
    shifted = [
        F.slice(token_list, k + 1, F.greatest(F.size(token_list) - k, F.lit(0))) for k in range(1, n)
    ]
    return F.arrays_zip(token_list, *shifted)


def normalize_mention(mention: Column) -> Column:
    return F.regexp_replace(F.lower(mention), r"(?U)^\s+|\s+$", "")


def keep_mention(mention: Column) -> Column:
    """False for sub-word debris, very short words and generic words."""
    return (
        ~mention.contains(SUBWORD_MARK)
        & (F.char_length(mention) >= MIN_MENTION_LENGTH)
        & ~mention.isin(GENERIC_MENTIONS)
    )


def clean_mentions(mentions: Column) -> Column:
    return F.filter(F.transform(mentions, normalize_mention), keep_mention)


def strip_tag(label: Column) -> Column:
    """Drop the begin/inside prefix of a token tag."""
    return F.regexp_replace(label, "^[BI]-", "")


def list_or_none(items: Column) -> Column:
    """Comma-separated list, or ``None`` for an empty or missing one."""
    return F.coalesce(F.nullif(F.array_join(items, ", "), F.lit("")), F.lit("None"))
