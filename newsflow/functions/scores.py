"""Chunk windows, lexicon scores and the reductions of chunk scores, as native expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.binding import let

LABELS = ("positive", "neutral", "negative")
PUNCTUATION = ".,;:!?\"'()"

# Window length and step in tokens, weight of the negative class.
CHUNK_LENGTH = 512
CHUNK_STEP = 256
NEGATIVE_WEIGHT = 1.5


def tokens(text: Column) -> Column:
    """Blank-separated words; an empty array for blank text."""
    return F.array_remove(F.split(text, r"[ \t\n\r\f]+"), "")


def windows(items: Column, length: int, step: int, lead: int = 0, trail: int = 0) -> Column:
    """Overlapping slices of an array: one every `step` items, short ones at the end.

    `lead` and `trail` count special tokens around the items: they take room in the windows
    and may open a window of their own, but are not part of the output.
    """
    def cut(all_items: Column) -> Column:
        total = F.size(all_items)
        starts = F.sequence(F.lit(0), total + lead + trail - 1, F.lit(step))

        def one(i: Column) -> Column:
            first = F.greatest(i - lead, F.lit(0))
            last = F.least(i - lead + length, total)
            return F.slice(all_items, first + 1, F.greatest(last - first, F.lit(0)))

        empty = F.slice(F.array(all_items), 1, 0)
        return F.when(total > 0, F.transform(starts, one)).otherwise(empty)

    return let(items, cut)


def windows_if_long(items: Column, length: int, step: int) -> Column:
    """`windows` for arrays longer than `length`; a shorter one is a single window."""
    return let(items, lambda t: F.when(F.size(t) > length, windows(t, length, step))
               .otherwise(F.array(t)))


@dataclass(frozen=True)
class Lexicon:
    """Word lists of the default scorer. Scores come from the share of listed words."""

    positive: tuple[str, ...]
    negative: tuple[str, ...]
    scale: float = 10.0


# The word lists that ship with the package; pass a Lexicon to use another one.
FINANCE = Lexicon(
    positive=("beat", "beats", "gain", "gains", "growth", "profit", "rally", "record", "rise",
              "rises", "strong", "surge", "up", "upgrade"),
    negative=("cut", "cuts", "decline", "downgrade", "drop", "drops", "fall", "falls", "fraud",
              "lawsuit", "loss", "miss", "plunge", "weak"),
)


def word_signs(items: Column, lexicon: Lexicon) -> Column:
    """+1, -1 or 0 for every lower-case word.

    The one lambda of the score. Nearly all words are in no list, so that is asked first.
    """
    def sign(word: Column) -> Column:
        bare = F.btrim(word, F.lit(PUNCTUATION))
        listed = bare.isin(*lexicon.positive, *lexicon.negative)
        return F.when(listed, F.when(bare.isin(*lexicon.positive), 1).otherwise(-1)).otherwise(0)
    return F.transform(items, sign)


def softmax(logits: Column) -> Column:
    """Probabilities of an array of logits."""
    def normal(x: Column) -> Column:
        top = F.array_max(x)
        powers = F.transform(x, lambda v: F.exp(v - top))
        return let(powers, lambda e: F.transform(
            e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))
    return let(logits, normal)


def lexicon_logits(signs: Column, scale: float) -> Column:
    """Logits (positive, neutral, negative) of one window of word signs.

    Counting by removal runs as a plain loop over the array, without a lambda per word.
    """
    def logits(found: Column) -> Column:
        positive = F.size(F.array_remove(found, -1))
        weight = F.lit(scale) / F.greatest(F.size(signs), F.lit(1))
        return F.array(positive * weight, F.lit(1.0), (F.size(found) - positive) * weight)
    return let(F.array_remove(signs, 0), logits)


def score_struct(probabilities: Column) -> Column:
    """Array (positive, neutral, negative) to a struct."""
    return F.struct(*[probabilities[i].alias(label) for i, label in enumerate(LABELS)])


def lexicon_scores(text: Column, lexicon: Lexicon = FINANCE, length: int = CHUNK_LENGTH,
                   step: int = CHUNK_STEP, only_long: bool = False) -> Column:
    """Array with one probability array per window of `text`; stays in the row, no shuffle."""
    cut = windows_if_long if only_long else windows
    signs = word_signs(tokens(F.lower(text)), lexicon)
    return F.transform(cut(signs, length, step),
                       lambda w: softmax(lexicon_logits(w, lexicon.scale)))


def mean_scores(chunks: Column) -> Column:
    """Struct of the mean probabilities over windows, every window the same weight."""
    def mean(c: Column) -> Column:
        def of(i: int) -> Column:
            return F.aggregate(c, F.lit(0.0), lambda a, p: a + p[i]) / F.size(c)
        return F.struct(*[F.when(F.size(c) > 0, of(i)).otherwise(0.0).alias(label)
                          for i, label in enumerate(LABELS)])
    return let(chunks, mean)


def top_label(p: Column) -> Column:
    """Label of the largest of an array (positive, neutral, negative); first wins ties."""
    return F.element_at(F.array(*[F.lit(x) for x in LABELS]),
                        F.array_position(p, F.array_max(p)).cast("int"))


def top1_means(chunks: Column) -> Column:
    """Struct per label: mean top score of the windows it wins, 0.0 when it wins none."""
    def reduce(c: Column) -> Column:
        def of(label: str) -> Column:
            won = F.filter(c, lambda p: top_label(p) == label)
            return let(won, lambda w: F.when(
                F.size(w) > 0,
                F.aggregate(w, F.lit(0.0), lambda a, p: a + F.array_max(p)) / F.size(w),
            ).otherwise(0.0)).alias(label)
        return F.struct(*[of(label) for label in LABELS])
    return let(chunks, reduce)


def clean_label(col: Column) -> Column:
    """Lower-case label; null when it is not one of the three."""
    return F.when(F.lower(col).isin(*LABELS), F.lower(col))


def weighted_label(negative: Column, neutral: Column, positive: Column,
                   weight: float = NEGATIVE_WEIGHT) -> Column:
    """Label of the largest score with negative weighted; ties go to negative, then neutral."""
    weighted = negative * weight
    return (F.when(negative.isNull() | neutral.isNull() | positive.isNull(), F.lit(None))
            .when((weighted >= neutral) & (weighted >= positive), "negative")
            .when(neutral >= positive, "neutral")
            .otherwise("positive"))


def raw_sentiment(positive: Column, negative: Column) -> Column:
    return positive - negative


def neutral_score(positive: Column, negative: Column, neutral: Column | None = None) -> Column:
    """The given neutral score, else what the other two leave of 1."""
    rest = 1 - (positive + negative)
    return rest if neutral is None else F.coalesce(neutral, rest)


def scores_json(scores: Column) -> Column:
    """Scores as JSON text."""
    return F.to_json(scores)
