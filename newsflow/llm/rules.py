"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Nothing is shuffled and no user function runs. The one measure that looks across a text, words in
repeated three-word windows, sorts window hashes together with their positions as long values and
compares the words themselves only where hashes meet, so it is exact and n log n in the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.text import WHITE, names, words

SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages.
STOP_WORDS = """a an and are as at be by for from in is it of on or that the this to was with
au aux avec dans de des du elle en est et la le les mais ne pas par pour que qui sur un une
als auf das dem den der des die ein eine für ist mit nicht sich und von zu
al como con del el en es las lo los más no para por que se su un una y""".split()


@dataclass(frozen=True)
class Rule:
    """A text passes when low <= measure <= high; a missing bound does not bind."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("word_length", "mean_word_chars", 2, 15),
    Rule("symbols", "symbols_per_word", high=0.1),
    Rule("exclamations", "exclamations_per_word", high=0.3),
    Rule("stop_words", "stop_word_share", low=0.02),
    Rule("capitals", "capital_share", high=0.4),
    Rule("table_lines", "table_line_share", high=0.5),
    Rule("repeated_lines", "dup_line_share", high=0.6),
)


def _repeat_words(base: DataFrame, w: str) -> tuple[DataFrame, str]:
    """`base` with the number of words that lie in a three-word window found twice or more."""
    hashed, near, same, out = names(base.columns, "hashed", "near", "same", "repeat")
    n = F.size(w)
    # hash in the upper bits, position in the lower: one sort of long values brings equal hashes together
    bits = F.when(n <= 65536, 16).otherwise(32)
    mask = F.when(n <= 65536, F.lit(65535)).otherwise(F.lit(4294967295)).cast("long")
    at = lambda i: F.get(F.col(w), i)
    windows = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))

    def packed(i: Column) -> Column:
        moved = F.call_function("shiftleft", F.xxhash64(at(i), at(i + 1), at(i + 2)), bits)
        return moved.bitwiseOR(i.cast("long"))

    base = base.withColumn(hashed, F.sort_array(F.transform(windows, packed)))
    head = lambda x: F.call_function("shiftright", x, bits)
    neighbours = F.filter(hashed, lambda x, j: F.coalesce(
        (j > 0) & (head(x) == head(F.get(F.col(hashed), j - 1))), F.lit(False))
        | F.coalesce(head(x) == head(F.get(F.col(hashed), j + 1)), F.lit(False)))
    base = base.withColumn(near, F.transform(neighbours, lambda x: x.bitwiseAND(mask).cast("int")))
    base = base.withColumn(same, F.sort_array(F.transform(near, lambda p: F.struct(
        F.concat_ws(" ", at(p), at(p + 1), at(p + 2)).alias("g"), p.alias("p")))))
    group = lambda i: F.get(F.col(same), i)["g"]
    repeated = F.filter(same, lambda s, j: F.coalesce((j > 0) & (s["g"] == group(j - 1)), F.lit(False))
                        | F.coalesce(s["g"] == group(j + 1), F.lit(False)))
    places = F.sort_array(F.transform(repeated, lambda s: s["p"]))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, p: F.struct((p + 3).alias("end"),
                              (a["n"] + 3 - F.greatest(F.lit(0), a["end"] - p)).alias("n")))["n"]
    return base.withColumn(out, covered.cast("long")), out


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """`docs` with its counts, `base_failed`, `kept` and `failed_rules` (the names, in table order).

    Counts (long): `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`. A null text
    is an empty one; a text without words has all measures 0 and fails the base. Rows are judged one
    by one, so repeated rows get equal results. Columns of `docs` named like the new ones are replaced.
    """
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "kept", "failed_rules")
    own = [c for c in docs.columns if c.lower() not in new]
    t, w, filled, lines = names(own, "text", "words", "filled", "lines")
    base = docs.select(*own, F.coalesce(F.col(text), F.lit("")).alias(t))
    base = base.withColumn(w, words(F.col(t)))
    all_lines = F.split(t, "\n")
    base = base.withColumn(filled, F.filter(all_lines, lambda x: F.btrim(x, F.lit(WHITE)) != ""))
    base, repeat = _repeat_words(base, w)
    without = lambda chars: F.char_length(t) - F.char_length(F.translate(t, chars, ""))
    counts = {
        "n_words": F.size(w), "word_chars": F.char_length(F.translate(t, WHITE, "")),
        "n_symbols": without(SYMBOLS), "n_dup_lines": F.size(filled) - F.size(F.array_distinct(filled)),
        "n_repeat_words": F.col(repeat)}
    extra = {
        "exclamations": without("!"),
        "stops": F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))),
        "capitals": F.char_length(F.regexp_replace(t, r"[^\p{Lu}]+", "")),
        "letters": F.char_length(F.regexp_replace(t, r"[^\p{L}]+", "")),
        "tables": F.size(F.filter(filled, lambda x: F.char_length(x) - F.char_length(
            F.replace(x, F.lit(" | "), F.lit(""))) > 0.05 * 3 * F.char_length(x))),
        "n_lines": F.size(filled)}
    held = dict(zip(extra, names([*base.columns, *new], *extra)))
    counted = base.select(*own, *[c.cast("long").alias(k) for k, c in counts.items()],
                          *[c.cast("long").alias(held[k]) for k, c in extra.items()])
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    measures = {
        "mean_word_chars": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "exclamations_per_word": share(held["exclamations"], "n_words"),
        "stop_word_share": share(held["stops"], "n_words"),
        "capital_share": share(held["capitals"], held["letters"]),
        "table_line_share": share(held["tables"], held["n_lines"]),
        "dup_line_share": share("n_dup_lines", held["n_lines"])}

    def passes(rule: Rule) -> Column:
        value, ok = measures[rule.measure], F.lit(True)
        if rule.low is not None:
            ok = ok & (value >= rule.low)
        return ok & (value <= rule.high) if rule.high is not None else ok

    failed = F.array_compact(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = counted.select(*own, *counts, base_failed.alias("base_failed"), failed.alias("failed_rules"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
