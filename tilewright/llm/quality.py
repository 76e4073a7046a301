"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Every rule is a condition that rejects a document. A bounded sample tells what each
rule costs and how much it rejects; the rules then stand in one conditional chain in
the order of rejection per cost, so that a document is put to the next rule only if
all before let it pass. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .common import SEPARATORS, store

WINDOW = 8  # words
HAS_WORD = r"[^\x20\x09-\x0D]"


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def window(first: Column) -> list[Column]:
    """The words of the window at ``first``; slices inside a lambda would copy all words each time."""
    return [F.get("_words", first + i) for i in range(WINDOW)]


def measures(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_rows: bool = False
) -> DataFrame:
    """Word, symbol, line and repetition counts of every whole text; a null text has none.

    Columns: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (lines
    with a word), ``n_dup_lines`` (those equal to an earlier one), ``n_repeat_words``
    (words inside 8-word windows that occur at least twice), ``_text`` and ``_words``;
    with ``whole_rows`` also ``_row``, the row itself.
    """
    row = [F.struct(*(quoted(c) for c in df.columns)).alias("_row")] if whole_rows else []
    carried = ["doc_id", "_text", "_words", "_lines", *(["_row"] if whole_rows else [])]
    frame = df.select(
        quoted(id_col).cast("long").alias("doc_id"),
        F.coalesce(quoted(text_col), F.lit("")).alias("_text"),
        *row,
    ).select(
        "*",
        F.array_remove(F.split("_text", SEPARATORS), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: F.rlike(x, F.lit(HAS_WORD))).alias("_lines"),
    )
    windows = F.sequence(F.lit(0), F.size("_words") - WINDOW)
    long_enough = F.size("_words") >= WINDOW
    frame = frame.select(
        "*",
        F.when(
            long_enough,
            F.transform(windows, lambda i: F.xxhash64(*window(i))),
        ).alias("_hashes"),
    )
    # Equal windows have equal hashes: only where hashes repeat, the words themselves are compared.
    maybe = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    frame = frame.select(
        *carried,
        F.when(
            long_enough & maybe,
            F.sort_array(
                F.transform(
                    windows,
                    lambda i: F.struct(
                        F.concat_ws(" ", *window(i)).alias("words"), i.alias("at")
                    ),
                )
            ),
        ).alias("_sorted"),
    )

    def repeated(one: Column, index: Column) -> Column:
        before = F.get("_sorted", index - 1)["words"]
        after = F.get("_sorted", index + 1)["words"]
        same = before.eqNullSafe(one["words"]) | after.eqNullSafe(one["words"])
        return F.when(same, one["at"])

    frame = frame.select(
        *carried,
        F.sort_array(F.array_compact(F.transform("_sorted", repeated))).alias("_starts"),
    )
    none = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("end"))

    def cover(so_far: Column, start: Column) -> Column:
        end = start + WINDOW
        added = end - F.greatest(so_far["end"], start)
        return F.struct((so_far["covered"] + added).alias("covered"), end.alias("end"))

    return frame.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate("_starts", none, cover)["covered"], F.lit(0))
        .cast("long")
        .alias("n_repeat_words"),
        *(c for c in carried if c not in ("doc_id", "_lines")),
    )


def base_rules() -> dict[str, Column]:
    return {
        "few_words": F.col("n_words") < 20,
        "repeated_windows": 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
    }


def extra_rules() -> dict[str, Column]:
    """Rules beyond the base ones; all are far from what running text does."""
    words = F.col("n_words")
    distinct = F.size(F.array_distinct("_words"))
    again = F.size(
        F.filter(
            F.sequence(F.lit(2), F.size("_words")),
            lambda i: F.element_at("_words", i) == F.element_at("_words", i - 1),
        )
    )
    capitals = F.length(F.regexp_replace("_text", r"[^\p{Lu}]+", ""))
    marks = F.length("_text") - F.length(F.replace("_text", F.lit("!"), F.lit("")))
    return {
        "symbols": 5 * F.col("n_symbols") > words,
        "duplicate_lines": 10 * F.col("n_dup_lines") > 4 * F.col("n_lines"),
        "word_length": (F.col("word_chars") > 15 * words) | (F.col("word_chars") < 2 * words),
        "exclamations": 2 * marks > words,
        "capitals": 10 * capitals > 4 * F.col("word_chars"),
        # More than half of the words repeat the word before: then fewer than half are distinct.
        "stutter": (words >= 2) & (2 * distinct < words) & (2 * again > words),
    }


def cascade_order(
    df: DataFrame,
    rules: Mapping[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = 500,
) -> list[str]:
    """The names of ``rules`` by rejections per second on at most ``sample_rows`` rows.

    The sample is the rows with the least hashes of their ids; only hashes pass the driver.
    """
    columns = df.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    number = F.xxhash64("doc_id")
    least = columns.select(number.alias("number")).orderBy("number").limit(sample_rows)
    last = least.agg(F.max("number")).first()[0]
    rows = columns.filter(number <= F.lit(last)).limit(sample_rows)
    sample = store(measures(store(rows, "quality-rows")), "quality-sample")
    total = max(1, sample.count())

    def rejected(rule: Column) -> tuple[int, float]:
        start = time.perf_counter()
        hits = sample.agg(F.count(F.when(rule, 1))).first()[0]
        return hits, time.perf_counter() - start

    rejected(F.lit(False))
    idle = rejected(F.lit(False))[1]
    score = {}
    for name, rule in rules.items():
        hits, seconds = rejected(rule)
        score[name] = (hits / total) / max(seconds - idle, 1e-3)
    return sorted(rules, key=lambda name: -score[name])


def cascade(rules: Mapping[str, Column], order: list[str]) -> Column:
    """The name of the first rule in the given order that rejects a row, or null."""
    first = F.lit(None).cast("string")
    for name in reversed(order):
        first = F.when(rules[name], F.lit(name)).otherwise(first)
    return first


def judged(
    df: DataFrame, id_col: str, text_col: str, sample_rows: int, whole_rows: bool = False
) -> DataFrame:
    """Measures with ``base_failed`` and ``kept``."""
    base, extra = base_rules(), extra_rules()
    order = cascade_order(df, extra, id_col, text_col, sample_rows)
    failed = base["few_words"] | base["repeated_windows"]
    kept = F.when(F.col("base_failed"), False).otherwise(cascade(extra, order).isNull())
    frame = measures(df, id_col, text_col, whole_rows).withColumn("base_failed", failed)
    return frame.withColumn("kept", kept)


def quality_rules(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 500
) -> DataFrame:
    """Measures and verdict of every document.

    A null, empty or wordless text has no words and fails the base rules; a text of any
    length is measured whole. A null id stays null, repeated rows give one row each, an
    empty table an empty result. Only the id and the text are read. The sample sets the
    order of the rules only: it changes no verdict.
    """
    return judged(df, id_col, text_col, sample_rows).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def keep_good(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 500
) -> DataFrame:
    """The rows of ``df`` that no rule rejects, all columns as they are."""
    # Not a filter: that would be pushed below the measures, which it would then repeat.
    row = F.inline(F.when(F.col("kept"), F.array("_row")))
    return judged(df, id_col, text_col, sample_rows, True).select(row)
