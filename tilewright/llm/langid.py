"""Language identification by interpolated Kneser-Ney character models.

One model per language, over the characters of lower-cased words with their borders.
All languages share sorted arrays of n-gram hashes, with a column of weights each. A
text goes to the language with the least cross-entropy per character. How far ahead
it is, is calibrated on documents kept back from the fit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import map_columns, portions, store

UNDETERMINED = "und"
BEGIN, END = 2, 3  # code points that stand for a word's borders
MIX = np.uint64(0x9E3779B97F4A7C15)
CACHED_WORDS = 600_000
CACHED_LENGTH = 64
THINNING = 1 << 30


def code_points(words: list[str], order: int) -> np.ndarray:
    """The words' lower-case code points in a row, each behind ``order - 1`` begin marks."""
    begin = chr(BEGIN) * (order - 1)
    text = "".join(f"{begin}{w.lower()}{chr(END)}" for w in words)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def hashes(columns: list[np.ndarray]) -> np.ndarray:
    """One hash per row of code points, oldest first."""
    value = np.full(len(columns[0]), np.uint64(len(columns)))
    for column in columns:
        value = (value ^ column) * MIX
        value ^= value >> np.uint64(29)
    return value


class Models:
    """Kneser-Ney weights of all languages, in sorted hash arrays."""

    def __init__(self, words: dict[str, dict[str, int]], order: int = 4):
        self.order = order
        self.languages = sorted(words)
        listed = [(i, w, n) for i, name in enumerate(self.languages) for w, n in sorted(words[name].items())]
        points = code_points([w for _, w, _ in listed], order)
        at = np.flatnonzero(points != BEGIN)
        sizes = np.array([len(w.lower()) + 1 for _, w, _ in listed], np.int64)
        language = np.repeat(np.array([i for i, _, _ in listed], np.int64), sizes)
        count = np.repeat(np.array([n for _, _, n in listed], np.float64), sizes)
        self.alphabet = max(1, len(np.unique(points[at])))
        columns = self.windows(points, at)
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        self.contexts: list[tuple[np.ndarray, np.ndarray]] = []
        longer = None
        for length in range(order, 0, -1):
            gram = hashes(columns[-length:])
            if longer is not None:  # below the highest order, in how many contexts a gram continues
                pairs = hashes([language.astype(np.uint64), longer])
                _, first = np.unique(pairs, return_index=True)
                count = np.zeros(len(gram))
                count[first] = 1
            self._add(gram, self.context(columns, length), language, count)
            longer = gram
        self.grams.reverse()
        self.contexts.reverse()
        # Whole n-grams of the highest order that were seen anywhere, with their final weights.
        names, first = np.unique(hashes(columns), return_index=True)
        self.seen = names, self._logs([c[first] for c in columns])

    def windows(self, points: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """The code points up to and at the given positions, oldest first."""
        return [points[at - back] for back in range(self.order - 1, -1, -1)]

    @staticmethod
    def context(columns: list[np.ndarray], length: int) -> np.ndarray:
        before = columns[len(columns) - length : -1]
        return hashes(before) if before else np.zeros(len(columns[-1]), np.uint64)

    def _add(self, gram: np.ndarray, context: np.ndarray, language: np.ndarray, count: np.ndarray) -> None:
        many = len(self.languages)
        names, at = np.unique(gram, return_inverse=True)
        table = np.bincount(at * many + language, count, len(names) * many).reshape(-1, many)
        first = np.zeros(len(names), np.int64)
        first[at] = np.arange(len(at))
        owners, owner = np.unique(context, return_inverse=True)
        of_gram = owner[first]
        total = np.zeros((len(owners), many))
        np.add.at(total, of_gram, table)
        kinds = np.zeros((len(owners), many))
        np.add.at(kinds, of_gram, table > 0)
        once, twice = (table == 1).sum(0), (table == 2).sum(0)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9)
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(total[of_gram] > 0, np.maximum(table - discount, 0) / total[of_gram], 0)
            rest = np.where(total > 0, discount * kinds / total, 1.0)
        self.grams.append((names, share.astype(np.float32)))
        self.contexts.append((owners, rest.astype(np.float32)))

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], wanted: np.ndarray, missing: float) -> np.ndarray:
        names, values = table
        at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
        return np.where((names[at] == wanted)[:, None], values[at], np.float32(missing))

    def _logs(self, columns: list[np.ndarray]) -> np.ndarray:
        """Log likelihoods of the last code points after those before, per language."""
        chance = np.full((len(columns[-1]), len(self.languages)), 1.0 / (self.alphabet + 1))
        for length in range(1, self.order + 1):
            rest = self._find(self.contexts[length - 1], self.context(columns, length), 1.0)
            share = self._find(self.grams[length - 1], hashes(columns[-length:]), 0.0)
            chance = share + rest * chance
        return np.log(np.maximum(chance, 1e-12)).astype(np.float32)

    def score(self, words: list[str]) -> np.ndarray:
        """Per word: log likelihood under each language, number of characters, letters or not."""
        points = code_points(words, self.order)
        at = np.flatnonzero(points != BEGIN)
        wanted = hashes(self.windows(points, at))
        names, known = self.seen
        place = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
        logs = known[place].astype(np.float64)
        new = np.flatnonzero(names[place] != wanted)
        if new.size:
            logs[new] = self._logs(self.windows(points, at[new]))
        starts = np.cumsum([0, *(len(w.lower()) + 1 for w in words)])
        sums = np.add.reduceat(logs, starts[:-1], axis=0)
        letters = [any(map(str.isalpha, w)) for w in words]
        return np.column_stack([sums, np.diff(starts), letters])


class Identifier:
    """Scores texts, remembering the scores of words."""

    def __init__(self, models: Models):
        self.models = models
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(models.languages) + 2))

    def score(self, texts: list[str]) -> np.ndarray:
        """Per text the sums over its words; see :meth:`Models.score`."""
        parts = [t.split() for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known, self.table = {}, self.table[:0]
        missing = list({w for words in parts for w in words} - self.known.keys())
        if missing:
            fresh = self.models.score([w.replace(chr(BEGIN), " ") for w in missing])
            self.known |= {w: i for i, w in enumerate(missing, len(self.table))}
            self.table = np.concatenate([self.table, fresh])
        known = self.known
        out = np.zeros((len(texts), self.table.shape[1]))
        for i, words in enumerate(parts):
            if words:
                out[i] = self.table[[known[w] for w in words]].sum(0)
        for w in [w for w in missing if len(w) > CACHED_LENGTH]:
            known.pop(w)
        return out


def entropies(sums: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its cross-entropy per character, and the lead on the next one.

    The lead is in standard errors: it grows with the root of the length. With a single
    language the next one is a model that knows nothing.
    """
    sizes = np.maximum(sums[:, -2], 1)
    entropy = -sums[:, :-2] / sizes[:, None]
    best = entropy.argmin(1) if entropy.shape[1] else np.zeros(len(sums), int)
    blank = np.full((len(sums), 1), math.log(alphabet + 1))
    ranked = np.sort(np.hstack([entropy, blank]), 1)
    lead = np.maximum(ranked[:, 1] - ranked[:, 0], 0) * np.sqrt(np.minimum(sizes, 10_000))
    return best, ranked[:, 0], lead


class Calibration:
    """Turns leads into the chance that the language is right, and rejects below one half.

    A text is rejected as well where its cross-entropy is above what all but one in a
    thousand of the documents kept back have.
    """

    def __init__(self, lead: np.ndarray, right: np.ndarray, entropy: np.ndarray):
        hits, misses = right.sum(), (~right).sum()
        # Targets short of 0 and 1, so that separable data have a finite solution.
        goal = np.where(right, (hits + 1) / (hits + 2), 1 / (misses + 2))
        self.slope, self.shift = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(self.slope * lead + self.shift, -30, 30)))
            g = np.array([((p - goal) * lead).sum() + 1e-2 * (self.slope - 1), (p - goal).sum() + 1e-2 * self.shift])
            w = p * (1 - p)
            h = np.array([[(w * lead * lead).sum() + 1e-2, (w * lead).sum()], [(w * lead).sum(), w.sum() + 1e-2]])
            step = np.linalg.solve(h, g)
            scale = min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
            self.slope, self.shift = self.slope - scale * step[0], self.shift - scale * step[1]
        self.highest = float(np.quantile(entropy, 0.999)) if len(entropy) else math.inf

    def chance(self, lead: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * lead + self.shift, -30, 30)))


def held_out(id_col: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether the CRC-32 of the id as text falls into the given fold; false for a null id."""
    rest = F.pmod(F.crc32(id_col.cast("long").cast("string").cast("binary")), F.lit(folds))
    return F.coalesce(rest == fold, F.lit(False))


def fit(df: DataFrame, sample: int = 500, order: int = 4) -> tuple[Identifier, Calibration] | None:
    """Models and calibration from at most ``sample`` documents of each language in ``df``.

    ``df`` has ``text`` and ``lang``. The texts with the least hashes are taken, each once
    however many rows repeat it; a fifth of them is kept back for the calibration. What
    comes to the driver is the words of the sample with their counts, and numbers for the
    texts kept back. None if nothing is labelled.
    """
    spark = df.sparkSession
    mark = F.xxhash64("text", F.lit(2))
    labelled = df.filter("lang is not null and text is not null").select("text", "lang", mark.alias("mark"))
    # Thinned by hash to some times the sample first, so that no task ranks a whole language.
    different = labelled.groupBy("lang").agg(F.approx_count_distinct("mark").alias("_size"))
    sizes = store(different.withColumnRenamed("lang", "_lang"), "langid-sizes")
    wanted = F.lit(4.0 * sample * THINNING) / F.col("_size")
    thinned = labelled.join(sizes, F.col("lang") == F.col("_lang"))
    thinned = thinned.filter(F.pmod("mark", F.lit(THINNING)) <= wanted).select("lang", "mark").distinct()
    chosen = F.row_number().over(W.partitionBy("lang").orderBy(F.pmod("mark", F.lit(THINNING)), "mark"))
    marks = thinned.select("lang", "mark", chosen.alias("_n")).filter(F.col("_n") <= sample)
    marks = store(marks.select(F.col("lang").alias("_lang"), F.col("mark").alias("_mark")), "langid-marks")
    part = labelled.join(marks, (F.col("mark") == F.col("_mark")) & (F.col("lang") == F.col("_lang")))
    part = part.groupBy("lang", "mark").agg(F.min("text").alias("text"))
    back = F.pmod(F.xxhash64("mark", F.lit(1)), F.lit(5)) == 0
    part = store(part.select("mark", "text", "lang", back.alias("back")), "langid-sample")

    def make():
        def rows(texts, langs):
            counts: dict[tuple[str, str], int] = {}
            for text, lang in zip(texts, langs):
                for word in text.split():
                    counts[lang, word] = counts.get((lang, word), 0) + 1
            yield from ((lang, word, n) for (lang, word), n in counts.items())

        return rows

    counts = map_columns(part.filter("not back").select("text", "lang"), "lang string, word string, n long", make)
    words: dict[str, dict[str, int]] = {}
    summed = counts.groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    for lang, word, n in zip(summed["lang"], summed["word"], summed["n"]):
        words.setdefault(lang, {})[word.replace(chr(BEGIN), " ")] = n
    if not words:
        return None
    identifier = Identifier(Models(words, order))
    shared = spark.sparkContext.broadcast(identifier)
    # Besides whole texts, short pieces of growing length: long texts alone are hardly ever wrong.
    cuts = [(0, 1), (1, 3), (3, 7), (7, 15), (15, 31), (0, None)]

    def make_scores():
        identifier = shared.value
        models = identifier.models

        def rows(marks, texts, langs):
            truth = np.array([models.languages.index(x) if x in models.languages else -1 for x in langs], int)
            for number, (a, b) in enumerate(cuts):
                pieces = texts if b is None else [" ".join(t.split()[a:b]) for t in texts]
                for start, end in portions(pieces):
                    sums = identifier.score(pieces[start:end])
                    best, entropy, lead = entropies(sums, models.alphabet)
                    letters = sums[:, -1] > 0
                    yield from zip(
                        [number] * (end - start), marks[start:end], langs[start:end], lead.tolist(),
                        (best == truth[start:end]).tolist(), letters.tolist(), entropy.tolist(),
                    )

        return rows

    schema = "cut int, mark long, lang string, lead double, right boolean, letters boolean, entropy double"
    scores = map_columns(part.filter("back").select("mark", "text", "lang"), schema, make_scores)
    scores = scores.toArrow().to_pandas().sort_values(["cut", "mark", "lang"], ignore_index=True)
    usable = scores[scores["letters"].astype(bool)]
    whole = scores.loc[scores["cut"] == len(cuts) - 1, "entropy"].to_numpy(float)
    calibration = Calibration(usable["lead"].to_numpy(float), usable["right"].to_numpy(bool), whole)
    return Identifier(identifier.models), calibration


def identify_languages(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = 500,
    order: int = 4,
) -> DataFrame:
    """Predict the language of every whole text of ``df``.

    Learns from text and label of documents that are not held out and have an id.
    Columns: ``doc_id``, ``held_out``, ``lang_pred``, ``score`` (chance that it is right),
    ``cross_entropy`` (per character) and ``rejected``. A text that is null or has no letter
    is ``und`` with score 0; so is every text if nothing is labelled. Equal entropies go to
    the first language by name. Repeated rows give one row each, an empty table an empty
    result. Predictions rest on the text alone.
    """
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    )
    fitted = fit(rows.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("text", "lang"), sample, order)
    shared = df.sparkSession.sparkContext.broadcast(fitted)

    def make():
        model = shared.value

        def predict(ids, held, texts) -> Iterator[tuple]:
            texts = [t or "" for t in texts]
            for start, end in portions(texts):
                if model is None:
                    for key, out in zip(ids[start:end], held[start:end]):
                        yield key, out, UNDETERMINED, 0.0, None, True
                    continue
                identifier, calibration = model
                sums = identifier.score(texts[start:end])
                best, entropy, lead = entropies(sums, identifier.models.alphabet)
                chance = calibration.chance(lead)
                for i in range(end - start):
                    if sums[i, -1] == 0:
                        yield ids[start + i], held[start + i], UNDETERMINED, 0.0, None, True
                        continue
                    no = chance[i] < 0.5 or entropy[i] > calibration.highest
                    name = identifier.models.languages[best[i]]
                    yield ids[start + i], held[start + i], name, float(chance[i]), float(entropy[i]), bool(no)

        return predict

    schema = (
        "doc_id long, held_out boolean, lang_pred string, score double, "
        "cross_entropy double, rejected boolean"
    )
    return map_columns(rows.select("doc_id", held_out(F.col("doc_id")), "text"), schema, make)
