"""Best-fit packing with a grouping genetic algorithm on islands.

Documents are tokenized and cut into pieces of at most one sequence. Full pieces
are sequences of their own. All others are dealt into cells of bounded size; in
every cell a few islands evolve packings independently. A crossover injects whole
well-filled bins of one parent into the other, dissolves the bins that hold the
same pieces, and puts what is displaced back best-fit. After each epoch every
island's best packing also settles on the next island; at the end the best packing
of a cell counts.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .common import map_columns, portions, store

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"
CACHED_CHUNKS = 300_000  # words that a worker has met again and remembers, some 50 MB
NEW_CHUNKS = 250_000  # words that it has met once, and forgets unless they come again
CACHED_LENGTH = 64
LAST_LATIN = "ɏ"
JOINED = 200
PORTION = 4_000_000  # characters that are encoded at the same time


# Tokenizing


class Encoder:
    """Encodes texts word by word and remembers the words' ids as bytes.

    Good for vocabularies that drop white space and never join across it.
    """

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.known: dict[str, bytes] = {}
        self.new: dict[str, bytes] = {}
        self.ends = dict(zip(".,", self.encode_words([".", ","])))
        self.ends[""] = b""
        model = json.loads(spec)["model"]
        suffix = model.get("end_of_word_suffix")
        self.is_last = np.zeros(max(model["vocab"].values()) + 1, bool)  # tokens that end a word
        self.is_last[[i for s, i in model["vocab"].items() if suffix and s.endswith(suffix)]] = True

    def encode_words(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def encode_plain(self, words: list[str]) -> list[bytes]:
        """Like :meth:`encode_words` for words of letters only, many of them as one text.

        Such a word is one unit to the splitter, and its last token is marked as such.
        """
        rows = range(0, len(words), JOINED)
        encoded = self.tokenizer.encode_batch_fast(
            [" ".join(words[i : i + JOINED]) for i in rows], add_special_tokens=False
        )
        ids = np.array([i for e in encoded for i in e.ids], np.uint32)
        cuts = [0, *(4 * (np.flatnonzero(self.is_last[ids]) + 1)).tolist()]
        if len(cuts) != len(words) + 1:  # a vocabulary without such marks
            return self.encode_words(words)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words, each looked up without case and a last stop or comma, which the
        vocabulary sets apart, where it is of letters only."""
        ends, known = self.ends, self.known
        stems = {}
        for word in words:
            end = word[-1:]
            low = word[:-1].lower() if end in ends else word.lower()
            if low.isalpha() and (low.isascii() or max(low) <= LAST_LATIN):
                stems[word] = low, end if end in ends else ""
            else:
                stems[word] = word, ""
        new = {stem for stem, _ in stems.values()} - known.keys()
        plain = [s for s in new if s.isalpha() and (s.isascii() or max(s) <= LAST_LATIN)]
        other = list(new.difference(plain))
        now = dict(zip(plain, self.encode_plain(plain)))
        now.update(zip(other, self.encode_words(other)))
        return {w: (known[stem] if stem in known else now[stem]) + ends[end] for w, (stem, end) in stems.items()}

    def look_up(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words that are not among the known ones.

        Most distinct words of a large corpus come once. Only those that come again within the
        next portions become known, so that frequent words fill the memory, not the first.
        """
        new = self.new
        again = {w: new.pop(w) for w in words if w in new}
        now = self.learn([w for w in words if w not in again])
        if len(self.known) < CACHED_CHUNKS:
            self.known |= again
        if len(new) > NEW_CHUNKS:
            new.clear()
        new |= {w: i for w, i in now.items() if len(w) <= CACHED_LENGTH}
        return now | again

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as 32-bit numbers.

        The words of all texts are numbered by Arrow; only distinct ones are looked up.
        """
        blank = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " ")
        parts = pc.split_pattern(blank, " ")
        coded = parts.flatten().dictionary_encode()
        words, word_of = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        ids = list(map(self.known.get, words))
        if missing := [w for w, i in zip(words, ids) if i is None]:
            found = self.look_up(missing)
            ids = [found[w] if i is None else i for w, i in zip(words, ids)]
        table = np.frombuffer(b"".join(ids), np.uint32)
        offsets = parts.offsets.to_numpy()
        del blank, parts, coded, words
        # Numbers of a portion fit 32 bits, which halves what is held here.
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        start = np.cumsum(size, dtype=np.int32) - size
        size, start = size[word_of], start[word_of]
        until = np.cumsum(size, dtype=np.int32)
        start -= until
        start += size
        place = np.repeat(start, size)
        place += np.arange(len(place), dtype=np.int32)
        flat = table[place]
        bounds = np.append(0, until)[offsets]
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]


_encoders: dict[str, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    if spec not in _encoders:
        # One thread for each task: a pool of threads would keep memory for each of them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders.clear()
        _encoders[spec] = Encoder(spec)
    return _encoders[spec]


def token_pieces(
    df: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 1,
    keep_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token ids of every document with ``end_id`` behind them, cut into pieces of ``capacity``.

    Only documents longer than ``capacity`` are cut. ``ids_crc32`` is the checksum
    of the piece's ids as little-endian 32-bit numbers. A null or empty text is the
    single ``end_id``. With ``keep_ids`` false the ids themselves stay null.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = df.sparkSession.sparkContext.broadcast(file.read())
    tail = np.array([end_id], np.uint32)

    def make():
        encoder = _encoder(spec.value)

        def rows(keys, texts):
            texts = [t or "" for t in texts]
            for first, last in portions(texts, PORTION):
                for key, ids in zip(keys[first:last], encoder.encode(texts[first:last])):
                    ids = np.concatenate((ids, tail)).astype("<u4")
                    for piece, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at : at + capacity]
                        held = part.astype(np.int32) if keep_ids else None
                        yield key, piece, at, len(part), zlib.crc32(part.tobytes()), held

        return rows

    chosen = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_columns(chosen, PIECES, make, PORTION)


# Packings of one cell


class Packing:
    """Bins of piece numbers with their loads, and the bin of every piece."""

    def __init__(self, n: int):
        self.bins: list[list[int]] = []
        self.load: list[int] = []
        self.where = [-1] * n

    @classmethod
    def of(cls, where: np.ndarray, lengths: list[int]) -> Packing:
        self = cls(len(lengths))
        names: dict[int, int] = {}
        for item, name in enumerate(where.tolist()):
            b = names.setdefault(name, len(self.bins))
            if b == len(self.bins):
                self.bins.append([])
                self.load.append(0)
            self.put(item, b, lengths[item])
        return self

    def put(self, item: int, b: int, length: int) -> None:
        self.bins[b].append(item)
        self.load[b] += length
        self.where[item] = b

    def best_fit(self, items: list[int], lengths: list[int], capacity: int) -> None:
        """Put each item into the fullest bin that takes it, else into a new one."""
        room = sorted((capacity - load, b) for b, load in enumerate(self.load))
        for item in items:
            length = lengths[item]
            at = bisect_left(room, (length, -1))
            if at < len(room):
                free, b = room.pop(at)
            else:
                free, b = capacity, len(self.bins)
                self.bins.append([])
                self.load.append(0)
            self.put(item, b, length)
            if free > length:
                insort(room, (free - length, b))

    def fitness(self, capacity: int) -> tuple[int, float]:
        """Fewer bins first, then unevenly filled ones: they leave room that can be used."""
        return len(self.bins), -sum((load / capacity) ** 2 for load in self.load)


def crossover(
    one: Packing, other: Packing, lengths: list[int], capacity: int, rng: np.random.Generator
) -> Packing:
    """Well-filled bins of ``other`` go into ``one`` whole; what they displace is best-fitted."""
    fullest = np.argsort(-np.array(other.load), kind="stable")[: max(1, len(other.bins) // 2)]
    chosen = [b for b in fullest.tolist() if rng.random() < 0.5] or [int(fullest[0])]
    injected = {item for b in chosen for item in other.bins[b]}
    hit = {one.where[item] for item in injected}
    child = Packing(len(lengths))
    for b, items in enumerate(one.bins):
        if b not in hit:
            for item in items:
                child.where[item] = len(child.bins)
            child.bins.append(list(items))
            child.load.append(one.load[b])
    for b in chosen:
        for item in other.bins[b]:
            child.where[item] = len(child.bins)
        child.bins.append(list(other.bins[b]))
        child.load.append(other.load[b])
    displaced = [i for b in hit for i in one.bins[b] if i not in injected]
    displaced.sort(key=lambda i: (-lengths[i], i))
    child.best_fit(displaced, lengths, capacity)
    return child


def evolve(
    lengths: list[int],
    capacity: int,
    settlers: list[np.ndarray],
    population: int,
    generations: int,
    rng: np.random.Generator,
) -> Packing:
    """The best packing after some generations from settlers and freshly made parents."""
    least = -(-sum(lengths) // capacity)
    members = [Packing.of(where, lengths) for where in settlers]
    by_length = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    while len(members) < max(2, population):
        order = by_length
        if members:  # all but one start from a disturbed order
            noise = rng.uniform(0.85, 1.0, len(lengths))
            order = np.argsort(-np.array(lengths) * noise, kind="stable").tolist()
        fresh = Packing(len(lengths))
        fresh.best_fit(order, lengths, capacity)
        members.append(fresh)
        if len(fresh.bins) == least:
            return fresh
    members.sort(key=lambda m: m.fitness(capacity))
    for _ in range(generations):
        if len(members[0].bins) == least:
            break
        a, b = rng.choice(len(members), 2, replace=False)
        child = crossover(members[int(a)], members[int(b)], lengths, capacity, rng)
        members.append(child)
        members.sort(key=lambda m: m.fitness(capacity))
        members.pop()
    return members[0]


# Islands


def pack_pieces(
    pieces: DataFrame,
    capacity: int = 4096,
    cell_size: int = 6000,
    islands: int = 2,
    epochs: int = 2,
    population: int = 4,
    generations: int = 8,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have a ``length`` of 1 to ``capacity``.

    Pieces of full length are sequences of their own. The rest is dealt by a hash of
    the row into cells of about ``cell_size`` rows, whatever documents or copies they
    come from, so that no group grows with the data. Numbers of sequences are any
    long values; offsets run gapless from 0. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    rows = store(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    full = rows.filter(F.col("length") >= capacity).select(
        *pieces.columns,
        (-1 - F.col("_row")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    short = rows.filter(F.col("length") < capacity)
    cells = max(1, round(short.count() / cell_size))
    island = F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island")
    state = short.select(
        F.pmod(F.xxhash64("_row"), F.lit(cells)).alias("cell"),
        "_row",
        "length",
        island,
        F.lit(None).cast("int").alias("origin"),
        F.lit(None).cast("int").alias("bin"),
    )
    result = "cell long, island int, _row long, length long, bin int, bins int, score double, offset long"

    def epoch(number: int):
        def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(["origin", "_row"], na_position="first")
            settlers, frame = [], group
            for _, part in group.groupby("origin", dropna=False):
                frame = part
                if part["bin"].notna().all():
                    settlers.append(part["bin"].to_numpy(np.int64))
            lengths = frame["length"].tolist()
            rng = np.random.default_rng([int(key[0]), int(key[1]), number])
            best = evolve(lengths, capacity, settlers, population, generations, rng)
            where = np.array(best.where)
            bins, score = best.fitness(capacity)
            inside = pd.Series(lengths).groupby(where).cumsum().to_numpy() - lengths
            return pd.DataFrame(
                {
                    "cell": key[0], "island": key[1], "_row": frame["_row"].to_numpy(),
                    "length": lengths, "bin": where, "bins": bins, "score": score,
                    "offset": inside,
                }
            )

        return run

    for number in range(epochs):
        packed = store(
            state.groupBy("cell", "island").applyInPandas(epoch(number), result), "packing"
        )
        home = F.explode(F.array("island", F.pmod(F.col("island") + 1, F.lit(islands))))
        state = packed.select(
            "cell", "_row", "length", home.alias("island"), F.col("island").alias("origin"), "bin"
        )
    best = packed.groupBy("cell").agg(F.min(F.struct("bins", "score", "island"))["island"].alias("island"))
    places = packed.join(best, ["cell", "island"]).select(
        "_row",
        (F.col("cell") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id"),
        "offset",
    )
    return short.join(places, "_row").select(*full.columns).unionByName(full)


def build_sequences(placed: DataFrame) -> DataFrame:
    """Put the ids of placed pieces together: one row per sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))


def pack_documents(df: DataFrame, tokenizer: str, capacity: int = 4096, **options) -> DataFrame:
    """Tokenize and pack whole documents; one row per piece.

    Null and empty texts are one token long and packed like any other. Rows with a
    null id or the same id are separate documents. Only the id and the text are read.
    ``options`` are those of :func:`pack_pieces`.
    """
    pieces = token_pieces(df, tokenizer, capacity, keep_ids=False).drop("ids")
    return pack_pieces(pieces, capacity, **options)
