"""Token counts by rank-synchronous merging of ragged arrays.

Texts fall apart into chunks whose tokens do not depend on their neighbours. The
distinct chunks of a portion of texts become one ragged array of byte symbols, in
which every sequence applies its own lowest-ranked pair, all sequences at once,
until no pair has a rank. What survives is counted; a document's count is the sum
over its chunks.
"""

from __future__ import annotations

import json
import re

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import pre_tokenizers

from .common import map_columns, portions

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

NO_RANK = np.int64(1) << 40
CACHED_CHUNKS = 600_000  # chunks a worker remembers before it starts afresh
CACHED_LENGTH = 64  # longer chunks are counted each time
LAST_LATIN = "ɏ"  # beyond it, letters are told by the library's own splitter

# Two separators side by side, or one at an end: the text is split by the slower pattern.
UNEVEN = re.compile(r"\s[ \n]|[ \n]\s|\A\s|\s\Z")
BEFORE_CHUNK = re.compile(r"(?<=\S)(?=[ \n]\S)")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in for every byte: itself where printable, else the next of U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """The merge table of a byte-level BPE file as sorted arrays."""

    def __init__(self, spec: str):
        parts = json.loads(spec)
        vocabulary = parts["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in parts["model"]["merges"]]
        left, right, merged = (
            np.array([vocabulary[x] for x in column], np.int64)
            for column in zip(*((a, b, a + b) for a, b in pairs))
        )
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged
        self.alphabet = byte_alphabet()
        self.of_byte = np.empty(256, np.int64)
        for char, byte in self.alphabet.items():
            self.of_byte[byte] = vocabulary[char]
        self.special = [t["content"] for t in parts["added_tokens"]]

    def rank_pairs(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that start at ``at``; pairs across two sequences have none."""
        after = np.minimum(at + 1, max(len(symbols) - 1, 0))
        pair = symbols[at] << 32 | symbols[after]
        place = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        found = (self.keys[place] == pair) & (owner[at] == owner[after]) & (after > at)
        return np.where(found, self.ranks[place], NO_RANK)

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left of each sequence when no pair with a rank is left."""
        counts = np.fromiter(map(len, sequences), np.int64, len(sequences))
        symbols = self.of_byte[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), counts)
        rank = self.rank_pairs(symbols, owner, np.arange(len(symbols)))
        while symbols.size > 1:
            first = np.concatenate(([True], owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, np.flatnonzero(first))[np.cumsum(first) - 1]
            going = lowest < NO_RANK
            here = np.flatnonzero(going & (rank == lowest))
            if not here.size:
                break
            # Equal pairs that overlap, as in "aaa", merge from the left: every other one of a run.
            starts = np.concatenate(([True], np.diff(here) > 1))
            run = np.maximum.accumulate(np.where(starts, here, 0))
            here = here[(here - run) % 2 == 0]
            symbols[here] = self.merged[rank[here]]
            counts -= np.bincount(owner[here], minlength=len(counts))
            touched = np.zeros(len(symbols), bool)
            touched[here] = True
            going[here + 1] = False
            symbols, owner, rank, touched = (x[going] for x in (symbols, owner, rank, touched))
            touched[:-1] |= touched[1:]
            again = np.flatnonzero(touched)
            rank[again] = self.rank_pairs(symbols, owner, again)
        return counts


class Counter:
    """Counts tokens of texts and remembers the counts of chunks."""

    def __init__(self, spec: str):
        self.merges = Merges(spec)
        self.special = re.compile("|".join(map(re.escape, self.merges.special)) or r"(?!)")
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        # Fixed value: the split pattern of the vocabulary.
        self.pattern = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )
        self.known: dict[str, int] = {}

    def chunks(self, text: str) -> list[str]:
        """Pieces of a text that the splitter treats alike wherever they stand."""
        if UNEVEN.search(text):
            return BEFORE_CHUNK.split(text)
        words = text.replace("\n", " \n").split(" ")
        return [words[0], *[w if w[:1] == "\n" else " " + w for w in words[1:]]]

    def pretokens(self, chunk: str) -> list[bytes]:
        if max(chunk) <= LAST_LATIN:
            return [p.encode() for p in self.pattern.findall(chunk)]
        return [
            bytes(self.merges.alphabet[c] for c in piece)
            for piece, _ in self.splitter.pre_tokenize_str(chunk)
        ]

    def count_chunks(self, chunks: list[str]) -> np.ndarray:
        pieces = [self.pretokens(c) for c in chunks]
        counts = self.merges.count([p for ps in pieces for p in ps])
        owner = np.repeat(np.arange(len(chunks)), [len(ps) for ps in pieces])
        return np.bincount(owner, counts, len(chunks)).astype(np.int64)

    def count(self, texts: list[str]) -> list[int]:
        total, parts = [], []
        for text in texts:
            between = self.special.split(text)
            total.append(len(between) - 1)
            parts.append([c for t in between if t for c in self.chunks(t)])
        if len(self.known) > CACHED_CHUNKS:
            self.known.clear()
        missing = list({c for chunks in parts for c in chunks} - self.known.keys())
        now = dict(zip(missing, self.count_chunks(missing).tolist())) if missing else {}
        self.known |= {c: n for c, n in now.items() if len(c) <= CACHED_LENGTH}
        known = self.known
        return [
            n + sum([known[c] if c in known else now[c] for c in chunks])
            for n, chunks in zip(total, parts)
        ]


_counters: dict[str, Counter] = {}


def _counter(spec: str) -> Counter:
    """One counter per worker process, kept from task to task."""
    if spec not in _counters:
        _counters.clear()
        _counters[spec] = Counter(spec)
    return _counters[spec]


def count_tokens(
    df: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``df`` the bytes and tokens of its whole text.

    ``tokenizer`` is the path of a byte-level BPE file; the driver reads it and
    sends its text (a vocabulary's size, whatever the data) to the executors.
    Special strings inside a text count one token each, as the library's default.

    A null text counts as empty: 0 bytes, 0 tokens. A null id stays null, repeated
    rows give one row each, an empty table an empty result. Only the two named
    columns are read, so other columns may have any name.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = df.sparkSession.sparkContext.broadcast(file.read())

    def make():
        counter = _counter(spec.value)

        def rows(ids, texts):
            texts = [t or "" for t in texts]
            for start, end in portions(texts):
                part = texts[start:end]
                for key, text, n in zip(ids[start:end], part, counter.count(part)):
                    yield key, len(text.encode()), n, n > limit

        return rows

    chosen = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_columns(chosen, COUNTS, make)
