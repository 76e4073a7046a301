"""Secret scans with probabilistic automata inferred from labelled credentials.

Fixed patterns find the base spans. A bounded sample of what they found, labelled by
kind, trains one automaton per kind: a prefix tree whose statistically compatible
states are merged. Ordinary long tokens train one more. Every other token that could
be a credential is scored by how much likelier its format is under a credential
automaton than under the ordinary one, and added where that passes a threshold, which
kept-back credentials and the bulk of ordinary tokens set.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from .common import map_columns, store

# Kinds in order, their patterns and least lengths.
KINDS = ["assign", "access", "hex", "format"]
KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
ASSIGN = re.compile(
    r"""(?a:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED, LEAST_ACCESS = 12, 18

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
CONFIDENCE = 0.05  # of the test that keeps two states apart
FEW = 8  # credentials of a kind, of which none is kept back
ROUNDS = 8  # of taking credentials out of the ordinary sample
UNSEEN = math.log(1e-4)  # a symbol that a state never emitted

Span = tuple[str, int, int, str]


def base_spans(text: str) -> list[Span]:
    """Kind, start, end (code points) and credential of every base match, in order."""
    found: list[Span] = []
    lowered = text.lower()
    if any(k in lowered for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[1]) >= LEAST_ASSIGNED:
                found.append(("assign", *m.span(), m[1]))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= LEAST_ACCESS:
                found.append(("access", *m.span(), m[0]))
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listing(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in spans)


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, str]]:
    """Tokens that could be credentials and touch no base span."""
    found = []
    at = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(base) and base[at][2] <= start:
            at += 1
        if not any(s < end and start < e for _, s, e, _ in base[at:at + 8]):
            found.append((start, end, m[0]))
    return found


# Automata


class Automaton:
    """A probabilistic automaton merged from the prefix tree of some words."""

    def __init__(self, words: Iterable[str]):
        self.passed: list[int] = [0]
        self.ended: list[int] = [0]
        self.taken: list[dict[str, int]] = [{}]  # how often each symbol was followed
        self.next: list[dict[str, int]] = [{}]
        for word in words:
            state = 0
            self.passed[0] += 1
            for char in word:
                if char not in self.next[state]:
                    self.next[state][char] = len(self.next)
                    for column, empty in ((self.passed, 0), (self.ended, 0), (self.taken, {}), (self.next, {})):
                        column.append(empty if empty == 0 else {})
                self.taken[state][char] = self.taken[state].get(char, 0) + 1
                state = self.next[state][char]
                self.passed[state] += 1
            self.ended[state] += 1
        self._merge()
        self._finish()

    def _differ(self, hits: int, of: int, other_hits: int, other_of: int) -> bool:
        bound = math.sqrt(0.5 * math.log(2 / CONFIDENCE))
        return abs(hits / of - other_hits / other_of) > bound * (of**-0.5 + other_of**-0.5)

    def _compatible(self, one: int, other: int) -> bool:
        """Whether two states, and all that follow them, could be the same one."""
        waiting = [(one, other)]
        while waiting:
            a, b = waiting.pop()
            n, m = self.passed[a], self.passed[b]
            if n * m == 0 or a == b:
                continue
            if self._differ(self.ended[a], n, self.ended[b], m):
                return False
            for char in self.next[a].keys() | self.next[b].keys():
                if self._differ(self.taken[a].get(char, 0), n, self.taken[b].get(char, 0), m):
                    return False
                if char in self.next[a] and char in self.next[b]:
                    waiting.append((self.next[a][char], self.next[b][char]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add the counts of a subtree of the prefix tree to a state and what follows it."""
        waiting = [(into, tree)]
        while waiting:
            a, b = waiting.pop()
            self.passed[a] += self.passed[b]
            self.ended[a] += self.ended[b]
            for char, count in self.taken[b].items():
                self.taken[a][char] = self.taken[a].get(char, 0) + count
                if char in self.next[a]:
                    waiting.append((self.next[a][char], self.next[b][char]))
                else:
                    self.next[a][char] = self.next[b][char]

    def _merge(self) -> None:
        """Settled states grow from the root; each state next to them joins one or settles."""
        settled = [0]
        members = {0}
        while True:
            edges = [(s, c, t) for s in settled for c, t in sorted(self.next[s].items()) if t not in members]
            if not edges:
                break
            source, char, state = max(edges, key=lambda e: self.passed[e[2]])
            for known in settled:
                if self._compatible(known, state):
                    self.next[source][char] = known
                    self._fold(known, state)
                    break
            else:
                settled.append(state)
                members.add(state)
        self.states = settled

    def _finish(self) -> None:
        number = {s: i for i, s in enumerate(self.states)}
        self.moves = []
        self.stop = []
        for s in self.states:
            total = max(1, self.passed[s])
            self.moves.append(
                {c: (number[t], math.log(self.taken[s][c] / total)) for c, t in self.next[s].items()}
            )
            self.stop.append(math.log(max(self.ended[s] / total, 1e-4)))

    def score(self, word: str) -> float:
        """Log likelihood of a word per symbol."""
        state, total = 0, 0.0
        for char in word:
            state, step = self.moves[state].get(char, (state, UNSEEN))
            total += step
        return (total + self.stop[state]) / (len(word) + 1)


def digest(value: str) -> int:
    """A number of 63 bits that orders values evenly."""
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest()) >> 1


def beyond(values: list[float], sign: int) -> float:
    """A bound that the bulk of some values stays under (1) or above (-1).

    It rests on the median and the quartile of the far side only, so that strangers on
    the near side, if less than half of all, hardly move it. It is never beyond all
    but a fiftieth of the values.
    """
    ordered = sorted(sign * v for v in values)
    middle = ordered[len(ordered) // 2]
    far = middle + 6 * (middle - ordered[len(ordered) // 4])
    return sign * min(far, ordered[-1 - len(ordered) // 50])


class FormatModel:
    """Credential automata against the ordinary one, with the thresholds between them.

    A quarter of each kind's credentials is kept back from training. A token passes for a
    kind if its score is one that kept-back credentials reach, and its margin over the
    ordinary automaton lies between theirs and those of the bulk of ordinary tokens, each
    judged by an automaton that did not see it. Ordinary samples are unlabelled, so those
    that pass are taken out and the rest trains anew. Without ordinary tokens none passes.
    """

    def __init__(self, credentials: dict[str, list[str]], ordinary: list[str]):
        self.kinds: list[tuple[Automaton, float, float]] = []  # with least score and margin
        self.ordinary = None
        if not ordinary:
            return
        kinds = []
        for _, words in sorted(credentials.items()):
            words = sorted(set(words), key=digest)
            if words:
                few = len(words) < FEW
                trained = Automaton(sorted(words if few else [w for i, w in enumerate(words) if i % 4]))
                held = words if few else words[::4]
                kinds.append((trained, held, beyond([trained.score(w) for w in held], -1)))
        words = sorted(set(ordinary), key=digest)
        strange: set[str] = set()
        for _ in range(ROUNDS):
            plain = [w for w in words if w not in strange]
            halves = [plain[::2], plain[1::2] or plain]
            automata = [Automaton(sorted(half)) for half in halves]
            unseen = {w: automata[1 - i].score(w) for i, half in enumerate(halves) for w in half}
            self.kinds = []
            for trained, held, least in kinds:
                bulk = beyond([trained.score(w) - score for w, score in unseen.items()], 1)
                margins = sorted(trained.score(w) - max(a.score(w) for a in automata) for w in held)
                reached = margins[len(margins) // 10]
                self.kinds.append((trained, least, max(0.0, bulk, (bulk + reached) / 2 if reached > bulk else bulk)))
            scores = {w: unseen.get(w, automata[0].score(w)) for w in words}
            found = {w for w in words if self.passes(w, scores[w])}
            if found <= strange or len(found | strange) == len(words):
                break
            strange |= found
        self.ordinary = Automaton(sorted(w for w in words if w not in strange))

    def passes(self, word: str, plain: float) -> bool:
        for trained, least, margin in self.kinds:
            score = trained.score(word)
            if score >= least and score - plain > margin:
                return True
        return False

    def is_credential(self, word: str) -> bool:
        return self.ordinary is not None and self.passes(word, self.ordinary.score(word))


# Spark


def learn_formats(df: DataFrame, text_col: str, sample: int = 400, longest: int = 512) -> FormatModel:
    """Train on at most ``sample`` distinct credentials of each kind and as many ordinary tokens.

    The sample is the values of at most ``longest`` characters with the least digests, taken
    over all documents. Longer ones are scored like any other, symbol by symbol.
    """

    def make():
        least = {kind: ([], set()) for kind in (*KINDS[:3], "ordinary")}  # digests: a heap and a set

        def chosen(kind, value):
            """Whether a value may be in the sample, by what this task has seen."""
            if len(value) > longest:
                return None
            heap, held = least[kind]
            number = digest(value)
            if number in held or len(heap) >= sample and number > -heap[0]:
                return None
            heapq.heappush(heap, -number)
            held.add(number)
            if len(heap) > sample:
                held.discard(-heapq.heappop(heap))
            return kind, number, value

        def rows(texts):
            for text in texts:
                base = base_spans(text or "")
                found = [chosen(kind, value) for kind, _, _, value in base]
                found += [chosen("ordinary", value) for _, _, value in candidates(text or "", base)]
                yield from filter(None, found)

        return rows

    texts = df.select(F.col(f"`{text_col}`"))
    values = store(map_columns(texts, "kind string, digest long, value string", make).distinct(), "secret-sample")
    # How many values lie in each of 2^16 ranges of digests tells up to where the least of a
    # kind reach, so only about these come to the driver and no task orders those of a kind.
    place = F.shiftright("digest", 47)
    last: dict[str, int] = {}
    reached: dict[str, int] = defaultdict(int)
    for r in values.groupBy("kind", place.alias("place")).count().orderBy("kind", "place").collect():
        if reached[r.kind] < sample:
            last[r.kind] = r.place
        reached[r.kind] += r["count"]
    within = F.lit(False)
    for kind, until in last.items():
        within = within | ((F.col("kind") == kind) & (place <= until))
    words = defaultdict(list)
    for kind, number, value in values.where(within).collect():
        words[kind].append((number, value))
    picked = {kind: [value for _, value in sorted(found)[:sample]] for kind, found in words.items()}
    ordinary = picked.pop("ordinary", [])
    return FormatModel(picked, ordinary)


class Verdicts:
    """Whether tokens are credentials, remembered for short ones that a task meets again."""

    def __init__(self, model: FormatModel):
        self.model, self.known = model, {}

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        return [("format", s, e, value) for s, e, value in candidates(text, base) if self.is_credential(value)]

    def is_credential(self, value: str) -> bool:
        found = self.known.get(value)
        if found is None:
            found = self.model.is_credential(value)
            if len(value) <= 100:
                if len(self.known) >= 50_000:
                    self.known.clear()
                self.known[value] = found
        return found


def find_secrets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 400
) -> DataFrame:
    """Per row of ``df`` its secrets: base spans by fixed patterns, further ones by format.

    Columns: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``n_format``,
    ``base_sha256`` (of the listing of the base spans), ``spans`` (the listing of all).
    A listing is kind:start:end in code points, end exclusive, by start, joined by
    commas. A null or empty text has no spans and the digest of an empty listing. Null
    ids stay null, repeated rows give one row each, an empty table an empty result.
    """
    model = df.sparkSession.sparkContext.broadcast(learn_formats(df, text_col, sample))

    def make():
        verdicts = Verdicts(model.value)

        def rows(ids, texts):
            for key, text in zip(ids, texts):
                base = base_spans(text or "")
                added = verdicts.spans(text or "", base)
                digest = hashlib.sha256(listing(base).encode()).hexdigest()
                counts = [sum(s[0] == kind for s in base) for kind in KINDS[:3]]
                yield key, *counts, len(added), digest, listing(in_order(base + added))

        return rows

    chosen = df.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"))
    schema = (
        "doc_id long, n_assign long, n_access long, n_hex long, n_format long, "
        "base_sha256 string, spans string"
    )
    return map_columns(chosen, schema, make)


def redact(text: str, spans: list[Span], mask: str) -> str:
    """The text with every span, overlapping ones as one, replaced by ``mask``."""
    parts, at = [], 0
    last = None
    for _, start, end, _ in spans:
        if last is not None and start < last:
            last = max(last, end)
            at = last
            continue
        parts += [text[at:start], mask]
        at = last = end
    return "".join(parts) + text[at:]


def redact_secrets(
    df: DataFrame,
    text_col: str = "text",
    length_col: str = "n_chars",
    mask: str = "[SECRET]",
    sample: int = 400,
) -> DataFrame:
    """``df`` with every secret masked in its text; other columns and clean texts stay as they are.

    ``length_col``, if there, becomes the code points of texts that changed. A null or empty
    text stays, repeated rows give one row each, an empty table an empty result. Columns may
    be in any order and have any name.
    """
    model = df.sparkSession.sparkContext.broadcast(learn_formats(df, text_col, sample))
    at = df.columns.index(text_col)
    length = df.columns.index(length_col) if length_col in df.columns else None

    def make():
        verdicts = Verdicts(model.value)

        def rows(*columns):
            for row in zip(*columns):
                text = row[at]
                if text:
                    base = base_spans(text)
                    added = verdicts.spans(text, base)
                    if base or added:
                        row = list(row)
                        row[at] = redact(text, in_order(base + added), mask)
                        if length is not None:
                            row[length] = len(row[at])
                yield tuple(row)

        return rows

    schema = ", ".join("`" + f.name.replace("`", "``") + f"` {f.dataType.simpleString()}" for f in df.schema)
    return map_columns(df, schema, make)
