"""Ranked search against scores of every document, and the index itself."""

import math
import random
import re
from collections import Counter

import numpy as np
import oracle_check
import pytest
from tilewright.llm import queries, ranking
from tilewright.session import local_frame

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, score string, m long, terms string"
ITEMS = "item_id long, text string, doc_id string"


def terms(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def expected(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * len(held) + 2) / (2 * n + 1))) for t, n in df.items()}
    rows = []
    for item, text in set(items):
        scored = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * len(held) // total
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i, m))
        for rank, (score, _, _, i, m) in enumerate(sorted(scored)[:k], start=1):
            rows.append((item, rank, i, -score, m))
    return sorted(rows, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score", "m").collect()), key=repr)


def test_sql(spark):
    df = queries.op11_lexical_search(spark, SF)
    con = oracle_check.connect(SF)
    assert oracle_check.differences(con, df, queries.ORACLE["op11_lexical_search"]) is None


def corpus(seed, count):
    rng = random.Random(seed)
    words = ["the", "a", "Of", "x1", "é", "\u00a0", "日本", "naïve", *(f"w{i}" for i in range(60))]
    weights = [30, 20, 10, *[1] * (len(words) - 3)]
    text = lambda n: rng.choice([" ", ", ", "\n", "-", "_"]).join(rng.choices(words, weights, k=n))
    docs = [(i, text(rng.choice([1, 3, 3, 3, 20, 40, 400]))) for i in range(count)]
    docs += docs[:5] + [(None, "w1 w2"), (None, "the w1"), (900, None), (901, ""), (902, " ,;"), (903, "w5 " * 30_000)]
    items = [(i, text(rng.choice([1, 2, 8, 30]))) for i in range(25)]
    items += [*items[:3], (3, "w1 another text"), (70, None), (71, ""), (72, "unseen words only"), (None, "W2 w2 the")]
    return docs, items


@pytest.mark.parametrize("portion, block", [(1_000_000, 100_000), (50, 7)])
def test_random_corpus(spark, monkeypatch, portion, block):
    """Ties, copies, nulls, long texts, clashing names; small portions and blocks give the same."""
    monkeypatch.setattr(ranking, "PORTION", portion)
    monkeypatch.setattr(ranking, "BLOCK_TERMS", block)
    docs, items = corpus(portion, 120 if block < 100 else 400)
    items = items if block > 100 else items[:6]
    frame = local_frame(spark, [(i, t, "s", 1, "t") for i, t in docs], DOCS)
    asked = local_frame(spark, [(i, t, "d") for i, t in items], ITEMS)
    assert found(ranking.lexical_search(frame, asked)) == expected(docs, items)


def test_empty_tables(spark):
    docs, items = (local_frame(spark, [], "item_id long, doc_id long, text string") for _ in range(2))
    some = local_frame(spark, [(1, 1, "words here")], "item_id long, doc_id long, text string")
    for pair in ((docs, items), (docs, some), (some, items)):
        result = ranking.lexical_search(*pair)
        assert result.count() == 0 and result.columns == ["item_id", "rank", "doc_id", "score", "m"]
    whole = ranking.lexical_search(some, some).collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in whole] == [(1, 1, 1)]


def portion_of(m, tfs):
    """One term, one document per entry."""
    n = len(m)
    documents = np.stack([np.zeros(n, np.int64), np.arange(n), np.array(m)])
    return ranking.Portion(documents, np.ones(n, np.int64), np.zeros(n, np.int64), np.array(tfs))


def test_bounds_spare_strata():
    """Short documents fill the ranks, so the strata of long ones are never visited; ties are."""
    portion = portion_of([20] * 12 + list(range(500, 900)), [3] * 12 + [1] * 400)
    best = ranking.Best(10)
    assert ranking.search(portion, np.array([0]), np.array([100]), best) == 1
    assert best.rows[2].tolist() == list(range(10))
    later = portion_of([20, 21], [3, 3])
    later.documents[1] = [-5, -6]
    assert ranking.search(later, np.array([0]), np.array([100]), best) == 1
    assert best.rows[2].tolist() == [-5, *range(9)]


def test_impacts_once_per_tf():
    portion = portion_of([50] * 6 + [60] * 2, [1, 2, 2, 7, 7, 1, 1, 2])
    assert portion.impact.tolist() == [10**9 * tf // (1000 * tf + 8 * m) for m, tf in
                                       [(50, 1), (50, 1), (50, 2), (50, 2), (50, 7), (50, 7), (60, 1), (60, 2)]]
    assert portion.most.tolist() == [10**9 * 7 // 7400, 10**9 * 2 // 2480]


def test_one_length_in_many_tasks(spark):
    """A length that all documents share is no single task."""
    docs = [(i, f"w{i % 7} the end") for i in range(4000)]
    frame = local_frame(spark, docs, "doc_id long, text string")
    items = [(1, "the w3")]
    asked = local_frame(spark, items, "item_id long, text string")
    assert found(ranking.lexical_search(frame, asked)) == expected(docs, items)
