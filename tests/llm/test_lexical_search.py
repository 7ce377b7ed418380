"""Lexical search against a plain count of all terms."""

import math
import random
import re
from collections import Counter

import pytest

from footfall.llm import lexical_search
from footfall.llm.common import ship_package

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def terms(text):
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return TERM.findall(lowered)


def by_hand(items, docs, top=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    documents, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    own = {}
    for item, text in items:
        own.setdefault(item, set()).update(terms(text))
    out = set()
    for item, wanted in own.items():
        rows = []
        for doc, c in counts:
            m = 100 - 90 + 90 * sum(c.values()) * documents // words
            score = 0
            for t in wanted & c.keys():
                w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                rows.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(rows)[:top], 1):
            out.add((item, rank, doc, -score))
    return out


def found(spark, items, docs, **options):
    rows = lexical_search.search(
        spark.createDataFrame(items, "item_id long, text string"),
        spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, score string, n int")
        .repartition(3),
        **options,
    ).collect()
    got = {(r.item_id, r["rank"], r.doc_id, r.score) for r in rows}
    assert len(got) == len(rows)
    return got


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "été", "Été", "x1", "漢字", "a_b", "_", "foo\x85bar", "İ", "x y"]
    words += ["".join(rng.choices("abc", k=2)) for _ in range(12)]
    glue = [" ", "\n", "  ", "-", "'", "\t", "\x1c"]
    return ["".join(rng.choice(words) + rng.choice(glue) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 60}, {"top": 3, "block_items": 2, "block_bytes": 400}])
def test_search_equals_all_scores(spark, options):
    items = list(enumerate(corpus(1, 9))) + [(3, "the Foo zz"), (None, "x1 été"), (40, None), (41, " .")]
    docs = list(enumerate(corpus(2, 150))) + [(150, None), (151, ""), (152, "--")]
    assert found(spark, items, docs, **options) == by_hand(items, docs, options.get("top", 10))


def test_ties_repeats_and_null_ids(spark, monkeypatch):
    items = [(1, "aa bb"), (2, "cc")]
    docs = [(i, "aa bb dd") for i in range(40, 0, -1)] + [(None, "aa bb dd")] * 2 + [(7, "cc dd"), (7, "cc dd")]
    rows = lexical_search.search(
        spark.createDataFrame(items, "item_id long, text string"),
        spark.createDataFrame(docs, "doc_id long, text string"),
    ).collect()
    got = sorted((r.item_id, r["rank"], r.doc_id) for r in rows)
    assert got == [(1, k, k) for k in range(1, 11)] + [(2, 1, 7), (2, 2, 7)]


def test_small_slices_give_the_same(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(lexical_search, "_CELLS", 7)
    block = lexical_search.make_block([1, 2, 3], ["aa bb", "bb cc", "dd"])
    weights = np.array([5, 7, 11, 13])
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array([5, 4, None, 9], pa.int64()), "n": pa.array([3, 3, 3, 9], pa.int64()),
        "terms": pa.array([[0, 1], [0, 1], [0, 1], [2]], pa.list_(pa.int32())),
        "tfs": pa.array([[1, 2], [1, 2], [1, 2], [9]], pa.list_(pa.int32())),
    })
    out = next(lexical_search._best_rows(block, weights, 4, 18, 2)(iter([batch]))).to_pydict()
    best = {}
    for place, doc in zip(out["place"], out["doc_id"], strict=True):
        best.setdefault(place, []).append(doc)
    assert {k: sorted(v) for k, v in best.items() if k == 0} == {0: [4, 5]}
    assert 2 not in best and len(best[1]) == 2


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == set()
    assert found(spark, [(1, "a")], []) == set()
    assert found(spark, [(1, None)], [(1, "a")]) == set()
    assert found(spark, [(1, "b")], [(1, "a")]) == set()


def test_marks_beyond_64_bits():
    import numpy as np

    n = np.array([3, 10**9])
    marks = lexical_search.length_marks(n, 10**11, 10**13)
    assert marks.tolist() == [10 + 90 * int(k) * 10**11 // 10**13 for k in n]
