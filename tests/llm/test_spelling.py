"""Spelling variants against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from footfall.llm import spelling

WORDS = "word string, n long, form string, key int"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(counts, ratio=spelling.RATIO):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        formed = best is not None and counts[best] >= ratio * n
        out[w] = (best if formed else None, len(near), counts[best] if formed else None)
    rows = {}
    for w, (form, n_near, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows[w] = (form, root, counts[w], n_near, form_n)
    return rows


def found(spark, counts, **options):
    df = spark.createDataFrame([(w, n, "x", 1) for w, n in counts.items()], WORDS)
    rows = spelling.spelling_forms(df, **options).collect()
    assert len(rows) == len(counts)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_forms_equal_all_pairs(spark):
    rng = random.Random(2)
    letters = "abcdeéÿ漢"
    counts = {}
    for _ in range(250):
        word = "".join(rng.choices(letters, k=rng.randrange(1, 8)))
        for _ in range(4):
            counts[word] = rng.choice([1, 5, 5, 26, 130, 700])
            at = rng.randrange(len(word) + 1)
            word = word[:at] + rng.choice(letters) + word[at + rng.randrange(2) :]
    assert found(spark, counts) == by_hand(counts)


def test_chains_and_ties(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "aaaaac": 25}
    rows = found(spark, counts)
    assert rows == by_hand(counts)
    assert rows["aaaaaa"][:2] == ("aaaaab", "aabbbb")


@pytest.mark.parametrize("size", [63, 64, 65, 300, 20_000])
def test_long_words(spark, size):
    rng = random.Random(size)
    base = "".join(rng.choices("abcdefgh", k=size))
    middle = size // 2
    counts = {base: 500, base[1:]: 7, base + "x": 6, base[:middle] + "q" + base[middle:]: 5,
              base[:-1] + "z": 8, "z" + base[1:]: 9, base[:middle] + base[middle + 1 :]: 40}
    assert found(spark, counts) == by_hand(counts)


def test_runs_and_counts(spark):
    texts = ["Éclair ÉCLAIR éclair's plusieurs", None, "", "x" * 30 + "×÷ÿ" + "9abcdefg", "plusieurs " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    runs = spelling.letter_runs(docs, 6)
    assert sorted(r.run for r in runs.collect()) == sorted(
        ["Éclair", "Éclair", "éclair", *["plusieurs"] * 4, "x" * 30 + "×÷ÿ", "abcdefg"]
    )
    counted = spelling.count_words(runs, "run", 2).collect()
    assert {(r.word, r.n) for r in counted} == {("Éclair", 2), ("plusieurs", 4)}
    none = spelling.spelling_forms(spelling.count_words(runs.limit(0), "run", 1))
    assert none.count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_forms(spelling.count_words(runs, "run", 1), ratio=1)


def test_neighbourhoods_are_full(spark):
    for size in (4, 6):
        symbols = spelling._SYMBOLS[:size]
        row = spark.range(1).select(spelling.neighbourhood(F.lit("0112"), size).alias("x")).first()
        every = {"0112"}
        for i in range(5):
            every |= {"0112"[:i] + s + "0112"[i:] for s in symbols}
            if i < 4:
                every |= {"0112"[:i] + s + "0112"[i + 1 :] for s in ["", *symbols]}
        assert len(row.x) == len(every) and set(row.x) == every
