"""Spelling variants: words one edit apart, found in a reduced alphabet.

Letters are hashed to a few symbols. An edit of a word changes its reduced form by one
edit or not at all, so the full one-edit neighbourhood of every distinct reduced word,
joined with the vocabulary of reduced words, holds all near pairs; the original strings
decide. Everything is built from DataFrame functions.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stage

#: Letters that get a symbol of their own hash; all other signs share one.
LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
_SYMBOLS = "0123456789abcdefghijklmnopqrstuv"
_OTHER = "~"
#: Words of at least so many code points are met by their halves instead: a
#: neighbourhood's size grows with the square of the length.
LONG = 64
#: A form is at least so many times as frequent as its variant.
RATIO = 5


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    upper = "".join(map(chr, range(0x41, 0x5B)))
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def letter_runs(
    docs: DataFrame, min_letters: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, run) for each maximal run of at least ``min_letters`` Latin-1 letters, A-Z lowered."""
    found = F.regexp_extract_all(
        F.col(text_col), F.lit(f"[A-Za-zÀ-ÿ]{{{min_letters},}}"), F.lit(0)
    )
    runs = docs.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("run"))
    return runs.select("doc_id", lower_ascii(F.col("run")).alias("run"))


def count_words(words: DataFrame, word_col: str, least: int) -> DataFrame:
    """(word, n) of the words that occur at least ``least`` times; combined in map tasks."""
    return (
        words.groupBy(F.col(word_col).alias("word"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") >= least) & (F.length("word") > 0))
    )


def symbols_for(words: int) -> int:
    """The size of the reduced alphabet; its eighth power covers the number of words."""
    size = 4
    while size**8 < words and size < len(_SYMBOLS):
        size += 1
    return size


def reduced(word: Column, size: int) -> Column:
    """``word`` over the first ``size`` symbols, sign by sign."""
    image = "".join(_SYMBOLS[zlib.crc32(c.encode()) % size] for c in LETTERS + _OTHER)
    return F.translate(F.regexp_replace(word, f"[^{LETTERS}]", _OTHER), LETTERS + _OTHER, image)


def neighbourhood(word: Column, size: int) -> Column:
    """``word`` and all strings one edit from it over the first ``size`` symbols, each once."""
    symbols = F.array(*[F.lit(s) for s in _SYMBOLS[:size]])
    places = F.sequence(F.lit(1), F.length(word))

    def head(at: Column) -> Column:
        return F.substring(word, F.lit(1), at - 1)

    def tail(at: Column) -> Column:
        return F.substring(word, at, F.length(word))

    deleted = F.transform(places, lambda at: F.concat(head(at), tail(at + 1)))
    replaced = F.flatten(
        F.transform(
            places,
            lambda at: F.transform(symbols, lambda s: F.concat(head(at), s, tail(at + 1))),
        )
    )
    inserted = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.length(word) + 1),
            lambda at: F.transform(symbols, lambda s: F.concat(head(at), s, tail(at))),
        )
    )
    return F.array_distinct(F.concat(F.array(word), deleted, replaced, inserted))


def near_pairs(words: DataFrame, long_word: int = LONG) -> DataFrame:
    """(a, b, n_a, n_b) with a < b for all words that differ by exactly one edit.

    ``words(word, n)`` holds each word once. Neighbourhoods are made per distinct
    reduced word and kept in one direction, so each pair of reduced words meets once.
    """
    size = symbols_for(words.count())
    length = F.length("word")
    keyed = stage(
        words.filter(length <= long_word).select(
            "word", "n", reduced(F.col("word"), size).alias("reduced")
        ),
        "reduced_words",
    )
    vocabulary = keyed.select("reduced").distinct()
    around = vocabulary.select(
        F.xxhash64("reduced").alias("src"),
        F.explode(
            F.transform(neighbourhood(F.col("reduced"), size), lambda r: F.xxhash64(r))
        ).alias("dst"),
    ).filter("dst >= src")
    links = around.join(vocabulary.select(F.xxhash64("reduced").alias("dst")).distinct(), "dst")
    links = stage(links, "reduced_links")
    named = keyed.withColumn("key", F.xxhash64("reduced"))
    met = links.join(
        named.select(F.col("key").alias("src"), F.col("word").alias("x"), F.col("n").alias("n_x")),
        "src",
    ).join(
        named.select(F.col("key").alias("dst"), F.col("word").alias("y"), F.col("n").alias("n_y")),
        "dst",
    )
    short = _one_edit(met.filter("src <> dst OR x < y"))
    long = words.filter(length >= long_word)
    if long.isEmpty():
        return short.distinct()
    return short.unionByName(_long_pairs(long)).distinct()


def _one_edit(met: DataFrame) -> DataFrame:
    apart = met.filter(F.levenshtein("x", "y", 1) == 1)
    up = F.col("x") < F.col("y")
    return apart.select(
        F.least("x", "y").alias("a"),
        F.greatest("x", "y").alias("b"),
        F.when(up, F.col("n_x")).otherwise(F.col("n_y")).alias("n_a"),
        F.when(up, F.col("n_y")).otherwise(F.col("n_x")).alias("n_b"),
    )


def _long_pairs(words: DataFrame) -> DataFrame:
    """Pairs of long words: one edit leaves the first or the last half of the shorter one alone."""
    size = F.length("word")
    halves = F.array_distinct(F.transform(F.array(size - 1, size, size + 1), lambda n: F.floor(n / 2)))
    key = F.explode(
        F.flatten(
            F.transform(
                halves,
                lambda h: F.array(
                    F.xxhash64(F.lit("head"), h, F.substring("word", F.lit(1), h.cast("int"))),
                    F.xxhash64(
                        F.lit("tail"), h, F.substring("word", (size - h + 1).cast("int"), h.cast("int"))
                    ),
                ),
            )
        )
    )
    keyed = stage(words.select("word", "n", key.alias("key")), "long_words")
    other = keyed.select("key", F.col("word").alias("y"), F.col("n").alias("n_y"))
    mine = keyed.select("key", F.col("word").alias("x"), F.col("n").alias("n_x"))
    return _one_edit(mine.join(other, "key").filter("x < y"))


def spelling_forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``words(word, n)``: word, form, root, n, n_near, form_n.

    Near words differ by exactly one inserted, deleted or replaced code point; the form
    is the near word of largest n (the smallest of equal ones) if that n is at least
    ``ratio`` times the word's, and the root is the last of the forms that follow.

    * each word once, no nulls, n of 1 or more; ``count_words`` gives that.
    * a word without near words: n_near 0, no form, its own root. Empty table: no rows.
    * words of any length and script; other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent, or forms may not end")
    words = stage(words.select("word", "n"), "words")
    pairs = stage(near_pairs(words), "near_pairs")
    both = pairs.select(F.col("a").alias("w"), F.col("b").alias("near"), F.col("n_b").alias("m"))
    both = both.unionByName(
        pairs.select(F.col("b").alias("w"), F.col("a").alias("near"), F.col("n_a").alias("m"))
    )
    best = both.groupBy("w").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("top")
    )
    enough = -F.col("top.m") >= ratio * F.col("n")
    formed = stage(
        words.join(best, F.col("word") == F.col("w"), "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("top.near")).alias("form"),
            F.when(enough, -F.col("top.m")).alias("form_n"),
        ),
        "forms",
    )
    return formed.join(_roots(formed, ratio), F.col("word") == F.col("r_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(formed: DataFrame, ratio: int) -> DataFrame:
    """(r_word, root) of the words that have a form: pointers to the last one, doubled each round.

    Counts grow by ``ratio`` with every step, which bounds the rounds.
    """
    steps = stage(
        formed.filter("form IS NOT NULL").select(F.col("word").alias("r_word"), F.col("form").alias("root")),
        "form_steps",
    )
    most = formed.agg(F.max("form_n")).first()[0] or 1
    chain = 1
    while ratio**chain <= most:
        chain += 1
    reached = 1
    while reached < chain:
        further = steps.select(F.col("r_word").alias("root"), F.col("root").alias("next"))
        steps = stage(
            steps.join(further, "root", "left").select(
                "r_word", F.coalesce("next", "root").alias("root")
            ),
            "form_steps",
        )
        reached *= 2
    return steps


__all__ = [
    "LETTERS", "LONG", "RATIO", "count_words", "letter_runs", "lower_ascii", "near_pairs",
    "neighbourhood", "reduced", "spelling_forms", "symbols_for",
]
