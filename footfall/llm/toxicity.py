"""Toxicity by maximum-scoring segments of token log-odds.

Tokens, which are words and beginnings of words, get log-odds under an informative
Dirichlet prior, shrunk by how well they are known; a word scores as its most telling token
does, harmless ones below zero. A linear scan finds every maximal segment of a text whose
summed score stands out; extreme-value statistics of such segments in harmless text turn
them into evidence, and a logistic curve turns evidence into a probability.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stage, unused

#: Labelled rows that the classifier is fitted on at most, chosen by a hash of the id.
MAX_TRAINING_ROWS = 10_000
#: A row is called toxic from this score on.
THRESHOLD = 0.3

_SIGNIFICANT = math.log(20)  # a passage is significant if chance makes under 1/20 of it
_PRIOR_SHARE = 0.1  # the prior weighs as much as this share of the counted words
_DOUBT = 8.0  # log-odds of significance z shrink to z^2 / (z^2 + this) of themselves
_IN_PASSAGE = 0.5  # share of telling words expected inside a toxic passage
_MISS = math.log(1 - _IN_PASSAGE)  # what a word without log-odds scores; added to all others
_FOLDS = 4  # a training row is judged by weights that were fitted on the other folds
_TAIL = 0.1  # share of the segments of harmless rows that the extreme values are fitted to
_WORD = re.compile(r"[^\W\d_]+")
_BEGINNINGS = range(3, 9)  # lengths of word beginnings that are tokens
_CACHED_WORDS = 200_000
_CHUNK = 1 << 18  # signs of training text whose tokens a task holds, about 30 MB of them
_MINIMA = 16  # of a training row; near copies share half of them
_UNIT = 1 << 20  # one row's weight; integers add up alike in any order


def tokens_of(word: str) -> list[str]:
    """The word, and its beginnings marked with a hyphen."""
    return [word, *[f"{word[:n]}-" for n in _BEGINNINGS if n <= len(word)]]


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2


@dataclass
class Model:
    """Shrunk log-odds of ``tokens`` (sorted hashes); extreme values; the logistic curve."""

    tokens: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    scale: float = 1.0
    log_rate: float = 0.0
    slope: float = 0.0
    offset: float = -6.0
    _known: dict[str, float] = field(default_factory=dict, repr=False)

    @classmethod
    def of(cls, weights: dict[str, float]) -> Model:
        """A model of given log-odds per token."""
        named = np.array([_hash(t) for t in weights], np.uint64)
        order = np.argsort(named)
        return cls(named[order], np.array(list(weights.values()), np.float32)[order])

    def word_scores(self, words: list[str]) -> np.ndarray:
        """For each word the log-odds of its most telling token, 0 if none is known."""
        known = self._known
        if len(known) >= _CACHED_WORDS:
            known.clear()
        new = list({w for w in words if w not in known})
        if new:
            known.update(zip(new, self._looked_up(new), strict=True))
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def _looked_up(self, words: list[str]) -> list[float]:
        if not len(self.tokens):
            return [0.0] * len(words)
        tokens = [tokens_of(w) for w in words]
        named = np.array([_hash(t) for own in tokens for t in own], np.uint64)
        at = np.minimum(np.searchsorted(self.tokens, named), len(self.tokens) - 1)
        found = np.where(self.tokens[at] == named, self.weights[at], np.float32(0))
        sizes = np.array([len(own) for own in tokens])
        starts = np.cumsum(sizes) - sizes
        high, low = np.maximum.reduceat(found, starts), np.minimum.reduceat(found, starts)
        return np.where(high >= -low, high, low).tolist()

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and (first word, last word, score) of each maximal segment."""
        words = _WORD.findall(text.lower())
        return len(words), maximal_segments(self.word_scores(words) + _MISS)

    def __getstate__(self):
        return {**self.__dict__, "_known": {}}

    def _said(self, n: int, scores: np.ndarray) -> np.ndarray:
        """Evidence of segments among ``n`` words: -ln of their number expected by chance."""
        return self.scale * scores - self.log_rate - math.log(max(n, 1))

    def passages(self, text: str) -> list[tuple[int, int, float]]:
        """Significant passages: first and last word, and evidence."""
        n, found = self.segments(text)
        said = self._said(n, np.array([s for _, _, s in found]))
        return [
            (a, b, float(e)) for (a, b, _), e in zip(found, said, strict=True) if e >= _SIGNIFICANT
        ]

    def evidence(self, n: int, scores: list[float]) -> float:
        """Evidence of all segments of a text beyond what is significant.

        The bar is soft: one that chance makes often adds little, none is cut.
        """
        return float(np.logaddexp(0, self._said(n, np.array(scores)) - _SIGNIFICANT).sum())

    def score(self, text: str) -> float:
        n, found = self.segments(text)
        x = self.offset + self.slope * math.log1p(self.evidence(n, [s for _, _, s in found]))
        return 1 / (1 + math.exp(-x))


def _hash(token: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(token)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence: first place, last place, score.

    Linear in the places that score above zero: every segment points to the nearest
    earlier one that starts from a smaller running sum, and a segment that is taken up is
    never seen again.
    """
    stack: list[list] = []  # sum before, sum after, first, last, nearest earlier with a lower start
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    for at in np.flatnonzero(scores > 0).tolist():
        low, total, first = sums[at], sums[at + 1], at
        near = len(stack) - 1
        while True:
            while near >= 0 and stack[near][0] >= low:
                near = stack[near][4]
            if near < 0 or stack[near][1] >= total:
                stack.append([low, total, first, at, near])
                break
            low, _, first, _, near_of = stack[near]
            del stack[near:]
            near = near_of
    return [(first, last, float(high - low)) for low, high, first, last, _ in stack]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_rows: int = MAX_TRAINING_ROWS,
) -> Model:
    """Fit on at most ``most_rows`` labelled rows that are not held out.

    Near copies are counted once: of rows that share their smallest hashed run of five
    words, each weighs one by the number of those that also share half of its other
    minima, so that rows with no more than a passage in common count in full. Of rows that
    repeat an id the largest text is taken. Every token of the sample has log-odds; only the
    sample bounds their number. Without labelled rows of both kinds the model has no tokens
    and gives every text the same low score.
    """
    rows = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = (
        rows.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    # at most most_rows ids and flags are broadcast
    train = stage(
        texts.join(F.broadcast(chosen), "id")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"), F.max("text").alias("text"))
        .select("toxic", "text"),
        "toxic_texts",
    )
    counted = stage(
        train.mapInArrow(
            _train_rows, "toxic int, key long, minima array<long>, tokens array<long>"
        ).withColumn("at", F.monotonically_increasing_id()),
        "toxic_train",
    )
    alike = counted.select("at", "toxic", "key", "minima").withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("key", "toxic"))
    )
    several = alike.filter("n > 1").groupBy("key", "toxic")
    shares = stage(
        several.applyInPandas(lambda rows: _shares(rows), "at long, share long").unionByName(
            alike.filter("n = 1").select("at", F.lit(_UNIT).cast("long").alias("share"))
        ),
        "toxic_shares",
    )
    share, own_fold = F.col("share"), F.col("key").bitwiseAND(F.lit(_FOLDS - 1))
    sums = [
        F.sum(F.when(own_fold == fold, value).otherwise(0)).alias(f"{name}{fold}")
        for name, value in (("bad", F.col("toxic") * share), ("all", share))
        for fold in range(_FOLDS)
    ]
    counts = (
        counted.join(shares, "at")
        .select("toxic", "share", "key", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(*sums)
        .mapInArrow(_packed, "raw binary")
        .collect()  # the tokens of the bounded sample
    )
    table = _unpacked([r.raw for r in counts], 1 + 2 * _FOLDS)
    del counts
    table = table[np.argsort(table[:, 0].view(np.uint64))]
    named = table[:, 0].copy().view(np.uint64)
    bad, every = (part / _UNIT for part in np.split(table[:, 1:].T, 2))
    del table
    if not bad.any() or bad.sum() == every.sum():
        return Model()
    model = Model(named, shrunk_log_odds(bad.sum(axis=0), every.sum(axis=0)))
    others = [
        Model(model.tokens, shrunk_log_odds(bad.sum(axis=0) - bad[f], every.sum(axis=0) - every[f]))
        for f in range(_FOLDS)
    ]
    _calibrate(model, others, train)
    return model


def shrunk_log_odds(bad: np.ndarray, every: np.ndarray) -> np.ndarray:
    """Log-odds of each token between toxic rows and others, under a Dirichlet prior.

    ``bad`` and ``every`` are its counts in toxic rows and in all. The prior spreads like the
    tokens of all rows. What a token's counts leave in doubt shrinks its log-odds to zero.
    """
    toxic, total = bad.sum(), every.sum()
    if not toxic or toxic == total:
        return np.zeros(len(bad), np.float32)
    prior = _PRIOR_SHARE * total
    alpha = np.maximum(every, 1e-9) * (prior / total)
    in_bad, in_good = bad + alpha, np.maximum(every - bad, 0) + alpha
    delta = np.log(in_bad / (toxic + prior - in_bad)) - np.log(
        in_good / (total - toxic + prior - in_good)
    )
    z2 = delta**2 / (1 / in_bad + 1 / in_good)
    return np.where(every > 0, delta * z2 / (z2 + _DOUBT), 0).astype(np.float32)


def _runs(words: list[str]) -> np.ndarray:
    """Hashed runs of five words."""
    runs = (" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
    return np.array([_hash(run) for run in runs], np.uint64)


def _key(runs: np.ndarray) -> int:
    return int(runs.min()) - (1 << 63)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns, which are integers, as a few rows of bytes, one row after the other in them.

    They are deflated, as most counts are 0 and the driver holds them more than once.
    """

    def out():
        raw = zlib.compress(b"".join(held), 1)
        return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["raw"])

    held, size = [], 0
    for batch in batches:
        held.append(np.stack([c.to_numpy() for c in batch.columns], 1).astype("<i8").tobytes())
        size += batch.num_rows
        if size >= _CHUNK >> 2:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _unpacked(packed: list[bytes], columns: int) -> np.ndarray:
    """The rows of what ``_packed`` made; takes the parts off the list as it goes."""
    raw = bytearray()
    while packed:
        raw += zlib.decompress(packed.pop())
    return np.frombuffer(raw, "<i8").reshape(-1, columns)


def _train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key, minima and hashed tokens of each row; a batch of about ``_CHUNK`` signs of text at a time."""

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array(toxic, pa.int32()), pa.array(keys, pa.int64()),
             pa.array(minima, pa.list_(pa.int64())), pa.array(tokens, pa.list_(pa.int64()))],
            ["toxic", "key", "minima", "tokens"],
        )

    toxic, keys, minima, tokens, size = [], [], [], [], 0
    for batch in batches:
        for label, text in zip(batch.column("toxic"), batch.column("text"), strict=True):
            text = text.as_py()
            words = _WORD.findall(text.lower())
            runs = _runs(words)
            toxic.append(label.as_py())
            keys.append(_key(runs))
            minima.append(_minima(runs))
            own = {t for w in set(words) for t in tokens_of(w)}
            tokens.append(np.sort(np.array([_hash(t) for t in own], np.uint64)).view(np.int64))
            size += len(text)
            if size >= _CHUNK:
                yield out()
                toxic, keys, minima, tokens, size = [], [], [], [], 0
    if toxic:
        yield out()


def _minima(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(_MINIMA, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(_MINIMA):
            mixed = (hashes ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            out[k] = (mixed ^ (mixed >> np.uint64(32))).min()
    return out.view(np.int64)


def _shares(rows: pd.DataFrame) -> pd.DataFrame:
    """Each row's weight: one by the number of rows that share half of its minima, itself included."""
    minima = np.stack(rows["minima"].tolist())
    alike = np.zeros(len(rows), np.int64)
    for i, own in enumerate(minima):  # at most the bounded number of training rows
        alike[i] = ((minima == own).sum(axis=1) * 2 >= _MINIMA).sum()
    return pd.DataFrame({"at": rows["at"], "share": _UNIT // alike})


def _calibrate(model: Model, others: list[Model], train: DataFrame) -> None:
    """Extreme values of segments in harmless training rows, then the logistic curve on all rows.

    A row is judged by the weights that its own fold had no part in, as a new text would be.
    """

    def found(batches):
        for batch in batches:
            n, scores = [], []
            for text in batch.column("text").to_pylist():
                words = _WORD.findall(text.lower())
                size, segments = others[_key(_runs(words)) & (_FOLDS - 1)].segments(text)
                n.append(size)
                scores.append([s for _, _, s in segments])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(n, pa.int64()), pa.array(scores, pa.list_(pa.float64()))],
                ["toxic", "n", "scores"],
            )

    # the segments of the bounded sample
    rows = train.mapInArrow(found, "toxic int, n long, scores array<double>").collect()
    harmless = [r for r in rows if not r.toxic]
    chance = np.concatenate([np.zeros(0), *[r.scores for r in harmless]])
    words = sum(r.n for r in harmless) + 1
    model.scale, model.log_rate = extreme_values(chance, words)
    x = np.array([math.log1p(model.evidence(r.n, r.scores)) for r in rows])
    y = np.array([r.toxic for r in rows], float)
    model.offset, model.slope = _logistic(x, y)


def extreme_values(scores: np.ndarray, words: int) -> tuple[float, float]:
    """(scale, log of the rate): of n words, n * rate * exp(-scale * s) segments reach s by chance.

    Fitted to how far the largest scores go beyond the smallest of them.
    """
    top = np.sort(scores)[::-1]
    k = max(min(20, len(top) // 2), int(len(top) * _TAIL))
    if k < 1 or top[0] <= top[k]:
        return 1.0, math.log((len(top) + 0.5) / words)
    scale = 1 / float(np.mean(top[:k] - top[k]))
    return scale, math.log(k / words) + scale * float(top[k])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps with a weak ridge; the slope is not negative."""
    features = np.stack([np.ones_like(x), x], 1)
    beta, ridge = np.zeros(2), np.diag([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        gradient = features.T @ (y - p) - ridge @ beta
        hessian = (features * (p * (1 - p))[:, None]).T @ features + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def score_column(model: Model, text: Column) -> Column:
    """The score of each text, 0 to 1."""

    @F.pandas_udf("double")
    def scores(texts):
        return texts.map(model.score)

    return scores(F.coalesce(text, F.lit("")))


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    * null and empty text: no words, the lowest score of the model.
    * null id: held out only if its remainder says so (it has none), so it is not.
    * repeated rows: scored each. Empty table: no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = rows.withColumn("score", score_column(model, F.col("text")))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def clean_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not called toxic, with all their columns."""
    name = unused(docs, "__toxicity")
    scored = docs.withColumn(name, score_column(model, F.col(text_col)))
    return scored.filter(F.col(name) < THRESHOLD).drop(name)
