"""Ranked lexical search by scanning documents with an automaton of all query terms.

The terms of a block of items make one Aho-Corasick automaton in which every term stands
between two guards, so only whole terms match. One scan of the texts counts the terms of
every document; no index of documents is built. A second pass over these counts scores
documents and keeps each task's best rows per item; the best of all tasks are the result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.groups import first_rows
from footfall.llm.common import running_sums, stage

TOP = 10
#: Bytes of item texts, and items, in one automaton; more items make more blocks, each with
#: a scan of its own. One item is never split.
BLOCK_BYTES, BLOCK_ITEMS = 1 << 22, 1 << 13
#: Cells of documents x items that are scored at once.
_CELLS = 1 << 20

# Terms are runs of what is not an ASCII control, space or punctuation sign.
_GUARD = 0x20
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else _GUARD
    for c in range(256)
)


def folded(text: str) -> bytes:
    """The text with A-Z lowered and a guard in place of each sign that no term holds."""
    return text.encode("utf-8", "replace").translate(_FOLD)


def terms_of(text: str) -> list[str]:
    return [t for t in folded(text).decode().split(" ") if t]


class Block(NamedTuple):
    """Items and their terms: term ``t`` is one of ``items[starts[t]:starts[t + 1]]``."""

    ids: list[int | None]
    terms: list[str]
    starts: np.ndarray
    items: np.ndarray


def make_block(ids: list[int | None], texts: list[str]) -> Block:
    """Rows that share an id make one item; each term counts once per item."""
    own: dict[int | None, set[str]] = {}
    for item, text in zip(ids, texts, strict=True):
        own.setdefault(item, set()).update(terms_of(text))
    holders: dict[str, list[int]] = {}
    for place, found in enumerate(own.values()):
        for term in found:
            holders.setdefault(term, []).append(place)
    terms = sorted(holders)
    counts = np.array([0, *[len(holders[t]) for t in terms]])
    items = np.array([p for t in terms for p in holders[t]], np.int64)
    return Block(list(own), terms, np.cumsum(counts), items)


def automaton(terms: list[str]):
    import ahocorasick

    built = ahocorasick.Automaton()
    for place, term in enumerate(terms):
        built.add_word(f" {term} ", place)
    if terms:
        built.make_automaton()
    return built


# --- scan ------------------------------------------------------------------------------
_COUNTS = "doc_id long, n long, terms array<int>, tfs array<int>"


def count_terms(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, tfs) of documents with terms: their number, and which of ``terms`` how often."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = automaton(terms)
        hit = itemgetter(1)
        for batch in batches:
            ids, sizes, found, tfs = [], [], [], []
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text"), strict=True
            ):
                guarded = b" " + folded(text.as_py()) + b" "
                signs = np.frombuffer(guarded, np.uint8) != _GUARD
                n = int(np.count_nonzero(signs[1:] & ~signs[:-1]))
                if not n:
                    continue
                hits = Counter(map(hit, built.iter(guarded.decode()))) if terms else {}
                ids.append(doc_id)
                sizes.append(n)
                found.append(list(hits.keys()))
                tfs.append(list(hits.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(found, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                ["doc_id", "n", "terms", "tfs"],
            )

    return docs.mapInArrow(scan, _COUNTS)


def _frequencies(counts: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each term of a block occurs."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms, np.int64)
        for batch in batches:
            column = batch.column("terms")
            held += np.bincount(column.flatten().to_numpy(zero_copy_only=False), minlength=terms)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(held[some])], ["term", "df"]
        )

    summed = counts.select("terms").mapInArrow(add, "term int, df long").groupBy("term")
    df = np.zeros(terms, np.int64)
    for row in summed.agg(F.sum("df").alias("df")).toLocalIterator():  # one row per term of the block
        df[row.term] = row.df
    return df


# --- scores ------------------------------------------------------------------------------
def term_weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64
    )


def length_marks(n: np.ndarray, documents: int, words: int) -> np.ndarray:
    if int(n.max(initial=0)) * documents * 90 < 1 << 62:
        return 10 + 90 * n * documents // words
    return np.array([10 + 90 * int(k) * documents // words for k in n], np.int64)


class _Best:
    """The best rows of a task per item: highest score first, then smallest id, null ids last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.rows = np.zeros((0, 4), np.int64)  # item, score, id, is null
        self.floor = np.zeros(items, np.int64)

    def add(self, item, score, doc, null):
        rows = np.concatenate([self.rows, np.stack([item, score, doc, null], axis=1)])
        order = np.lexsort((rows[:, 2], rows[:, 3], -rows[:, 1], rows[:, 0]))
        rows = rows[order]
        starts = np.searchsorted(rows[:, 0], rows[:, 0])
        self.rows = rows[np.arange(len(rows)) - starts < self.top]
        last, count = np.unique(self.rows[:, 0], return_counts=True)
        ends = np.cumsum(count) - 1
        full = count == self.top
        self.floor[last[full]] = self.rows[ends[full], 1]


def _best_rows(block: Block, weights: np.ndarray, documents: int, words: int, top: int):
    items = len(block.ids)
    fan = np.diff(block.starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(items, top)
        step = max(1, _CELLS // items)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                lists = part.column("terms")
                per_doc = np.asarray(lists.value_lengths())
                term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = part.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(part.num_rows), per_doc)
                mark = length_marks(part.column("n").to_numpy(), documents, words)
                value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * mark[doc]))
                score = np.zeros(part.num_rows * items, np.int64)
                for low, high in _slices(fan[term]):
                    own = fan[term[low:high]]
                    first = np.repeat(block.starts[term[low:high]], own)
                    place = np.arange(len(first)) - np.repeat(np.cumsum(own) - own, own)
                    cell = np.repeat(doc[low:high], own) * items + block.items[first + place]
                    np.add.at(score, cell, np.repeat(value[low:high], own))
                score = score.reshape(-1, items)
                # equal scores may still have a smaller id
                where, item = np.nonzero((score > 0) & (score >= best.floor))
                ids = part.column("doc_id")
                null = np.asarray(ids.is_null())
                known = ids.fill_null(0).to_numpy()
                best.add(item, score[where, item], known[where], null[where].astype(np.int64))
        item, score, doc, null = best.rows.T
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(block.ids))[item], pa.int32()),
             pa.array(doc, pa.int64(), mask=null.astype(bool)), pa.array(score, pa.int64())],
            ["place", "doc_id", "score"],
        )

    return run


def _slices(fan: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of hits that make about _CELLS additions each."""
    ends = np.cumsum(fan)
    low = 0
    while low < len(fan):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + _CELLS, side="right")))
        yield low, high
        low = high


def search(
    items: DataFrame,
    docs: DataFrame,
    top: int = TOP,
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """The ``top`` documents per item: item_id, rank, doc_id, score.

    Terms are maximal runs of signs that are not ASCII controls, spaces or punctuation, A-Z
    lowered. N documents have a term, L terms with repeats in all, n in the document; df
    documents hold a term, tf times in the document. All but the logarithm is whole:
    w = floor(1000 ln((2N + 2) / (2df + 1))), m = 10 + 90 n N div L, and a document scores the
    sum of w (10^9 tf div (1000 tf + 8 m)) over the item's terms, once each. Rows of score 0
    are left out; equal scores rank by ascending id, null ids last.

    * null text, text without terms: no document, an item without rows.
    * repeated documents: each ranked. Rows that share an item id: one item with the terms
      of all of them. Empty tables: no rows. Other columns are ignored.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).filter("text IS NOT NULL")
    given = items.select(
        F.col(item_id_col).cast("long").alias("item_id"),
        F.coalesce(F.col(item_text_col), F.lit("")).alias("text"),
    ).distinct()
    per_item = given.groupBy("item_id").agg(F.sum(F.octet_length("text")).alias("bytes"))
    cost = F.greatest(F.col("bytes"), F.lit(-(-block_bytes // block_items)))
    placed = running_sums(per_item.withColumn("cost", cost), ["item_id"], "cost", "before")
    blocks = stage(
        placed.select(
            F.col("item_id").alias("k"), F.floor(F.col("before") / block_bytes).alias("block")
        ),
        "item_blocks",
    )
    numbers = sorted(r.block for r in blocks.select("block").distinct().toLocalIterator())
    ranked = None
    for number in numbers:
        found = _search_block(given.join(blocks.filter(F.col("block") == number),
                                         F.col("item_id").eqNullSafe(F.col("k"))), texts, top)
        ranked = found if ranked is None else ranked.unionByName(found)
    if ranked is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return ranked


def _search_block(given: DataFrame, texts: DataFrame, top: int) -> DataFrame:
    spark = texts.sparkSession
    rows = given.select("item_id", "text").collect()  # BLOCK_BYTES of text, or one item
    block = make_block([r.item_id for r in rows], [r.text for r in rows])
    counts = stage(count_terms(texts, block.terms), "term_counts")
    total = counts.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("words")).first()
    weights = term_weights(_frequencies(counts, len(block.terms)), total.n)
    best = stage(
        counts.filter(F.size("terms") > 0).mapInArrow(
            _best_rows(block, weights, total.n, total.words or 1, top),
            "place int, doc_id long, score long",
        ),
        "best_of_tasks",
    )
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    kept = first_rows(best, ["place"], order, top)
    names = spark.createDataFrame(list(enumerate(block.ids)), "place int, item_id long")
    rank = F.row_number().over(Window.partitionBy("place").orderBy(*order))
    return kept.withColumn("rank", rank).join(names, "place").select("item_id", "rank", "doc_id", "score")


__all__ = [
    "BLOCK_BYTES", "BLOCK_ITEMS", "TOP", "automaton", "count_terms", "folded", "length_marks",
    "make_block", "search", "term_weights", "terms_of",
]
