"""BPE encoding by tree concatenation, and decoding.

A text of usual length is encoded where it is read. A longer one is cut into
pieces that are encoded in parallel and joined pair by pair, level by level.
Pieces are cut between words where that is possible; only a word that is longer
than a piece is cut inside. There the two sides' tokens can be wrong near the
cut, and a window around it is encoded anew, twice as large each time, until its
first token is also the left side's and its last one the right side's. Neighbours
in a BPE encoding depend on nothing but each other, so the joined sequence is then
exactly that of the whole word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stage
from footfall.llm.vocab import Vocabulary, vocabulary

#: A text of more code points than this is encoded in pieces.
LONG_CHARS = 1 << 16
_FIRST_WINDOW = 8  # tokens on either side of a cut


class Finish(Protocol):
    """What is made of a text's ids where they are encoded."""

    schema: str

    def __call__(self, vocab: Vocabulary, ids: list[bytes]) -> list[pa.Array]: ...


class AsIds:
    schema = "ids array<int>"

    def __call__(self, vocab, ids):
        arrays = [np.frombuffer(b, "<u4").astype(np.int32) for b in ids]
        return [pa.array(arrays, pa.list_(pa.int32()))]


class AsTexts:
    """Ids and the decoded text."""

    schema = "ids array<int>, decoded string"

    def __call__(self, vocab, ids):
        decoded = [vocab.decode(np.frombuffer(b, "<u4")) for b in ids]
        return [*AsIds()(vocab, ids), pa.array(decoded, pa.string())]


class AsDigests:
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    def __call__(self, vocab, ids):
        counts, of_ids, of_texts = [], [], []
        for packed in ids:
            numbers = np.frombuffer(packed, "<u4")
            counts.append(len(numbers))
            joined = " ".join([vocab.numerals[i] for i in numbers.tolist()])
            of_ids.append(hashlib.sha256(joined.encode()).hexdigest())
            of_texts.append(hashlib.sha256(vocab.decode(numbers).encode()).hexdigest())
        return [
            pa.array(counts, pa.int64()),
            pa.array(of_ids, pa.string()),
            pa.array(of_texts, pa.string()),
        ]


def encode(
    docs: DataFrame,
    vocabulary_path: str,
    finish: Finish | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    long_chars: int = LONG_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id and what ``finish`` makes of the text's ids.

    Ids and decoded texts equal the tokenizers library's (no special tokens added,
    none skipped).

    * null and empty text: no ids, an empty decoded text. Null ids stay null.
    * repeated rows: encoded each. Empty table: no rows. Other columns are ignored.
    """
    finish = finish or AsDigests()
    chars = F.length(F.col("text"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, {finish.schema}"
    short = rows.filter(chars <= long_chars).mapInArrow(
        _encode_batches(vocabulary_path, finish), schema
    )
    long = rows.filter(chars > long_chars)
    if long.isEmpty():
        return short
    joined = _in_pieces(long, vocabulary_path, long_chars)
    return short.unionByName(joined.mapInArrow(_finish_batches(vocabulary_path, finish), schema))


def _encode_batches(path: str, finish: Finish):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            ids = vocab.encode(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), *finish(vocab, ids)]
            names = ["doc_id", *[c.split()[0] for c in finish.schema.split(", ")]]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _finish_batches(path: str, finish: Finish):
    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            columns = [batch.column("doc_id"), *finish(vocab, batch.column("ids").to_pylist())]
            names = ["doc_id", *[c.split()[0] for c in finish.schema.split(", ")]]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


# --- long texts ----------------------------------------------------------------------
_PIECE = "uid long, seq int, words string, opens boolean, closes boolean"
_PART = "uid long, seq int, ids binary, opens boolean, closes boolean"


def cut(words: list[str], most: int) -> Iterator[tuple[str, bool, bool]]:
    """Pieces of about ``most`` signs: joined words, begins inside a word, ends inside one."""
    held: list[str] = []
    size = 0
    for word in words:
        if len(word) <= most:
            if held and size + len(word) > most:
                yield " ".join(held), False, False
                held, size = [], 0
            held.append(word)
            size += len(word)
            continue
        if held:
            yield " ".join(held), False, False
            held, size = [], 0
        for at in range(0, len(word), most):
            yield word[at : at + most], at > 0, at + most < len(word)
    if held:
        yield " ".join(held), False, False


def _in_pieces(long: DataFrame, path: str, most: int) -> DataFrame:
    numbered = stage(long.withColumn("uid", F.monotonically_increasing_id()), "long_texts")

    def to_pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path)
        for frame in frames:
            for uid, text in zip(frame["uid"], frame["text"], strict=True):
                rows = [
                    (uid, seq, *piece) for seq, piece in enumerate(cut(vocab.words(text), most))
                ]
                yield pd.DataFrame(rows, columns=["uid", "seq", "words", "opens", "closes"])

    def to_ids(frames):
        vocab = vocabulary(path)
        for frame in frames:
            ids = []
            for words, opens, closes in zip(
                frame["words"], frame["opens"], frame["closes"], strict=True
            ):
                if opens or closes:
                    found = vocab.fragment_ids(words, ends_word=not closes)
                else:
                    found = [i for w in words.split(" ") for i in vocab.word_ids(w)]
                ids.append(np.array(found, "<u4").tobytes())
            yield frame[["uid", "seq"]].assign(
                ids=ids, opens=frame["opens"], closes=frame["closes"]
            )

    def join_pair(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values("seq").to_dict("records")
        if len(rows) == 2:
            rows = [_joined(vocabulary(path), *rows)]
        return pd.DataFrame([{**rows[0], "seq": rows[0]["seq"] // 2}])

    pieces = numbered.select("uid", "text").mapInPandas(to_pieces, _PIECE)
    parts = stage(
        pieces.repartition("uid", "seq").mapInPandas(to_ids, _PART), "encoded_pieces"
    )
    last = parts.agg(F.max("seq")).first()[0] or 0
    while last > 0:
        pair = F.floor(F.col("seq") / 2)
        parts = parts.groupBy("uid", pair.alias("pair")).applyInPandas(join_pair, _PART)
        last //= 2
    return (
        numbered.select("uid", "doc_id")
        .join(parts.select("uid", "ids"), "uid", "left")
        .select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    )


def _joined(vocab: Vocabulary, left: dict, right: dict) -> dict:
    a = np.frombuffer(left["ids"], "<u4").tolist()
    b = np.frombuffer(right["ids"], "<u4").tolist()
    ids = join_ids(vocab, a, b) if left["closes"] and right["opens"] else a + b
    return {
        "uid": left["uid"],
        "seq": left["seq"],
        "ids": np.array(ids, "<u4").tobytes(),
        "opens": left["opens"],
        "closes": right["closes"],
    }


def join_ids(vocab: Vocabulary, left: list[int], right: list[int]) -> list[int]:
    """The ids of one text from those of two halves that were cut inside a word."""
    start = next((i + 1 for i in range(len(left) - 1, -1, -1) if vocab.ends_word(left[i])), 0)
    end = next((i + 1 for i, t in enumerate(right) if vocab.ends_word(t)), len(right))
    closed = end > 0 and vocab.ends_word(right[end - 1])
    wide = _FIRST_WINDOW
    while True:
        at, to = max(start, len(left) - wide), min(end, wide)
        whole_left, whole_right = at == start, to == end
        spelt = "".join(map(vocab.bare, left[at:] + right[:to]))
        window = vocab.fragment_ids(spelt, ends_word=whole_right and closed)
        agrees_left = whole_left or window[0] == left[at]
        agrees_right = whole_right or window[-1] == right[to - 1]
        if agrees_left and agrees_right:
            return left[:at] + window + right[to:]
        wide *= 2


__all__ = ["LONG_CHARS", "AsDigests", "AsIds", "AsTexts", "cut", "encode", "join_ids"]
