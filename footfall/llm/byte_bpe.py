"""Byte-level BPE by overlapping chunks, and decoding.

A text of usual length is encoded where it is read. A longer one is cut into chunks
that overlap; each is split into pre-tokens by itself, in parallel. A match of the
pattern depends on nothing before its start, so from the first boundary that two
neighbouring chunks have in common their splits are the same: there they are
stitched, and each chunk encodes the pre-tokens between its two seams. Chunks without
a common boundary (a pre-token longer than the overlap) become one chunk and are split
again, until every seam is found. Decoding concatenates the raw bytes of the ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stage

#: A text of more code points than this is encoded in chunks of this size.
CHUNK = 1 << 16
#: Code points that a chunk reads of the next one.
OVERLAP = 1 << 10
# A match that ends so many signs before a chunk's end is the whole text's: the
# alternatives of the pattern look at no more than that behind a match.
_LOOKS_AHEAD = 3
_CACHED_WORDS, _CACHED_CHARS = 1 << 17, 64
_ROWS = 256  # rows that a task returns at once


class Ranks:
    """A rank file and the pattern that splits texts before its merges.

    With the usual pattern a space can only be the first sign of a pre-token, or part
    of one that is all white space. A text may then be cut before every space that
    follows another sign than white space, and the words between are cached.
    """

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as source:
            self.ranks = {base64.b64decode(t): int(rank) for t, rank in map(bytes.split, source)}
        self._pattern = regex.compile(pattern)
        self._splits_at_space = pattern == public_tokenizers.PATTERN
        self._words: dict[str, bytes] = {}

    @cached_property
    def tokens(self) -> dict[int, bytes]:
        return {rank: token for token, rank in self.ranks.items()}

    @cached_property
    def _merges(self):
        import tiktoken

        return tiktoken.Encoding(
            "ranks", pat_str=self._pattern.pattern, mergeable_ranks=self.ranks, special_tokens={}
        )

    def split(self, text: str) -> list[str]:
        return self._pattern.findall(text)

    def pieces(self, pieces: list[str]) -> bytes:
        """The ids of pre-tokens, one after the other, as little-endian 32-bit integers."""
        ids: list[int] = []
        for piece in pieces:
            ids += self._merges._encode_single_piece(piece)
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not self._splits_at_space:
            return self.pieces(self.split(text))
        first, *parts = text.split(" ")
        if not parts:
            return self.pieces(self.split(text))
        # a cached part neither is empty nor ends in white space, so a cut follows it
        if first and not first[-1].isspace():
            *middle, last = parts
            try:
                found = b"".join(map(self._words.__getitem__, middle))
                return self.pieces(self.split(first)) + found + self._word(last)
            except KeyError:
                pass
        out, held = [], first
        for part in parts:
            if held and not held[-1].isspace():
                out.append(self._word(held[1:]) if held[0] == " " else self.pieces(self.split(held)))
                held = " " + part
            else:
                held = f"{held} {part}"
        out.append(self._word(held[1:]) if held[0] == " " else self.pieces(self.split(held)))
        return b"".join(out)

    def _word(self, part: str) -> bytes:
        """The ids of a space and ``part``."""
        found = self._words.get(part)
        if found is None:
            found = self.pieces(self.split(" " + part))
            if part and len(part) <= _CACHED_CHARS and not part[-1].isspace():
                if len(self._words) >= _CACHED_WORDS:
                    self._words.clear()
                self._words[part] = found
        return found

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def ranks_of(path: str, pattern: str) -> Ranks:
    """One per Python worker."""
    return Ranks(path, pattern)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per row of ``docs``: doc_id and ids, little-endian 32-bit integers.

    Each match of ``pattern`` is encoded by the ranks of the file, without special
    tokens: their strings are ordinary text.

    * null and empty text: no ids. Null ids stay null.
    * repeated rows: encoded each. Empty table: no rows. Other columns are ignored.
    * a text of any length: the ids of one text meet in one row, as its signs do.
    """
    if not 0 < _LOOKS_AHEAD < overlap < chunk:
        raise ValueError("an overlap must be shorter than a chunk and longer than what a match sees")
    chars = F.length(F.col("text"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, ids binary"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(ranks_path, pattern)
        for batch in _parts(batches):
            ids = [ranks.encode(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"]
            )

    short = rows.filter(chars <= chunk).mapInArrow(whole, schema)
    long = rows.filter(chars > chunk)
    if long.isEmpty():
        return short
    return short.unionByName(_in_chunks(long, ranks_path, pattern, chunk, overlap))


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the raw bytes of its ids, not checked to be UTF-8.

    Null ids decode to null, none to no bytes. An id without a rank is an error.
    """
    if "decoded" in {c.lower() for c in encoded.columns}:
        raise ValueError("a column decoded is there already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(ranks_path, public_tokenizers.PATTERN)
        for batch in _parts(batches):
            raw = [
                None if ids is None else ranks.decode(ids)
                for ids in batch.column(ids_col).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(raw, pa.binary())], [*batch.schema.names, "decoded"]
            )

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)
    return encoded.mapInArrow(run, f"{kinds}, decoded binary")


# --- long texts ------------------------------------------------------------------------
_CHUNKS = "uid long, seq long, start long, last boolean, text string"
_SPLIT = f"{_CHUNKS}, bounds array<int>"


def certain_bounds(pieces: list[str], size: int, last: bool) -> np.ndarray:
    """Where pre-tokens of a chunk end, as far as signs behind the chunk cannot change them."""
    ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
    return ends if last else ends[ends <= size - _LOOKS_AHEAD]


def _in_chunks(long: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    numbered = stage(long.withColumn("uid", F.monotonically_increasing_id()), "long_texts")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for uid, text in zip(frame["uid"], frame["text"], strict=True):
                starts = range(0, max(1, len(text) - overlap), chunk)
                for seq, at in enumerate(starts):
                    last = at == starts[-1]
                    own = text[at:] if last else text[at : at + chunk + overlap]
                    row = (uid, seq, at, last, own)
                    yield pd.DataFrame([row], columns=["uid", "seq", "start", "last", "text"])

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks = ranks_of(path, pattern)
        for frame in frames:
            found = [
                certain_bounds(ranks.split(text), len(text), last)
                for text, last in zip(frame["text"], frame["last"], strict=True)
            ]
            yield frame.assign(bounds=found)

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values("seq")
        starts = rows["start"].tolist()
        parts = rows["text"].tolist()
        kept = [t[: b - a] for t, a, b in zip(parts, starts, starts[1:], strict=False)]
        whole = rows.iloc[[0]].assign(text="".join(kept) + parts[-1], last=bool(rows["last"].iloc[-1]))
        return next(split(iter([whole[["uid", "seq", "start", "last", "text"]]])))

    def encode_part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks = ranks_of(path, pattern)
        for frame in frames:
            ids = []
            for text, bounds, low, high in zip(
                frame["text"], frame["bounds"], frame["low"], frame["high"], strict=True
            ):
                inside = [low, *[int(b) for b in bounds if low < b <= high]]
                pieces = [text[a:b] for a, b in zip(inside, inside[1:], strict=False)]
                ids.append(ranks.pieces(pieces))
            yield frame[["uid", "seq"]].assign(ids=ids)

    pieces = numbered.select("uid", "text").mapInPandas(cut, _CHUNKS)
    chunks = stage(pieces.repartition("uid", "seq").mapInPandas(split, _SPLIT), "chunks")
    while True:
        seams = stage(_seams(chunks, overlap), "seams")
        lost = seams.filter("NOT last AND seam IS NULL")
        if lost.isEmpty():
            break
        before = Window.partitionBy("uid").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
        closed = F.coalesce(F.sum(F.col("seam").isNotNull().cast("int")).over(before), F.lit(0))
        runs = seams.select("uid", "seq", closed.alias("run"))
        sizes = runs.groupBy("uid", "run").agg(F.count(F.lit(1)).alias("n"))
        runs = stage(runs.join(sizes, ["uid", "run"]).filter("n > 1").drop("n"), "open_chunks")
        merged = (
            chunks.join(runs, ["uid", "seq"])
            .select("uid", "run", "seq", "start", "last", "text")
            .groupBy("uid", "run")
            .applyInPandas(merge, _SPLIT)
        )
        chunks = stage(
            chunks.join(runs, ["uid", "seq"], "left_anti").unionByName(merged), "chunks"
        )
    ordered = Window.partitionBy("uid").orderBy("seq")
    places = seams.select(
        "uid", "seq",
        (F.coalesce(F.lag("seam").over(ordered), F.lit(0)) - F.col("start")).alias("low"),
        (F.coalesce("seam", F.col("start") + F.col("size")) - F.col("start")).alias("high"),
    )
    encoded = stage(
        chunks.join(places, ["uid", "seq"]).mapInPandas(encode_part, "uid long, seq long, ids binary"),
        "encoded_chunks",
    )
    joined = encoded.groupBy("uid").applyInPandas(
        lambda frame: pd.DataFrame(
            {"uid": frame["uid"].iloc[:1], "ids": [b"".join(frame.sort_values("seq")["ids"])]}
        ),
        "uid long, ids binary",
    )
    return numbered.select("uid", "doc_id").join(joined, "uid").select("doc_id", "ids")


def _seams(chunks: DataFrame, overlap: int) -> DataFrame:
    """(uid, seq, start, size, last, seam): the first boundary a chunk shares with the next one."""
    at = F.transform("bounds", lambda b: b + F.col("start"))
    head = F.filter(at, lambda b: b <= F.col("start") + overlap)
    ordered = Window.partitionBy("uid").orderBy("seq")
    small = chunks.select("uid", "seq", "start", "last", F.length("text").alias("size"),
                          head.alias("head"), at.alias("at"))
    tail = F.filter("at", lambda b: b > F.col("start") + F.col("size") - overlap)
    small = small.withColumn("tail", F.when(~F.col("last"), tail)).drop("at")
    shared = F.array_intersect("tail", F.lead("head").over(ordered))
    return small.select("uid", "seq", "start", "size", "last", F.array_min(shared).alias("seam"))


__all__ = ["CHUNK", "OVERLAP", "Ranks", "certain_bounds", "decode", "encode", "ranks_of"]
