"""Token counts of documents in flat token files that have no index.

Blocks of a file are read in parallel and searched for the end-of-document id with
one vectorised comparison each; a document that spans blocks is stitched together
by a prefix scan over the blocks' last separators.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import new_folder, stage
from footfall.llm.vocab import vocabulary

#: A block's ids: 4 MiB of 16-bit ids.
BLOCK_IDS = 1 << 21
#: A file is closed once it holds this many bytes.
FILE_BYTES = 1 << 28


def write_flat_files(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write the texts' ids, each text followed by ``end_id``, as raw little-endian files.

    Returns (file, ordinal, doc_id, width): where each document went. The files
    themselves hold ids only, 16 bits wide if the vocabulary allows it. Strings of
    special tokens inside texts are encoded as ordinary text, so ``end_id`` stands
    at ends of documents only. Every attempt of a task writes files of its own;
    only those named in the returned, staged rows count.
    """
    folder = new_folder(docs.sparkSession, "flat_tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        vocab = vocabulary(vocabulary_path, True)
        kind = "<u2" if max(vocab.size, end_id) < 1 << 16 else "<u4"
        end = np.array([end_id], kind).tobytes()
        system, root = fs.FileSystem.from_uri(folder)
        sink, uri, size, ordinal = None, "", 0, 0
        for batch in batches:
            files, ordinals = [], []
            for packed in vocab.encode(batch.column("text").to_pylist()):
                if sink is None or size >= file_bytes:
                    if sink is not None:
                        sink.close()
                    name = f"{uuid.uuid4().hex}.ids"
                    sink, uri = system.open_output_stream(f"{root}/{name}"), f"{folder}/{name}"
                    size = ordinal = 0
                ids = np.frombuffer(packed, "<u4").astype(kind).tobytes()
                sink.write(ids + end)
                size += len(ids) + len(end)
                files.append(uri)
                ordinals.append(ordinal)
                ordinal += 1
            width = pa.array([int(kind[2])] * len(files), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(files, pa.string()), pa.array(ordinals, pa.int64()),
                 batch.column("doc_id"), width],
                ["file", "ordinal", "doc_id", "width"],
            )
        if sink is not None:
            sink.close()

    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    kind = dict(rows.dtypes)["doc_id"]
    written = rows.mapInArrow(write, f"file string, ordinal long, doc_id {kind}, width int")
    return stage(written, "flat_rows")


def count_tokens(files: DataFrame, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``files(file, width)`` to (file, ordinal, start, n_tokens, closed), a row per document.

    ``start`` is the place of the document's first id in its file and ``n_tokens``
    counts its ids without the end. Ids after the last end are a document that is
    not ``closed``.

    * empty file: no documents. Two ends in a row: a document of 0 tokens.
    * repeated files: read once. Other columns are ignored. Empty table: no rows.
    """
    sized = files.select("file", "width").distinct().mapInPandas(
        _sizes, "file string, width int, ids long"
    )
    sized = stage(sized, "flat_sizes")
    last_block = F.floor((F.col("ids") - 1) / block_ids)
    blocks = sized.filter("ids > 0").select(
        "file", "width", F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias("block")
    )

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for frame in frames:
            for uri, width, block in zip(
                frame["file"], frame["width"], frame["block"], strict=True
            ):
                system, path = fs.FileSystem.from_uri(uri)
                with system.open_input_file(path) as source:
                    data = source.read_at(block_ids * width, int(block) * block_ids * width)
                at = np.flatnonzero(np.frombuffer(data, f"<u{width}") == end_id)
                at = at + int(block) * block_ids
                before = np.concatenate([[-1], at[:-1]])[: len(at)]
                yield pd.DataFrame(
                    {"file": uri, "block": block, "nth": np.arange(len(at)), "at": at, "before": before}
                )

    ends = stage(
        blocks.repartition("file", "block").mapInPandas(
            scan, "file string, block long, nth long, at long, before long"
        ),
        "separators",
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = (
        ends.groupBy("file", "block")
        .agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last"))
        .select(
            F.col("file").alias("f"),
            F.col("block").alias("k"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("documents"),
            F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("open_since"),
        )
    )
    same = (F.col("file") == F.col("f")) & (F.col("block") == F.col("k"))
    since = F.when(F.col("nth") == 0, F.col("open_since")).otherwise(F.col("before"))
    closed = ends.join(stitched, same).select(
        "file",
        (F.col("documents") + F.col("nth")).alias("ordinal"),
        (since + 1).alias("start"),
        (F.col("at") - since - 1).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    tails = (
        sized.join(
            ends.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last")),
            "file",
            "left",
        )
        .select(
            "file",
            F.coalesce("n", F.lit(0)).alias("ordinal"),
            (F.coalesce("last", F.lit(-1)) + 1).alias("start"),
            (F.col("ids") - F.coalesce("last", F.lit(-1)) - 1).alias("n_tokens"),
            F.lit(False).alias("closed"),
        )
        .filter("n_tokens > 0")
    )
    return closed.unionByName(tails)


def _sizes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for frame in frames:
        sizes = []
        for uri, width in zip(frame["file"], frame["width"], strict=True):
            system, path = fs.FileSystem.from_uri(uri)
            sizes.append(system.get_file_info(path).size // int(width))
        yield frame.assign(ids=sizes)
