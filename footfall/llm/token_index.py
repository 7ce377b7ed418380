"""Token ids in binary shards with a minimal perfect hash index.

A shard file is little-endian:

* 8 bytes magic, then 64-bit counts: documents, ids, buckets, bytes per id
* the ids of its documents, one after the other, without separators
* a 32-bit seed per bucket, then by slot: a 32-bit fingerprint of the key, the
  64-bit place of its first id, the 64-bit number of its ids

A key is hashed to a bucket; the bucket's seed sends its keys to slots that no
other key has, so n documents take n slots and a look-up reads one bucket, one
slot and one run of ids. The fingerprint tells keys that are not in the shard.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import new_folder, stage
from footfall.llm.vocab import vocabulary

MAGIC = b"IDSHARD1"
#: A shard is closed at so many bytes of ids or so many documents.
SHARD_BYTES, SHARD_DOCS = 1 << 26, 1 << 16
_KEYS_PER_BUCKET = 4
_TRIES = 64
_HEAD = 40
#: Texts that a task makes Python strings of at once.
_TEXTS = 500


# --- minimal perfect hash --------------------------------------------------------------
def key_hashes(keys: list[str]) -> np.ndarray:
    """Two independent 64-bit hashes per key, as columns."""
    import xxhash

    raw = b"".join(xxhash.xxh3_128_digest(k.encode()) for k in keys)
    return np.frombuffer(raw, "<u8").reshape(-1, 2)


def _slots(h: np.ndarray, seeds, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h + np.asarray(seeds, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


def build_index(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds per bucket and each key's slot; all slots differ and fill 0 to n - 1.

    Large buckets are placed first, by trying seeds; buckets of one key take the
    free slots that are left and store the slot itself, as a negative seed.
    """
    n = len(hashes)
    buckets = max(1, -(-n // _KEYS_PER_BUCKET))
    seeds, slots, taken = np.zeros(buckets, np.int32), np.zeros(n, np.int64), np.zeros(n, bool)
    bucket = (hashes[:, 0] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    sizes = np.diff(ends, prepend=0)
    singles = []
    for b in np.argsort(-sizes, kind="stable"):
        size = sizes[b]
        if size == 0:
            break
        members = order[ends[b] - size : ends[b]]
        if size == 1:
            singles.append((b, members[0]))
            continue
        first = 0
        while True:
            tried = np.arange(first, first + _TRIES)
            at = np.sort(_slots(hashes[members, 1][None, :], tried[:, None], n), axis=1)
            fits = ~taken[at].any(axis=1) & (np.diff(at, axis=1) > 0).all(axis=1)
            if fits.any():
                seeds[b] = tried[np.argmax(fits)]
                slots[members] = _slots(hashes[members, 1], seeds[b], n)
                taken[slots[members]] = True
                break
            first += _TRIES
            if first >= 1 << 30:
                raise ValueError("keys of an index must differ")
    free = np.flatnonzero(~taken)
    for (b, key), slot in zip(singles, free, strict=True):
        seeds[b], slots[key] = -slot - 1, slot
    return seeds, slots


def find_slots(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    seed = seeds[(hashes[:, 0] % np.uint64(len(seeds))).astype(np.int64)]
    placed = _slots(hashes[:, 1], np.maximum(seed, 0).astype(np.uint64), n)
    return np.where(seed < 0, -seed.astype(np.int64) - 1, placed)


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return ((hashes[:, 0] ^ (hashes[:, 1] << np.uint64(1))) >> np.uint64(32)).astype("<u4")


# --- shards ------------------------------------------------------------------------------
def shard_bytes(keys: list[str], ids: list[bytes], width: int) -> bytes:
    """A shard file of documents whose ids are given as 32-bit integers."""
    n = len(keys)
    counts = np.array([len(b) // 4 for b in ids], "<u8")
    starts = np.cumsum(counts, dtype="<u8") - counts
    hashes = key_hashes(keys)
    seeds, slots = build_index(hashes)
    prints, first, number = np.zeros(n, "<u4"), np.zeros(n, "<u8"), np.zeros(n, "<u8")
    prints[slots], first[slots], number[slots] = fingerprints(hashes), starts, counts
    head = np.array([n, counts.sum(), len(seeds), width], "<u8")
    payload = np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}")
    parts = [head, payload, seeds.astype("<i4"), prints, first, number]
    return MAGIC + b"".join(p.tobytes() for p in parts)


class Shard:
    """Keyed access to a shard: one bucket, one slot, one run of ids per look-up."""

    def __init__(self, uri: str):
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(uri)
        self._file = system.open_input_file(path)
        head = self._file.read_at(_HEAD, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{uri} is no shard of ids")
        self.n, self.ids, buckets, self.width = map(int, np.frombuffer(head[8:], "<u8"))
        at = _HEAD + self.ids * self.width
        index = self._file.read_at(4 * buckets + 20 * self.n, at)
        cuts = np.cumsum([4 * buckets, 4 * self.n, 8 * self.n])
        self._seeds = np.frombuffer(index[: cuts[0]], "<i4")
        self._prints = np.frombuffer(index[cuts[0] : cuts[1]], "<u4")
        self._starts = np.frombuffer(index[cuts[1] : cuts[2]], "<u8").astype(np.int64)
        self._counts = np.frombuffer(index[cuts[2] :], "<u8").astype(np.int64)

    def find(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each key: is it here, the place of its first id, the number of its ids."""
        hashes = key_hashes(keys)
        slots = find_slots(hashes, self._seeds, self.n)
        here = self._prints[slots] == fingerprints(hashes)
        return here, self._starts[slots], self._counts[slots]

    def read(self, start: int, count: int) -> np.ndarray:
        data = self._file.read_at(count * self.width, _HEAD + start * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def close(self):
        self._file.close()


def write_shards(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_size: int = SHARD_BYTES,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """Encode and write all documents in ascending id order; returns the staged key list.

    One row per row of ``docs``: (range, number, shard, doc_id, key), where (range,
    number) orders the shards. ``end_id`` follows each document's ids. Rows with
    equal ids get keys of their own in the order they come. Every attempt of a task
    writes files of its own; only those named in the returned rows count.

    * null and empty text: the end alone. Null id: key "null", first in order.
    * repeated rows: stored each. Empty table: no shards. Other columns are ignored.
    """
    folder = new_folder(docs.sparkSession, "id_shards")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        vocab = vocabulary(vocabulary_path)
        width = 2 if max(vocab.size, end_id) < 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()
        system, root = fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        held_ids, held_keys, held_docs, size, number = [], [], [], 0, 0
        seen: dict[str, int] = {}

        def flush():
            name = f"{uuid.uuid4().hex}.shard"
            with system.open_output_stream(f"{root}/{name}") as sink:
                sink.write(shard_bytes(held_keys, held_ids, width))
            n = len(held_keys)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array([number] * n, pa.int32()),
                 pa.array([f"{folder}/{name}"] * n, pa.string()),
                 pa.array(held_docs, batch.column("doc_id").type),
                 pa.array(held_keys, pa.string())],
                ["range", "number", "shard", "doc_id", "key"],
            )

        batch = None
        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            parts = (texts.slice(at, _TEXTS) for at in range(0, len(texts), _TEXTS))
            found = (ids for part in parts for ids in vocab.encode(part.to_pylist()))
            for name, ids in zip(names, found, strict=True):
                base = "null" if name is None else str(name)
                again = seen.get(base, 0)
                seen[base] = again + 1
                held_keys.append(f"{base}#{again}" if again else base)
                held_ids.append(ids + end)
                held_docs.append(name)
                size += (len(ids) + len(end)) // 4 * width
                if size >= shard_size or len(held_keys) >= shard_docs:
                    yield flush()
                    held_ids, held_keys, held_docs, size = [], [], [], 0
                    seen = {}
                    number += 1
        if held_keys:
            yield flush()

    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    kind = dict(rows.dtypes)["doc_id"]
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first()
    )
    schema = f"range int, number int, shard string, doc_id {kind}, key string"
    return stage(ordered.mapInArrow(write, schema), "shard_keys")


def read_documents(keys: DataFrame) -> DataFrame:
    """Look every key up in its shard: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, over all shards.
    """
    kind = dict(keys.dtypes)["doc_id"]

    def look_up(frame: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(frame["shard"].iloc[0])
        here, starts, counts = shard.find(frame["key"].tolist())
        if not here.all():
            raise ValueError(f"a key is missing in {frame['shard'].iloc[0]}")
        crcs = [
            zlib.crc32(shard.read(s, c).tobytes())
            for s, c in zip(starts.tolist(), counts.tolist(), strict=True)
        ]
        shard.close()
        return frame[["range", "number", "doc_id"]].assign(
            inside=starts, n_tokens=counts, ids_crc32=np.array(crcs, np.int64)
        )

    found = stage(
        keys.groupBy("shard").applyInPandas(
            look_up,
            f"range int, number int, doc_id {kind}, inside long, n_tokens long, ids_crc32 long",
        ),
        "found",
    )
    earlier = Window.orderBy("range", "number").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        found.groupBy("range", "number")
        .agg(F.sum("n_tokens").alias("ids"))
        .select("range", "number", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("shift"))
    )
    shifts = stage(shifts, "shard_starts")  # one row per shard
    return found.join(shifts, ["range", "number"]).select(
        "doc_id", (F.col("shift") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
