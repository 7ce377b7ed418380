"""Near-duplicate texts by consistent weighted sampling.

Improved consistent weighted samples of a text's five-word shingles under TF-IDF agree
with those of another one with the probability of their weighted Jaccard similarity;
bands of samples find candidates. The similarity of the whole shingle sets under the same
weights decides.

Document frequencies are counted by whole hashes over all texts for every shingle that
more than ``Weights.floor`` texts hold, which is all shingles divided by ``FREQUENT`` and
at least 1; rarer ones weigh as if so many held them. So there are fewer than ``FREQUENT``
frequent shingles, at any size of the corpus.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import small_batches, stage
from footfall.llm.components import components

SIMILARITY = 0.8
WORDS = 5
#: Bands of samples; a pair of similarity 0.8 is missed with probability 0.00003.
BANDS, ROWS = 20, 4
#: Fewer shingles than this can be frequent; their frequencies go to every task, 4 MB at most.
FREQUENT = 1 << 18
#: Counters that tell which shingles can be frequent, and how many of them make a row.
CELLS, CELL_ROW = 1 << 22, 1 << 12
#: Texts that are compared with one leader, or block with block, in a task's group.
GROUP = 256
#: Rounds at most in which mixed buckets with more than LEADER_ABOVE texts outside their
#: largest component get another leader before blocks are compared.
LEADER_ROUNDS, LEADER_ABOVE = 2, 8 * GROUP
#: From so many texts of a group that meet the others, its shingles are numbered once.
_FEW = 4
#: The side of texts that stand on both sides of a group.
BOTH = 2
#: Bits of the table that keeps most texts without a candidate out of the shuffle; 4 MB at any size.
FILTER_BITS = 1 << 25

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)


# --- shingles --------------------------------------------------------------------------
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


_CHUNK = 1 << 18  # signs of text worked on at once, about 20 MB of arrays
_GAP = re.compile(r"[ \t\n\r]")


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(n, _U(_P)), np.full(n, _U(_P_INVERSE))
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _mix_in_place(x: np.ndarray, spare: np.ndarray) -> None:
    """``_mix`` without new arrays."""
    for _ in range(2):
        x ^= np.right_shift(x, _U(32), out=spare)
        x *= _U(0xD6E8FEB86659FD93)
    x ^= np.right_shift(x, _U(32), out=spare)


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first places of the words of UTF-8 bytes that end in a blank."""
    word = _IS_WORD[data]
    edges = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(1 << max(16, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, _U)
    powers = sums[1:]
    with np.errstate(over="ignore"):
        powers[:] = data
        powers += _U(1)
        powers *= up[: len(data)]
        np.cumsum(powers, out=powers)
        return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U)), starts


def _bytes(texts: list[str]) -> list[bytes]:
    return [t.lower().encode("utf-8", "replace") + b" " for t in texts]


def _pieces(text: str) -> Iterator[str]:
    """The text cut at white space, _CHUNK signs or a little more at a time."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + _CHUNK)
        end = gap.end() if gap else len(text)
        yield text[at:end]
        at = end


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts one after the other: hashes, counts, and how many per text.

    Words are runs of letters and digits in lower case. A text of fewer than five
    words has one shingle of all its words; a text without words has none. A long text
    given alone takes memory for its words, not its signs, unless it has no white space.
    """
    if len(texts) == 1 and len(texts[0]) > 2 * _CHUNK:
        found = [_words(np.frombuffer(_bytes([p])[0], np.uint8))[0] for p in _pieces(texts[0])]
        hashes = np.concatenate(found)
        words = np.array([len(hashes)])
    else:
        raw = _bytes(texts)
        hashes, starts = _words(np.frombuffer(b"".join(raw), np.uint8))
        ends = np.searchsorted(starts, np.cumsum([len(r) for r in raw]))
        words = np.diff(ends, prepend=0)
    if not len(hashes):
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    first = np.cumsum(words) - words
    runs = np.where(words >= WORDS, words - WORDS + 1, np.minimum(words, 1))
    found = np.zeros(len(hashes), _U)  # at each word the run that begins there
    with np.errstate(over="ignore"):
        factors = [_U(pow(_P, k + 1, 1 << 64) | 1) for k in range(WORDS)]
        run = found[: max(0, len(hashes) - WORDS + 1)]
        for k in range(WORDS if len(run) else 0):
            run += hashes[k : k + len(run)] * factors[k]
        run[:] = _mix(run)
        for i in np.flatnonzero((words > 0) & (words < WORDS)):
            n, at = words[i], first[i]
            few = (hashes[at : at + n] * np.array(factors[:n], _U)).sum(dtype=_U)
            found[at : at + 1] = _mix(np.array([few + _U(n)], _U))
    place = np.arange(len(found)) - np.repeat(first, words)
    found = found[place < np.repeat(runs, words)]
    first = np.cumsum(runs) - runs
    new = np.ones(len(found), bool)
    for at, n in zip(first.tolist(), runs.tolist(), strict=True):
        found[at : at + n].sort()
    new[1:] = found[1:] != found[:-1]
    new[first[runs > 0]] = True
    at = np.flatnonzero(new)
    per_text = np.diff(np.searchsorted(at, np.append(first, len(found))))
    return found[at], np.diff(at, append=len(found)), per_text


class Weights:
    """Inverse document frequencies times counts; the former lie between 1 and 2."""

    def __init__(self, documents: int, floor: int, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.documents, self.floor = max(documents, 2), floor
        self.hashes, self.counts = hashes[order], counts[order]
        self._likely: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "_likely": None}

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the frequent shingles among ``hashes``, and where they are in the table.

        Most shingles are rare, and most of those are told by their last bits alone.
        """
        if self._likely is None:
            self._likely = np.zeros(CELLS, bool)
            self._likely[(self.hashes & _U(CELLS - 1)).view(np.int64)] = True
        likely = np.flatnonzero(self._likely[(hashes & _U(CELLS - 1)).view(np.int64)])
        at = np.searchsorted(self.hashes, hashes[likely])
        at = np.minimum(at, len(self.hashes) - 1)
        same = self.hashes[at] == hashes[likely]
        return likely[same], at[same]

    def frequencies(self, hashes: np.ndarray) -> np.ndarray:
        """Of each shingle the number of texts that hold it, ``floor`` if that is not more."""
        out = np.full(len(hashes), self.floor, np.int64)
        if len(self.hashes):
            places, at = self._known(hashes)
            out[places] = self.counts[at]
        return out

    def of(self, hashes: np.ndarray, tf: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), self._inverse(np.array([self.floor])))
        if len(self.hashes):
            places, at = self._known(hashes)
            out[places] = self._inverse(self.counts[at])
        return out * tf

    def _inverse(self, frequencies: np.ndarray) -> np.ndarray:
        most = np.log(max(self.documents / self.floor, 2.0))
        rare = np.maximum(self.documents / frequencies, 1.0)
        return 1 + np.minimum(np.log(rare) / most, 1.0)


# --- consistent weighted sampling ----------------------------------------------------------
@lru_cache(maxsize=1)
def _gamma_table() -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of 2**16 equal steps."""
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros_like(p), np.full_like(p, 64.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < p
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return ((low + high) / 2).astype(np.float32)


def samples(hashes: np.ndarray, weights: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """BANDS * ROWS samples of every text that has shingles, a row per text.

    Each draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) from the shingle's hash, puts
    t = floor(ln w / r + b) and ln a = ln c - r (t - b) - r, and takes the (shingle,
    t) of the smallest a.
    """
    gamma = _gamma_table()
    log_gamma = np.log(gamma)
    log_w = np.log(weights)
    sizes = per_text[per_text > 0]
    starts = np.cumsum(sizes) - sizes
    out = np.zeros((len(sizes), BANDS * ROWS), np.uint32)
    low = hashes.astype(np.uint32)
    packed = np.zeros((len(hashes), 2), "<i4")  # the lesser a first, then the sample's name
    bits, part = np.empty(len(hashes), _U), np.empty(len(hashes), _U)  # used again and again
    place, b, t = part.view(np.int64), np.empty_like(log_w), np.empty_like(log_w)
    with np.errstate(over="ignore"):
        for k in range(BANDS * ROWS):
            np.add(hashes, _U((k + 1) * _P & (1 << 64) - 1), out=bits)
            _mix_in_place(bits, part)
            np.bitwise_and(bits, _U(0xFFFF), out=part)
            r = gamma.take(place)
            np.bitwise_and(np.right_shift(bits, _U(32), out=part), _U(0xFFFF), out=part)
            log_a = log_gamma.take(place)
            np.bitwise_and(np.right_shift(bits, _U(16), out=part), _U(0xFFFF), out=part)
            b[:] = place
            b *= np.float32(1 / 65536)
            np.divide(log_w, r, out=t)
            t += b
            np.floor(t, out=t)
            np.subtract(t, b, out=b)
            b *= r
            log_a -= b
            log_a -= r
            order = log_a.view(np.int32)  # of floats, as integers
            sign = order >> 31
            sign &= 0x7FFFFFFF
            packed[:, 1] = np.bitwise_xor(order, sign, out=sign)
            name = t.astype(np.int32).view(np.uint32)
            name *= np.uint32(_P & 0xFFFFFFFF)
            name ^= low
            packed[:, 0] = name.view(np.int32)
            least = np.minimum.reduceat(packed.view("<i8")[:, 0], starts)
            out[:, k] = least.astype(np.uint32)
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, a row per text."""
    keys = np.zeros((len(found), BANDS), np.int64)
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            key = np.full(len(found), _U(band + 1))
            for row in range(ROWS):
                key = _mix(key * _U(_P) + found[:, band * ROWS + row].astype(_U))
            keys[:, band] = key.view(np.int64)
    return keys


def weighted_jaccard(a, wa: np.ndarray, b, wb: np.ndarray) -> float:
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = np.minimum(wa[i], wb[j]).sum(dtype=np.float64)
    return common / (wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64) - common)


# --- tasks -----------------------------------------------------------------------------------
def _slices(texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``shingles`` of about ``_CHUNK`` signs of texts at a time."""
    held: list[str] = []
    size = 0
    for text in texts:
        if held and len(text) > 2 * _CHUNK:  # a long text goes alone
            yield shingles(held)
            held, size = [], 0
        held.append(text)
        size += len(text)
        if size >= _CHUNK:
            yield shingles(held)
            held, size = [], 0
    if held:
        yield shingles(held)


def _strings(column: pa.Array) -> Iterator[str]:
    """One Python string at a time."""
    return (text.as_py() for text in column)


SIGNED = "id long, row long, node long, mass double, bands array<long>"


def _signatures(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _signed(batch, weights)

    return run


def _signed(batch: pa.RecordBatch, weights: Weights) -> Iterator[pa.RecordBatch]:
    import xxhash

    done = 0
    for hashes, tf, per_text in _slices(_strings(batch.column("text"))):
        if len(hashes):
            w = weights.of(hashes, tf)
            found = band_keys(samples(hashes, w.astype(np.float32), per_text))
        nodes: list[int | None] = []
        masses: list[float | None] = []
        bands: list[np.ndarray | None] = []
        row, at = 0, 0
        for n in per_text.tolist():
            if not n:
                nodes.append(None)
                masses.append(None)
                bands.append(None)
                continue
            whole = hashes[at : at + n].tobytes() + tf[at : at + n].tobytes()
            nodes.append(xxhash.xxh3_64_intdigest(whole) - (1 << 63))
            masses.append(w[at : at + n].sum())
            bands.append(found[row])
            row, at = row + 1, at + n
        part = batch.slice(done, len(per_text))
        done += len(per_text)
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("row"), pa.array(nodes, pa.int64()),
             pa.array(masses, pa.float64()), pa.array(bands, pa.list_(pa.int64()))],
            ["id", "row", "node", "mass", "bands"],
        )


# --- document frequencies --------------------------------------------------------------------
def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, counts): how many shingles of this task's texts fall on each cell."""
    counts = np.zeros(CELLS, np.int32)
    for batch in batches:
        for hashes, _, _ in _slices(_strings(batch.column("text"))):
            # ones of the counters' own type: add.at has a fast loop for those
            ones = np.ones(len(hashes), counts.dtype)
            np.add.at(counts, (hashes & _U(CELLS - 1)).view(np.int64), ones)
    for place, row in enumerate(counts.reshape(-1, CELL_ROW)):
        most = row.max()
        if most:
            yield pa.RecordBatch.from_arrays(
                [pa.array([place], pa.int32()),
                 pa.array([row.astype(np.min_scalar_type(most)).tobytes()])],
                ["place", "counts"],
            )


def _add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, total, counts): sums of rows that come in the order of their places."""

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([place], pa.int32()), pa.array([int(held.sum())]), pa.array([held.tobytes()])],
            ["place", "total", "counts"],
        )

    place, held = None, np.zeros(CELL_ROW, np.int64)
    for batch in batches:
        for at, raw in zip(batch.column("place").to_pylist(), batch.column("counts"), strict=True):
            if at != place:
                if place is not None:
                    yield row()
                place, held = at, np.zeros(CELL_ROW, np.int64)
            raw = raw.as_py()
            held += np.frombuffer(raw, f"<u{len(raw) // CELL_ROW}")
    if place is not None:
        yield row()


def _full_cells(floor: int):
    """(place, bits): the cells on which more than ``floor`` shingles fall."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [
                np.packbits(np.frombuffer(raw.as_py(), "<i8") > floor, bitorder="little").tobytes()
                for raw in batch.column("counts")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), pa.array(bits, pa.binary())], ["place", "bits"]
            )

    return run


def _count_shingles(bitmap: np.ndarray):
    last = _U(8 * len(bitmap) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.unpackbits(bitmap, bitorder="little").view(bool)
        held, size = [np.zeros(0, _U)], 0
        for batch in batches:
            for hashes, _, _ in _slices(_strings(batch.column("text"))):
                held.append(hashes[full[(hashes & last).view(np.int64)]])
                size += len(held[-1])
                if size >= _CHUNK:
                    yield _counted(held)
                    held, size = [np.zeros(0, _U)], 0
        yield _counted(held)

    return run


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    h, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"]
    )


def corpus_weights(texts: DataFrame) -> Weights:
    """TF-IDF weights of the shingles of ``texts(text)``, every text counted.

    Every task adds its shingles up by ``CELLS`` hashed cells and sends those alone; only
    shingles on cells with more than the floor are then counted by their whole hashes,
    combined in map tasks. Bits of cells (512 KB) and fewer than ``FREQUENT`` frequencies
    reach the driver.
    """
    texts = texts.select(F.coalesce("text", F.lit("")).alias("text"))
    added = texts.mapInArrow(_count_cells, "place int, counts binary")
    cells = stage(
        added.repartition("place")
        .sortWithinPartitions("place")
        .mapInArrow(_add_cells, "place int, total long, counts binary"),
        "cells",
    )
    everything = cells.agg(F.sum("total")).first()[0] or 0
    floor = max(1, everything // FREQUENT)
    bitmap = np.zeros(CELLS >> 3, np.uint8)
    full = cells.select("place", "counts").mapInArrow(_full_cells(floor), "place int, bits binary")
    for row in full.collect():  # at most CELLS / CELL_ROW rows
        at = row.place * (CELL_ROW >> 3)
        bitmap[at : at + (CELL_ROW >> 3)] = np.frombuffer(row.bits, np.uint8)
    counted = texts.mapInArrow(_count_shingles(bitmap), "h long, n long")
    frequent = counted.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") > floor)
    found = stage(frequent, "frequencies").toPandas()  # fewer than FREQUENT rows
    hashes = found["h"].to_numpy(np.int64).view(_U)
    return Weights(texts.count(), floor, hashes, found["n"].to_numpy(np.int64))


# --- comparison ------------------------------------------------------------------------------
LINKS = "a long, b long"


def _links(groups: DataFrame, keys: list[str], check) -> DataFrame:
    """What ``check`` finds inside each group of ``groups(*keys, id, comp, side, text)``.

    Groups come one after the other, so that a task takes many small ones at once. Keys
    with the same hash would only have more texts compared.
    """
    rows = groups.select(F.xxhash64(*keys).alias("key"), "id", "comp", "side", "text")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(check, LINKS)


def _verify(weights: Weights, least: float):
    """Links between the texts of side 0 and side 1 of a group that are not joined yet.

    Texts of side ``BOTH`` are compared with each other. Whole groups are taken, several
    at once until they make about ``_CHUNK`` signs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            numbers = (batch.column(c).to_pylist() for c in ("key", "id", "comp", "side"))
            for row in zip(*numbers, _strings(batch.column("text")), strict=True):
                if row[0] != last and size >= _CHUNK:
                    yield _found(held, weights, least)
                    held, size = [], 0
                last = row[0]
                held.append(row)
                size += len(row[-1])
        if held:
            yield _found(held, weights, least)

    return run


def _found(rows: list[tuple], weights: Weights, least: float) -> pa.RecordBatch:
    """Links of whole groups: rows of (key, id, comp, side, text) in the order of their keys."""
    *numbers, texts = zip(*rows, strict=True)
    key, ids, comp, side = (np.array(n, np.int64) for n in numbers)
    hashes, tf, per_text = map(np.concatenate, zip(*_slices(texts), strict=True))
    w = weights.of(hashes, tf)
    ends = np.cumsum(per_text)
    links: list[tuple[int, int]] = []
    edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
    for a, b in zip(edges, edges[1:], strict=False):
        low, high = ends[a] - per_text[a], ends[b - 1]
        own = slice(a, b)
        found = _alike(hashes[low:high], w[low:high], per_text[own], side[own], comp[own], least)
        links += [(ids[a + i], ids[a + j]) for i, j in found]
    return pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())],
        ["a", "b"],
    )


def _alike(hashes, w, per_text, side, comp, least: float) -> list[tuple[int, int]]:
    """Pairs of one group's texts that link components not joined yet."""
    ends = np.cumsum(per_text)
    starts = ends - per_text
    total = np.add.reduceat(w, starts)
    joined = {c: c for c in comp.tolist()}

    def root(x):
        while joined[x] != x:
            joined[x] = x = joined[joined[x]]
        return x

    links = []
    firsts, others = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    places = table = None
    for i in firsts.tolist():
        own = root(comp[i])
        fits = least * np.maximum(total[others], total[i]) <= np.minimum(total[others], total[i]) * (1 + 1e-9)
        if side[i] == BOTH:
            fits &= (others > i) | (side[others] == 1)
        left = [j for j in others[fits].tolist() if root(comp[j]) != own]
        if not left:
            continue
        mine, mine_w = hashes[starts[i] : ends[i]], w[starts[i] : ends[i]]
        if len(firsts) < _FEW:
            at = np.minimum(np.searchsorted(mine, hashes), len(mine) - 1)
            shared = np.where(mine[at] == hashes, np.minimum(mine_w[at], w), 0.0)
        else:
            if places is None:  # numbers of the shingles, and a weight for each
                names, places = np.unique(hashes, return_inverse=True)
                table = np.zeros(len(names))
            table[places[starts[i] : ends[i]]] = mine_w
            shared = np.minimum(table[places], w)
            table[places[starts[i] : ends[i]]] = 0.0
        common = np.add.reduceat(shared, starts)
        alike = common >= least * (total + total[i] - common)
        for j in left:
            if alike[j] and root(comp[j]) != root(comp[i]):
                joined[root(comp[j])] = root(comp[i])
                links.append((i, j))
    return links


def _star_links(pairs: DataFrame, pool: DataFrame, check) -> DataFrame:
    """Links among ``pairs(lead, lead_comp, id, comp)``, in groups of a leader and GROUP texts."""
    pairs = stage(pairs, "stars")
    sizes = stage(
        pairs.groupBy("lead", "lead_comp").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts")),
        "star_sizes",
    )
    spread = pairs.join(sizes, ["lead", "lead_comp"])
    members = spread.select(
        "lead", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"), "id", "comp",
        F.lit(1).alias("side"),
    )
    leads = sizes.select(
        "lead",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.col("lead").alias("id"),
        F.col("lead_comp").alias("comp"),
        F.lit(0).alias("side"),
    )
    groups = members.unionByName(leads).join(pool, "id")
    return stage(_links(groups, ["lead", "part"], check), "star_links")


def _block_links(mixed: DataFrame, pool: DataFrame, check, least: float) -> DataFrame:
    """Links between each text outside its bucket's largest component and all others.

    Two texts can only be alike if the lesser of their masses (sums of weights) is ``least``
    of the greater at the least, so texts of large buckets are cut into classes of mass, of
    which only neighbours are compared, and each class into blocks. Two blocks of texts
    outside the largest component meet once; a block's comparison with itself shares its
    group with a block of the largest component.
    """
    step = max(-math.log(max(least, 1e-9)), 1e-3) * (1 + 1e-6)
    of_mass = F.floor(F.log("mass") / step).cast("long")
    marked = mixed.select(
        "band", "id", "comp", (F.col("comp") != F.col("big")).alias("outside"),
        F.when(F.col("n") > GROUP, of_mass).otherwise(0).alias("k"),
    )
    parts = F.ceil(F.count(F.lit(1)) / GROUP)
    sizes = stage(marked.groupBy("band", "outside", "k").agg(parts.alias("parts")), "block_sizes")
    blocks = sizes.withColumn("p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    ones = blocks.filter("outside").select(
        "band", F.col("k").alias("k1"), F.col("p").alias("p1"),
        F.explode(F.array(F.col("k") - 1, F.col("k"), F.col("k") + 1)).alias("k2"),
    )
    others = blocks.select(
        "band", F.col("outside").alias("outside2"), F.col("k").alias("k2"), F.col("p").alias("p2")
    )
    tiles = stage(
        ones.join(others, ["band", "k2"])
        .filter("NOT outside2 OR k2 > k1 OR (k2 = k1 AND p2 >= p1)")
        .withColumn("meet", F.expr("k1 = k2 AND p1 = p2"))
        .select(
            "*", F.expr("outside2 AND meet").alias("same"),
            F.expr("NOT outside2 AND meet").alias("beside"),
            F.expr("outside2 OR meet").alias("other"),
        ),
        "tiles",
    )
    placed = marked.join(sizes, ["band", "outside", "k"]).withColumn(
        "p", F.pmod(F.xxhash64("id"), F.col("parts"))
    )
    tile = ["band", "k1", "p1", "other", "k2", "p2"]
    first = placed.filter("outside").withColumnsRenamed({"k": "k1", "p": "p1"})
    first = first.join(tiles.filter("NOT beside"), ["band", "k1", "p1"]).select(
        *tile, "id", "comp", F.when(F.col("same"), BOTH).otherwise(0).alias("side")
    )
    second = placed.withColumnsRenamed({"outside": "outside2", "k": "k2", "p": "p2"})
    second = second.join(tiles.filter("NOT same"), ["band", "outside2", "k2", "p2"]).select(
        *tile, "id", "comp", F.lit(1).alias("side")
    )
    groups = first.unionByName(second).join(pool, "id")
    return stage(_links(groups, tile, check), "block_links")


def _mixed(members: DataFrame, links: DataFrame) -> DataFrame:
    """(band, id, mass, comp, big, n, rest) of the buckets that hold several components.

    ``big`` is the component with most texts in the bucket and ``rest`` counts the
    others. Of buckets with the same texts one is kept.
    """
    marked = stage(
        members.join(components(links), "id", "left").select(
            "band", "id", "mass", F.coalesce("component", "id").alias("comp")
        ),
        "marked",
    )
    per = marked.groupBy("band", "comp").agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("who")
    )
    several = (
        per.groupBy("band")
        .agg(
            F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("n"),
            F.sum("who").alias("who"), F.count(F.lit(1)).alias("comps"),
        )
        .filter("comps > 1")
        .groupBy("n", "who", "top")
        .agg(F.min("band").alias("band"))
    )
    kept = stage(
        several.select(
            "band", F.col("top.comp").alias("big"), "n", (F.col("n") - F.col("top.k")).alias("rest")
        ),
        "mixed",
    )
    return stage(marked.join(kept, "band"), "mixed_members")


def _with_candidates(texts: DataFrame, met: DataFrame) -> DataFrame:
    """(id, text) of the ids in ``met``; of rows that repeat an id the largest text.

    Hashed ids are first looked up in a bitmap of FILTER_BITS bits, which is broadcast as
    at most FILTER_BITS / 32768 rows of 4 KB. The join with the ids decides; where the
    bitmap is full it only spares nothing.
    """

    def place(id_):
        return F.pmod(F.xxhash64(id_), F.lit(FILTER_BITS)) + 1

    bitmap = stage(
        met.groupBy(F.bitmap_bucket_number(place(F.col("id"))).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place(F.col("id")))).alias("bits")
        ),
        "bitmap",
    )
    at = F.bitmap_bit_position(F.col("place"))
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    likely = (
        texts.withColumn("place", place(F.col("id")))
        .withColumn("bucket", F.bitmap_bucket_number("place"))
        .join(F.broadcast(bitmap), "bucket")
        .filter(F.getbit(byte, (at % 8).cast("int")) == 1)
        .select("id", "text")
    )
    # an inner join: the optimizer would move a semi join below the lookup
    found = likely.join(met.select("id").distinct(), "id")
    return found.groupBy("id").agg(F.max("text").alias("text"))


def row_hash(id_: Column, text: Column) -> Column:
    """What tells rows apart that share an id but not the text."""
    return F.xxhash64(id_.cast("long"), F.coalesce(text, F.lit("")))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept.

    A class is a connected component of links of at least ``similarity``; its id is
    its smallest doc_id, which is the row to keep. Texts with equal shingles and
    counts are one text, and one node of the links, from the start.

    Every text is first compared with one leader, the smallest node in any of its
    buckets, in groups of ``GROUP``; its words move once. Buckets that then hold more
    than ``LEADER_ABOVE`` texts outside their largest component compare all with another
    leader from there. In buckets that are still mixed, every text outside the largest
    component is compared with all others, block by block. So each pair of texts that
    shares a bucket is joined in the end or has been compared, and a group of texts
    that are all alike costs as many comparisons as it has texts.

    * null text, text without words: a class of its own.
    * very long text: read whole; its words take about 50 bytes each in a task.
    * repeated rows: in one class; rows that repeat the kept id are all kept.
    * rows that share an id but not the text: each in the class of its own text; classes
      with the same smallest doc_id then share their class_id, but not class_size.
    * null id: never linked, class_id is null. Empty table: no rows.
    * other columns are ignored, whatever their names.
    """
    return near_classes(docs, id_col, text_col, similarity).drop("row")


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``near_duplicates`` with the ``row_hash`` of each row in a column ``row``.

    What hands texts to Python is staged, so its small batches end with the call.
    """
    with small_batches(docs.sparkSession):
        return _classes(docs, id_col, text_col, similarity)


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    id_ = F.col(id_col).cast("long")
    texts = docs.select(
        id_.alias("id"),
        F.coalesce(text_col, F.lit("")).alias("text"),
        row_hash(id_, F.col(text_col)).alias("row"),
    )
    weights = corpus_weights(texts)
    signed = stage(
        texts.mapInArrow(_signatures(weights), SIGNED),
        "signatures",
    )
    known = signed.filter("node IS NOT NULL AND id IS NOT NULL")
    distinct = stage(
        known.groupBy("node").agg(F.min(F.struct("id", "row")).alias("rep")).select("node", "rep.*"),
        "distinct_texts",
    )
    bands = stage(
        known.join(distinct, ["node", "id", "row"], "left_semi")
        .dropDuplicates(["node", "id", "row"])
        .select(F.col("node").alias("id"), "mass", F.explode("bands").alias("band")),
        "bands",
    )
    buckets = stage(
        bands.groupBy("band")
        .agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1"),
        "buckets",
    )
    met = stage(bands.join(buckets, "band"), "met")
    candidates = stage(
        distinct.join(met.select(F.col("id").alias("node")).distinct(), "node").select(
            F.col("row").alias("id"), "node"
        ),
        "candidates",
    )
    found = _with_candidates(texts.select(F.col("row").alias("id"), "text"), candidates)
    pool = stage(found.join(candidates, "id").select(F.col("node").alias("id"), "text"), "pool")
    check = _verify(weights, similarity)

    stars = met.groupBy("id").agg(F.min("lead").alias("lead")).filter("id <> lead")
    stars = stars.select(
        "lead", F.col("lead").alias("lead_comp"), "id", F.col("id").alias("comp")
    )
    links = _star_links(stars, pool, check)
    members = met.select("band", "id", "mass")
    mixed = _mixed(members, links)
    for _ in range(LEADER_ROUNDS):
        large = mixed.filter(F.col("rest") > LEADER_ABOVE)
        if large.isEmpty():
            break
        lead = stage(
            large.filter("comp <> big").groupBy("band").agg(F.min(F.struct("id", "comp")).alias("l")),
            "leads",
        )
        stars = large.join(lead, "band").filter("comp <> l.comp")
        stars = stars.select(
            F.col("l.id").alias("lead"), F.col("l.comp").alias("lead_comp"), "id", "comp"
        )
        links = stage(links.unionByName(_star_links(stars.distinct(), pool, check)), "all_links")
        mixed = _mixed(members, links)
    links = links.unionByName(_block_links(mixed, pool, check, similarity))
    classes = components(links)
    named = stage(
        distinct.join(classes, F.col("node") == classes["id"], "left").select(
            F.col("node").alias("k"), F.coalesce("component", "node").alias("class")
        ),
        "classes",
    )
    rows = stage(
        signed.join(named, F.col("node") == F.col("k"), "left").select(
            "id", "row", F.when(F.col("id").isNotNull(), F.coalesce("class", "row")).alias("class")
        ),
        "members",
    )
    counts = stage(
        rows.groupBy("class")
        .agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least"))
        .filter("size > 1"),
        "class_sizes",
    ).withColumnRenamed("class", "c")
    class_id = F.coalesce("least", "id")
    return rows.join(counts, F.col("class") == F.col("c"), "left").select(
        F.col("id").alias("doc_id"),
        class_id.alias("class_id"),
        F.coalesce("size", F.lit(1)).alias("class_size"),
        F.col("id").eqNullSafe(class_id).alias("kept"),
        "row",
    )
