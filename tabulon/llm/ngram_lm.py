"""An interpolated modified Kneser-Ney model of order 2 or 3, counted in Spark and mapped by workers.

Counting, each step balanced by a hash of what it counts, with sums taken before any shuffle:

1. Words: every task counts its words; buckets of the hash range add them up and write the
   sorted word hashes with their counts. A word's id is its place in that order.
2. Pairs: every task counts pairs of ids; buckets of the pair hash add them up and write the
   sorted hashes of pairs seen once, and of the others with their counts. They pass on, per
   first word, how many pairs were seen once, twice and more often, and per second word in how
   many pairs it ends. No bucket holds all pairs of one word.
3. Blocks of ids add these up and write, per word, its back-off weight and continuation count.

Tasks that score map these files, look up the sorted words and pairs of a batch of texts, and
never hold the model in memory. The driver keeps the file list, the totals, and the counts of
counts that give the discounts.

The probability of word w after v, with n(vw) the pair's count and n(v) the word's, is
``(n(vw) - D) / n(v) + g(v) * P(w)``, where ``P(w) = (k(w) - E) / K + h / (V + 1)``; k(w) counts
the different words before w, D and E are the discounts for counts 1, 2 and 3 or more, and g and
h hand on what was taken. An unseen v gives P(w); an unseen w shares ``h / (V + 1)``.

That is order 2. With order 3, triples are counted before pairs, and n(vw) is the number of
different words before the pair, n(v) the sum of these. The probability of w after u and v is
``(n(uvw) - D') / n(uv) + g(uv) * P(w after v)``, or P(w after v) if uv was not seen. Triples lie
in files by the hash of (u, v): sorted pairs, the ids that follow each, and a byte for each count.
As a pair that does not end a text is followed by a word, these are also the files of pairs.

Defined results: a null or empty text is its end alone; texts score whether or not they were
learned from; repeated rows count as often as they occur; without training texts the score is
that of the uniform distribution over one word. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import col
from tabulon.llm.common import (
    mixed,
    shuffles_removed,
    small_batches,
    word_hashes,
    worker_state,
)
from tabulon.llm.shared_files import mapped, write_file
from tabulon.session import scratch_path, stored

#: Pairs or words that a task gathers before it adds them up and hands them on.
GATHER = 4_000_000
#: Words of one block of step 3.
BLOCK = 1 << 16
#: Stands for the end of a text; no word has white space in it.
END = b" "


def text_words(data: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased, and the end."""
    words = (data or b"").lower().split()
    words.append(END)
    return words


def unmixed(h: np.ndarray) -> np.ndarray:
    """The inverse of ``common.mixed``."""
    h = h ^ (h >> np.uint64(31)) ^ (h >> np.uint64(62))
    h = h * np.uint64(0x319642B2D24D8EC3)
    h = h ^ (h >> np.uint64(27)) ^ (h >> np.uint64(54))
    h = h * np.uint64(0x96DE1B173F119089)
    return h ^ (h >> np.uint64(30)) ^ (h >> np.uint64(60))


def _bounds(buckets: int) -> np.ndarray:
    """First hash of every bucket but the first."""
    return np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def _binary(rows: list[tuple]) -> pa.RecordBatch:
    """(bucket, keys, counts) as a record batch; counts that fit take four bytes."""
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()),
         pa.array([r[1].tobytes() for r in rows], pa.binary()),
         pa.array([r[2].astype(np.uint32 if not len(r[2]) or r[2].max() < 1 << 32
                               else np.uint64).tobytes() for r in rows], pa.binary())],
        names=["bucket", "keys", "counts"])


_PARTS = "bucket int, keys binary, counts binary"


def _split(keys: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> list[tuple]:
    edges = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
    return [(b, keys[x:y], counts[x:y])
            for b, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]


def _counts_of(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint32 if len(data) == 4 * n else np.uint64).astype(np.int64)


class _Adder:
    """Sums (keys, counts) parts, adding up whenever as much again has come in."""

    def __init__(self) -> None:
        self.keys = [np.empty(0, np.uint64)]
        self.counts = [np.empty(0, np.int64)]
        self.waiting = self.limit = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.waiting += len(keys)
        if self.waiting > max(self.limit, GATHER):
            self.result()

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        if len(self.keys) > 1 and len(keys):
            keys, counts = _summed(keys, counts)
        self.keys, self.counts, self.waiting, self.limit = [keys], [counts], 0, len(keys)
        return keys, counts


def _added(iterator) -> dict[int, _Adder]:
    """Sums of all parts of one partition by bucket."""
    sums: dict[int, _Adder] = {}
    for batch in iterator:
        for b, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
            k = np.frombuffer(keys, np.uint64)
            sums.setdefault(b, _Adder()).add(k, _counts_of(counts, len(k)))
    return sums


def _places(a: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in the sorted array, -1 if it is not there."""
    if not len(a):
        return np.full(len(keys), -1, np.int64)
    at = np.searchsorted(a, keys)
    at[at == len(a)] = 0
    return np.where(a[at] == keys, at, -1)


class Parts:
    """Values in several mapped files, in the order of sorted keys or of ids."""

    def __init__(self, urls: list[str | None], dtype: str) -> None:
        """Without a URL a file has no values."""
        self.arrays = [mapped(u, dtype) if u else np.empty(0, dtype) for u in urls]

    def find(self, sorted_keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Place of each key within its file, -1 if it is not there; files are hash ranges."""
        out = np.full(len(sorted_keys), -1, np.int64)
        edges = [0, *np.searchsorted(sorted_keys, bounds).tolist(), len(sorted_keys)]
        for a, x, y in zip(self.arrays, edges, edges[1:]):
            if y > x:
                out[x:y] = _places(a, sorted_keys[x:y])
        return out

    def take(self, places: np.ndarray, file: np.ndarray) -> np.ndarray:
        """Values at places within files; both arrays are sorted by file."""
        out = np.zeros(len(places), self.arrays[0].dtype if self.arrays else np.int64)
        edges = np.searchsorted(file, np.arange(len(self.arrays) + 1))
        for a, x, y in zip(self.arrays, edges[:-1], edges[1:]):
            if y > x:
                out[x:y] = a[places[x:y]]
        return out


@dataclass(frozen=True)
class Vocabulary:
    """Sorted word hashes and counts in files by hash range; ids count through the files."""

    folder: str
    sizes: tuple[int, ...]
    tokens: int

    @property
    def size(self) -> int:
        return sum(self.sizes)

    def _maps(self) -> tuple[Parts, Parts, np.ndarray, np.ndarray]:
        def load():
            urls = [f"{self.folder}/words-{b:06d}" for b in range(len(self.sizes))]
            first = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
            return (Parts([f"{u}.hash" for u in urls], "<u8"),
                    Parts([f"{u}.count" for u in urls], "<i8"), _bounds(len(urls)), first)
        return worker_state(self.folder, load)

    def lookup(self, hashes: np.ndarray, with_counts: bool = True
               ) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, count) of every word hash."""
        words, counts, bounds, first = self._maps()
        unique, inverse = np.unique(hashes, return_inverse=True)
        place = words.find(unique, bounds)
        file = np.searchsorted(bounds, unique, side="right")
        ids = np.where(place >= 0, first[file] + place, -1)
        if not with_counts:
            return ids[inverse], ids[:0]
        n = np.where(place >= 0, counts.take(np.maximum(place, 0), file), 0) \
            if self.size else np.zeros(len(unique), np.int64)
        return ids[inverse], n[inverse]


def _partitions(df: DataFrame) -> int:
    """Tasks that read the table; so many buckets hold about one task's part each."""
    return max(1, df.rdd.getNumPartitions())


def count_words(texts: DataFrame, folder: str, buckets: int) -> Vocabulary:
    """Count the words of the column ``text`` (bytes) into files below ``folder``."""
    bounds = _bounds(buckets)

    def count(iterator) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0

        def flush():
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return _binary(_split(keys, counts, bounds))

        for batch in iterator:
            for data in batch.column(0).to_pylist():
                waiting.append(word_hashes().of(text_words(data)))
                n += len(waiting[-1])
            if n > GATHER:
                yield flush()
                waiting, n = [], 0
        if waiting:
            yield flush()

    def add(iterator) -> Iterator[pa.RecordBatch]:
        for b, adder in _added(iterator).items():
            keys, counts = adder.result()
            write_file(f"{folder}/words-{b:06d}.hash", keys.astype("<u8").tobytes())
            write_file(f"{folder}/words-{b:06d}.count", counts.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.array([len(keys)], pa.int64()),
                 pa.array([int(counts.sum())], pa.int64())], names=["bucket", "n", "tokens"])

    done = stored(texts.mapInArrow(count, _PARTS).repartition(buckets, "bucket")
                  .mapInArrow(add, "bucket int, n long, tokens long"), "words").collect()
    sizes = {r["bucket"]: r["n"] for r in done}
    for b in range(buckets):
        if b not in sizes:
            write_file(f"{folder}/words-{b:06d}.hash", b"")
            write_file(f"{folder}/words-{b:06d}.count", b"")
    return Vocabulary(folder, tuple(sizes.get(b, 0) for b in range(buckets)),
                      sum(r["tokens"] for r in done))


def _pair_hashes(ids: np.ndarray, counts: list[int], start: int) -> np.ndarray:
    """Hash of (previous id, id) for texts one after another; ``start`` stands before each."""
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[np.cumsum([0, *counts[:-1]])] = start
    return mixed((before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64))


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Discounts for counts 1, 2, 3+ from the numbers of entries counted 1, 2, 3 and 4 times.

    Where a number is missing, the discount takes half of what lies between two counts.
    """
    n1, n2, n3, n4 = n
    if not n1 or not n2:
        return (0.5, 0.5, 0.5)
    y = n1 / (n1 + 2 * n2)
    d3 = 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in
                 ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, d3)))


#: Files of a bucket of triples: contexts, where their followers begin, the followers' ids, and
#: what is known of contexts with more than ``FEW`` followers.
TRIPLE_FILES = {"context": "<u8", "first": "<u4", "word": "<u4", "wide": "<u4", "total": "<u8",
                "n1": "<u4", "n2": "<u4"}
#: Contexts with at most so many followers are added up when they are looked up.
FEW = 16


def packed(a: np.ndarray) -> bytes:
    """The values' first bytes, then their second bytes and so on, compressed.

    Ids use few of their high bytes, so these come to almost nothing.
    """
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    planes = raw.reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _packed_pairs(rows: list[tuple]) -> pa.RecordBatch:
    """(bucket, pair hashes, counts) as a record batch; the ids behind the hashes are packed."""
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _, _ in rows], pa.int32()),
         pa.array([packed(unmixed(keys)) for _, keys, _ in rows], pa.binary()),
         pa.array([packed(counts.astype("<u8")) for _, _, counts in rows], pa.binary())],
        names=["bucket", "keys", "counts"])


def _added_pairs(iterator) -> dict[int, _Adder]:
    """Sums of all packed pairs of one partition by bucket."""
    sums: dict[int, _Adder] = {}
    for batch in iterator:
        for b, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
            sums.setdefault(b, _Adder()).add(mixed(unpacked(keys, "<u8")),
                                             unpacked(counts, "<u8").astype(np.int64))
    return sums


def write_clipped(url: str, counts: np.ndarray) -> None:
    """Write counts in a byte each, and those of 255 or more once again with their places."""
    large = np.flatnonzero(counts >= 255)
    write_file(f"{url}.small", np.minimum(counts, 255).astype("<u1").tobytes())
    write_file(f"{url}.at", large.astype("<u4").tobytes())
    write_file(f"{url}.large", counts[large].astype("<u8").tobytes())


class Clipped:
    """Counts written by ``write_clipped``."""

    def __init__(self, urls: list[str | None]) -> None:
        self.small, self.at, self.large = (
            Parts([u and f"{u}.{kind}" for u in urls], dtype).arrays
            for kind, dtype in (("small", "<u1"), ("at", "<u4"), ("large", "<u8")))

    def of(self, file: int, places: np.ndarray) -> np.ndarray:
        out = self.small[file][places].astype(np.int64)
        large = np.flatnonzero(out == 255)
        if len(large):
            out[large] = self.large[file][np.searchsorted(self.at[file], places[large])]
        return out

    def take(self, places: np.ndarray, file: np.ndarray) -> np.ndarray:
        """Counts at places within files; both arrays are sorted by file."""
        out = np.zeros(len(places), np.int64)
        edges = np.searchsorted(file, np.arange(len(self.small) + 1))
        for b, (x, y) in enumerate(zip(edges[:-1], edges[1:])):
            if y > x and len(self.small[b]):
                out[x:y] = self.of(b, places[x:y])
        return out


def _run_starts(a: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))


def _summed_triples(contexts: np.ndarray, ids: np.ndarray, counts: np.ndarray):
    order = np.lexsort((ids, contexts))
    contexts, ids, counts = contexts[order], ids[order], counts[order]
    starts = np.flatnonzero(np.concatenate(
        [[True], (contexts[1:] != contexts[:-1]) | (ids[1:] != ids[:-1])]))
    return contexts[starts], ids[starts], np.add.reduceat(counts, starts)


def _count_triples(texts: DataFrame, vocabulary: Vocabulary, folder: str, buckets: int
                   ) -> dict[int, np.ndarray]:
    """Count triples into files by the hash of their first two words.

    Gives, for each bucket with triples, how many were seen 1, 2, 3 and 4 times. A text has two
    starts before it. The job ends here, so that its shuffle is gone when pairs are counted.
    """
    start, bounds = vocabulary.size, _bounds(buckets)

    def count(iterator) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0

        def flush():
            contexts, words = (np.concatenate(x) for x in zip(*waiting))
            contexts, words, counts = _summed_triples(contexts, words,
                                                      np.ones(len(words), np.int64))
            edges = [0, *np.searchsorted(contexts, bounds).tolist(), len(contexts)]
            rows = []
            for b, (x, y) in enumerate(zip(edges, edges[1:])):
                if y > x:
                    starts = _run_starts(contexts[x:y])
                    rows.append((b, packed(unmixed(contexts[x:y][starts])),
                                 packed(np.diff(starts, append=y - x).astype("<u4")),
                                 packed(words[x:y].astype("<u4")),
                                 packed(counts[x:y].astype("<u8"))))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 0 else pa.binary())
                 for i, c in enumerate(zip(*rows))],
                names=["bucket", "keys", "runs", "words", "counts"])

        for batch in iterator:
            hashes = [word_hashes().of(text_words(x)) for x in batch.column(0).to_pylist()]
            if not hashes:
                continue
            ids, _ = vocabulary.lookup(np.concatenate(hashes), with_counts=False)
            first = np.cumsum([0, *[len(h) for h in hashes[:-1]]])
            previous = np.roll(ids, 1)
            previous[first] = start
            earlier = np.roll(previous, 1)
            earlier[first] = start
            waiting.append((mixed((earlier.astype(np.uint64) << np.uint64(32))
                                  | previous.astype(np.uint64)), ids))
            n += len(ids)
            if n > GATHER:
                yield flush()
                waiting, n = [], 0
        if waiting:
            yield flush()

    def add(iterator) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in iterator:
            for b, keys, runs, words, counts in zip(*(c.to_pylist() for c in batch.columns)):
                new = (np.repeat(mixed(unpacked(keys, "<u8")), unpacked(runs, "<u4")),
                       unpacked(words, "<u4").astype(np.int64),
                       unpacked(counts, "<u8").astype(np.int64))
                held = sums.setdefault(b, [[], 0, 0])
                held[0].append(new)
                held[1] += len(new[0])
                if held[1] > max(held[2], GATHER):
                    whole = _summed_triples(*(np.concatenate(x) for x in zip(*held[0])))
                    sums[b] = [[whole], 0, len(whole[0])]
        for b, (parts, _, _) in sums.items():
            contexts, words, counts = _summed_triples(
                *(np.concatenate(x) for x in zip(*parts)))
            starts = _run_starts(contexts)
            wide = np.flatnonzero(np.diff(starts, append=len(contexts)) > FEW)
            each = {k: np.add.reduceat(x, starts)[wide] for k, x in
                    (("total", counts), ("n1", (counts == 1).astype(np.int64)),
                     ("n2", (counts == 2).astype(np.int64)))}
            files = {"context": contexts[starts], "first": np.append(starts, len(contexts)),
                     "word": words, "wide": wide, **each}
            for k, x in files.items():
                write_file(f"{folder}/triples-{b:06d}.{k}", x.astype(TRIPLE_FILES[k]).tobytes())
            write_clipped(f"{folder}/triples-{b:06d}.times", counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32())] + [pa.array([int((counts == k).sum())], pa.int64())
                                               for k in (1, 2, 3, 4)],
                names=["bucket", "n1", "n2", "n3", "n4"])

    parts = texts.mapInArrow(count, "bucket int, keys binary, runs binary, words binary, "
                                    "counts binary")
    done = stored(parts.repartition(buckets, "bucket")
                  .mapInArrow(add, "bucket int, n1 long, n2 long, n3 long, n4 long"), "triples")
    return {r["bucket"]: np.array(r[1:], np.int64) for r in done.collect()}


def _pairs_of_triples(spark: SparkSession, folder: str, buckets: int, written: set[int]
                      ) -> DataFrame:
    """Parts of counted pairs (v, w) with the number of different words before them, read from
    the files of triples, a task for each."""
    bounds = _bounds(buckets)

    def pairs(iterator) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            for b in batch.column(0).to_pylist():
                if b in written:
                    contexts, first, words = (
                        mapped(f"{folder}/triples-{b:06d}.{k}", TRIPLE_FILES[k])
                        for k in ("context", "first", "word"))
                    second = np.repeat(unmixed(contexts) << np.uint64(32), np.diff(first))
                    yield _packed_pairs(_split(*np.unique(mixed(second | words),
                                                          return_counts=True), bounds))

    return spark.range(0, buckets, 1, buckets).mapInArrow(pairs, _PARTS)


def _find_within(a: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray
                 ) -> np.ndarray:
    """Place of each wanted value in its sorted run ``a[low:high]``, -1 if it is not there."""
    low, end = low.copy(), high
    high = high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        less = a[middle] < wanted[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
        open_ = open_[low[open_] < high[open_]]
    out = np.full(len(wanted), -1, np.int64)
    inside = np.flatnonzero(low < end)
    hit = inside[a[low[inside]] == wanted[inside]]
    out[hit] = low[hit]
    return out


@dataclass(frozen=True)
class NgramModel:
    """The files of a model and the few numbers that go with them."""

    folder: str
    vocabulary: Vocabulary
    buckets: int
    #: Buckets that hold pairs, and those that hold triples.
    pair_files: frozenset[int]
    triple_files: frozenset[int]
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    pair_types: int
    left_over: float
    order: int = 2
    triple_discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)

    def _urls(self, name: str, written: frozenset[int]) -> list[str | None]:
        return [f"{self.folder}/{name}-{b:06d}" if b in written else None
                for b in range(self.buckets)]

    def _maps(self):
        def load():
            blocks = [f"{self.folder}/block-{b:06d}"
                      for b in range(-(-(self.vocabulary.size + 1) // BLOCK))]
            return (_bounds(self.buckets),
                    Parts([f"{u}.backoff" for u in blocks], "<f4"),
                    Parts([f"{u}.before" for u in blocks], "<i8"),
                    Parts([f"{u}.total" for u in blocks], "<i8") if self.order > 2 else None)
        return worker_state(self.folder + "/blocks", load)

    def _pair_maps(self) -> dict:
        def load():
            urls = self._urls("pairs", self.pair_files)
            kinds = {"once": "<u8", "more": "<u8", "count": "<u4"} if self.order == 2 \
                else {"end": "<u8", "end_count": "<u4"}
            maps = {k: Parts([u and f"{u}.{k}" for u in urls], t) for k, t in kinds.items()}
            if self.order > 2:
                maps["before"] = Clipped([u and f"{u}.before" for u in urls])
            return maps
        return worker_state(self.folder + "/pairs", load)

    def _triple_maps(self) -> dict:
        def load():
            urls = self._urls("triples", self.triple_files)
            return {"times": Clipped([u and f"{u}.times" for u in urls]),
                    **{k: Parts([u and f"{u}.{k}" for u in urls], t)
                       for k, t in TRIPLE_FILES.items()}}
        return worker_state(self.folder + "/triples", load)

    def _pair_counts(self, unique: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Counts of sorted pair hashes. With order 3 a pair is the context of a triple, unless
        it ends a text."""
        maps = self._pair_maps()
        if self.order == 2:
            seen = (maps["once"].find(unique, bounds) >= 0).astype(np.int64)
            steps = [(maps["more"], maps["count"])]
        else:
            seen = np.zeros(len(unique), np.int64)
            steps = [(self._triple_maps()["context"], maps["before"]),
                     (maps["end"], maps["end_count"])]
        for keys, counts in steps:
            place = keys.find(unique, bounds)
            hit = place >= 0
            seen[hit] = counts.take(place[hit], np.searchsorted(bounds, unique[hit],
                                                                side="right"))
        return seen

    def _per_word(self, parts: Parts, ids: np.ndarray, missing: float) -> np.ndarray:
        unique, inverse = np.unique(ids, return_inverse=True)
        out = np.full(len(unique), missing, float)
        known = unique >= 0
        out[known] = parts.take(unique[known] % BLOCK, unique[known] // BLOCK)
        return out[inverse]

    def log10_probabilities(self, ids: np.ndarray, n: np.ndarray, counts: list[int],
                            texts_learned: int) -> np.ndarray:
        """log10 P of every token; ``n`` holds the tokens' own counts."""
        bounds, backoff, before, totals = self._maps()
        start = self.vocabulary.size
        first = np.cumsum([0, *counts[:-1]])
        previous, previous_n = np.roll(ids, 1), np.roll(n, 1).astype(float)
        previous[first], previous_n[first] = start, texts_learned
        if self.order > 2:
            previous_n = self._per_word(totals, previous, 0.0)
        keys = mixed((np.maximum(previous, 0).astype(np.uint64) << np.uint64(32))
                     | np.maximum(ids, 0).astype(np.uint64))
        unique, inverse = np.unique(keys, return_inverse=True)
        seen = self._pair_counts(unique, bounds)
        seen = np.where((ids >= 0) & (previous >= 0), seen[inverse], 0)
        d = np.array([0.0, *self.pair_discounts])[np.minimum(seen, 3)]
        k = self._per_word(before, ids, 0.0)
        e = np.array([0.0, *self.word_discounts])[np.minimum(k, 3).astype(np.int64)]
        lower = (np.maximum(k - e, 0) / max(self.pair_types, 1)
                 + self.left_over / (self.vocabulary.size + 1))
        weight = self._per_word(backoff, previous, 1.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            upper = np.where(seen > 0, (seen - d) / np.maximum(previous_n, 1), 0.0)
        p = upper + weight * lower
        if self.order > 2:
            p = self._with_triples(p, ids, previous, first)
        return np.log10(p)

    def _followers(self, file: int, context: np.ndarray, low: np.ndarray, n: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray]:
        """(sum of counts, sum of discounts) of the ``n`` followers from ``low`` on."""
        maps, d = self._triple_maps(), np.array([0.0, *self.triple_discounts])
        total, taken = np.zeros(len(n)), np.zeros(len(n))
        few = np.flatnonzero(n <= FEW)
        if len(few):
            first = np.cumsum(n[few]) - n[few]
            counts = maps["times"].of(file, np.repeat(low[few] - first, n[few])
                                      + np.arange(n[few].sum()))
            total[few] = np.add.reduceat(counts, first)
            taken[few] = np.add.reduceat(d[np.minimum(counts, 3)], first)
        wide = np.flatnonzero(n > FEW)
        if len(wide):
            at = np.searchsorted(maps["wide"].arrays[file], context[wide])
            n1, n2 = (maps[k].arrays[file][at].astype(np.int64) for k in ("n1", "n2"))
            total[wide] = maps["total"].arrays[file][at]
            taken[wide] = d[1] * n1 + d[2] * n2 + d[3] * (n[wide] - n1 - n2)
        return total, taken

    def _with_triples(self, lower: np.ndarray, ids: np.ndarray, previous: np.ndarray,
                      first: np.ndarray) -> np.ndarray:
        """Probabilities after two words; ``lower`` holds those after one."""
        maps, bounds = self._triple_maps(), _bounds(self.buckets)
        earlier = np.roll(previous, 1)
        earlier[first] = self.vocabulary.size
        known = (earlier >= 0) & (previous >= 0)
        context = mixed((np.maximum(earlier, 0).astype(np.uint64) << np.uint64(32))
                        | np.maximum(previous, 0).astype(np.uint64))
        unique, inverse = np.unique(context, return_inverse=True)
        place = maps["context"].find(unique, bounds)
        total, taken = np.zeros(len(unique)), np.zeros(len(unique))
        low, n = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64)
        seen = np.zeros(len(ids), np.int64)
        tokens = np.argsort(inverse, kind="stable")       # by context, and so by file
        files = np.arange(self.buckets + 1)
        file = np.searchsorted(bounds, unique, side="right")
        edges = np.searchsorted(file, files)
        token_edges = np.searchsorted(file[inverse[tokens]], files)
        for b in range(self.buckets):
            at = edges[b] + np.flatnonzero(place[edges[b]:edges[b + 1]] >= 0)
            if not len(at):
                continue
            starts = maps["first"].arrays[b]
            low[at] = starts[place[at]]
            n[at] = starts[place[at] + 1].astype(np.int64) - low[at]
            total[at], taken[at] = self._followers(b, place[at], low[at], n[at])
            own = tokens[token_edges[b]:token_edges[b + 1]]
            own = own[known[own] & (ids[own] >= 0)]
            begin = low[inverse[own]]
            found = _find_within(maps["word"].arrays[b], ids[own], begin,
                                 begin + n[inverse[own]])
            own, found = own[found >= 0], found[found >= 0]
            seen[own] = maps["times"].of(b, found)
        total, taken = np.where(known, total[inverse], 0), np.where(known, taken[inverse], 0)
        d = np.array([0.0, *self.triple_discounts])[np.minimum(seen, 3)]
        some = np.maximum(total, 1)
        return np.where(total > 0, (seen - d) / some + taken / some * lower, lower)


def fit_bigrams(texts: DataFrame, order: int = 2) -> tuple[NgramModel, int]:
    """(model of order 2 or 3, number of texts) learned from the column ``text`` of bytes."""
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    spark = texts.sparkSession
    small_batches(spark)
    with shuffles_removed(spark):
        return _fit_bigrams(spark, texts, order)


def _fit_bigrams(spark: SparkSession, texts: DataFrame, order: int) -> tuple[NgramModel, int]:
    buckets = _partitions(texts)
    folder = scratch_path(spark, "ngrams")
    learned = texts.count()
    vocabulary = count_words(texts, folder, buckets)
    start = vocabulary.size
    if start >= (1 << 32) - 1:
        raise ValueError("pairs of word ids have 64 bits: at most 2**32 - 2 different words")
    bounds = _bounds(buckets)

    def count(iterator) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0

        def flush():
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return _packed_pairs(_split(keys, counts, bounds))

        for batch in iterator:
            hashes = [word_hashes().of(text_words(x)) for x in batch.column(0).to_pylist()]
            if not hashes:
                continue
            ids, _ = vocabulary.lookup(np.concatenate(hashes), with_counts=False)
            waiting.append(_pair_hashes(ids, [len(h) for h in hashes], start))
            n += len(ids)
            if n > GATHER:
                yield flush()
                waiting, n = [], 0
        if waiting:
            yield flush()

    def add(iterator) -> Iterator[pa.RecordBatch]:
        """Write a bucket's pairs; pass on (block, kind, ids in the block, counts).

        Kinds 1, 2, 3: first words' pairs seen once, twice, more often; 4: second words' pairs;
        5, for order 3: the sum of the counts of first words' pairs;
        0 with block -1 - bucket: how many pairs were seen 1, 2, 3 and 4 times, and in all.
        """
        for b, adder in _added_pairs(iterator).items():
            keys, counts = adder.result()
            url = f"{folder}/pairs-{b:06d}"
            single = counts == 1
            if order == 2:
                write_file(f"{url}.once", keys[single].astype("<u8").tobytes())
                write_file(f"{url}.more", keys[~single].astype("<u8").tobytes())
                write_file(f"{url}.count", np.minimum(counts[~single], (1 << 32) - 1)
                           .astype("<u4").tobytes())
            else:
                # A pair that does not end a text is a context of triples in the same bucket.
                contexts = mapped(f"{folder}/triples-{b:06d}.context", "<u8") \
                    if b in triples else np.empty(0, "<u8")
                place = _places(contexts, keys)
                before = np.zeros(len(contexts), np.int64)
                before[place[place >= 0]] = counts[place >= 0]
                write_clipped(f"{url}.before", before)
                write_file(f"{url}.end", keys[place < 0].astype("<u8").tobytes())
                write_file(f"{url}.end_count", np.minimum(counts[place < 0], (1 << 32) - 1)
                           .astype("<u4").tobytes())
            pairs = unmixed(keys)
            left, right = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
            rows = [(-1 - b, 0, np.arange(5, dtype=np.uint64),
                     np.array([(counts == k).sum() for k in (1, 2, 3, 4)] + [len(keys)]))]
            for kind, words in ((1, left[single]), (2, left[counts == 2]),
                                (3, left[counts > 2]), (4, right),
                                *([(5, left)] if order > 2 else [])):
                ids, n = np.unique(words, return_counts=True)
                block = (ids // np.uint64(BLOCK)).astype(np.int64)
                if kind == 5:
                    n = np.add.reduceat(counts[np.argsort(left, kind="stable")],
                                        np.concatenate([[0], np.cumsum(n)[:-1]])) \
                        if len(n) else n
                edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])) \
                    if len(ids) else np.zeros(1, np.int64)
                rows += [(int(block[x]), kind, ids[x:y] % np.uint64(BLOCK), n[x:y])
                         for x, y in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2].astype("<u2").tobytes() for r in rows], pa.binary()),
                 pa.array([r[3].astype("<i8" if r[0] < 0 else "<u4").tobytes() for r in rows],
                          pa.binary())], names=["block", "kind", "ids", "counts"])

    triples = {} if order == 2 else _count_triples(texts, vocabulary, folder, buckets)
    counted = (texts.mapInArrow(count, _PARTS) if order == 2
               else _pairs_of_triples(spark, folder, buckets, set(triples)))
    passed = stored(counted.repartition(buckets, "bucket")
                    .mapInArrow(add, "block int, kind int, ids binary, counts binary"), "pairs")
    sums, pair_files = np.zeros(5, np.int64), set()
    for r in passed.where("block < 0").select("block", "counts").collect():
        sums += np.frombuffer(r["counts"], "<i8")
        pair_files.add(-1 - r["block"])
    pair_discounts = _discounts(sums[:4].tolist())
    blocks = -(-(start + 1) // BLOCK)

    def blocked(iterator) -> Iterator[pa.RecordBatch]:
        """Write each block's back-off weights and continuation counts; pass on sums."""
        found: dict[int, np.ndarray] = {}
        for batch in iterator:
            for b, kind, ids, counts in zip(*(c.to_pylist() for c in batch.columns)):
                table = found.setdefault(b, np.zeros((5, BLOCK), np.int64))
                table[kind - 1, np.frombuffer(ids, "<u2")] += np.frombuffer(counts, "<u4")
        for b, table in found.items():
            taken = sum(d * table[i] for i, d in enumerate(pair_discounts))
            url = f"{folder}/block-{b:06d}"
            total = _word_counts(b) if order == 2 else table[4]
            if order > 2:
                write_file(f"{url}.total", total.astype("<i8").tobytes())
            write_file(f"{url}.backoff", np.where(total > 0, taken / np.maximum(total, 1), 1.0)
                       .astype("<f4").tobytes())
            write_file(f"{url}.before", table[3].astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([int((table[3] == k).sum()) for _ in (0,)], pa.int64())
                 for k in (1, 2, 3, 4)] + [pa.array([int((table[3] > 2).sum())], pa.int64())],
                names=["n1", "n2", "n3", "n4", "n3plus"])

    def _word_counts(block: int) -> np.ndarray:
        """How often each word of the block stands before another."""
        first = np.concatenate([[0], np.cumsum(vocabulary.sizes)])
        out = np.zeros(BLOCK, np.int64)
        low, high = block * BLOCK, (block + 1) * BLOCK
        for f in range(len(vocabulary.sizes)):
            x, y = max(low, first[f]), min(high, first[f + 1])
            if y > x:
                counts = mapped(f"{folder}/words-{f:06d}.count", "<i8")
                out[x - low:y - low] = counts[x - first[f]:y - first[f]]
        if low <= start < high:
            out[start - low] = learned
        return out

    done = stored(passed.where("block >= 0").repartition(min(blocks, buckets), "block")
                  .mapInArrow(blocked, "n1 long, n2 long, n3 long, n4 long, n3plus long"),
                  "blocks")
    n1, n2, n3, n4, more = (x or 0 for x in done.agg(
        *[F.sum(c) for c in ("n1", "n2", "n3", "n4", "n3plus")]).first())
    word_discounts = _discounts([n1, n2, n3, n4])
    types = int(sums[4])
    left = (word_discounts[0] * n1 + word_discounts[1] * n2 + word_discounts[2] * more) / types \
        if types else 1.0
    _fill(folder, blocks, {r["block"] for r in passed.select("block").distinct().collect()},
          order)
    seen = sum(triples.values(), np.zeros(4, np.int64))
    return NgramModel(folder, vocabulary, buckets, frozenset(pair_files), frozenset(triples),
                      pair_discounts, word_discounts, types, left, order,
                      _discounts(seen.tolist())), learned


def _fill(folder: str, blocks: int, written: set[int], order: int) -> None:
    """Files of blocks without words, of which there is at most one."""
    for b in set(range(blocks)) - written:
        if order > 2:
            write_file(f"{folder}/block-{b:06d}.total", np.zeros(BLOCK, "<i8").tobytes())
        write_file(f"{folder}/block-{b:06d}.backoff", np.ones(BLOCK, "<f4").tobytes())
        write_file(f"{folder}/block-{b:06d}.before", np.zeros(BLOCK, "<i8").tobytes())


_SCORE = T.StructType([T.StructField("n_tokens", T.LongType()),
                       T.StructField("n_known", T.LongType()),
                       T.StructField("base_score", T.DoubleType()),
                       T.StructField("score", T.DoubleType())])


def score_texts(docs: DataFrame, model: NgramModel, learned: int, text: str = "text"
                ) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score, score and perplexity."""
    small_batches(docs.sparkSession)
    total, types = model.vocabulary.tokens, model.vocabulary.size

    def run(texts: pa.Array) -> pa.Array:
        hashes = [word_hashes().of(text_words(x)) for x in texts.to_pylist()]
        counts = [len(h) for h in hashes]
        if not counts:
            return pa.array([], pa.struct([(f.name, pa.int64() if i < 2 else pa.float64())
                                           for i, f in enumerate(_SCORE.fields)]))
        ids, n = model.vocabulary.lookup(np.concatenate(hashes))
        first = np.cumsum([0, *counts[:-1]])
        # Without any training token the base has one unseen word to give everything to.
        base = np.log10((n + 0.1) / (total + 0.1 * (types + 1)))
        score = model.log10_probabilities(ids, n, counts, learned)
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()),
             pa.array(np.add.reduceat((n > 0).astype(np.int64), first), pa.int64()),
             pa.array(np.add.reduceat(base, first), pa.float64()),
             pa.array(np.add.reduceat(score, first), pa.float64())],
            names=[f.name for f in _SCORE.fields])

    names = [f.name for f in _SCORE.fields]
    scored = docs.withColumn("_lm", F.arrow_udf(run, _SCORE)(F.col(text).cast("binary")))
    taken = {*names, "train_tokens", "perplexity", "_lm"}
    return scored.select(*[col(c) for c in docs.columns if c.lower() not in taken],
                         *[F.col(f"_lm.{n}").alias(n) for n in names],
                         F.lit(total).cast("long").alias("train_tokens"),
                         F.pow(F.lit(10.0), -F.col("_lm.score") / F.col("_lm.n_tokens"))
                         .alias("perplexity"))


def language_model(docs: DataFrame, training: Column, text: str = "text", order: int = 2
                   ) -> DataFrame:
    """Learn from the rows where ``training`` holds, score all."""
    model, learned = fit_bigrams(docs.where(training).select(F.col(text).cast("binary")
                                                             .alias("text")), order)
    return score_texts(docs, model, learned, text)
