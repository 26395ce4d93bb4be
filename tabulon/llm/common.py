"""Words, hashes and small samples shared by the text operators.

Word rules work on UTF-8 bytes: ``bytes.lower`` changes A-Z only, and ``bytes.split()`` cuts at
exactly 0x20 and 0x09-0x0D, so both follow the byte rules stated by the operators.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.shared_files import opened

WHITE = b" \t\n\x0b\x0c\r"
#: A word hash cache of a worker is emptied beyond this many words.
CACHE_WORDS = 250_000
#: Rows of text in one Arrow batch. Texts are long; a batch is held whole on both sides.
BATCH_ROWS = 1000

_P = np.uint64(0x9E3779B97F4A7C15)


def worker_state(name: str, make):
    """An object that lives as long as the Python worker process, shared by its tasks."""
    state = sys.modules.setdefault("tabulon_worker_state",
                                   types.ModuleType("tabulon_worker_state")).__dict__
    if name not in state:
        state[name] = make()
    return state[name]


class WordHashes(dict):
    """Word bytes -> 64-bit hash, computed once for each word while it is kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes() -> WordHashes:
    return worker_state("words", WordHashes)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit hash over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words, in order."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for k in range(1, size):
        out *= _P
        out += h[k:k + n]
    return mixed(out)


def shingle_set(h: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word runs; fewer words are one run; none is empty."""
    if not len(h):
        return np.empty(0, np.uint64)
    runs = np.sort(windows(h, min(size, len(h))))
    return runs[np.append(True, runs[1:] != runs[:-1])]


def crc_mod(column: str | Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null stays null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(c.cast("string").cast("binary")) % modulus


def small_batches(spark: SparkSession) -> None:
    """Let the session send at most ``BATCH_ROWS`` rows at a time to Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark removes the shuffle files of every query as it ends.

    For operators of several steps that write each step's result: their shuffles would
    otherwise stay until the driver happens to collect its garbage. What is iterated over within
    must be a written table, as an iteration goes on after its query has ended.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def drop_stored(table: DataFrame) -> None:
    """Remove the files of a table that ``stored`` has written and nothing reads any more."""
    folders = {f.rpartition("/")[0] for f in table.inputFiles()}
    for folder in folders:
        store, path = opened(folder)
        store.delete_dir(path)


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: list[str], per_class: int,
                    id_column: str = "doc_id", label_column: str = "quality",
                    usable: Column | None = None) -> DataFrame:
    """At most ``per_class`` documents of each label 0 and 1, with ``columns`` and ``label``.

    Those with the smallest crc32 of their id are taken, so the sample is the same on every run.
    A document labelled more than once counts as 0 if any of its labels is 0; null labels and
    ids are left out. The labels taken are at most ``2 * per_class`` rows and are broadcast.
    """
    known = (labels.select(F.col(id_column).alias("_id"),
                           F.col(label_column).cast("int").alias("label"))
             .where("_id is not null and label in (0, 1)")
             .groupBy("_id").agg(F.min("label").alias("label")))
    if usable is not None:
        known = known.where(usable)
    order = [crc_mod("_id", 1 << 32), F.col("_id")]
    taken = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(*order).limit(per_class)
        taken = part if taken is None else taken.unionByName(part)
    return (docs.select(F.col(id_column).alias("_id"), *columns)
            .join(F.broadcast(taken), "_id")
            .dropDuplicates(["_id"]))


def batches(iterator) -> Iterator[dict[str, list]]:
    """Arrow record batches as dictionaries of Python lists."""
    for batch in iterator:
        yield {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
