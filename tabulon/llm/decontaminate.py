"""Benchmark passages in documents, found by a prefix-filtered containment join.

A benchmark item's windows are its runs of ``window`` words (an item of fewer words is one
window). A document holds a window if the same words follow each other in it.

1. The shingles (runs of three words, fewer in shorter windows) of all windows set the bits of
   one filter of fixed size. A pass over the documents keeps the segments of text whose shingles
   all pass it: every occurrence of a window lies inside one segment. The length filter drops
   segments shorter than the shortest window.
2. The shingles inside the segments are counted; the rarest one of each window is its prefix.
   Containment asks for every shingle, so one necessary shingle is a sufficient prefix.
3. Segment shingles are joined with the prefixes. The positional filter keeps those where the
   window fits into the segment around the shingle, and the words are then compared one by one.
4. Hit positions are the union of the occurrences, taken per document.

Nothing depends on the filter's false positives: they only lengthen segments.

Defined results: null and empty texts have no words and no hits; items without words have no
windows; repeated items are hit together, and a null item id is never counted as an item.
Repeated documents get a row each. Columns of the input that have the name of an added one are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.expr import col
from tabulon.llm.common import mixed, small_batches, windows, word_hashes
from tabulon.session import BROADCAST_ROWS, stored

#: Words of a shingle.
SHINGLE = 3
#: Bits of the filter: 2**26 bits are 8 MB, however many items there are.
FILTER_BITS = 26

#: Fixed rule: words are runs of 0-9, a-z after lower-casing A-Z, and all bytes from 0x80.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
               else 32 for c in range(256))


def words_of(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(_WORDS).split()


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two filter bits for each hash."""
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return (h & mask).astype(np.int64), (mixed(h) & mask).astype(np.int64)


def item_windows(items: DataFrame, window: int, item: str, text: str) -> DataFrame:
    """Stored table (item, words, size) with a row per item and distinct window."""
    def cut(iterator) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            ids, out = [], []
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words_of(data)
                size = min(window, len(w))
                runs = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if w else ()
                ids += [i] * len(runs)
                out += runs
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()),
                 pa.array([[x.decode("utf-8", "replace") for x in r] for r in out],
                          pa.list_(pa.string()))], names=["item", "words"])

    cast = items.select(F.col(item).cast("string").alias("i"), F.col(text).cast("binary"))
    return stored(cast.mapInArrow(cut, "item string, words array<string>")
                  .withColumn("size", F.size("words")), "windows")


def _shingle_filter(windows_table: DataFrame) -> dict[int, bytes]:
    """Filter bits by shingle size. Tasks add up bits; the driver gets words of the filter."""
    def bits(iterator) -> Iterator[pa.RecordBatch]:
        found: dict[int, set[int]] = {}
        for batch in iterator:
            for w in batch.column(0).to_pylist():
                size = min(SHINGLE, len(w))
                h = word_hashes().of([x.encode() for x in w])
                for p in _places(windows(h, size)):
                    found.setdefault(size, set()).update(p.tolist())
        rows = [(s, p >> 6, 1 << (p & 63)) for s, ps in found.items() for p in ps]
        masks: dict[tuple[int, int], int] = {}
        for s, k, b in rows:
            masks[s, k] = masks.get((s, k), 0) | b
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in masks], pa.int32()),
             pa.array([k for _, k in masks], pa.int32()),
             pa.array(np.array(list(masks.values()), np.uint64).view(np.int64), pa.int64())],
            names=["size", "slot", "mask"])

    out: dict[int, np.ndarray] = {}
    rows = (windows_table.select("words").distinct()
            .mapInArrow(bits, "size int, slot int, mask long")
            .groupBy("size", "slot").agg(F.bit_or("mask").alias("mask")))
    for r in rows.toLocalIterator():
        words = out.setdefault(r["size"], np.zeros(1 << (FILTER_BITS - 6), np.int64))
        words[r["slot"]] = r["mask"]
    return {s: w.tobytes() for s, w in out.items()}


_SEGMENTS = "struct<n_words: bigint, segments: array<struct<size: int, at: int, words: array<string>>>>"


def segments(docs: DataFrame, text: str, filters: dict[int, bytes], shortest: dict[int, int]
             ) -> DataFrame:
    """``docs`` with a column ``_s`` of the word count and the segments that may hold windows.

    ``shortest`` gives, for each shingle size, the fewest words of a window with such shingles.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)   # at most 3 filters

    def find(texts: pa.Array) -> pa.Array:
        maps = {s: np.frombuffer(f, np.uint64) for s, f in shared.value.items()}
        known = word_hashes()
        counts, found = [], []
        for data in texts.to_pylist():
            words = words_of(data)
            counts.append(len(words))
            out = []
            h = known.of(words)
            for size, bits in maps.items():
                if len(words) < size:
                    continue
                good = np.ones(len(words) - size + 1, bool)
                for p in _places(windows(h, size)):
                    good &= (bits[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) != 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], good.view(np.int8), [0]])))
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    if b - a + size - 1 >= shortest[size]:
                        out.append({"size": size, "at": a, "words": [
                            x.decode("utf-8", "replace") for x in words[a:b + size - 1]]})
            found.append(out)
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()),
             pa.array(found, pa.list_(pa.struct([("size", pa.int32()), ("at", pa.int32()),
                                                 ("words", pa.list_(pa.string()))])))],
            names=["n_words", "segments"])

    return docs.withColumn("_s", F.arrow_udf(find, _SEGMENTS)(F.col(text).cast("binary")))


def _shingles(words: str, size: str) -> str:
    """SQL: hashes of all runs of ``size`` words of an array column, in order."""
    return (f"transform(sequence(1, size({words}) - {size} + 1), "
            f"i -> xxhash64(slice({words}, i, {size})))")


def occurrences(found: DataFrame, windows_table: DataFrame) -> DataFrame:
    """(row, at, size, words) of every window in every stored segment (row, size, at, words)."""
    inside = stored(found.select("_row", "size", "at", "words",
                                 F.posexplode(F.expr(_shingles("words", "size")))
                                 .alias("i", "shingle")), "shingles")
    counted = inside.groupBy("shingle").agg(F.count("*").alias("n"))
    distinct = windows_table.select("words", F.col("size").alias("length"),
                                    F.least("size", F.lit(SHINGLE)).alias("size")).distinct()
    each = distinct.select("*", F.posexplode(F.expr(_shingles("words", "size")))
                           .alias("offset", "shingle"))
    # A window with a shingle that no segment has cannot occur: the inner join drops it only if
    # its rarest shingle is missing, so missing counts as the rarest.
    rarest = (each.join(counted, "shingle", "left")
              .groupBy("words", "length", "size")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset"))
                   .alias("r"))
              .where("r.n > 0")
              .select(F.col("words").alias("window"), "length",
                      F.col("size").alias("w_size"), "r.shingle", "r.offset"))
    # ``i - offset`` is the window's place in the segment.
    return (inside.join(rarest, "shingle")
            .where("size = w_size and i >= offset and i - offset + length <= size(words) "
                   "and slice(words, i - offset + 1, length) = window")
            .select("_row", (F.col("at") + F.col("i") - F.col("offset")).alias("at"),
                    F.col("length"), "window")
            .distinct())


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text",
                  item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items (sorted ids), items_sha256, contaminated."""
    small_batches(docs.sparkSession)
    table = item_windows(items, window, item, item_text)
    shortest = {r["k"]: r["m"] for r in table.groupBy(
        F.least("size", F.lit(SHINGLE)).alias("k")).agg(F.min("size").alias("m")).collect()}
    names = ["n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated"]
    keep = [c for c in docs.columns if c.lower() not in {*names, "_row", "_s"}]
    # The text stays where it is: rows are told apart by a number given before the first write,
    # and only what the later steps need is stored.
    carried = [c for c in keep if c.lower() != text.lower()]
    marked = segments(docs.select(*[col(c) for c in keep]), text, _shingle_filter(table), shortest)
    base = stored(marked.withColumn("_row", F.monotonically_increasing_id())
                  .select("_row", *[col(c) for c in carried], "_s"), "segments")
    found = (base.select("_row", F.explode("_s.segments").alias("_g"))
             .select("_row", "_g.size", "_g.at", "_g.words"))
    hits = stored(occurrences(found, table), "hits")
    return base.withColumn("n_words", F.col("_s.n_words")).drop("_s").join(
        hit_counts(hits, table), "_row", "left").select(
        *[col(c) for c in carried], "n_words",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_hit", "n_items")],
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256)
        .alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def hit_counts(hits: DataFrame, table: DataFrame) -> DataFrame:
    """Per document row: words inside any occurrence, and the items whose windows occur."""
    spans = hits.groupBy("_row", "at").agg(F.max("length").alias("length"))
    earlier = Window.partitionBy("_row").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1)
    ends = F.max(F.col("at") + F.col("length")).over(earlier)
    covered = (spans.withColumn("before", F.coalesce(ends, F.lit(0)))
               .withColumn("new", F.greatest(F.lit(0), F.col("at") + F.col("length")
                                             - F.greatest("at", "before")))
               .groupBy("_row").agg(F.sum("new").alias("n_hit")))
    named = (hits.select("_row", "window").distinct()
             .join(table.where("item is not null")
                   .select("item", F.col("words").alias("window")).distinct(), "window")
             .select("_row", "item").distinct()
             .groupBy("_row").agg(F.sort_array(F.collect_list("item")).alias("items")))
    return covered.join(named, "_row", "left").withColumn(
        "n_items", F.coalesce(F.size("items"), F.lit(0)))



def clean_documents(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text",
                    id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that hold no window, with all their columns."""
    whole = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("_document"),
                        col(id_column).alias("_id"), col(text).alias("text"),
                        F.xxhash64(col(text)).alias("_h"))
    hit = stored(contamination(whole.drop("_document"), items, window).where("contaminated")
                 .select(F.col("_id").alias("_i"), F.col("_h").alias("_g")).distinct(), "hit")
    if hit.count() <= BROADCAST_ROWS:
        hit = F.broadcast(hit)
    return (whole.drop("text").join(hit, F.expr("_id <=> _i and _h = _g"), "left_anti")
            .select("_document.*"))
