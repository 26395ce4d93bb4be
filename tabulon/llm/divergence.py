"""How the sources of a language differ in their words, from stripes folded inside the tasks.

1. Every task folds its whole documents into a hash map: language and term to a stripe, the
   number of documents and the occurrences in each source. A map that has grown to
   ``STRIPES`` is spilled: its stripes are handed to the shuffle, and the fold goes on with an
   empty map.
2. The shuffle sorts stripes by language and term. Terms in too few documents fall out by a
   running sum, the stripes of each other term are merged as they stream by.
3. Every merged stripe holds all that its term adds to the divergences. Tasks add up, for all
   pairs of sources, the differences of their shares, and name the terms that a source has more
   of than its language.

Shares are whole numbers of billionths, floored, so all sums are exact: 64-bit numbers where they
are large enough for every product, Python's unbounded ones beyond.

Sources are dealt in blocks of ``SOURCES``, so a task holds a square of at most that many sums at
a time; a language with more sources takes one pass over the merged stripes for each pair of
blocks. The driver holds a row for each language and block, and the totals of one pass's blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.expr import col
from tabulon.llm.common import batches, drop_stored, shuffles_removed, small_batches
from tabulon.session import stored

#: Entries, of terms and of sources of a term, that a task holds before it spills them.
STRIPES = 600_000
#: Stripes in one Arrow batch.
_OUT_ROWS = 20_000
#: Sources whose pairs are added up in one pass.
SOURCES = 1000
#: Cells of the table of shares that a task makes at a time.
_CELLS = 1 << 20
#: The share is 1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)).
SCALE, PRIOR = 1_000_000_000, 5

# A-Z to lower case; every other byte below 0x80 but a-z separates terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))

_STRIPE = "lang string, term string, docs long, sources array<string>, counts array<long>"


def terms_of(data: bytes) -> list[bytes]:
    """Runs of ASCII letters and of characters beyond ASCII, A-Z lower-cased."""
    return data.translate(_FOLD).split()


def _record(langs: pa.Array, terms: pa.Array, docs: np.ndarray, offsets: np.ndarray,
            sources: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(offsets.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [langs, terms, pa.array(docs), pa.ListArray.from_arrays(offsets, sources),
         pa.ListArray.from_arrays(offsets, pa.array(counts))],
        names=["lang", "term", "docs", "sources", "counts"])


def _longs(values, n: int) -> np.ndarray:
    return np.fromiter(values, np.int64, n)


class _Stripes:
    """The hash map of one task: per language, documents of a term and counts by source."""

    def __init__(self) -> None:
        self.docs: dict[str, Counter] = {}
        self.counts: dict[tuple[str, str], Counter] = {}
        self.held = 0

    def fold(self, lang: str, source: str, text: bytes) -> None:
        """Add a whole document."""
        docs = self.docs.setdefault(lang, Counter())
        counts = self.counts.setdefault((lang, source), Counter())
        before = len(docs) + len(counts)
        terms = terms_of(text)
        counts.update(terms)
        docs.update(set(terms))
        self.held += len(docs) + len(counts) - before

    def spill(self) -> Iterator[pa.RecordBatch]:
        """All stripes, a row per language and term, and an empty map."""
        for lang, docs in self.docs.items():
            own = [(s, c) for (one, s), c in self.counts.items() if one == lang and c]
            if not own:
                continue
            at = dict(zip(docs, range(len(docs))))
            term = np.concatenate([_longs(map(at.__getitem__, c), len(c)) for _, c in own])
            count = np.concatenate([_longs(c.values(), len(c)) for _, c in own])
            source = np.repeat(np.arange(len(own)), [len(c) for _, c in own])
            order = np.argsort(term, kind="stable")
            count, source = count[order], source[order]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(docs)))])
            names = pa.array([s for s, _ in own], pa.string())
            terms = pa.array(list(docs), pa.binary()).cast(pa.string())
            totals = _longs(docs.values(), len(docs))
            for a in range(0, len(docs), _OUT_ROWS):
                ends = offsets[a:a + _OUT_ROWS + 1]
                cut = slice(ends[0], ends[-1])
                rows = len(ends) - 1
                yield _record(pa.repeat(pa.scalar(lang, pa.string()), rows),
                              terms.slice(a, rows), totals[a:a + rows], ends - ends[0],
                              names.take(pa.array(source[cut])), count[cut])
        self.__init__()


def _fold(iterator) -> Iterator[pa.RecordBatch]:
    """Whole documents (lang, source, text) to stripes, spilled whenever the map is full."""
    stripes = _Stripes()
    for batch in batches(iterator):
        for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
            stripes.fold(lang, source, text)
            if stripes.held >= STRIPES:
                yield from stripes.spill()
    yield from stripes.spill()


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Neighbouring stripes of one (lang, term) added up."""
    lang, term, docs, sources, counts = (batch.column(n) for n in range(5))
    if not batch.num_rows:
        return batch
    new = np.ones(batch.num_rows, bool)
    new[1:] = pc.or_(pc.not_equal(lang[1:], lang[:-1]),
                     pc.not_equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    names = sources.flatten().dictionary_encode()
    run = np.repeat(np.cumsum(new) - 1, pc.list_value_length(sources).to_numpy())
    cells, at = np.unique(run * len(names.dictionary) + names.indices.to_numpy(),
                          return_inverse=True)
    sums = np.zeros(len(cells), np.int64)
    np.add.at(sums, at, counts.flatten().to_numpy())
    run, source = np.divmod(cells, max(len(names.dictionary), 1))
    offsets = np.searchsorted(run, np.arange(len(first) + 1))
    rows = pa.array(first)
    return _record(lang.take(rows), term.take(rows), np.add.reduceat(docs.to_numpy(), first),
                   offsets, names.dictionary.take(pa.array(source)), sums)


def _merge(iterator) -> Iterator[pa.RecordBatch]:
    """Stripes sorted by (lang, term) to one per term; the last of a batch waits for the next."""
    waiting = None
    for batch in iterator:
        if waiting is not None:
            batch = pa.Table.from_batches([waiting, batch.cast(waiting.schema)])
            batch = batch.combine_chunks().to_batches()[0]
        done = _merged(batch)
        if done.num_rows:
            waiting = done.slice(done.num_rows - 1)
            if done.num_rows > 1:
                yield done.slice(0, done.num_rows - 1)
    if waiting is not None:
        yield waiting


def _plain(docs: DataFrame, lang: str, source: str) -> list:
    return [F.coalesce(col(c).cast("string"), F.lit("")).alias(n)
            for c, n in ((lang, "lang"), (source, "source"))]


def stripes(docs: DataFrame, min_docs: int = 30, text: str = "text", lang: str = "lang",
            source: str = "source") -> DataFrame:
    """(lang, term, docs, sources, counts) of every term in at least ``min_docs`` documents of
    its language: the documents that have it, and its occurrences in each source."""
    small_batches(docs.sparkSession)
    folded = docs.select(
        *_plain(docs, lang, source),
        F.coalesce(col(text).cast("binary"), F.lit(b"")).alias("text")).mapInArrow(_fold, _STRIPE)
    same = Window.partitionBy("lang", "term")
    return (folded.withColumn("all_docs", F.sum("docs").over(same))
            .where(F.col("all_docs") >= min_docs).drop("all_docs")
            .sortWithinPartitions("lang", "term").mapInArrow(_merge, _STRIPE))


def groups_of(docs: DataFrame, merged: DataFrame, lang: str = "lang", source: str = "source"
              ) -> DataFrame:
    """(lang, source, at, n, terms) of every occurring group: its place among the sources of its
    language, its occurrences of kept terms, and the number of kept terms of the language."""
    sums = (merged.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
            .groupBy("lang", F.col("x.sources").alias("source"))
            .agg(F.sum("x.counts").alias("n")))
    kept = merged.groupBy("lang").agg(F.count("*").alias("terms"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return (docs.select(*_plain(docs, lang, source)).distinct()
            .join(sums, ["lang", "source"], "left").join(kept, "lang", "left")
            .select("lang", "source", place.alias("at"), F.coalesce("n", F.lit(0)).alias("n"),
                    F.coalesce("terms", F.lit(0)).alias("terms")))


def shares(counts, totals, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exactly."""
    wholes = np.asarray(totals, np.int64) + PRIOR * terms
    if int(wholes.max(initial=0)) < (1 << 63) // SCALE:     # counts are at most their totals
        return 1 + SCALE * (np.asarray(counts, np.int64) + PRIOR) // wholes
    exact = SCALE * (np.asarray(counts, object) + PRIOR) // wholes.astype(object)
    return 1 + exact.astype(np.int64)


_PART = "lang string, source string, part string, item string, value long"


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], pa.int64() if k == 4 else pa.string()) for k in range(5)],
        names=["lang", "source", "part", "item", "value"])


def _diverge(plan: dict, top: int):
    """Arrow function: merged stripes to the parts of the divergences that they hold.

    ``plan`` is {lang: (terms, total, [sources a], [totals a], [sources b], [totals b], same)}
    for the languages and the two blocks of sources of this pass.
    """
    def diverge(iterator) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        best: dict[tuple[str, str], list] = {}
        for lang, (_, _, a, _, b, _, _) in plan.items():
            sums[lang] = np.zeros((len(a), len(b)), np.int64)

        def add(lang: str, rows: list[tuple]) -> None:
            terms, total, a, totals_a, b, totals_b, same = plan[lang]
            size = max(1, _CELLS // max(len(a), len(b)))
            for at in range(0, len(rows), size):
                part = rows[at:at + size]
                tables = []
                for names in (a, b):
                    place = {s: i for i, s in enumerate(names)}
                    table = np.zeros((len(part), len(names)), np.int64)
                    for i, (_, sources, counts) in enumerate(part):
                        for s, n in zip(sources, counts):
                            if s in place:
                                table[i, place[s]] = n
                    tables.append(table)
                p = shares(tables[0], totals_a, terms)
                q = p if same else shares(tables[1], totals_b, terms)
                for i in range(len(a)):
                    sums[lang][i] += np.abs(q - p[:, i:i + 1]).sum(0)
                if same:
                    whole = [sum(counts) for _, _, counts in part]
                    more = p - shares(whole, [total], terms)[:, None]
                    for i, k in np.argwhere((tables[0] > 0) & (more > 0)).tolist():
                        best.setdefault((lang, a[k]), []).append((-int(more[i, k]), part[i][0]))
            for key, found in best.items():
                if len(found) > 20 * top:
                    best[key] = sorted(found)[:top]

        for batch in batches(iterator):
            waiting: dict[str, list] = {}
            for lang, term, sources, counts in zip(batch["lang"], batch["term"],
                                                   batch["sources"], batch["counts"]):
                waiting.setdefault(lang, []).append((term.encode(), sources, counts))
            for lang, rows in waiting.items():
                add(lang, rows)
        for lang, (_, _, a, _, b, _, same) in plan.items():
            for i, one in enumerate(a):
                cells = [(other, int(v)) for other, v in zip(b, sums[lang][i]) if v]
                rows = [(lang, one, "pair", other, v) for other, v in cells if other != one]
                if not same:
                    rows += [(lang, other, "pair", one, v) for other, v in cells]
                if rows:
                    yield _emit(rows)
        for (lang, source), found in best.items():
            yield _emit([(lang, source, "term", term.decode(), -v)
                         for v, term in sorted(found)[:top]])

    return diverge


def _passes(groups: DataFrame) -> Iterator[dict]:
    """Plans of ``_diverge`` that hold every pair of blocks of every language once."""
    blocks = groups.groupBy("lang", F.floor(F.col("at") / SOURCES).alias("block"))
    sizes = blocks.agg(F.count("*").alias("size")).where("size > 0").collect()  # a row a block
    by_lang: dict[str, list[tuple[int, int]]] = {}
    for r in sizes:
        by_lang.setdefault(r.lang, []).append((r.block, r["size"]))
    todo = [(lang, x, y) for lang, all_blocks in by_lang.items()
            for x, y in combinations_with_replacement(sorted(all_blocks), 2)]
    totals = {r.lang: (r.terms, r.total) for r in
              groups.groupBy("lang").agg(F.max("terms").alias("terms"),
                                         F.sum("n").alias("total")).collect()}
    while todo:
        taken, cells, names, rest = [], 0, 0, []
        for lang, x, y in todo:        # small languages share a pass
            if taken and (cells + x[1] * y[1] > SOURCES ** 2 or names + x[1] > SOURCES
                          or taken[-1][0] == lang):
                rest.append((lang, x, y))
            else:
                taken.append((lang, x, y))
                cells, names = cells + x[1] * y[1], names + x[1]
        todo = rest
        wanted = {(lang, z[0]) for lang, x, y in taken for z in (x, y)}
        rows = groups.where(F.concat_ws(
            " ", F.floor(F.col("at") / SOURCES), "lang").isin(
                [f"{block} {lang}" for lang, block in wanted])).collect()
        found: dict[tuple[str, int], list] = {}
        for r in sorted(rows, key=lambda r: r.at):
            found.setdefault((r.lang, r.at // SOURCES), []).append((r.source, r.n))
        plan = {}
        for lang, x, y in taken:
            a, b = found[lang, x[0]], found[lang, y[0]]
            plan[lang] = (*totals[lang], [s for s, _ in a], [n for _, n in a],
                          [s for s, _ in b], [n for _, n in b], x[0] == y[0])
        yield plan


def source_divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, text: str = "text",
                      lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) for every group of a language and a source.

    Part ``pair``: ``item`` is another source of the language, ``value`` the sum over the kept
    terms of the differences of both groups' shares. Part ``term``: ``item`` is a kept term that
    the group has and has more of than its language, ``value`` the difference of the shares, the
    ``top`` largest. Ranks count from 1 by value, largest first, then item in UTF-8 order.

    Null text, lang and source read as ''. A group without terms has its ``pair`` rows, of value
    0 where the language keeps no term; the only source of a language has none. Repeated rows are
    documents of their own. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    with shuffles_removed(spark):
        merged = stored(stripes(docs, min_docs, text, lang, source), "stripes")
        groups = stored(groups_of(docs, merged, lang, source), "groups")
        zero = (groups.select("lang", "source")
                .join(groups.select(F.col("lang").alias("l"), F.col("source").alias("item")),
                      F.expr("lang = l and source <> item"))
                .select("lang", "source", F.lit("pair").alias("part"), "item",
                        F.lit(0).cast("long").alias("value")))
        parts = zero
        for plan in _passes(groups):
            some = merged.where(F.col("lang").isin(list(plan))).select(
                "lang", "term", "sources", "counts")
            parts = parts.unionByName(some.mapInArrow(_diverge(plan, top), _PART))
        sums = stored(parts.groupBy("lang", "source", "part", "item")
                      .agg(F.sum("value").alias("value")), "divergences")
        drop_stored(merged)
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (sums.withColumn("rank", F.row_number().over(order))
            .where((F.col("part") == "pair") | (F.col("rank") <= top)))
