"""Near copies by an exact Jaccard join on word n-grams, their links and their groups.

A text's set are the hashes of its distinct runs of five words. Sets in one order, rare n-grams
first, can only be similar enough if they share one of their first few n-grams, so only those
prefixes are joined.

1. A sketch of fixed size counts all n-grams of all texts; its counts order them, rare first.
2. Each text gives its set's hash, size, a bitmap of 1024 bits and its prefix. Equal sets are
   one class. Prefix n-grams that only one class has are dropped.
3. Where a prefix n-gram is in many classes, they are compared with one of them, and every large
   component that comes out gets a consensus: the n-grams of more than half of its classes. The
   class nearest to it is compared with others that share a prefix n-gram with the component, and
   the consensus is taken once more, of all that are in the component then. Two
   classes that share h and k n-grams with a consensus of m have h + k - m in common, and one
   more for every difference from the consensus that both have. Pairs that link without those
   are counted from sorted sums and are never listed. Of the others only pairs with as many
   differences in common as they lack can link; they are found by joining the differences.
4. All other classes that share a prefix n-gram are compared. Candidates pass the length filter,
   the positional filter and the suffix filter (bits of one map missing in the other bound the
   overlap) and are verified once, on their whole sets. So every link of two different sets is
   listed or counted; equal sets link by their class.

Where only the groups are asked for, steps take the place of the last two that leave most pairs
of a group out:

3. Rounds of stars: in every list of classes sharing a prefix n-gram, all are compared with a
   hub; in later rounds a member of each component found so far with one of the largest.
   Candidates pass the length filter and the suffix filter and are verified.
4. Last, all classes of different components that share a prefix n-gram are compared, with the
   positional filter on top, so no link that could join two components is missed. A pair is
   verified once: pairs tried before are left out.

Links inside a component already joined are then not verified; the groups do not depend on them.

Hashes have 64 bits: two different n-grams of a text, or two different sets, count as one with
a probability of 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import col
from tabulon.llm.common import (
    batches,
    drop_stored,
    mixed,
    shingle_set,
    shuffles_removed,
    small_batches,
    windows,
)
from tabulon.llm.components import components
from tabulon.session import BROADCAST_ROWS, stored

#: Slots of the counting sketch: 2**23 counts, one byte each when broadcast.
SLOT_BITS = 23
_CHUNK = 1 << 13
#: N-grams that a task of the sketch sorts before it adds them to its counts, about.
_SORTED = 1 << 20
_MASK = (1 << 64) - 1
#: 64-bit words of the bitmap.
MAP_WORDS = 16
#: Prefix n-grams counted this many times above the mean of all slots are joined with the
#: adaptive skew handling; the others cannot make a task large.
HOT = 10_000
#: Ranges of the prefix n-grams that are joined one after the other, and of pairs that are
#: verified so when they are more than ``RANGE_PAIRS``.
RANGES = 4
RANGE_PAIRS = 10_000
#: Texts that share a prefix n-gram, and classes of a component, from which on a consensus is
#: worth its cost. The links are the same whatever the number.
LARGE = 64
#: Star rounds before the last, exhaustive one.
STAR_ROUNDS = 3


def _words(data: bytes | None) -> np.ndarray:
    """Hashes of the words, each computed: most words of a corpus are too rare to be remembered."""
    digests = b"".join(map(xxhash.xxh3_64_digest, (data or b"").lower().split()))
    return np.frombuffer(digests, ">u8").astype(np.uint64)


def text_set(data: bytes | None, size: int) -> np.ndarray:
    """The sorted n-gram hashes of a UTF-8 text, A-Z lower-cased."""
    return shingle_set(_words(data), size)


def text_runs(data: bytes | None, size: int) -> np.ndarray:
    """The same in order and with repeats."""
    h = _words(data)
    return windows(h, min(size, max(len(h), 1)))


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and how often each is there."""
    values = np.sort(values)
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1])[:len(values)])
    return values[at], np.diff(np.append(at, len(values)))


def count_sketch(texts: DataFrame, size: int) -> bytes:
    """The order of the slots of all n-grams, a byte each: the number of bits of the slot's
    count, 128 more for a hot one. ``texts`` has the column ``text`` of bytes.

    Every task adds up its texts, then chunks of slots are added up, streaming, and turned into
    bytes. The driver gets the 2**23 bytes, chunk by chunk.
    """
    def count(iterator) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.uint32)
        waiting: list[np.ndarray] = []
        n = 0

        def add_waiting() -> None:
            slots, times = _counted(np.concatenate(waiting or [np.empty(0, np.int32)]))
            # Hot however often more.
            counts[slots] = np.minimum(counts[slots] + times.astype(np.int64), 1 << 31)

        for batch in batches(iterator):
            for data in batch["text"]:
                waiting.append(_slot(text_runs(data, size)).astype(np.int32))
                n += len(waiting[-1])
                if n >= _SORTED:
                    add_waiting()
                    waiting, n = [], 0
        add_waiting()
        chunks = [(k // _CHUNK, counts[k:k + _CHUNK]) for k in range(0, len(counts), _CHUNK)]
        # The narrowest type that holds a chunk: most are counts of a few.
        chunks = [(k, c.astype(np.min_scalar_type(c.max())).tobytes())
                  for k, c in chunks if c.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in chunks], pa.int32()),
                                          pa.array([c for _, c in chunks], pa.binary())],
                                         names=["chunk", "counts"])

    def add(iterator) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches(iterator):
            for k, data in zip(batch["chunk"], batch["counts"]):
                part = np.frombuffer(data, f"<u{len(data) // _CHUNK}")
                sums[k] = sums.get(k, 0) + part.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([c.tobytes() for c in sums.values()], pa.binary()),
             pa.array([int(c.sum()) for c in sums.values()], pa.int64())],
            names=["chunk", "counts", "total"])

    schema = "chunk int, counts binary"
    sums = stored(texts.mapInArrow(count, schema).repartition("chunk").mapInArrow(
        add, schema + ", total long"), "sketch")
    limit = (sums.agg(F.sum("total")).first()[0] or 0) // (1 << SLOT_BITS) + HOT

    def rank(iterator) -> Iterator[pa.RecordBatch]:
        for batch in batches(iterator):
            levels = []
            for data in batch["counts"]:
                counts = np.frombuffer(data, np.int64)
                level = np.ceil(np.log2(counts + 1.0)).astype(np.uint8)
                level[counts > limit] |= 128
                levels.append(level.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(batch["chunk"], pa.int32()),
                                              pa.array(levels, pa.binary())],
                                             names=["chunk", "counts"])

    levels = bytearray(1 << SLOT_BITS)
    for row in sums.select("chunk", "counts").mapInArrow(rank, schema).collect():
        levels[row.chunk * _CHUNK:(row.chunk + 1) * _CHUNK] = row.counts
    drop_stored(sums)
    return bytes(levels)


def _bitmap(tokens: np.ndarray) -> np.ndarray:
    bits = np.zeros(64 * MAP_WORDS, np.uint8)
    bits[(tokens & np.uint64(64 * MAP_WORDS - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def _class(tokens: np.ndarray) -> int | None:
    """Hash of a set, which does not depend on an order; none for the empty set."""
    if not len(tokens):
        return None
    h = 0
    for part in (tokens.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(tokens)), len(tokens)):
        h = _mixed_int(h + int(part))
    return h - (h >> 63 << 64)


def _mixed_int(h: int) -> int:
    """``mixed`` of one number, modulo 2**64."""
    h &= _MASK
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & _MASK
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & _MASK
    return h ^ (h >> 31)


def _whole(size: int):
    """Arrow function: texts to (class, bytes of the sorted hashes)."""
    def whole(texts: pa.Array) -> pa.Array:
        sets = [text_set(x, size) for x in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([_class(s) for s in sets], pa.int64()),
             pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "tokens"])

    return whole


_SIGNATURE = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("cls", T.LongType()),
    T.StructField("bits", T.ArrayType(T.LongType(), False)),
    T.StructField("prefix", T.ArrayType(T.LongType(), False)),
    T.StructField("hot", T.ArrayType(T.LongType(), False))])


def _longs(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64)))


def signatures(spark: SparkSession, docs: DataFrame, size: int, percent: int, text: str,
               keep: list[str]) -> DataFrame:
    """``keep`` and (n, cls, bits, prefix, hot) of every text, stored.

    ``prefix`` holds the first n-grams, rare first, as far as sets similar enough must share
    one; ``hot`` is the part of it that many texts have.
    """
    order = spark.sparkContext.broadcast(                 # 8 MB, whatever the input
        count_sketch(docs.select(F.col(text).cast("binary").alias("text")), size))

    def sign(texts: pa.Array) -> pa.Array:
        level = np.frombuffer(order.value, np.uint8)
        ns, classes, maps, prefixes, hots = [], [], [], [], []
        none = np.empty(0, np.int64)
        for data in texts.to_pylist():
            s = text_set(data, size)
            n = len(s)
            ns.append(n)
            classes.append(_class(s))
            if not n:
                for column in (maps, prefixes, hots):
                    column.append(none)
                continue
            maps.append(_bitmap(s))
            levels = level[_slot(s)]
            order_of = np.argsort(levels, kind="stable")[:n - -(-percent * n // 100) + 1]
            first, is_hot = s[order_of], levels[order_of] >= 128
            prefixes.append(first[~is_hot].view(np.int64))
            hots.append(first[is_hot].view(np.int64))
        return pa.StructArray.from_arrays(
            [pa.array(ns, pa.int64()), pa.array(classes, pa.int64()), _longs(maps),
             _longs(prefixes), _longs(hots)], names=[f.name for f in _SIGNATURE.fields])

    udf = F.arrow_udf(sign, _SIGNATURE)
    signed = docs.select(*keep, udf(F.col(text).cast("binary")).alias("_s")).select(*keep, "_s.*")
    return stored(signed, "signatures")


def _shared(postings: DataFrame) -> DataFrame:
    """Postings (token, at, cls) of tokens that more than one class has; ``low`` is the least,
    and ``many`` says that many texts have the token."""
    # All columns are read, so that both sides of the join come from one shuffle.
    ends = (postings.groupBy("token").agg(F.min("cls").alias("low"), F.max("cls").alias("high"),
                                          F.min("at").alias("first"),
                                          (F.count("*") >= LARGE).alias("many"))
            .where("low < high and first >= 0").select("token", "low", "many"))
    return postings.join(ends.hint("shuffle_hash"), "token").distinct()


#: Classes with a consensus, see ``_compared``.
_GAPS = "cls long, component long, gap long"
#: SQL: both classes of a pair are held against one consensus, which tells whether they link.
_TOGETHER = "coalesce(a_component = b_component, false)"


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _compared(found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(cls, component, odd, gap) of the classes in large components of ``found``, stored.

    Of a consensus of m n-grams let a class of n have h, so that n + m - 2 h n-grams are odd: in
    one of both sets only. Two classes have h1 + h2 - m + s n-grams in common, s being the odd
    ones in common. They link if (100 + percent) (h1 + h2 - m + s) >= percent (n1 + n2), that is
    if their gaps, (100 + percent) (m - 2 h) + 2 percent n each, add up to 2 (100 + percent) s
    or less.
    """
    large = (found.groupBy("component").agg(F.count("*").alias("size"))
             .where(F.col("size") >= LARGE))
    within = stored(found.withColumnRenamed("node", "cls").join(_few(large), "component")
                    .join(sets, "cls"), "within")

    @F.arrow_udf(T.ArrayType(T.LongType(), False))
    def numbers(tokens: pa.Array) -> pa.Array:
        return _longs([np.frombuffer(x, np.int64) for x in tokens.to_pylist()])

    @F.arrow_udf(T.ArrayType(T.LongType(), False))
    def differing(tokens: pa.Array, consensus: pa.Array) -> pa.Array:
        return _longs([np.setxor1d(np.frombuffer(x, np.int64), np.array(y, np.int64), True)
                       for x, y in zip(tokens.to_pylist(), consensus.to_pylist())])

    # A consensus has less than twice as many n-grams as the classes have on the average.
    consensus = stored(
        within.select("component", "size", F.explode(numbers("tokens")).alias("token"))
        .groupBy("component", "token").agg(F.first("size").alias("size"), F.count("*").alias("k"))
        .where("2 * k > size")
        .groupBy("component").agg(F.collect_list("token").alias("consensus")), "consensus")
    compared = stored(
        within.join(_few(consensus), "component")
        .select("cls", "component", (F.length("tokens") / 8).cast("long").alias("n"),
                differing("tokens", "consensus").alias("odd"))
        .select("cls", "component", "odd", F.expr(
            f"{100 + percent} * (size(odd) - n) + {2 * percent} * n").alias("gap")), "compared")
    drop_stored(within)
    drop_stored(consensus)
    return compared


def _odd_links(compared: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) of two classes of one component whose gaps add up to more than 0, stored."""
    @F.arrow_udf(T.ArrayType(T.LongType(), False))
    def bitmaps(tokens: pa.Array) -> pa.Array:
        return _longs([_bitmap(np.array(x, np.int64).view(np.uint64)) for x in tokens.to_pylist()])

    # Odd n-grams that several classes have, rare first; few of a pair's are in common.
    posted = compared.select("component", "cls", "gap", F.explode("odd").alias("token"))
    several = posted.groupBy("component", "token").agg(F.count("*").alias("k")).where("k > 1")
    odd = stored(
        posted.join(several, ["component", "token"])
        .groupBy("cls", "component", "gap").agg(F.sort_array(F.collect_list(
            F.struct("k", "token"))).getField("token").alias("odd"))
        .withColumn("bits", bitmaps("odd")), "odd")
    a, b = (odd.select("cls", "component", "gap", "bits", F.size("odd").alias("n"),
                       F.posexplode("odd").alias("at", "token"))
            .toDF(x, "component", *(f"{x}_{c}" for c in ("gap", "bits", "n", "at")), "token")
            for x in "ab")

    def at_most(x: str, y: str) -> str:
        return f"{x}_n - ({_missing(x, y)})"

    # Behind the first odd n-gram in common there must be enough of both; bits bound s as well.
    enough = (f"a_gap + b_gap > 0 and a_gap + b_gap <= {2 * (100 + percent)} * "
              f"least(a_n - a_at, b_n - b_at, {at_most('a', 'b')}, {at_most('b', 'a')})")
    pairs = stored(a.join(b, ["component", "token"]).where("a < b and " + enough)
                   .select("a", "b", (F.col("a_gap") + F.col("b_gap")).alias("gap")).distinct(),
                   "near")
    x, y = (odd.select(F.col("cls").alias(c), F.col("odd").alias(f"{c}_odd")) for c in "ab")
    links = stored(pairs.join(x, "a").join(y, "b").where(
        f"gap <= {2 * (100 + percent)} * size(array_intersect(a_odd, b_odd))").select("a", "b"),
        "odd_links")
    drop_stored(odd)
    drop_stored(pairs)
    return links


def _missing(x: str, y: str) -> str:
    """SQL: the number of bits of one map that the other has not."""
    return " + ".join(f"bit_count({x}_bits[{k}] & ~{y}_bits[{k}])" for k in range(MAP_WORDS))


def _bound(a: str, b: str, percent: int) -> str:
    """SQL: the length and suffix filters let the pair through."""
    def enough(x: str, y: str) -> str:
        return (f"{100 + percent} * ({x}_n - ({_missing(x, y)})) >= "
                f"{percent} * ({a}_n + {b}_n)")

    return (f"{percent} * greatest({a}_n, {b}_n) <= 100 * least({a}_n, {b}_n) and "
            f"{enough(a, b)} and {enough(b, a)}")


def _named(classes: DataFrame, side: str) -> DataFrame:
    return classes.select(F.col("cls").alias(side), F.col("n").alias(f"{side}_n"),
                          F.col("bits").alias(f"{side}_bits"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked): every pair compared on the whole sets."""
    def overlap(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(x.to_pylist(), y.to_pylist()):
            both = np.sort(np.concatenate([np.frombuffer(a, np.uint64),
                                           np.frombuffer(b, np.uint64)]))
            union = len(both) - int((both[1:] == both[:-1]).sum())
            out.append(100 * (len(both) - union) >= percent * union)
        return pa.array(out, pa.bool_())

    linked = F.arrow_udf(overlap, T.BooleanType())
    x = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("_x"))
    y = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("_y"))
    # A set is moved for each of its pairs, so many pairs go in ranges, one after the other.
    ranges = min(RANGES, 1 + pairs.count() // RANGE_PAIRS)
    parts = []
    for k in range(ranges):
        own = F.pmod("b", F.lit(ranges)) == k
        parts.append(stored(x.join(_few(pairs.where(own)), "a").join(y.where(own), "b")
                            .select("a", "b", linked("_x", "_y").alias("linked")), "verified"))
    return reduce(DataFrame.unionByName, parts)


def classes_and_links(docs: DataFrame, text: str = "text", id_column: str = "doc_id",
                      size: int = 5, percent: int = 75, every_link: bool = True
                      ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(membership, links, class components, gaps).

    ``membership`` has a row per document: ``_id``, ``n`` (set size), ``cls`` (null if empty)
    and ``_h``, the hash of its text.
    ``links`` are pairs of classes (a, b) similar enough, each once: with those that ``gaps``
    tells all there are; without ``every_link`` only verified ones that join all of each component.
    ``components`` is (node, component) for the classes that have a link.
    ``gaps`` is (cls, component, gap): two classes of one component link if their gaps add up to
    0 or less. Such pairs are not in ``links``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with shuffles_removed(spark):
        return _classes_and_links(spark, docs, text, id_column, size, percent, every_link)


def _classes_and_links(spark: SparkSession, docs: DataFrame, text: str, id_column: str,
                       size: int, percent: int, every_link: bool
                       ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    docs = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"),
                       F.xxhash64(text).alias("_h"))
    signed = signatures(spark, docs, size, percent, "_text", ["_id", "_h"])

    # Postings are dealt and joined in ranges of the token's hash, one after the other, so that
    # the shuffle of one range is on the disk at a time.
    postings = signed.select(F.posexplode("prefix").alias("at", "token"), "cls")
    parts = [stored(_shared(postings.where(F.pmod("token", F.lit(RANGES)) == k)
                            .repartition("token")), "shared") for k in range(RANGES)]
    hot = (signed.select(F.posexplode("hot").alias("at", "token"), "cls",
                         F.size("prefix").alias("n_cold"))
           .select((F.col("at") + F.col("n_cold")).alias("at"), "token", "cls"))
    shared = reduce(DataFrame.unionByName, [*parts, stored(_shared(hot), "shared")])

    classes = stored(signed.select("cls", "n", "bits", "_id")
                     .join(shared.select("cls").distinct(), "cls", "left_semi").groupBy("cls")
                     .agg(F.first("n").alias("n"), F.first("bits").alias("bits"),
                          F.min("_id").alias("_id")), "classes")
    members = stored(signed.select("_id", "_h", "n", "cls"), "members")
    drop_stored(signed)
    repeated = bool(members.where("_id is not null").groupBy("_id").count().where("count > 1")
                    .head(1))
    # Not deterministic for the optimizer, which would run it on all texts to look for nulls.
    whole = F.arrow_udf(_whole(size), "struct<cls: bigint, tokens: binary>").asNondeterministic()

    def whole_sets(pairs: DataFrame) -> DataFrame:
        """The sets of the classes in ``pairs``, from the text of one document each.

        An id may stand for several texts, and many texts may have none, so what is read is
        matched by the class itself.
        """
        named = pairs.select(F.col("a").alias("cls")).unionByName(
            pairs.select(F.col("b").alias("cls")))
        wanted = stored(named.distinct().join(classes.select("cls", "_id"), "cls"), "wanted")
        texts = docs.join(_few(wanted.select("_id").distinct()), "_id", "left_semi")
        unnamed = bool(wanted.where("_id is null").head(1))
        if unnamed:
            texts = texts.unionByName(docs.where("_id is null"))
        sets = texts.select(whole(F.col("_text").cast("binary")).alias("_s")).select("_s.*")
        # Otherwise an id has one text, and that is of a class in ``pairs``.
        if unnamed or repeated:
            sets = sets.join(_few(wanted.select("cls")), "cls", "left_semi").dropDuplicates(["cls"])
        return stored(sets, "sets")

    tried = None
    found = spark.createDataFrame([], "node long, component long")

    def with_component(df: DataFrame) -> DataFrame:
        known = found.withColumnRenamed("node", "cls")
        if known.count() <= BROADCAST_ROWS:
            known = F.broadcast(known)
        return (df.join(known, "cls", "left")
                .withColumn("component", F.coalesce("component", "cls")))

    def attempt(pairs: DataFrame, kept: list[DataFrame] | None = None) -> bool:
        """Verify new pairs; True if any is linked. The sets are added to ``kept``, if given."""
        nonlocal tried, found
        if tried is not None:
            pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if not pairs.head(1):
            return False
        sets = whole_sets(pairs)
        result = _verified(pairs, sets, percent)
        tried = result if tried is None else tried.unionByName(result)
        linked = bool(result.where("linked").head(1))
        if linked:
            found = components(tried.where("linked"))
        if kept is None:
            drop_stored(sets)
        else:
            kept.append(sets)
        return linked

    def filtered(pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) that pass the length and suffix filters, smaller hash first."""
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return (ordered.where("a < b").distinct()
                .join(_named(classes, "a"), "a").join(_named(classes, "b"), "b")
                .where(_bound("a", "b", percent)).select("a", "b"))

    def near_centres(compared: DataFrame) -> DataFrame:
        """Pairs (a, b) of a class and of the class nearest to the consensus of a component that
        has most of the classes of one of its lists, but not this one."""
        own = _few(compared.select("cls", "component"))
        centres = compared.groupBy("component").agg(F.min_by("cls", "gap").alias("b"))
        listed = shared.where("many").select("token", "cls").join(own, "cls", "left")
        most = (listed.where("component is not null").groupBy("token", "component")
                .agg(F.count("*").alias("k")).groupBy("token")
                .agg(F.max_by("component", F.struct("k", "component")).alias("near")))
        return (listed.join(most, "token").where("not component <=> near")
                .select(F.col("cls").alias("a"), F.col("near").alias("component")).distinct()
                .join(_few(centres), "component").select("a", "b"))

    gaps, odd_links = spark.createDataFrame([], _GAPS), None
    if every_link:
        kept: list[DataFrame] = []
        if attempt(filtered(shared.where("many").select(F.col("cls").alias("a"),
                                                        F.col("low").alias("b"))), kept):
            compared = _compared(found, kept[0], percent)
            if compared.head(1):
                if attempt(filtered(near_centres(compared)), kept):
                    drop_stored(compared)
                    more = kept[1].join(kept[0].select("cls"), "cls", "left_anti")
                    compared = _compared(found, kept[0].unionByName(more), percent)
                gaps = stored(compared.select("cls", "component", "gap"), "gaps")
                odd_links = _odd_links(compared, percent)
            drop_stored(compared)
        for sets in kept:
            drop_stored(sets)
    pairs = shared.select(F.col("cls").alias("a"), F.col("low").alias("b"))
    for k in range(1, (0 if every_link else STAR_ROUNDS) + 1):
        if not attempt(filtered(pairs)):
            break
        # Another member stands for a component in each round, and the largest is the hub.
        mask = F.xxhash64(F.lit(k))
        hubs = (with_component(shared).groupBy("token", "component")
                .agg(F.min(F.col("cls").bitwiseXOR(mask)).alias("least"),
                     F.count("*").alias("size"))
                .select("token", "size", F.col("least").bitwiseXOR(mask).alias("cls"))
                .repartition("token"))
        hub = (hubs.groupBy("token").agg(F.max_by("cls", "size").alias("hub"),
                                         F.count("*").alias("k"))
               .where("k > 1").select("token", "hub"))
        pairs = hubs.join(hub, "token").select(F.col("cls").alias("a"), F.col("hub").alias("b"))
    about = classes.select("cls", "n", "bits")
    if every_link:
        lists = shared.select("token", "at", "cls")
        about = about.join(_few(gaps.select("cls", "component")), "cls", "left")
        apart = f"not {_TOGETHER} and "
    else:
        lists = with_component(shared).select("token", "at", "cls", "component")
        apart = "a_component <> b_component and "
        open_lists = (lists.groupBy("token")
                      .agg(F.min("component").alias("low"), F.max("component").alias("high"))
                      .where("low < high").select("token"))
        lists = lists.join(open_lists, "token", "left_semi")
    # Positional filter: behind the first n-gram in common, enough must be left of both. Where
    # it fails, either an earlier n-gram is in common or the pair is not similar.
    enough_left = f"{100 + percent} * least(a_n - a_at, b_n - b_at) >= {percent} * (a_n + b_n)"
    met = []
    for k in range(RANGES):                         # again one range of tokens at a time
        rest = stored(lists.where(F.pmod("token", F.lit(RANGES)) == k)
                      .join(about, "cls"), "open")
        # The shorter of two sets, b, shares one of its first n - 2 t / (1 + t) n + 1 n-grams.
        a, b = (rest.select(F.col("token").alias(f"{x}_token"), F.col("cls").alias(x),
                            *(F.col(c).alias(f"{x}_{c}")
                              for c in ("component", "n", "bits", "at")))
                for x in "ab")
        b = b.where(f"b_at <= b_n - ({2 * percent} * b_n + {99 + percent}) div {100 + percent}")
        met.append(stored(
            a.join(b, F.expr("a_token = b_token and " + apart +
                             "(a_n > b_n or a_n = b_n and a > b) and " + enough_left + " and "
                             + _bound("a", "b", percent)))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "met"))
        drop_stored(rest)
    attempt(stored(reduce(DataFrame.unionByName, met).distinct(), "met"))
    links = (tried.where("linked").select("a", "b") if tried is not None
             else spark.createDataFrame([], "a long, b long"))
    if odd_links is not None:                 # gaps tell the links within their components
        for x in "ab":
            links = links.join(_few(gaps.select("cls", "component").toDF(x, f"{x}_component")),
                               x, "left")
        links = links.where(f"not {_TOGETHER}").select("a", "b").unionByName(odd_links)
    return members, links, found, gaps


def near_copies(docs: DataFrame, text: str = "text", id_column: str = "doc_id", size: int = 5,
                percent: int = 75) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id``, ``text_hash`` (xxhash64), ``n_links``.

    ``n_links`` is the number of other documents similar enough to it, equal ones included.
    ``component_id`` is the smallest id reachable by links, its own included. Null and empty
    texts, and texts of white space, have no n-grams and reach only themselves; a text with
    fewer words than ``size`` is one n-gram. Null ids never become a component id unless all of
    a component are null. Repeated rows are separate documents that link.
    """
    members, links, found, gaps = classes_and_links(docs, text, id_column, size, percent)
    grouped = (members.where("cls is not null")
               .join(found.withColumnRenamed("node", "cls"), "cls", "left")
               .withColumn("component", F.coalesce("component", "cls")))
    smallest = grouped.groupBy("component").agg(F.min("_id").alias("component_id"))
    # A document links to the others of its class and to all of the classes linked with it.
    sizes = members.where("cls is not null").groupBy("cls").agg(F.count("*").alias("size"))
    linked = (links.select(F.col("a").alias("of"), F.col("b").alias("cls"))
              .unionByName(links.select(F.col("b").alias("of"), F.col("a").alias("cls")))
              .join(sizes, "cls").groupBy(F.col("of").alias("cls"))
              .agg(F.sum("size").alias("others")))
    # The classes of a component whose gap is at most minus that of a class link to it. Gaps and
    # what they ask for stand in one order; different gaps are as many as sets have sizes.
    sized = gaps.join(sizes, "cls")
    at = sized.groupBy("component", "gap").agg(F.sum("size").alias("docs"))
    order = Window.partitionBy("component").orderBy("place").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    within = (at.select("component", F.col("gap").alias("place"), "docs", F.lit(None).alias("gap"))
              .unionByName(at.select("component", (-F.col("gap")).alias("place"),
                                     F.lit(0).alias("docs"), "gap"))
              .withColumn("within", F.sum("docs").over(order)).where("gap is not null"))
    counted = (sized.join(within.select("component", "gap", "within"), ["component", "gap"])
               .select("cls", F.expr("within - if(gap <= 0, size, 0)").alias("counted")))
    counts = sizes.join(linked, "cls", "left").join(counted, "cls", "left").select(
        "cls", (F.col("size") - 1 + F.coalesce("others", F.lit(0))
                + F.coalesce("counted", F.lit(0))).alias("n_links"))
    columns = [F.col("_id").alias(id_column), F.col("n").alias("n_shingles"), "component_id",
               F.col("_h").alias("text_hash"), "n_links"]
    return (grouped.join(counts, "cls").join(smallest, "component").select(*columns)
            .unionByName(members.where("cls is null").withColumn("component_id", F.col("_id"))
                         .withColumn("n_links", F.lit(0).cast("long")).select(*columns)))


def one_of_each(docs: DataFrame, text: str = "text", id_column: str = "doc_id", size: int = 5,
                percent: int = 75) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest id.

    Of equal ids the text with the smallest hash stays. Texts without words all stay.
    """
    whole = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("_document"),
                        col(id_column).alias("doc_id"), col(text).alias("text"),
                        F.xxhash64(col(text)).alias("_key"))
    has_words = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    wordy = whole.where(has_words)
    members, _, found, _ = classes_and_links(wordy, size=size, percent=percent, every_link=False)
    member = F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_h")
    keyed = (members.join(found.withColumnRenamed("node", "cls"), "cls", "left")
             .groupBy(F.coalesce("component", "cls").alias("group"), "_id", "_h")
             .agg(F.count("*").alias("rows")))
    first = keyed.groupBy("group").agg(F.min(member).alias("first"))
    # Keys of rows that do not simply stay: those of another row of the group, and those that
    # stay but stand for several rows, of which one stays.
    keys = stored(keyed.join(first, "group").withColumn("is_first", member == F.col("first"))
                  .where("rows > 1 or not is_first")
                  .select(F.col("_id").alias("_i"), F.col("_h").alias("_g"), "is_first"), "keys")
    rows = whole.where(has_words).select("_document", "doc_id", "_key")
    on = F.expr("doc_id <=> _i and _key = _g")
    several = keys.where("is_first")
    if keys.count() <= BROADCAST_ROWS:
        keys, several = F.broadcast(keys), F.broadcast(several)
    parts = [rows.join(keys, on, "left_anti"),
             rows.join(several, on, "left_semi").dropDuplicates(["doc_id", "_key"]),
             whole.where(~has_words)]
    return (parts[0].select("_document").unionByName(parts[1].select("_document"))
            .unionByName(parts[2].select("_document")).select("_document.*"))
