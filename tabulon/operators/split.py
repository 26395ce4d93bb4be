"""Exact and repeatable splits.

Rows are ordered by a hash of their key, so a split depends on the data and the
seed only, not on partitioning. The hash value standing at each wanted rank is
found from bucket counts; assigning rows is then a comparison with that value and
moves no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import col
from tabulon.operators.common import join_small, settled
from tabulon.operators.quantiles import cut_by_rank
from tabulon.operators.rowindex import with_row_index
from tabulon.session import stored

#: Rows of one stratum and hash bucket that are ranked together.
BUCKET_ROWS = 20_000
#: Strata whose quotas are worked out on the driver.
DRIVER_STRATA = 10_000


def hash_order(key: Sequence[str], seed: int) -> Column:
    """Text hash of the key; two engines give the same for whole-number keys."""
    return F.md5(F.concat_ws("|", *[col(k).cast("string") for k in key], F.lit(str(seed))))


def hash_cuts(df: DataFrame, strata: Sequence[str], hashed: Column, cuts: DataFrame,
              names: Sequence[str], largest: int, fits: bool = True,
              bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Replace rank cuts by hash values: rows up to the cut have a hash not above it.

    ``cuts`` has one row per stratum with a row count per name, ``largest`` is the
    size of the biggest stratum and ``fits`` says that the strata are few. A cut of 0
    gives an empty hash.
    """
    if not strata:
        one = F.lit(0).alias("__all")
        return hash_cuts(df.select(one, hashed.alias("__hash")), ["__all"], F.col("__hash"),
                         cuts.select(one, *[col(c) for c in names]), names, largest, fits,
                         bucket_rows).drop("__all")
    keys = [col(s) for s in strata]
    slim = df.select(*keys, hashed.alias("__h")).withColumn(
        "__b", _bucket("__h", largest, bucket_rows))
    counts = slim.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__n"))
    split = _split_buckets(counts, strata, cuts, names, fits)
    # Only the buckets a cut falls into are ranked.
    near = join_small(slim, split, list(strata) + ["__b"], how="inner", fits=fits)
    return _hashes_at_cuts(near, strata, cuts, names, fits)


def _bucket(hashed: str, largest: int, bucket_rows: int) -> Column:
    """First digits of the hash, as many as leave about ``bucket_rows`` rows to a bucket."""
    digits = 1
    while largest / 16 ** digits > bucket_rows and digits < 5:
        digits += 1
    return F.substring(hashed, 1, digits)


def _split_buckets(counts: DataFrame, strata: Sequence[str], cuts: DataFrame,
                   names: Sequence[str], fits: bool) -> DataFrame:
    """(strata..., __b, __w, __from): buckets that cuts fall into, the cuts, the rows before."""
    keys = [col(s) for s in strata]
    # At most 16^5 rows per stratum.
    running = W.partitionBy(*keys).orderBy("__b").rowsBetween(W.unboundedPreceding, 0)
    counts = counts.withColumn("__to", F.sum("__n").over(running))
    counts = join_small(counts, cuts, strata, fits=fits)
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), col(c).alias("cut"))
                       for i, c in enumerate(names)])
    inside = counts.withColumn("__w", F.filter(wanted, lambda w: (
        w["cut"] > F.col("__to") - F.col("__n")) & (w["cut"] <= F.col("__to"))))
    # One row per stratum and cut at most.
    return settled(inside.filter(F.size("__w") > 0).select(
        *keys, "__b", "__w", (F.col("__to") - F.col("__n")).alias("__from")), fits, "cuts")


def _hashes_at_cuts(near: DataFrame, strata: Sequence[str], cuts: DataFrame,
                    names: Sequence[str], fits: bool) -> DataFrame:
    """Rank the rows of split buckets and give the hash that stands at each cut."""
    keys = [col(s) for s in strata]
    place = W.partitionBy(*keys, "__b").orderBy("__h")
    near = near.withColumn("__r", F.col("__from") + F.row_number().over(place))
    hits = (near.withColumn("__w", F.filter("__w", lambda w: w["cut"] == F.col("__r")))
            .filter(F.size("__w") > 0)
            .select(*keys, "__h", F.explode("__w").alias("__w")))
    found = hits.groupBy(*keys).agg(*[
        F.max(F.when(F.col("__w.i") == i, F.col("__h"))).alias(f"__h{i}")
        for i in range(len(names))])
    out = join_small(cuts, settled(found, fits, "cuts"), strata, fits=fits)
    return out.select(*keys, *[
        F.coalesce(F.col(f"__h{i}"), F.when(col(c) <= 0, F.lit(""))).alias(c)
        for i, c in enumerate(names)])


def band_by_cuts(df: DataFrame, strata: Sequence[str], hashed: Column, cuts: DataFrame,
                 names: Sequence[str], out: str, fits: bool = True) -> DataFrame:
    """Add how many of the ascending cuts lie below the row's hash."""
    held = [f"__c{i}" for i in range(len(names))]
    named = cuts.select(*[col(s) for s in strata],
                        *[col(c).alias(h) for c, h in zip(names, held)])
    if strata:
        joined = join_small(df, named, strata, fits=fits)
    else:
        row = named.first()
        joined = df.select("*", *[F.lit(row[h]).alias(h) for h in held])
    passed = [(F.col("__hash") > F.col(h)).cast("int") for h in held]
    return (joined.withColumn("__hash", hashed)
            .withColumn(out, sum(passed[1:], passed[0])).drop("__hash", *held))


def largest_remainder(counts: dict, draws: int) -> dict:
    """Share ``draws`` over the groups in proportion; left-over ones go to the largest
    remainders, ties by group name."""
    total = sum(counts.values())
    exact = {g: Fraction(n * draws, total) for g, n in counts.items()}
    quota = {g: math.floor(x) for g, x in exact.items()}
    left = draws - sum(quota.values())
    for g in sorted(exact, key=lambda g: (quota[g] - exact[g], g))[:left]:
        quota[g] += 1
    return quota


def _remainder_quota(sizes: DataFrame, strata: Sequence[str], size: str, draws: int,
                     total: int, name: str) -> DataFrame:
    """``largest_remainder`` for any number of strata, as a distributed ranking."""
    product = col(size).cast("decimal(38,0)") * F.lit(draws)
    floored = F.floor(product / F.lit(total)).cast("bigint")
    # Recompute the remainder exactly; the division above may round.
    rest = product - floored * F.lit(total)
    low = sizes.withColumn("__q", floored).withColumn("__rest", rest.cast("decimal(38,0)"))
    low = low.withColumn("__q", F.when(F.col("__rest") < 0, F.col("__q") - 1)
                         .when(F.col("__rest") >= total, F.col("__q") + 1)
                         .otherwise(F.col("__q")))
    low = low.withColumn("__rest", (product - F.col("__q") * F.lit(total)).cast("decimal(38,0)"))
    left = draws - (low.agg(F.sum("__q")).first()[0] or 0)
    ranked = with_row_index(low, [F.desc("__rest"), *[col(s) for s in strata]], "__i")
    return ranked.withColumn(name, F.col("__q") + (F.col("__i") < left).cast("bigint")) \
                 .drop("__q", "__rest", "__i")


def _exact_count(n: int, share: float) -> int:
    """ceil(n * share), computed on the decimal the share was written as."""
    return math.ceil(Fraction(str(share)) * n)


def split_sizes(n: int, test: float = 0.15, val: float = 0.15) -> tuple[int, int, int]:
    """(train, val, test) row counts of two successive draws."""
    n_test = _exact_count(n, test)
    rest = n - n_test
    n_val = math.ceil(Fraction(str(val)) / (1 - Fraction(str(test))) * rest) if val else 0
    return rest - n_val, n_val, n_test


def stratum_quotas(df: DataFrame, strata: Sequence[str], test: float, val: float,
                   driver_strata: int = DRIVER_STRATA) -> tuple[DataFrame, int, bool]:
    """(strata..., n, n_train, n_val, n_test) per stratum, the largest stratum, and
    whether the strata are few.

    Train and validation together are shared out first and the test set takes what
    remains; the same again between train and validation.
    """
    keys = [col(s) for s in strata]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    rows = sizes.limit(driver_strata + 1).collect()
    if len(rows) > driver_strata:
        return *_many_quotas(stored(sizes, "strata"), strata, test, val), False
    counts = {tuple(r[s] for s in strata): r["n"] for r in rows}
    total = sum(counts.values())
    if strata and min(counts.values()) < 2:
        raise ValueError("every stratum needs at least two rows")
    n_train, n_val, n_test = split_sizes(total, test, val)

    def by_name(c: dict) -> dict:      # nulls sort first and do not compare with text
        return {tuple((x is not None, x) for x in k): v for k, v in c.items()}

    kept = largest_remainder(by_name(counts), n_train + n_val)
    train = largest_remainder(kept, n_train)
    table = []
    for k, n in counts.items():
        b = tuple((x is not None, x) for x in k)
        table.append((*k, n, train[b], kept[b] - train[b], n - kept[b]))
    schema = sizes.drop("n").schema
    for c in ("n", "n_train", "n_val", "n_test"):
        schema = schema.add(c, T.LongType())
    return spark.createDataFrame(table, schema), max(counts.values()), True


def _many_quotas(sizes: DataFrame, strata: Sequence[str], test: float, val: float
                 ) -> tuple[DataFrame, int]:
    summary = sizes.agg(F.sum("n"), F.min("n"), F.max("n")).first()
    total, smallest, largest = summary
    if smallest < 2:
        raise ValueError("every stratum needs at least two rows")
    n_train, n_val, n_test = split_sizes(total, test, val)
    kept = _remainder_quota(sizes, strata, "n", n_train + n_val, total, "__kept")
    both = _remainder_quota(kept, strata, "__kept", n_train, n_train + n_val, "n_train")
    out = (both.withColumn("n_val", F.col("__kept") - F.col("n_train"))
           .withColumn("n_test", F.col("n") - F.col("__kept")))
    return out.select(*[col(s) for s in strata], "n", "n_train", "n_val", "n_test"), largest


def three_way_split(df: DataFrame, key: Sequence[str], strata: Sequence[str] = (),
                    test: float = 0.15, val: float = 0.15, seed: int = 42,
                    out: str = "split", driver_strata: int = DRIVER_STRATA,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``train``, ``val`` or ``test`` with exact sizes overall and per stratum.

    ``key`` must tell rows apart; rows sharing a key share their side.
    """
    quotas, largest, fits = stratum_quotas(df, strata, test, val, driver_strata)
    cuts = quotas.select(*[col(s) for s in strata], F.col("n_test").alias("cut_test"),
                         (F.col("n_test") + F.col("n_val")).alias("cut_val"))
    hashed = hash_order(key, seed)
    cuts = hash_cuts(df, strata, hashed, cuts, ["cut_test", "cut_val"], largest, fits,
                     bucket_rows)
    banded = band_by_cuts(df, strata, hashed, cuts, ["cut_test", "cut_val"], "__band", fits)
    side = F.element_at(F.array(F.lit("test"), F.lit("val"), F.lit("train")),
                        F.col("__band") + 1)
    return banded.withColumn(out, side).drop("__band")


def train_test_split(df: DataFrame, key: Sequence[str], test: float = 0.2, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """Add ``train`` or ``test``, not stratified."""
    return three_way_split(df, key, (), test, 0.0, seed, out)


def fold_starts(n: int, k: int) -> list[int]:
    """First row of each fold; the first n mod k folds get one row more."""
    size, more = divmod(n, k)
    return [f * size + min(f, more) for f in range(k)]


def kfold(df: DataFrame, order: Sequence[str], k: int = 5, out: str = "fold") -> DataFrame:
    """Add contiguous, unshuffled folds 0..k-1 in the order of unique keys, nulls first.

    Keys are numbers, dates, timestamps or texts (in the order of their UTF-8 bytes). Only the
    key tuples at the k-1 fold starts are looked up; rows are compared with them in place.
    """
    n, nulls = df.agg(F.count(F.lit(1)), F.count_if(col(order[0]).isNull())).first()
    if n < k:
        raise ValueError(f"{n} rows cannot make {k} folds")
    cuts = cut_by_rank(df.select(*[col(c) for c in order]), order, fold_starts(n, k)[1:],
                       rows=n, nulls=nulls)
    fold = F.lit(0)
    for cut in cuts:
        at_or_after = F.lit(True)
        for c, v in reversed(list(zip(order, cut))):
            if v is None:
                at_or_after = col(c).isNotNull() | at_or_after
            else:
                at_or_after = F.coalesce((col(c) > F.lit(v)) | ((col(c) == F.lit(v))
                                                                & at_or_after), F.lit(False))
        fold = fold + at_or_after.cast("int")
    return df.withColumn(out, fold)


def outside_counts(slim: DataFrame, folds: int) -> DataFrame:
    """(__f, __b, __n): rows of each bucket outside each fold, from ``slim`` (__own, __b, ...).

    Rows are counted once, by bucket and own fold; a bucket's rows outside a fold are all its
    rows without those of the fold.
    """
    counts = slim.groupBy("__b", "__own").agg(F.count(F.lit(1)).alias("__n"))
    buckets = counts.groupBy("__b").agg(
        F.sum("__n").alias("__all"),
        F.map_from_entries(F.collect_list(F.struct("__own", "__n"))).alias("__in"))
    each = buckets.withColumn("__f", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    return each.select("__f", "__b", (F.col("__all") - F.coalesce(
        F.try_element_at("__in", F.col("__f")), F.lit(0))).alias("__n"))


def learning_subsets(df: DataFrame, key: Sequence[str], fold: str, folds: int,
                     steps: int = 10, seed: int = 42, out: str = "steps_from",
                     bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add, per validation fold, the smallest training prefix each row belongs to.

    The new column is an array of length ``folds``: entry f is 1..steps (the row is in
    prefixes of that number and above, when fold f is held out) or 0 for rows of fold
    f itself. Prefix s holds floor(s / steps * rows outside the fold) rows in hash
    order. Rows are counted once; only those of buckets that a cut falls into meet every fold
    they are outside of. Rows without a fold count for none, and get the entries of their hash.
    """
    hashed = hash_order(key, seed)
    slim = df.select(col(fold).cast("int").alias("__own"), hashed.alias("__h")) \
        .filter("__own is not null")
    sizes = {r[0]: r[1] for r in slim.groupBy("__own").agg(F.count(F.lit(1))).collect()}
    total = sum(sizes.values())
    names = [f"s{i}" for i in range(1, steps)]
    outside = {f: total - sizes.get(f, 0) for f in range(folds)}
    cuts = df.sparkSession.createDataFrame(
        [(f, *[outside[f] * i // steps for i in range(1, steps)]) for f in range(folds)],
        "__f int, " + ", ".join(f"{n} bigint" for n in names))
    slim = slim.withColumn("__b", _bucket("__h", max(outside.values()), bucket_rows))
    # At most a row for every fold and step.
    split = _split_buckets(outside_counts(slim, folds), ["__f"], cuts, names, True)
    near = join_small(slim, split, ["__b"], how="inner", fits=True).filter("__f <> __own")
    held = {r["__f"]: r for r in
            _hashes_at_cuts(near, ["__f"], cuts, names, True).collect()}
    per_fold = []
    for f in range(folds):
        passed = [(F.col("__hash") > F.lit(held[f][n])).cast("int") for n in names]
        per_fold.append(F.when(col(fold) == f, F.lit(0)).otherwise(sum(passed, F.lit(1))))
    # The hash is a column of its own so that it is computed once per row.
    return df.withColumn("__hash", hashed).withColumn(out, F.array(*per_fold)).drop("__hash")
