"""Distributed ranks, exact quantiles and rolling-frame buckets.

A window over a whole series, label or source puts that group into one task. The functions here
give the same numbers while every task sees a bounded share of the rows:

* ``hash_rank``    order given by a hash: range partitions over the digest split each group evenly;
* ``ordered_rank`` order given by values: range partitions, per-partition sums, offsets;
* ``halo_buckets`` fixed-size runs of ranked rows plus the neighbours a rolling frame needs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accordant.functions.ids import shuffle_hash
from accordant.session import stored

_BEFORE = (Window.unboundedPreceding, -1)
_UPTO = (Window.unboundedPreceding, Window.currentRow)
#: Ranges of digests for each part of a shuffle, so that shuffle parts get about as many rows each.
PARTS_OF_TASK = 4


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet null keys; the key columns of ``left`` are kept."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def hash_rank(df: DataFrame, keys: list[str], id_column: str, seed: int, name: str = "hash_rank") -> DataFrame:
    """1-based rank of each row within ``keys`` in shuffled (hash) order."""
    hashed = df.withColumn("_hash", shuffle_hash(F.col(id_column), seed))
    return ordered_rank(hashed, keys, ["_hash", id_column], name=name).drop("_hash")


def hash_neighbours(df: DataFrame, keys: list[str], id_column: str, seed: int) -> DataFrame:
    """Pair each row with the next one of its group in shuffled (hash) order.

    Adds ``next``, a struct of the successor's columns; the last row of a group has none and is
    left out. Rows are cut by digest into parts, whose number grows with the table; the
    successor is found inside a part, and only the last row of a part looks at the first row of the
    following part. Without ``keys`` the parts are ranges of digests, which need no sample: rows are
    moved once, and ``df`` is read three times, so it should be stored.
    """
    columns = [c for c in df.columns if c not in keys]
    row = F.struct(*columns)
    if not keys:
        return _neighbours_of_all(df, row, id_column, seed)
    ranged = _ranged(df.withColumn("_hash", F.unhex(shuffle_hash(F.col(id_column), seed))), [*keys, "_hash", id_column])
    inside = Window.partitionBy(*keys, "_part").orderBy("_hash", id_column)
    placed = ranged.withColumns({"_next": F.lead(row).over(inside), "_n": F.row_number().over(inside)})
    linked = placed.drop("_n")
    firsts = placed.where("_n = 1").select(*keys, "_part", row.alias("_first"))
    following = firsts.withColumn("_first", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_part")))
    joined = join_on(linked, following, [*keys, "_part"], "left")
    paired = joined.withColumn("next", F.coalesce("_next", "_first")).where(F.col("next").isNotNull())
    return paired.select(*df.columns, "next")


def _neighbours_of_all(df: DataFrame, row: Column, id_column: str, seed: int) -> DataFrame:
    """``hash_neighbours`` of one group: a part is a range of the first 28 bits of the digest."""
    conf = df.sparkSession.conf
    parts = PARTS_OF_TASK * int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions"))
    digest = shuffle_hash(F.col(id_column), seed)
    head = F.coalesce(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(0).cast("long"))
    part = F.shiftright(F.shiftright(head, 32) * parts, 28).cast("int")
    inside = Window.partitionBy("_part").orderBy("_hash", id_column)
    hashed = df.withColumns({"_part": part, "_hash": F.unhex(digest)})
    # rows are moved as they are; digests and the structs of rows are made where they are used
    linked = df.withColumn("_part", part).repartition("_part").withColumn("_hash", F.unhex(digest)).withColumn("_next", F.lead(row).over(inside))
    starts = df.select(part.alias("_part"), head.alias("_head")).groupBy("_part").agg(F.min("_head").alias("_head"))
    first = hashed.withColumn("_head", head).join(F.broadcast(starts), ["_part", "_head"])
    firsts = first.withColumn("_n", F.row_number().over(inside)).where("_n = 1").select("_part", row.alias("_first"))
    following = firsts.withColumn("_first", F.lead("_first").over(Window.orderBy("_part")))  # a row for each part
    joined = linked.join(F.broadcast(following), "_part", "left")
    return joined.withColumn("next", F.coalesce("_next", "_first")).where(F.col("next").isNotNull()).select(*df.columns, "next")


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` in range partitions, numbered by ``_part``; stored, as the sampled bounds must not change."""
    return stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def ordered_rank(df: DataFrame, keys: list[str], order: list[str], weight: str | None = None,
                 name: str = "row_rank") -> DataFrame:
    """Running sum of ``weight`` (running row count without one) within ``keys`` along ``order``.

    ``order`` should end in a unique column: a group of equal order values is then cut like any
    other run of rows. The range partitioning is materialised once, because its sampled
    boundaries must be the same for the rows and for the per-partition sums.
    """
    amount = F.col(weight) if weight else F.lit(1)
    ranged = _ranged(df, [*keys, *order])
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(*_UPTO)
    rows = ranged.withColumn("_run", F.sum(amount).over(inside))
    sums = ranged.groupBy(*keys, "_part").agg(F.sum(amount).alias("_sum"))
    offsets = sums.withColumn(
        "_offset", F.coalesce(F.sum("_sum").over(
            Window.partitionBy(*keys).orderBy("_part").rowsBetween(*_BEFORE)), F.lit(0))).drop("_sum")
    return (join_on(rows, offsets, [*keys, "_part"])
            .withColumn(name, (F.col("_offset") + F.col("_run")).cast("long"))
            .drop("_part", "_run", "_offset"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation per group: one column per entry of ``probabilities``.

    Equal values are counted first; the distinct values are then ranked across tasks, so a large
    group is never held in one aggregation buffer.
    """
    clean = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counted = clean.groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    return quantiles_of_counts(counted, keys, "_v", "_n", probabilities)


def quantiles_of_counts(counted: DataFrame, keys: list[str], value: str, count: str,
                        probabilities: dict[str, float | Column]) -> DataFrame:
    """The same from a table of distinct values with their counts.

    A probability may be a column that is constant within each group.
    """
    ranked = ordered_rank(counted, keys, [value], count, "_upto")
    totals = ranked.groupBy(*keys).agg(F.max("_upto").alias("_total"))
    if keys:
        placed = join_on(ranked, totals, keys)
    else:
        placed = ranked.withColumn("_total", totals.select("_total").scalar())

    def at(position: Column) -> Column:
        hit = (F.col("_upto") - F.col(count) <= position) & (position < F.col("_upto"))
        return F.max(F.when(hit, F.col(value)))

    aggregates = []
    for name, p in probabilities.items():
        place = (F.col("_total") - 1) * (p if isinstance(p, Column) else F.lit(float(p)))
        aggregates += [at(F.floor(place)).alias(f"_lo_{name}"), at(F.ceil(place)).alias(f"_hi_{name}"),
                       F.max(place - F.floor(place)).alias(f"_frac_{name}")]
    picked = placed.groupBy(*keys).agg(*aggregates)
    return picked.select(*keys, *[
        (F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_frac_{name}")).alias(name)
        for name in probabilities])


def quantile_sketches(df: DataFrame, keys: list[str], value: str, k: int = 800) -> DataFrame:
    """Mergeable sketches (keys, ``sketch``) of a column, for approximate quantiles on request.

    A rank that ``sketch_quantiles`` answers is off by at most about 2.3 / ``k`` ** 0.9 of the rows (0.6 % for 800)
    in 99 of 100 cases; a sketch takes some ``k`` * 10 bytes, however many rows it has seen.
    """
    number = F.col(value).cast("double")
    clean = df.where(number.isNotNull() & ~F.isnan(number))
    return clean.groupBy(*keys).agg(F.kll_sketch_agg_double(number, k).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of finer groups (hours, days, files) merged to those of ``keys``."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, keys: list[str], probabilities: dict[str, float]) -> DataFrame:
    """Approximate quantiles, one column per entry of ``probabilities``."""
    return sketches.select(*keys, *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(n) for n, p in probabilities.items()])


def halo_buckets(df: DataFrame, rank: str, size: int, before: int, after: int) -> DataFrame:
    """Assign ranked rows to runs of ``size`` rows and copy the edge rows neighbours need.

    A frame of row i covers ranks i-before .. i+after. Rows with ``_owned`` false are copies.
    """
    position = F.col(rank) - 1
    first = F.greatest(F.floor((position - after) / size), F.lit(0))
    last = F.floor((position + before) / size)
    copies = df.withColumn("_bucket", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    return copies.withColumn("_owned", F.col("_bucket") == F.floor(position / size))
