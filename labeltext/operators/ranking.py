"""Exact ranks, cuts and running sums without a one-task window.

A plain ``row_number() over (partition by label order by hash)`` sends each class to one
task. Here rows are first put into buckets that follow the order, the small table of bucket
totals is summed up, and the window runs inside (group, bucket) only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labeltext.session import cut_lineage, stored

# Hash buckets: 16 ** HASH_CHARS per group, about a million rows each at 6e10 rows.
HASH_CHARS = 4
# Rows of a range of running sums.
RANGE_ROWS = 1_000_000


def seeded_hash(key: Column, seed: int) -> Column:
    """Reproducible random order: md5 of ``seed:key``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def _before(window_by: list[str], order: Column, value: str) -> Column:
    window = (
        Window.partitionBy(*window_by)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def bucketed_rank(
    df: DataFrame, groups: list[str], order: list[str], bucket: Column, name: str = "rank"
) -> DataFrame:
    """Add the 1-based row number per ``groups`` ordered by ``order``. ``bucket`` must not
    decrease along that order.

    Rows and bucket totals are both partitioned by (group, bucket), so join and window share
    one exchange of the rows."""
    keyed = df.withColumn("_bucket", bucket)
    by = [*groups, "_bucket"]
    totals = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    offsets = totals.select(*by, _before(groups, F.col("_bucket"), "_n").alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return (
        keyed.join(offsets, by)
        .withColumn(name, inside.cast("bigint") + F.col("_offset"))
        .drop("_bucket", "_offset")
    )


def seeded_rank(
    df: DataFrame, groups: list[str], key: str, seed: int, hash_chars: int = HASH_CHARS
) -> DataFrame:
    """Row number of a seeded shuffle inside each group."""
    hashed = df.withColumn("_hash", seeded_hash(F.col(key), seed))
    bucket = F.substring("_hash", 1, hash_chars)
    return bucketed_rank(hashed, groups, ["_hash", key], bucket).drop("_hash")


def key_rank(df: DataFrame, groups: list[str], key: str, name: str = "rank") -> DataFrame:
    """Row number by a unique key inside each group, however far apart the keys lie; a group
    may hold any share of the rows."""
    sums = running_sums(df.withColumn("_one", F.lit(1).cast("bigint")), groups, key, ["_one"])
    return sums.drop("_one").withColumnRenamed("cum__one", name)


def rank_slices(
    df: DataFrame,
    groups: list[str],
    key: str,
    seed: int,
    slices: list[str],
    bounds: Callable[[DataFrame], DataFrame],
    hash_chars: int = HASH_CHARS,
    name: str = "phase",
) -> DataFrame:
    """Give each row the slice its seeded rank falls into; rows past the last bound are
    dropped when ``slices`` has no entry for them.

    ``bounds`` gets the group totals (``groups``, ``n``) and adds one BIGINT column ``r0``,
    ``r1``, ... per bound: rows with rank <= r0 are in slices[0], <= r1 in slices[1], the
    rest in the last slice (if there are more slices than bounds).

    No row is sorted or moved: counts per hash bucket locate the bucket holding each bound,
    only rows of these buckets are ranked, and the hash found there is the cut every row is
    compared with. The cut table has one row per group."""
    if not groups:
        whole = df.withColumn("_all", F.lit(0))
        return rank_slices(
            whole, ["_all"], key, seed, slices, bounds, hash_chars, name
        ).drop("_all")
    df = df.dropna(subset=groups)
    keyed = df.select(
        *groups, F.col(key).alias("_key"), seeded_hash(F.col(key), seed).alias("_hash")
    ).withColumn("_bucket", F.substring("_hash", 1, hash_chars))
    by = [*groups, "_bucket"]
    counts = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    totals = bounds(counts.groupBy(*groups).agg(F.sum("_n").alias("n")))
    names = [c for c in totals.columns if c not in [*groups, "n"]]

    # The bucket of each bound and the bound's position inside it: groups x bounds rows.
    wanted = F.array(
        *[F.struct(F.lit(i).alias("no"), F.col(b).alias("at")) for i, b in enumerate(names)]
    )
    edges = (
        counts.withColumn("_lo", _before(groups, F.col("_bucket"), "_n"))
        .join(totals.select(*groups, wanted.alias("_wanted")), groups)
        .select(*by, "_n", "_lo", F.explode("_wanted").alias("_cut"))
        .where(F.col("_cut.at") > F.col("_lo"))
        .where(F.col("_cut.at") <= F.col("_lo") + F.col("_n"))
        .select(*by, F.col("_cut.no").alias("_no"), (F.col("_cut.at") - F.col("_lo")).alias("_at"))
    )
    order = Window.partitionBy(*by, "_no").orderBy("_hash", "_key")
    cuts = (
        keyed.join(stored(edges), by)
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == F.col("_at"))
        .groupBy(*groups)
        .agg(
            *[
                F.max(F.when(F.col("_no") == i, F.struct("_hash", "_key"))).alias(f"_cut{i}")
                for i in range(len(names))
            ]
        )
    )

    here = F.struct(seeded_hash(F.col(key), seed).alias("_hash"), F.col(key).alias("_key"))
    chosen = None
    for i in range(len(names)):
        inside = F.coalesce(F.col("_here") <= F.col(f"_cut{i}"), F.lit(False))
        chosen = (F if chosen is None else chosen).when(inside, slices[i])
    if len(slices) > len(names):
        chosen = chosen.otherwise(slices[-1])
    return (
        df.withColumn("_here", here)
        .join(stored(cuts), groups, "left")
        .withColumn(name, chosen)
        .drop("_here", *[f"_cut{i}" for i in range(len(names))])
        .where(F.col(name).isNotNull())
    )


def ranges(
    df: DataFrame, groups: list[str], order: Column, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``df``, evaluated once and stored in ranges of (groups, order) of about ``range_rows``
    rows, with the range's number as ``_range``. There are more ranges if there are more rows;
    sampled bounds only balance them."""
    held = cut_lineage(df)
    wide = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = max(wide, -(-held.count() // range_rows))
    dealt = held.repartitionByRange(many, *groups, order)
    return stored(dealt.withColumn("_range", F.spark_partition_id()))


def running_sums(
    df: DataFrame,
    groups: list[str],
    order: str,
    values: list[str],
    descending: bool = False,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add ``cum_<value>``: the sum of each value up to and including the row, per group in
    the order of the column ``order``, whose values are distinct per group.

    Rows are stored in ranges, a small table of totals per group and range is summed up, and
    the window runs inside (group, range). The table of totals has at most a row per range and
    one per group."""
    if not groups:
        whole = df.withColumn("_all", F.lit(0))
        return running_sums(whole, ["_all"], order, values, descending, range_rows).drop("_all")
    direction = F.col(order).desc() if descending else F.col(order).asc()
    keyed = ranges(df, groups, direction, range_rows)
    by = [*groups, "_range"]
    totals = keyed.groupBy(*by).agg(*[F.sum(v).alias(v) for v in values])
    offsets = totals.select(
        *by, *[_before(groups, F.col("_range"), v).alias(f"_before_{v}") for v in values]
    )
    inside = (
        Window.partitionBy(*by)
        .orderBy(direction)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        keyed.join(offsets, by)
        .select(
            *df.columns,
            *[
                (F.sum(v).over(inside) + F.col(f"_before_{v}")).alias(f"cum_{v}")
                for v in values
            ],
        )
    )
