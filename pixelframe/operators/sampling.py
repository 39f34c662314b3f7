"""Samples, splits and partitioning."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelframe.functions.hashing import key_fraction
from pixelframe.schemas import SPLITS
from pixelframe.storage import materialize

SEED = 42


def _known_stratum(stratum: str, fractions: Mapping[str, float]) -> Column:
    """The stratum column, failing on a value that ``fractions`` does not name, NULL included."""
    c = F.col(stratum)
    unknown = F.concat(F.lit("no sampling fraction for "), F.coalesce(c.cast("string"), F.lit("NULL")))
    return F.when(c.isin(list(fractions)), c).otherwise(F.raise_error(unknown))


def split_fractions(fraction: float, splits: Sequence[str] = SPLITS) -> dict[str, float]:
    return dict.fromkeys(splits, fraction)


def sample_by_split(
    df: DataFrame,
    fractions: Mapping[str, float],
    split: str = "split",
    seed: int = SEED,
) -> DataFrame:
    """Stratified sample without a shuffle.

    A split missing from ``fractions``, also NULL, raises instead of losing its rows.
    """
    checked = df.withColumn(split, _known_stratum(split, fractions))
    return checked.sampleBy(split, dict(fractions), seed)


def hash_sample_by_split(
    df: DataFrame,
    fractions: Mapping[str, float],
    key: str,
    split: str = "split",
    salt: str = "",
) -> DataFrame:
    """Stratified sample by a hash of ``key``: the same rows however they are partitioned."""
    limit = F.lit(0.0)
    for value, fraction in fractions.items():
        limit = F.when(F.col(split) == value, F.lit(float(fraction))).otherwise(limit)
    checked = df.withColumn(split, _known_stratum(split, fractions))
    return checked.where(key_fraction(key, salt) < limit)


#: Rows of a stratum among which the last ones of an exact sample are chosen by rank.
EDGE_ROWS = 10_000
#: Hex digits of the hash by which an exact sample's histogram gets finer each time.
DIGITS = 4


def exact_sample(
    df: DataFrame, sizes: Mapping[str, int], key: str, stratum: str = "split", salt: str = ""
) -> DataFrame:
    """Exactly so many rows of each stratum, or all it has: those of the smallest hash of ``key``.

    A histogram of the hashes' first digits says in which bin the last row lies;
    bins below are taken whole, and that one is parted by further digits until it
    is small. Nothing is sorted but the rows of that last bin. Rows that share a key
    are ordered by a hash of the row. A stratum that ``sizes`` does not name raises.
    """
    digest = F.md5(F.concat(F.lit(salt), F.col(key).cast("string")).cast("binary"))
    checked = df.withColumn("__stratum", _known_stratum(stratum, sizes))
    rows = checked.withColumn("__hash", F.coalesce(digest, F.lit("")))
    wanted = [(value, "", n) for value, n in sizes.items() if n > 0]
    edges = df.sparkSession.createDataFrame(wanted, "edge_stratum string, prefix string, need long")
    rows = rows.where(F.col("__stratum").isin([value for value, *_ in wanted]))
    at_edge = (F.col("__stratum") == F.col("edge_stratum")) & F.startswith("__hash", "prefix")
    by_bin = Window.partitionBy("__stratum").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    for digits in range(DIGITS, 32 + DIGITS, DIGITS):
        inside = rows.join(F.broadcast(edges), at_edge)  # a row per stratum
        bins = inside.groupBy("__stratum", F.substring("__hash", 1, digits).alias("__bin")).agg(
            F.count(F.lit(1)).alias("rows"), F.max("need").alias("need")
        )
        before = F.coalesce(F.sum("rows").over(by_bin), F.lit(0))
        last = bins.withColumn("before", before).where("before < need and before + rows >= need")
        edges = materialize(
            last.select(
                F.col("__stratum").alias("edge_stratum"),
                F.col("__bin").alias("prefix"),
                (F.col("need") - F.col("before")).alias("need"),
                "rows",
            ),
            "sample-edges",
        )
        if (edges.agg(F.max("rows")).first()[0] or 0) <= EDGE_ROWS:
            break
    # A stratum without an edge has no more rows than wanted.
    found = rows.join(F.broadcast(edges.drop("rows")), F.col("__stratum") == F.col("edge_stratum"), "left")
    edge = F.coalesce(F.startswith("__hash", "prefix"), F.lit(False))
    below = found.where(F.col("prefix").isNull() | ((F.col("__hash") < F.col("prefix")) & ~edge))
    names = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    rank = F.row_number().over(Window.partitionBy("__stratum").orderBy("__hash", F.xxhash64(*names)))
    chosen = found.where(edge).withColumn("__rank", rank).where("__rank <= need")
    return below.select(*names).unionByName(chosen.select(*names))


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = SEED
) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def _part_of(fraction: Column, weights: Mapping[str, float]) -> Column:
    """Name of the part that a number in [0, 1) falls into."""
    names, total = list(weights), float(sum(weights.values()))
    bounds = list(accumulate(weights.values()))
    part = F.lit(names[-1])
    for name, bound in reversed(list(zip(names, bounds))[:-1]):
        part = F.when(fraction < bound / total, F.lit(name)).otherwise(part)
    return part


def hash_split(
    df: DataFrame,
    key: str,
    weights: Mapping[str, float],
    output: str = "part",
    salt: str = "",
) -> DataFrame:
    """Name a part for each row by a hash of ``key``, in proportion to ``weights``."""
    return df.withColumn(output, _part_of(key_fraction(key, salt), weights))


def random_parts(
    df: DataFrame, weights: Mapping[str, float], output: str = "part", seed: int = SEED
) -> DataFrame:
    """Name a random part for each row. Store the result: a changed row order changes it."""
    return df.withColumn(output, _part_of(F.rand(seed), weights))


def split_rows(df: DataFrame, value: str, split: str = "split") -> DataFrame:
    """Rows of one split; prunes directories when the table is stored by split."""
    return df.where(F.col(split) == value)


def first_rows(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows by key; any ``n`` rows without one."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def first_many(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by key for any ``n``: no task holds more than its range of the keys.

    Ranges are sorted apart and stored; their sizes say which are whole among the
    first, and where the cut lies in the one range that is not.
    """
    nth = F.monotonically_increasing_id()
    sorted_rows = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    placed = materialize(
        sorted_rows.withColumn("__part", F.shiftright(nth, 33)).withColumn("__row", nth.bitwiseAND(F.lit((1 << 33) - 1))),
        "first-rows",
    )
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    wanted = starts.where(F.col("__before") < n)  # a row per partition
    return placed.join(F.broadcast(wanted), "__part").where(F.col("__before") + F.col("__row") < n).select(*df.columns)


def hash_partition(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Hash repartition. Use a key with many values: three splits fill three partitions."""
    return df.repartition(n, *keys)


#: Pieces that a partition's weight is made of at least; a key heavier than a piece is parted.
PIECES = 10


def balanced_partition(df: DataFrame, n: int, key: str, weight: Column | None = None) -> DataFrame:
    """``df`` in ``n`` partitions of even weight, rows of a key together where it is light enough.

    Weights per key are summed up and laid end to end in key order; a key's place
    says its partition. A key heavier than a tenth of a partition is parted into
    pieces no heavier than that, and its rows are dealt to them in turn. So no
    partition weighs more than a tenth above the mean, but for the unevenness of the
    rows of one piece. ``weight``, 1 by default, must not be negative.
    """
    rows = df.withColumn("__weight", (F.lit(1) if weight is None else weight).cast("double"))
    per_key = materialize(rows.groupBy(F.col(key).alias("__key")).agg(F.sum("__weight").alias("__sum")), "key-weights")
    target = (per_key.agg(F.sum("__sum")).first()[0] or 0.0) / n or 1.0
    ranges = per_key.repartitionByRange("__key").sortWithinPartitions("__key")
    placed = materialize(ranges.withColumn("__range", F.spark_partition_id()), "key-ranges")
    sums = placed.groupBy("__range").agg(F.sum("__sum").alias("__whole"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = sums.select("__range", F.coalesce(F.sum("__whole").over(earlier), F.lit(0.0)).alias("__start"))
    inside = Window.partitionBy("__range").orderBy("__key").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.col("__start") + F.coalesce(F.sum("__sum").over(inside), F.lit(0.0))).alias("__from")
    pieces = F.greatest(F.lit(1), F.ceil(F.col("__sum") * PIECES / target)).alias("__pieces")
    homes = placed.join(F.broadcast(starts), "__range").select(F.col("__key").alias("__home"), "__sum", start, pieces)
    homes = materialize(homes, "key-homes")
    turn = F.pmod(F.monotonically_increasing_id(), F.col("__pieces")) + 0.5
    place = F.col("__from") + turn * F.col("__sum") / F.col("__pieces")
    to = F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor(place / target))).cast("int")
    dealt = df.join(homes, df[key].eqNullSafe(homes["__home"])).withColumn("__to", to)
    return dealt.repartitionById(n, F.col("__to")).select(*df.columns)


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows in each partition, also in those that hold none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sum(batch.num_rows for batch in batches)
        here = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"partition": [here], "rows": [rows]})

    # A task without rows still counts them, which an aggregate by partition would not.
    return df.select(F.lit(1).alias("one")).mapInArrow(count, "partition long, rows long")


def partition_report(df: DataFrame) -> DataFrame:
    """Partitions, those in use, rows in all, and rows of the fullest and emptiest one."""
    return partition_counts(df).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.count(F.when(F.col("rows") > 0, 1)).alias("filled"),
        F.sum("rows").alias("rows"),
        F.max("rows").alias("max_rows"),
        F.min("rows").alias("min_rows"),
    )
