"""End-to-end jobs. Each writes tables at its stage boundaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.operators.audit import (
    COUNT_COLUMNS,
    count_by_directory,
    is_incomplete,
    with_directory_counts,
)
from pixelframe.operators.catalog import (
    build_catalog,
    malformed_ids,
    scheme_rejects,
    slim_catalog,
    with_scheme,
)
from pixelframe.operators.categories import CategoryIndexer, sparse_assembler
from pixelframe.operators.features import columns_by_type
from pixelframe.operators.models import (
    accuracy_by,
    fit,
    forest,
    linear_regression,
    predict,
    rmse_of,
)
from pixelframe.operators.pixels import explode_pixels
from pixelframe.operators.sampling import (
    SEED,
    first_many,
    first_rows,
    hash_sample_by_split,
    hash_split,
    random_parts,
    sample_by_split,
    split_fractions,
    split_rows,
)
from pixelframe.operators.stages import (
    BAND_PATHS,
    FeatureAssembler,
    IndexBuilder,
    LabelRecoder,
)
from pixelframe.schemas import (
    AUDIT_COLUMNS,
    COMPLETE_FILES,
    PIXEL_JOB_COLUMNS,
    PIXEL_ORDER,
)
from pixelframe.sources.files import count_listed_files
from pixelframe.sources.rasters import ERROR, Decoder, decode_patches
from pixelframe.sources.sinks import (
    BATCH,
    COPY,
    ROW_KEY,
    commit_pixels,
    committed,
    read_pixels,
    write_audit,
    write_catalog,
    write_pixels,
    write_slim_catalog,
    write_table,
)
from pixelframe.sources.tables import read_metadata, read_table
from pixelframe.storage import materialize

KEYS = ["patch_id", "split"]
ROW = "__row"
PART = "__part"
ROUND = "__round"
#: Decode tasks of small batches that are under way together, for each core.
TASKS_PER_CORE = 16
#: So many first rows are ordered in one task; more are cut out of sorted ranges.
FIRST_IN_ONE_TASK = 10_000


def catalog_job(
    spark: SparkSession,
    metadata: str,
    output: str,
    root: str,
    folders: Mapping[str, str] | None = None,
) -> None:
    """Metadata table to catalogue with image directories.

    Rows whose ids name no scene stay, without directories, and are also
    written to ``rejects_path(output)``.
    """
    built = build_catalog(read_table(spark, metadata), root, folders)
    write_catalog(built, output)
    write_table(malformed_ids(built), rejects_path(output))


def slim_catalog_job(spark: SparkSession, catalog: str, output: str, scheme: str = "s3://") -> None:
    """Catalogue to patch id, split and path bundle, as preprocessing reads them.

    Rows without a path of that scheme go to ``rejects_path(output)`` with the reason.
    """
    rows = read_metadata(spark, catalog)
    write_slim_catalog(slim_catalog(with_scheme(rows, scheme=scheme), scheme), output)
    write_table(scheme_rejects(rows, scheme=scheme), rejects_path(output))


def rejects_path(output: str) -> str:
    """The table beside ``output`` that holds what a job could not use."""
    return f"{output.rstrip('/')}-rejects"


def task_count(rows: int, rows_per_task: int) -> int:
    return max(1, ceil(rows / rows_per_task))


def in_even_ranges(catalog: DataFrame, patches_per_task: int) -> DataFrame:
    """Catalogue in even ranges of split and patch, one per decode task.

    A row number spreads copies of one patch over several ranges. It is stored,
    so that a recomputed task sees the same numbers.
    """
    numbered = catalog.withColumn(ROW, F.monotonically_increasing_id())
    stored = materialize(numbered, "sampled-catalog")
    tasks = task_count(stored.count(), patches_per_task)
    return stored.repartitionByRange(tasks, "split", "patch_id", ROW)


def audit_job(
    spark: SparkSession,
    catalog: str,
    output: str,
    first: int | None = None,
    inventory: DataFrame | None = None,
    expected: Mapping[str, int] = COMPLETE_FILES,
    patches_per_task: int = 512,
) -> None:
    """Report patches whose number of files is not the expected one.

    Directories are listed in the tasks, next to the catalogue row they belong
    to, so nothing is shuffled or joined. With an ``inventory`` of file paths
    nothing is listed: files are counted per directory, and the counts are
    written before they are joined, so that adaptive execution can split a hot
    key. ``first`` audits that many patches in id order.
    """
    patches = read_table(spark, catalog, AUDIT_COLUMNS)
    if first is not None:
        few = first <= FIRST_IN_ONE_TASK
        patches = (first_rows if few else first_many)(patches, first, ["patch_id"])
    if inventory is None:
        tasks = task_count(patches.count(), patches_per_task)
        counted = count_listed_files(patches.repartition(tasks), COUNT_COLUMNS)
    else:
        counts = materialize(count_by_directory(inventory), "file-counts")
        counted = with_directory_counts(patches, counts)
    write_audit(counted.where(is_incomplete(expected)), output)


def pixel_job(
    spark: SparkSession,
    catalog: str,
    output: str,
    fraction: float = 1.0,
    find: str = "list",
    seed: int = SEED,
    decoder: Decoder | None = None,
    patches_per_task: int = 512,
) -> None:
    """Decode the sampled patches once and store one row per pixel by split.

    Only catalogue rows are shuffled: into even ranges of split and patch, so
    that a decode task reads whole patches and writes one or two splits. From
    there on listing, decoding, exploding and writing are one stage. Patches
    that could not be decoded are stored beside the pixels with the reason. A
    split that is unknown or NULL raises, whatever the fraction.
    """
    rows = read_table(spark, catalog, PIXEL_JOB_COLUMNS)
    sampled = sample_by_split(rows, split_fractions(fraction), seed=seed)
    ordered = in_even_ranges(sampled, patches_per_task)
    arrays = decode_patches(BAND_PATHS[find](ordered, KEYS), KEYS, decoder=decoder)
    pixels = explode_pixels(arrays, keep=[*KEYS, ERROR], outer=True)
    write_pixels(pixels.select(*PIXEL_ORDER, *KEYS, ERROR), output)


def pending_patches(catalog: DataFrame, done: DataFrame) -> DataFrame:
    """Catalogue rows that ``done`` lacks, each copy of equal rows by a number of its own."""
    columns = catalog.columns
    counted = catalog.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    last = F.col("__copies") - 1
    rows = counted.select(
        *columns, F.xxhash64(*columns).alias(ROW_KEY), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias(COPY)
    )
    return rows.join(done.select(ROW_KEY, COPY), [ROW_KEY, COPY], "left_anti")


def resumable_pixel_job(
    spark: SparkSession,
    catalog: str,
    output: str,
    fraction: float = 1.0,
    find: str = "list",
    decoder: Decoder | None = None,
    patches_per_task: int = 512,
    tasks_per_commit: int = 1000,
    commits: int | None = None,
) -> int:
    """``pixel_job`` in batches that are kept: a rerun decodes only the patches that lack.

    The sample is drawn by a hash of the patch id, so that every run has the same
    one. Patches are cut into even ranges, so many ranges make a batch, and each
    batch is committed when it is whole. ``commits`` bounds the batches of this
    run; the result says how many patches are left.

    Batches too small to occupy the cores are decoded side by side, in rounds of
    ``TASKS_PER_CORE`` tasks a core, and committed one by one when their round ends;
    a run that fails loses the round it is in. A round reads its own patches alone.
    """
    rows = read_table(spark, catalog, PIXEL_JOB_COLUMNS)
    sampled = hash_sample_by_split(rows, split_fractions(fraction), "patch_id")
    lacking = materialize(pending_patches(sampled, committed(spark, output)), "pending-patches")
    left = lacking.count()
    if not left:
        return 0
    tasks = task_count(left, patches_per_task)
    batches = ceil(tasks / tasks_per_commit)
    wanted = len(range(batches)[:commits])
    side_by_side = max(1, int(TASKS_PER_CORE * spark.sparkContext.defaultParallelism) // tasks_per_commit)
    ranges = lacking.repartitionByRange(tasks, "split", "patch_id", ROW_KEY, COPY)
    numbered = ranges.withColumn(PART, F.spark_partition_id())
    numbered = numbered.withColumn(BATCH, F.expr(f"cast({PART} div {tasks_per_commit} as int)"))
    # What this run does not commit is one partition more, which no round reads.
    turn = F.expr(f"cast({BATCH} div {side_by_side} as int)")
    numbered = numbered.withColumn(ROUND, F.when(F.col(BATCH) < wanted, turn).otherwise(-1))
    dealt = materialize(numbered.hint("rebalance", F.col(ROUND)), "pending-ranges", [ROUND])
    sizes = {r[ROUND]: r["count"] for r in dealt.groupBy(ROUND).count().collect()}  # one per round
    for turn in sorted(sizes.keys() - {-1}):
        own = dealt.where(F.col(ROUND) == turn)
        spread = own.repartitionByRange(task_count(sizes[turn], patches_per_task), PART)
        carried = [*KEYS, BATCH]
        arrays = decode_patches(BAND_PATHS[find](spread, carried), carried, decoder=decoder)
        pixels = explode_pixels(arrays, keep=[*carried, ERROR], outer=True)
        commit_pixels(pixels.select(*PIXEL_ORDER, *carried, ERROR), own, output)
        left -= sizes[turn]
    return left


@dataclass
class ForestResult:
    model: PipelineModel
    accuracy: DataFrame


def forest_job(
    spark: SparkSession,
    pixels: str,
    dictionary: str,
    evaluate: Sequence[str] = ("train", "test"),
    drop_unlabeled: bool = False,
    seed: int = SEED,
    **forest_params,
) -> ForestResult:
    """Train the land-cover forest on stored pixels and score it per split.

    All scored splits are predicted in one pass over the pixel table.
    """
    table = read_pixels(spark, pixels)
    steps = [
        IndexBuilder(),
        LabelRecoder(path=dictionary, dropUnlabeled=drop_unlabeled),
        FeatureAssembler(exclude=KEYS, keep=["split"]),
        forest(seed=seed, **forest_params),
    ]
    model = fit(steps, split_rows(table, "train"))
    scored = table.where(F.col("split").isin(list(evaluate)))
    predictions = predict(model, scored, ["split", "label", "prediction"])
    return ForestResult(model, accuracy_by(predictions, ["split"]))


@dataclass
class RegressionResult:
    model: PipelineModel
    predictions: DataFrame
    rmse: float


def regression_job(
    df: DataFrame,
    label: str,
    weights: Sequence[float] = (0.8, 0.2),
    seed: int = SEED,
    keys: Sequence[str] = (),
    **regression_params,
) -> RegressionResult:
    """Linear regression on a table of strings and numbers, scored on held-out rows.

    Text columns become one-hot categories and numbers are scaled; the label and
    ``keys`` are never features. With ``keys`` the rows are held out by a hash of
    the first one, which no partitioning changes; else at random by ``seed``.

    Text columns may have any number of values: their codes are stored tables,
    a row's vector is sparse, and the coefficients of many values are a stored table.

    Every estimator passes over the training rows, so they are stored once, by
    part, with the columns in use, and their vectors once for the solver's passes.
    """
    shares = dict(zip(("train", "test"), weights))
    categorical, numerical = columns_by_type(df.drop(*keys), label)
    used = df.select(*dict.fromkeys([*keys, *categorical, *numerical, label]))
    split = (
        hash_split(used, keys[0], shares, PART) if keys else random_parts(used, shares, PART, seed)
    )
    parts = materialize(split, "regression-parts", [PART])
    train, test = (split_rows(parts, p, PART).drop(PART) for p in shares)
    index = CategoryIndexer(inputCols=categorical).fit(train)
    vectors = PipelineModel([index, sparse_assembler(index, train, numerical)])
    rows = materialize(vectors.transform(train).select("features", label), "regression-vectors")
    line = linear_regression(label, one_hot=index.getOrDefault("known"), **regression_params).fit(rows)
    model = PipelineModel([*vectors.stages, line])
    predictions = model.transform(test)
    return RegressionResult(model, predictions, predictions.agg(rmse_of(label)).first()[0])
