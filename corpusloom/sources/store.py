"""The sample store: Parquet by split, CSV exports, metadata, staleness, histories."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import settings
from ..functions.text import let
from ..operators.quality import SPLITS
from ..session import local_rows
from . import files

SAMPLE_COLUMNS = (
    "sample_id", "text_raw", "label_raw", "text_clean", "text_fingerprint", "char_len", "source_id", "source_file",
    "created_at", "split_name",
)
_META_SCHEMA = "key string, value string, written_at timestamp"


def write_samples(samples: DataFrame, path: str, row_key: str, created_at: datetime | None = None) -> None:
    """Overwrite the store; one folder per split, so reading a split touches only that.

    A numeric ``row_key`` is the sample id; for a composite one the store numbers its rows.
    """
    stamp = created_at or datetime.now(UTC)
    composite = isinstance(samples.schema[row_key].dataType, StructType)
    sample_id = F.monotonically_increasing_id() if composite else F.col(row_key).cast("long")
    full = samples.withColumns({"sample_id": sample_id, "created_at": F.lit(stamp).cast("timestamp")})
    if "source_file" not in full.columns:
        full = full.withColumn("source_file", F.lit(None).cast("string"))
    full.select(*SAMPLE_COLUMNS).write.mode("overwrite").partitionBy("split_name").parquet(path)


def read_samples(spark: SparkSession, path: str, split: str | None = None, ordered: bool = False) -> DataFrame:
    """All samples or one split (a pruned read); sorted by id only on request."""
    frame = spark.read.parquet(path)
    if split is not None:
        frame = frame.filter(F.col("split_name") == split)
    return frame.orderBy("sample_id") if ordered else frame


def export_splits(samples: DataFrame, folder: str, text_name: str = "clean_text", label_name: str = "is_depression") -> None:
    """One CSV folder per split, with the exported column names; the samples are read once.

    All splits are written beside the target first, then each folder is put in its place. A split without rows gets an
    empty file with the header.
    """
    spark = samples.sparkSession
    staging = files.join(folder, f"_export-{uuid.uuid4().hex}")
    chosen = samples.filter(F.col("split_name").isin(list(SPLITS)))
    columns = [F.col("text_raw").alias(text_name), F.col("label_raw").alias(label_name)]
    options = {"header": True, "quote": '"', "escape": '"'}
    chosen.select(*columns, "split_name").write.partitionBy("split_name").csv(staging, **options)
    for name in SPLITS:
        made, target = files.join(staging, f"split_name={name}"), files.join(folder, f"{name}.csv")
        if files.exists(spark, made):
            files.replace(spark, made, target)
        else:
            samples.limit(0).select(*columns).write.mode("overwrite").csv(target, **options)
    files.delete(spark, staging)


def write_meta(spark: SparkSession, path: str, key: str, stats: DataFrame | str) -> None:
    """Upsert by key: append the new version, the latest one counts when reading.

    ``stats`` is a one-row frame, stored as JSON, or a plain text.
    """
    now = F.current_timestamp()
    if isinstance(stats, str):
        row = spark.range(1).select(F.lit(key).alias("key"), F.lit(stats).alias("value"), now.alias("written_at"))
    else:
        row = stats.select(F.lit(key).alias("key"), F.to_json(F.struct("*")).alias("value"), now.alias("written_at"))
    row.write.mode("append").parquet(path)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """(key, value): the latest value of every key; empty when nothing was written."""
    if not files.exists(spark, path):
        return local_rows(spark, [], "key string, value string")
    frame = spark.read.schema(_META_SCHEMA).parquet(path)
    return frame.groupBy("key").agg(F.max_by("value", "written_at").alias("value"))


def is_stale(spark: SparkSession, path: str, resolved: DataFrame) -> bool:
    """Must the store be rebuilt?

    True when it or its fingerprint column is missing, a source is new, or a source file is
    over a second newer than the store. ``resolved`` has (id, path), one row per source, with
    a null path for absent ones.
    """
    if not files.exists(spark, path):
        return True
    store = spark.read.parquet(path)
    if "text_fingerprint" not in store.columns:
        return True
    built = store.groupBy("source_id").agg(F.max("created_at").cast("double").alias("built_at"))
    present = {row.source_id: row.built_at for row in built.collect()}
    newest = max(present.values(), default=0.0)
    for row in resolved.filter(F.col("path").isNotNull()).select("id", "path").collect():
        if row.id not in present or files.modified(spark, row.path) > newest + 1.0:
            return True
    return False


def flatten_histories(raw: DataFrame) -> DataFrame:
    """User histories to one row per post: user_id, y, position, dt, text.

    control is 0 and depression is 1; a null label is skipped and any other is an error.
    """
    label = (
        F.when(F.col("label") == "control", 0)
        .when(F.col("label") == "depression", 1)
        .otherwise(F.raise_error(F.concat(F.lit("unknown label: "), "label")).cast("int"))
    )
    known = raw.filter(F.col("label").isNotNull()).withColumn("y", label)
    return known.select("user_id", "y", F.posexplode("posts").alias("position", "p")).select(
        "user_id", "y", "position", F.col("p.dt").alias("dt"), F.col("p.post").alias("text")
    )


def read_histories(spark: SparkSession, path: str) -> DataFrame:
    """Gzipped JSON lines, each a list whose first entry has label and posts.

    A gzip file cannot be split; with one file per part the files are read side by side.
    Users are numbered by file and line as Spark reads them.
    """
    line = "array<struct<label:string,posts:array<array<string>>>>"
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    user = F.from_json("value", line)
    raw = lines.select(F.monotonically_increasing_id().alias("user_id"), F.get(user, F.lit(0)).alias("u"))
    posts = F.transform(F.col("u.posts"), lambda p: F.struct(F.get(p, F.lit(0)).alias("dt"), F.get(p, F.lit(1)).alias("post")))
    return flatten_histories(raw.select("user_id", F.col("u.label").alias("label"), posts.alias("posts")))


# The sentence templates of the placeholder corpus.
DEPRESSED_TEMPLATES = (
    "i feel empty and exhausted every day and nothing helps anymore",
    "i cannot sleep and i keep thinking that i am a burden to everyone",
    "nothing makes sense i just want to disappear and stop hurting",
    "i cry all the time and i feel hopeless about the future",
)
NORMAL_TEMPLATES = (
    "the weather is nice today and i enjoyed a walk in the park",
    "i finished my assignment early and treated myself to good food",
    "hanging out with friends tonight felt relaxing and fun",
    "i started a new hobby and it is challenging but exciting",
)
# End of fixed values.


def synthetic_corpus(spark: SparkSession, n_each: int = 1200, seed: int = settings.SEED) -> DataFrame:
    """A two-class template corpus with a 75/25 cut: id, text, status, held_out."""
    from ..operators.splits import holdout

    def side(templates: tuple[str, ...], filler: str) -> F.Column:
        pick = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(len(templates))).cast("int")
        times = F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(5)).cast("int")
        text = F.get(F.array(*[F.lit(t) for t in templates]), pick)
        return let(text, lambda t: F.concat(t, F.lit(" "), F.repeat(F.lit(filler), times)))

    rows = spark.range(2 * n_each)
    depressed = F.col("id") < n_each
    corpus = rows.select(
        "id",
        F.when(depressed, side(DEPRESSED_TEMPLATES, "word")).otherwise(side(NORMAL_TEMPLATES, "note")).alias("text"),
        F.when(depressed, "Depression").otherwise("Normal").alias("status"),
    )
    return holdout(corpus, "id", "status", 0.25, seed)


def write_report(metrics: DataFrame, path: str) -> None:
    """Long metric rows as JSON lines and, pivoted to one column per metric, as CSV."""
    metrics.write.mode("overwrite").json(files.join(path, "metrics.json"))
    keys = [c for c in metrics.columns if c not in ("metric", "value")]
    wide = metrics.groupBy(*keys).pivot("metric").agg(F.first("value"))
    wide.write.mode("overwrite").csv(files.join(path, "metrics.csv"), header=True)


def write_nested_report(metrics: DataFrame, path: str, by: str) -> None:
    """One JSON document per ``by`` value: {metric: value}."""
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value"))))
    nested = metrics.groupBy(by).agg(entries.alias("metrics"))
    nested.write.mode("overwrite").json(path)


def score_file(scored: DataFrame, path: str, version: str) -> None:
    """Write scored rows as CSV with all their columns and the model version."""
    scored.withColumn("model_version", F.lit(version)).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')
