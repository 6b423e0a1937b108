"""The source manifest: JSON entries to one row per source, and their files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings
from ..functions import text as tx
from ..functions.labels import normalise_label
from ..operators import quality
from ..session import local_rows
from . import files
from .readers import pick_column, read_posts

_SCHEMA = (
    "sources array<struct<id:string,file:string,text_column:string,text_columns:array<string>,label_column:string,"
    "label_type:string,alt_files:array<string>,required:boolean,min_chars:int>>"
)
_RESOLVED = "id string, path string, status string"


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per source in manifest order (``rank``), defaults filled in."""
    raw = spark.read.schema(_SCHEMA).json(path, multiLine=True)
    empty = F.array().cast("array<string>")
    return raw.select(F.posexplode("sources").alias("rank", "s")).select(
        "rank", "s.id", "s.file", "s.text_column",
        F.coalesce("s.text_columns", empty).alias("text_columns"),
        F.coalesce("s.label_column", F.lit("label")).alias("label_column"),
        F.coalesce("s.label_type", F.lit("binary_numeric")).alias("label_type"),
        F.coalesce("s.alt_files", empty).alias("alt_files"),
        F.coalesce("s.required", F.lit(False)).alias("required"),
        "s.min_chars",
    )


def resolve(spark: SparkSession, manifest: DataFrame, folder: str, ids: Sequence[str] | None = None) -> DataFrame:
    """(id, path, status) per wanted source: loaded, skipped or missing_required.

    The manifest is a short configuration list, so it is read on the driver.
    """
    rows = []
    for spec in manifest.orderBy("rank").collect():
        if ids and spec.id not in ids:
            continue
        found = next((p for p in (files.join(folder, n) for n in (spec.file, *spec.alt_files)) if files.exists(spark, p)), None)
        status = "loaded" if found else ("missing_required" if spec.required else "skipped")
        rows.append((spec.id, found, status))
    return local_rows(spark, rows, _RESOLVED)


def load_source(spark: SparkSession, path: str, spec, positives: Sequence[str] = settings.POSITIVE_LABELS) -> DataFrame:
    """One source file as text_raw, label_raw, source_id, source_file, in reading order."""
    frame = read_posts(spark, path)
    named = [c for c in spec.text_columns if c in frame.columns]
    if spec.text_column and spec.text_column in frame.columns:
        text = F.col(f"`{spec.text_column}`")
    elif named:
        text = tx.coalesce_text([F.col(f"`{c}`") for c in named])
    else:
        found = pick_column(frame.columns, settings.TEXT_COLUMNS)
        if found is None:
            raise ValueError(f"no text column for source {spec.id} in {frame.columns}")
        text = F.col(f"`{found}`")
    label = spec.label_column
    if label not in frame.columns:
        label = pick_column(frame.columns, settings.LABEL_COLUMNS)
        if label is None:
            raise ValueError(f"no label column for source {spec.id} in {frame.columns}")
    return frame.select(
        text.cast("string").alias("text_raw"),
        normalise_label(F.col(f"`{label}`"), spec.label_type, positives).alias("label_raw"),
        F.lit(spec.id).alias("source_id"),
        F.lit(path.rsplit("/", 1)[-1]).alias("source_file"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def load_sources(
    spark: SparkSession,
    manifest: DataFrame,
    folder: str,
    ids: Sequence[str] | None = None,
    positives: Sequence[str] = settings.POSITIVE_LABELS,
) -> tuple[DataFrame, DataFrame]:
    """(raw rows of all present sources with ``row_key``, per-source minimum lengths).

    Row ids follow the reading order of a file and are only stable once written: write
    the raw rows before building samples from them twice.
    """
    resolved = {row.id: row for row in resolve(spark, manifest, folder, ids).collect()}
    missing = [name for name, row in resolved.items() if row.status == "missing_required"]
    if missing:
        raise FileNotFoundError(f"required sources missing: {', '.join(missing)}")
    specs = [s for s in manifest.orderBy("rank").collect() if s.id in resolved and resolved[s.id].path]
    if not specs:
        raise FileNotFoundError(f"no source file found in {folder}")
    frames = [
        load_source(spark, resolved[s.id].path, s, positives).withColumn(
            "row_key", quality.ordered_key(F.lit(s.rank), F.col("row_id"))
        )
        for s in specs
    ]
    minimum = local_rows(spark, [(s.id, s.min_chars) for s in specs if s.min_chars is not None], "source_id string, min_chars int")
    return quality.union_sources(frames).drop("row_id"), minimum


def require_rows(samples: DataFrame, least: int = settings.MIN_MERGED_ROWS) -> DataFrame:
    """The merged samples, if there are enough of them to build splits on."""
    found = samples.limit(least).count()
    if found < least:
        raise ValueError(f"only {found} rows after merging, at least {least} are needed; add source files")
    return samples

