"""Reading sources: CSV with unknown encoding and columns, bundles, import report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings
from ..operators.quality import dedupe_first

_BOM = "﻿"


def read_posts(spark: SparkSession, path: str, multi_line: bool | None = None, encoding: str | None = None) -> DataFrame:
    """Read CSV files with a header; every column is a string, empty cells are null.

    One look at the lines settles two things per file. Encoding: UTF-8 where all bytes are valid, else Latin-1, so a file that
    really contains U+FFFD stays as it is and one broken file does not change the others. Line breaks inside quotes: only
    a file with a line whose quotes do not close is read as a whole, all others are split among tasks. A caller that knows both
    names them, and nothing is read twice.
    """

    def load(files: str | list[str], charset: str, whole: bool) -> DataFrame:
        frame = spark.read.csv(files, header=True, multiLine=whole, quote='"', escape='"', encoding=charset, inferSchema=False)
        return frame.toDF(*[name.lstrip(_BOM).removeprefix("\u00ef\u00bb\u00bf") for name in frame.columns])

    if multi_line is not None and encoding is not None:
        return load(path, encoding, multi_line)
    quotes = F.octet_length("value") - F.octet_length(F.replace(F.col("value").cast("binary").cast("string"), F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("ok"), (quotes % 2 == 1).alias("open")
    )
    checked = lines.groupBy("file").agg(F.min("ok").alias("ok"), F.max("open").alias("open")).collect()  # one row per file
    groups: dict[tuple[str, bool], list[str]] = {}
    for row in checked:
        charset = encoding or ("UTF-8" if row.ok else "ISO-8859-1")
        groups.setdefault((charset, row.open if multi_line is None else multi_line), []).append(row.file)
    if not groups:
        return load(path, "UTF-8", False)
    frames = [load(sorted(files), charset, whole) for (charset, whole), files in sorted(groups.items(), reverse=True)]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def pick_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First candidate present, by exact name or else ignoring case."""
    by_lower = {name.lower(): name for name in columns}
    for name in candidates:
        if name in columns:
            return name
        if name.lower() in by_lower:
            return by_lower[name.lower()]
    return None


def detect_columns(df: DataFrame) -> tuple[str | None, str | None]:
    """(text column, label column), from the schema alone."""
    return pick_column(df.columns, settings.TEXT_COLUMNS), pick_column(df.columns, settings.LABEL_COLUMNS)


def normalise_columns(df: DataFrame, text: str | None = None, label: str | None = None) -> DataFrame:
    """Rename the text and label column to text_raw and label_raw; other columns stay."""
    found_text, found_label = detect_columns(df)
    text, label = text or found_text, label or found_label
    if text is None or label is None:
        raise ValueError(f"could not detect text and label columns in {df.columns}")
    return df.withColumnsRenamed({text: "text_raw", label: "label_raw"})


def two_class(df: DataFrame, label: str, classes: Sequence[str] = settings.TWO_CLASS_LABELS) -> DataFrame:
    return df.filter(F.col(label).isin(list(classes)))


def import_report(df: DataFrame, source: str, text: str, label: str, row_key: str) -> DataFrame:
    """Per source: rows and positives after deduplication inside the source, and the rows
    that remain after deduplication across sources (first ``row_key`` wins)."""
    inside = dedupe_first(df, [source, text], row_key)
    across = dedupe_first(inside, [text], row_key).select(row_key, F.lit(1).alias("_kept"))
    joined = inside.select(source, label, row_key).join(across, row_key, "left")
    return joined.groupBy(source).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(label).cast("string") == "1").alias("n_positive"),
        F.count("_kept").alias("n_merged"),
    )


@dataclass(frozen=True)
class Bundle:
    """Train, test and optional validation frames with columns text_raw, label_raw."""

    train: DataFrame
    test: DataFrame
    val: DataFrame | None
    note: str


def prepare(df: DataFrame) -> DataFrame:
    """text_raw / label_raw of a source frame without blanks and repeated texts.

    A CSV carries no row number. The id follows Spark's partition order, which for a
    file is its reading order; the first copy of a text is kept.
    """
    named = normalise_columns(df).select("text_raw", "label_raw")
    kept = named.filter(F.col("text_raw").isNotNull() & (F.length("text_raw") > 0))
    rows = kept.select("text_raw", F.trim("label_raw").alias("label_raw"), F.monotonically_increasing_id().alias("_row"))
    first = F.min(F.struct("_row", "label_raw"))
    return rows.groupBy("text_raw").agg(first["label_raw"].alias("label_raw"))


def load_pair(spark: SparkSession, train: str, test: str) -> Bundle:
    """Two declared files as train and test."""
    return Bundle(
        prepare(read_posts(spark, train)), prepare(read_posts(spark, test)), None, f"declared train/test: {train}, {test}"
    )


def load_single(spark: SparkSession, path: str, test_fraction: float = 0.2, seed: int = settings.SEED) -> Bundle:
    """One file cut into train and test by label."""
    from ..functions.text import fingerprint
    from ..operators.splits import holdout

    frame = prepare(read_posts(spark, path)).withColumn("_key", F.sha2("text_raw", 256))
    cut = holdout(frame, "_key", "label_raw", test_fraction, seed, "_test").drop("_key")
    return Bundle(cut.filter(~F.col("_test")).drop("_test"), cut.filter("_test").drop("_test"), None, f"single file: {path}")


def load_bundle(
    spark: SparkSession,
    folder: str,
    store: str | None = None,
    pair: tuple[str, str] | None = None,
    single: str | None = None,
) -> Bundle:
    """First layout present: stored table, train/val/test files, a declared pair, one file."""
    from . import files
    from .store import read_samples

    if store is not None and files.exists(spark, store):
        samples = {name: read_samples(spark, store, name).select("text_raw", "label_raw") for name in ("train", "val", "test")}
        return Bundle(samples["train"], samples["test"], samples["val"], f"store: {store}")
    train, val, test = (files.join(folder, f"{name}.csv") for name in ("train", "val", "test"))
    if files.exists(spark, train) and files.exists(spark, test):
        extra = prepare(read_posts(spark, val)) if files.exists(spark, val) else None
        return Bundle(prepare(read_posts(spark, train)), prepare(read_posts(spark, test)), extra, "split files")
    if pair is not None and all(files.exists(spark, files.join(folder, name)) for name in pair):
        return load_pair(spark, files.join(folder, pair[0]), files.join(folder, pair[1]))
    if single is not None and files.exists(spark, files.join(folder, single)):
        return load_single(spark, files.join(folder, single))
    raise FileNotFoundError(f"no known layout under {folder}")
