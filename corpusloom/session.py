"""Session helpers: test sessions, lineage cuts and size-checked small tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from . import settings


# Temporary folders of local sessions that name none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cores: str = "*", shuffle_partitions: int = 8, name: str = "corpusloom") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder is lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_FOLDERS.get(spark.sparkContext.applicationId)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL_FOLDERS.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="corpusloom-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Unlike ``checkpoint()`` this computes the frame once, and the planner knows the
    size of what was written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_wide(df: DataFrame, key: str) -> DataFrame:
    """:func:`cut_lineage` in at least two files per core, by a unique key.

    For rows with much work each, such as texts that become features: the planner sizes tasks by bytes, so a
    table of a few megabytes would be read by one or two of them.
    """
    return cut_lineage(df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key))


def bounded_batches(spark: SparkSession, rows: int = settings.TEXTS_PER_BATCH) -> None:
    """Let at most ``rows`` whole texts travel to a Python worker at once, from here on in this session.

    A plan of several Python steps keeps that many workers per task, and each keeps what its largest batch needed.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    spark.conf.set(name, str(min(rows, now) if now > 0 else rows))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a small single-file input over the cores of a local session, by key.

    On a cluster the frame is returned as it is: tables of that size have many splits, and
    texts should not be shuffled for parallelism.
    """
    if not df.sparkSession.sparkContext.master.startswith("local["):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


@dataclass(frozen=True)
class SmallTable:
    """A table whose size was checked; ``rows`` is None when it exceeded the limit."""

    frame: DataFrame
    rows: list[Row] | None

    @property
    def is_local(self) -> bool:
        return self.rows is not None


def small_table(df: DataFrame, limit: int = settings.LOCAL_TABLE_ROWS) -> SmallTable:
    """Turn ``df`` into a local relation when it has at most ``limit`` rows.

    The optimiser knows the exact size of a local relation and broadcasts it without a
    hint. Beyond the limit the frame is returned as it is, so that the join is planned
    as a shuffled one with adaptive skew handling.
    """
    table = df.limit(limit + 1).toArrow()
    if table.num_rows > limit:
        return SmallTable(df, None)
    return SmallTable(local_table(df.sparkSession, table, df.schema), [Row(**r) for r in table.to_pylist()])


def small_rows(df: DataFrame, limit: int = settings.LOCAL_TABLE_ROWS) -> list[Row]:
    """All rows of a table that must be small; an error, never a cut, beyond ``limit``."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows where a small table is needed")
    return rows


def local_table(spark: SparkSession, table: pa.Table, schema: StructType) -> DataFrame:
    """An Arrow table as a local relation, whose size the optimiser knows."""
    return spark.createDataFrame(table, schema)


def local_rows(spark: SparkSession, rows: Sequence[Sequence], schema: StructType | str) -> DataFrame:
    """A few driver-side rows as a local relation; ``schema`` may be DDL text."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    table = pa.Table.from_arrays(
        [pa.array(list(c), type=to_arrow_type(f.dataType)) for c, f in zip(columns, schema)],
        names=schema.names,
    )
    return local_table(spark, table, schema)
