"""Stored candidates: one versioned artifact per training run, read back as a whole.

A version is a folder with the vocabulary, the lexicons, the scaler and model stages, and a manifest with everything
else. The manifest is written last: a folder without it is the rest of a run that did not finish, and is never read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, models, risk
from ..session import bounded_batches, local_rows, small_rows, small_table
from ..sources import files
from .experiments import FeatureSpace, Fitted

_LEXICONS = ("valence", "terms", "positive", "negative", "names")
_MANIFEST = (
    "version long, folder string, name string, threshold double, low double, high double, dense array<string>, size int, "
    "data_digest string, n_rows long, has_lexicons boolean, members int, platt array<struct<slope: double, intercept: double>>, "
    "member_platt array<struct<slope: double, intercept: double>>"
)


@dataclass(frozen=True)
class Artifact:
    """A candidate with its cut-offs and the digest of its training data."""

    candidate: Fitted
    low: float
    high: float
    data_digest: str
    n_rows: int
    version: int

    @property
    def name(self) -> str:
        return f"{self.candidate.name}-v{self.version}"

    def score(self, df: DataFrame, text: str) -> DataFrame:
        """Adds model_score, both tiers, flags and the version; other columns stay, text features go."""
        return score_texts(self.candidate, df, text, self.low, self.high, self.name)


def _manifests(spark: SparkSession, path: str) -> list:
    folders = files.glob(spark, files.join(path, "*", "manifest", "_SUCCESS"))
    if not folders:
        return []
    read = spark.read.schema(_MANIFEST).json([f.rsplit("/", 1)[0] for f in folders])
    return sorted(small_rows(read), key=lambda r: (r.version, r.folder))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that were written completely."""
    return [r.version for r in _manifests(spark, path)]


def _pair(platt: models.Platt | None) -> list[tuple[float, float]]:
    return [] if platt is None else [(platt.slope, platt.intercept)]


def save(candidate: Fitted, path: str, low: float, high: float, data_digest: str, n_rows: int) -> int:
    """Write a candidate as the next version and return its number."""
    space = candidate.space
    spark = space.vocab.sparkSession
    version = max(versions(spark, path), default=0) + 1
    folder = files.join(path, f"{version:06d}-{uuid.uuid4().hex}")
    space.vocab.write.parquet(files.join(folder, "vocab"))
    if space.lexicons is not None:
        for name in _LEXICONS:
            getattr(space.lexicons, name).write.parquet(files.join(folder, "lexicons", name))
    svm = candidate.model if isinstance(candidate.model, models.CalibratedSvm) else None
    members = [m for m, _ in svm.members] if svm else [candidate.model]
    candidate.scaler.write().save(files.join(folder, "scaler"))
    for i, member in enumerate(members):
        PipelineModel(stages=[member]).write().save(files.join(folder, f"model-{i}"))
    row = (
        version, folder, candidate.name, candidate.threshold, low, high, list(space.dense), space.size, data_digest, n_rows,
        space.lexicons is not None, len(svm.members) if svm else 0, _pair(candidate.platt),
        [_pair(p)[0] if p else (None, None) for _, p in svm.members] if svm else [],
    )
    spark.createDataFrame([row], _MANIFEST).coalesce(1).write.json(files.join(folder, "manifest"))
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> Artifact:
    """The given version, or the latest complete one."""
    found = [r for r in _manifests(spark, path) if version is None or r.version == version]
    if not found:
        raise ValueError(f"no complete artifact{'' if version is None else f' of version {version}'} in {path}")
    m = found[-1]
    lexicons = None
    if m.has_lexicons:
        lexicons = risk.Lexicons(*[spark.read.parquet(files.join(m.folder, "lexicons", name)) for name in _LEXICONS])
    vocab = small_table(spark.read.parquet(files.join(m.folder, "vocab"))).frame
    members = [PipelineModel.load(files.join(m.folder, f"model-{i}")).stages[0] for i in range(max(m.members, 1))]
    model = members[0]
    if m.members:
        platts = [None if p.slope is None else models.Platt(p.slope, p.intercept) for p in m.member_platt]
        model = models.CalibratedSvm(list(zip(members, platts)))
    platt = models.Platt(m.platt[0].slope, m.platt[0].intercept) if m.platt else None
    space = FeatureSpace(vocab, m.size, tuple(m.dense), lexicons)
    candidate = Fitted(m.name, space, PipelineModel.load(files.join(m.folder, "scaler")), model, m.threshold, platt)
    return Artifact(candidate, m.low, m.high, m.data_digest, m.n_rows, m.version)


def score_texts(candidate: Fitted, df: DataFrame, text: str, low: float, high: float, version: str) -> DataFrame:
    """Scores, both tiers and flags of a table of texts in one pass; all input columns stay.

    Without lexicons there is no rule layer, and the displayed tier is the model's.
    """
    from ..functions.text import clean_text

    bounded_batches(df.sparkSession)
    added = {"clean": clean_text(F.col(text)), "key": F.monotonically_increasing_id()}
    inner = df.select(F.struct(*df.columns).alias("_row"), F.col(text).alias("_text")).withColumns(
        {"clean": clean_text(F.col("_text")), "key": added["key"]}
    )
    scored = candidate.score(inner).withColumnRenamed("score", "model_score")
    lexicons = candidate.space.lexicons
    if lexicons is None:
        tier = risk.model_tier(F.col("model_score"), *risk.sane_cutoffs(F.lit(low), F.lit(high)))
        done = scored.withColumns({"model_tier": tier, "display_tier": tier, "flags": F.array().cast("array<string>")})
    else:
        kept = scored.select("_row", "_text", "model_score")
        done = risk.assess(kept, "_text", "model_score", lexicons, low, high)
    result = ("model_score", "model_tier", "display_tier", "flags")
    return done.withColumn("model_version", F.lit(version)).select("_row.*", *result, "model_version")
