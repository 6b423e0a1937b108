"""The assessment on streaming posts: every rule looks at one row, so no state is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from .. import settings
from ..operators import risk

RESULT_COLUMNS = ("doc_id", "score", "model_tier", "display_tier", "flags", "confidence", "sentiment", "notes")


def assess_stream(
    posts: DataFrame,
    lexicons: risk.Lexicons,
    path: str,
    checkpoint: str,
    low: float = settings.TIER_LOW,
    high: float = settings.TIER_HIGH,
    once: bool = False,
) -> StreamingQuery:
    """Assess a stream of (doc_id, text, score) and append the results as Parquet.

    The automata of each lexicon must not exceed ``settings.AUTOMATA_AT_ONCE``, as a stream cannot be written in
    between. With ``once`` the query stops after what is available now. The file sink and the
    checkpoint together give exactly-once output.
    """
    assessed = risk.assess(posts.withColumnRenamed("score", "given"), "text", "given", lexicons, low, high)
    writer = assessed.select(*[F.col(c) for c in RESULT_COLUMNS]).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
