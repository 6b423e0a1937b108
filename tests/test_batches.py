from corpusloom import settings
from corpusloom.plans import artifacts
from corpusloom.session import bounded_batches

NAME = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Candidate:
    """Stands for a fitted candidate; notes how many rows travel at once while it scores."""

    space = type("Space", (), {"lexicons": None})

    def score(self, df):
        self.rows = int(df.sparkSession.conf.get(NAME))
        return df.selectExpr("*", "0.5D AS score")


def test_stored_candidates_score_in_small_batches(spark):
    before = spark.conf.get(NAME)
    try:
        spark.conf.set(NAME, "10000")
        candidate = Candidate()
        scored = artifacts.score_texts(candidate, spark.createDataFrame([(1, "a b")], "id long, text string"), "text", 0.3, 0.7, "v1")
        assert candidate.rows == settings.TEXTS_PER_BATCH and scored.count() == 1
        spark.conf.set(NAME, "100")
        bounded_batches(spark)
        assert spark.conf.get(NAME) == "100"
    finally:
        spark.conf.set(NAME, before)
