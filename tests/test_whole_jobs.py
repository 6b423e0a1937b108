"""Registered fits run over all their rows and at the published numbers of rounds."""

import inspect

import pytest

from corpusloom import settings
from corpusloom.catalog import model_queries
from corpusloom.operators import models, splits
from corpusloom.plans import experiments


class Seen(Exception):
    """Ends a run at the call that was looked for; its arguments are those of the call, defaults included."""

    @classmethod
    def at(cls, fn):
        def stop(*args, **named):
            bound = inspect.signature(fn).bind(*args, **named)
            bound.apply_defaults()
            raise cls(bound.arguments)

        return stop


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """150 documents, labels and vectors in three words that tell the labels apart."""
    path = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, f"{'good' if i % 3 else 'bad'} words come in document {'abcdefgh'[i % 8] * 3} here", "en", f"src{i % 20}", 40) for i in range(150)]
    tables = {
        "documents": spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(150)], "doc_id long, quality int, toxic int"),
        "embeddings": spark.createDataFrame([(i, [float(i % 3), float(i % 7)], i % 10) for i in range(150)], "vec_id long, embedding array<float>, label int"),
    }
    for name, table in tables.items():
        table.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def test_m04_boosts_all_published_rounds(spark, folder, monkeypatch):
    monkeypatch.setattr(experiments, "fit_candidate", Seen.at(experiments.fit_candidate))
    with pytest.raises(Seen) as seen:
        model_queries.QUERIES["m04_boosting"](spark, folder)
    estimator = seen.value.args[0]["estimator"]
    assert (estimator.getMaxIter(), estimator.getMaxDepth()) == (settings.BOOSTING_ROUNDS, settings.BOOSTING_DEPTH)


def test_m11_searches_over_all_published_rounds(spark, folder, monkeypatch):
    monkeypatch.setattr(models, "grid", Seen.at(models.grid))
    with pytest.raises(Seen) as seen:
        model_queries.QUERIES["m11_grid"](spark, folder)
    called = seen.value.args[0]
    assert (called["rounds"], called["k"], tuple(called["steps"])) == (settings.BOOSTING_ROUNDS, settings.CV_FOLDS, settings.GRID_STEPS)


def test_v14_boosts_all_published_rounds(spark, folder, monkeypatch):
    monkeypatch.setattr(experiments, "out_of_domain", Seen.at(experiments.out_of_domain))
    with pytest.raises(Seen) as seen:
        model_queries.QUERIES["v14_out_of_domain"](spark, folder)
    candidates = seen.value.args[0]["candidates"](100.0)
    assert candidates["boosting"].getMaxIter() == settings.OOV_BOOSTING_ROUNDS


@pytest.mark.parametrize("name", ["m09_run_facts", "m09_training_run"])
def test_m09_fits_every_training_row(spark, folder, monkeypatch, name):
    train, _, _ = model_queries._cut(spark, folder)
    monkeypatch.setattr(splits.cap, "__defaults__", (30, settings.SEED))
    monkeypatch.setattr(experiments, "fit_candidate", Seen.at(experiments.fit_candidate))
    with pytest.raises(Seen) as seen:
        model_queries.QUERIES[name](spark, folder)
    assert seen.value.args[0]["train"].count() == train.count() > 30
