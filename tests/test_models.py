import math
import os
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tidewheel.functions import features_to_vector
from tidewheel.operators import cleaning, models, scoring
from tidewheel.plans import queries
from tidewheel.plans.views import Views
from tidewheel.session import written

SMALL = models.AlsParams(rank=4, iterations=3, blocks=2)


@pytest.fixture(scope="module")
def ratings(spark):
    return written(Views(spark, "/root/testdata/sf0.001").ratings(), "ratings")


@pytest.fixture(scope="module")
def parts(ratings):
    return cleaning.train_test_split(ratings)


@pytest.fixture(scope="module")
def model(parts):
    return models.fit_als(parts[0], SMALL)


def test_factors_are_not_negative_and_have_the_rank(model):
    for factors in (model.userFactors, model.itemFactors):
        lowest = factors.select(F.array_min("features").alias("m"), F.size("features").alias("n"))
        assert lowest.filter("m < 0 OR n <> 4").count() == 0


def test_same_seed_same_error(parts, model):
    first = models.model_rmse(model, parts[1])
    assert math.isfinite(first)
    assert first == pytest.approx(models.model_rmse(models.fit_als(parts[0], SMALL), parts[1]), abs=1e-6)


def test_predictions_agree_with_the_model(parts, model):
    ours = models.model_rmse(model, parts[1])
    evaluator = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    assert ours == pytest.approx(evaluator.evaluate(model.transform(parts[1])), abs=1e-5)


def test_rmse_formula(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "rating double, prediction double")
    assert models.rmse(df).first()["rmse"] == pytest.approx(math.sqrt(5 / 3))


def test_tuning_only_above_the_gate(parts):
    train, test = parts
    kept = models.tune_als_if_needed(train, test, threshold=100.0, params=SMALL)
    assert not kept.tuned and kept.model.rank == 4
    grid = [models.AlsParams(rank=r, iterations=2, regularization=0.5) for r in (2, 3)]
    tuned = models.tune_als_if_needed(train, test, threshold=0.0, grid=grid, folds=2, params=SMALL)
    assert tuned.tuned and tuned.model.rank in (2, 3) and math.isfinite(tuned.rmse)


def test_full_grid_has_eighteen_points():
    assert len({(p.rank, p.regularization, p.iterations) for p in models.full_grid()}) == 18


def test_factor_tables_are_written(spark, model, tmp_path):
    paths = models.export_factors(model, str(tmp_path))
    users = spark.read.parquet(paths["user_factors"])
    assert users.count() == model.userFactors.count()
    summary = models.training_summary(model, 1.25).first()
    assert summary["rmse"] == 1.25 and summary["rank"] == 4 and summary["user_factors"] == users.count()


def test_each_user_has_one_segment(model):
    segments = models.assign_segments(models.fit_segments(model.userFactors), model.userFactors)
    assert segments.count() == segments.select("user_idx").distinct().count() == model.userFactors.count()
    assert {r["segment"] for r in segments.select("segment").distinct().collect()} == set(range(5))
    assert segments.filter("segment_label IS NULL").count() == 0


def test_vectors_hold_the_features(spark):
    df = spark.createDataFrame([(1, [0.5, 2.0])], "id int, features array<float>")
    assert features_to_vector(df).first()["features_vec"].toArray().tolist() == [0.5, 2.0]


def test_history_votes(spark):
    ratings = spark.createDataFrame(
        [(1, 10), (2, 10), (3, 11), (9, 10), (9, 11), (8, 12)], "user_idx int, item_idx int"
    )
    segments = spark.createDataFrame([(1, 2), (2, 2), (3, 0)], "user_idx int, segment int")
    got = models.segment_by_history(ratings, segments).collect()
    assert [(r["user_idx"], r["segment"], r["votes"]) for r in got] == [(9, 2, 2)]
    tie = spark.createDataFrame([(1, 10), (3, 10), (9, 10)], "user_idx int, item_idx int")
    assert models.segment_by_history(tie, segments).first()["segment"] == 0


def brute_force(users, items, k):
    best = []
    for u, vector in users:
        scores = sorted(((-float(np.dot(np.float64(vector), np.float64(f))), i) for i, f in items))[:k]
        best += [(u, n + 1, i, round(-s, 6)) for n, (s, i) in enumerate(scores)]
    return sorted(best)


@pytest.mark.parametrize("cell_rows, tile", [(7, 4096), (40, 3), (None, 8), (None, 4096)])
def test_grid_scoring_equals_brute_force(spark, monkeypatch, cell_rows, tile):
    monkeypatch.setattr(scoring, "ITEM_TILE", tile)
    monkeypatch.setattr(scoring, "USER_TILE", 2 * tile)
    rng = np.random.default_rng(3)
    # Small whole numbers make many equal scores.
    users = [(n, rng.integers(0, 3, 4).astype(float).tolist()) for n in range(60)]
    items = [(n * 3, rng.integers(0, 3, 4).astype(float).tolist()) for n in range(50)]
    schema = "id int, features array<float>"
    got = scoring.top_k_by_factors(
        spark.createDataFrame(users, schema), spark.createDataFrame(items, schema), 5, cell_rows=cell_rows
    )
    rows = sorted((r["user_id"], r["rank"], r["item_id"], round(r["score"], 6)) for r in got.collect())
    assert rows == brute_force(users, items, 5)


@pytest.mark.parametrize("low", [-1.0, 0.0])
def test_stopping_early_loses_nothing(low):
    rng = np.random.default_rng(11)
    items = rng.uniform(low, 1, (400, 6)) * rng.pareto(1.0, (400, 1))
    users = rng.uniform(low, 1, (90, 6)).round(1)
    score = scoring._cell_scorer(5, [], ["user_id", "rank", "item_id", "score"], 32, 16)
    got = score(
        pd.DataFrame({"user_id": range(90), "features": list(users)}),
        pd.DataFrame({"item_id": range(400), "features": list(items)}),
    )
    rows = sorted((r.user_id, r.rank, r.item_id, round(r.score, 6)) for r in got.itertuples(index=False))
    assert rows == brute_force(list(enumerate(users)), list(enumerate(items)), 5)


def test_scoring_runs_where_the_package_is_not_installed(tmp_path):
    script = "import sys, pickle; print(pickle.load(open(sys.argv[1], 'rb')).__name__)"
    (tmp_path / "f").write_bytes(cloudpickle.dumps(scoring._cell_scorer(5, ["path"], ["user_id"], 8, 8)))
    done = subprocess.run(
        [sys.executable, "-c", script, str(tmp_path / "f")], cwd="/", capture_output=True, text=True,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    assert done.stdout.strip() == "score", done.stderr


def test_fewer_items_than_k_and_no_items(spark):
    schema = "id int, features array<float>"
    users = spark.createDataFrame([(1, [1.0])], schema)
    items = spark.createDataFrame([(4, [2.0]), (5, [3.0])], schema)
    assert [r["item_id"] for r in scoring.top_k_by_factors(users, items).orderBy("rank").collect()] == [5, 4]
    assert scoring.top_k_by_factors(users, items.limit(0)).count() == 0
    assert scoring.top_k_by_factors(users.limit(0), items).count() == 0


def test_one_frame_as_users_and_items(spark):
    factors = spark.createDataFrame([(n, [float(n), 1.0]) for n in range(6)], "id int, features array<float>")
    best = scoring.top_k_by_factors(factors, factors, 1).collect()
    assert sorted((r["user_id"], r["item_id"]) for r in best) == [(0, 0)] + [(n, 5) for n in range(1, 6)]


def test_model_lists_agree_with_the_library(parts, model):
    users = parts[0].select("user_idx").filter("user_idx >= 20")
    ours = scoring.top_k_by_model(model, users)
    theirs = (
        model.recommendForUserSubset(users, 5)
        .select("user_idx", F.posexplode("recommendations").alias("place", "e"))
        .selectExpr("user_idx AS user_id", "place + 1 AS rank", "e.rating AS rating")
    )
    both = ours.join(theirs, ["user_id", "rank"])
    assert both.count() == ours.count() == theirs.count() > 0
    assert both.filter("abs(score - rating) > 1e-4").count() == 0


def test_a_cell_takes_arrow_tables_and_keeps_ties_over_many_tiles():
    """Scores that repeat over all tiles, so that lists that are full are reached again and again."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    vectors, who = rng.integers(-2, 3, (700, 3)).astype(float), rng.integers(-2, 3, (40, 3)).astype(float)
    ids = rng.permutation(700)
    items = pa.table({"item_id": pa.array(ids), "features": pa.array(vectors.tolist(), pa.list_(pa.float32()))})
    users = pa.table({"user_id": pa.array(range(40)), "features": pa.array(who.tolist(), pa.list_(pa.float32())), "path": ["p"] * 40})
    got = scoring._cell_scorer(5, ["path"], ["user_id", "path", "rank", "item_id", "score"], 16, 32)(users, items)
    assert isinstance(got, pa.Table)
    expected = []
    for user, vector in enumerate(who):
        best = sorted(zip(-(vectors @ vector), ids.tolist(), strict=True))[:5]
        expected += [(user, "p", n + 1, item, -score) for n, (score, item) in enumerate(best)]
    assert [tuple(row.values()) for row in got.to_pylist()] == expected


@pytest.mark.parametrize("name", ["fit_als", "training_summary"])
def test_the_test_part_is_drawn_once(spark, monkeypatch, name):
    """All passes over the test part read a stored table, and nothing draws it anew."""
    given, predict, fit = [], models.predict, models.fit_als

    def recorded(pairs, *factors):
        given.append(pairs)
        return predict(pairs, *factors)

    monkeypatch.setattr(models, "predict", recorded)
    monkeypatch.setattr(models, "fit_als", lambda train: fit(train, SMALL))
    queries.queries()[name](spark, "/root/testdata/sf0.001").collect()
    (pairs,) = given
    assert pairs._stored_at and "md5" not in pairs._jdf.queryExecution().toString()


def test_short_fits_do_not_compute_the_first_iteration_again(spark):
    assert models.als_estimator(spark).getCheckpointInterval() == -1
    assert models.als_estimator(spark, models.AlsParams(iterations=40)).getCheckpointInterval() == 10
