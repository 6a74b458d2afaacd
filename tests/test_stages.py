import dataclasses

import pytest
from conftest import SMALL, csv_parts, plan, rows

from daytally.operators import models
from daytally.operators.boosting import TweedieBoosting
from daytally.operators.isolation import IsolationForest
from daytally.operators.models import Forest
from daytally.operators.quality import Limits
from daytally.plans import panel as P
from daytally.plans import stages
from daytally.schemas import MODEL_FEATURES
from daytally.sources import files

SETTINGS = stages.Settings(
    state=P.STATE,
    store=P.STORE,
    top_n=25,
    train_end=P.TRAIN_END,
    val_start=P.VAL_START,
    val_end=P.VAL_END,
    limits=Limits(first_date=P.GATE_FIRST, last_date=P.GATE_LAST),
    forest=Forest(trees=4, max_depth=4),
    boosting=TweedieBoosting(rounds=3, learning_rate=0.3, max_depth=3, min_rows=5),
    isolation=IsolationForest(trees=10),
    stride=50,
)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    # Days without a sale count as zero here, as in complete retail files.
    wide = P.wide_sales(spark, SMALL).fillna(0)
    return stages.RawFiles(
        files.write_csv(wide, f"{folder}/sales"),
        files.write_csv(P.calendar(spark, SMALL), f"{folder}/calendar"),
        files.write_csv(P.prices(spark, SMALL), f"{folder}/prices"),
    )


@pytest.mark.parametrize("schema", [None, "default"])
def test_full_run(spark, raw, tmp_path, schema):
    store = stages.Store(spark, str(tmp_path / "out"), schema=schema, partitions=4)
    outcome = stages.run_all(store, raw, SETTINGS)
    counts = outcome.row_counts
    assert counts["sales_long_rows"] == counts["joined_rows"] == 125 * 2499
    assert counts["calendar_rows"] == 2499
    features = store.read_panel("feature_table")
    assert features.count() == 125 * 2499
    predictions = store.read("val_predictions")
    assert predictions.columns == ["item_id", "store_id", "date", "actual", "predicted"]
    assert predictions.count() == store.read("val_rows").count() > 0
    anomalies = store.read("anomalies")
    assert anomalies.count() == predictions.count()
    assert csv_parts(outcome.anomalies)
    log = dict(rows(store.read("run_log"), "key", "value"))
    assert log["best_model_by_mae"] == outcome.best_model
    assert int(log["train_rows"]) == store.read("train_rows").count()
    best = models.load_model(store.at("models/best"))
    again = models.predict(best, store.read("val_rows"))
    assert rows(again, "item_id", "date", "predicted") == rows(predictions, "item_id", "date", "predicted")
    samples = stages.build_sequences(store, SETTINGS)
    assert samples["n_series"] == samples["validation_samples"] == 25
    logged = dict(rows(store.read("sequence_log"), "key", "value"))
    assert logged["max_encoder_length"] == "120" and logged["n_series"] == "25"
    encoded = store.read("encoded_frame")
    assert encoded.count() == store.read("sequence_frame").count()
    assert encoded.filter("item_id_code = 0 OR month_code = 0").isEmpty()
    assert models.example_rows(store.at("models/best")).columns == MODEL_FEATURES
    # Window ends from day 120 to the cutoff less the horizon, thinned by the stride.
    assert samples["training_samples"] == 25 * len(range(119, 2499 - 2 * 28, SETTINGS.stride))
    future = stages.forecast_all(store, SETTINGS)
    assert future.count() == 125 * 28 and future.filter("predicted < 0").isEmpty()
    asked = future.select("item_id", "store_id").distinct().limit(2).selectExpr("*", "3 AS horizon")
    requested = stages.forecast_requests(store, asked)
    assert requested.count() == 6
    assert set(rows(requested, "item_id", "date", "predicted")) <= set(rows(future, "item_id", "date", "predicted"))
    target = stages.anomalies_from_csv(
        spark, store.at("val_predictions_csv"), str(tmp_path / "flags"), SETTINGS
    )
    flagged = spark.read.option("header", True).csv(target)
    assert flagged.count() == anomalies.count()
    assert rows(flagged, "item_id", "is_anomaly") == [
        (i, str(f)) for i, f in rows(anomalies, "item_id", "is_anomaly")
    ]


def test_bucketed_table_is_registered_again(spark, tmp_path):
    """A catalog that has lost the table learns it from the folder, buckets included."""
    store = stages.Store(spark, str(tmp_path / "out"), schema="default", partitions=4)
    panel = P.sales_long(spark, SMALL).repartition(4, "item_id", "store_id")
    before = store.write_panel(panel, "lost_panel", 0)
    expected = before.groupBy("store_id").count().collect()
    spark.sql("DROP TABLE default.lost_panel")
    after = store.read_panel("lost_panel")
    assert after.schema.simpleString() == before.schema.simpleString()
    assert sorted(after.groupBy("store_id").count().collect()) == sorted(expected)
    assert "Exchange" not in plan(after.groupBy("item_id", "store_id").count())
    spark.sql("DROP TABLE default.lost_panel")


@pytest.mark.parametrize("part", ["sales", "calendar", "prices"])
def test_repeated_keys_stop_before_the_write(spark, raw, tmp_path, part):
    once = spark.read.option("header", True).csv(getattr(raw, part))
    twice = files.write_csv(once.unionByName(once.limit(1)), str(tmp_path / part))
    store = stages.Store(spark, str(tmp_path / "out"), partitions=4)
    with pytest.raises(ValueError, match="several rows"):
        stages.ingest(store, dataclasses.replace(raw, **{part: twice}))
    assert not (tmp_path / "out" / "sales_long").exists()


def test_buckets_follow_the_rows(spark):
    store = stages.Store(spark, "unused")
    assert store.buckets(0) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert store.buckets(100 * stages.BUCKET_ROWS) == 100


def test_failed_gate_stops_the_run(spark, raw, tmp_path):
    store = stages.Store(spark, str(tmp_path / "out"), partitions=4)
    stages.ingest(store, raw)
    stages.build_features(store, SETTINGS)
    with pytest.raises(ValueError, match="date_range_reasonable"):
        stages.check_features(store, stages.Settings())
    assert store.read("quality_report").count() == 9
