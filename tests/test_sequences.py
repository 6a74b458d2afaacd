import datetime as dt
import math

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from daytally.operators import sequences

START = dt.date(2016, 1, 1)
SCHEMA = (
    "item_id string, store_id string, dept_id string, cat_id string, state_id string, date date, "
    "sales smallint, sell_price double, has_event int, day_of_week bigint, month bigint"
)


def panel(spark, series):
    made = [
        (item, "s", "dep", "cat", "CA", START + dt.timedelta(i), sales, price, None, 5, 1)
        for item, days in series.items()
        for i, sales, price in days
    ]
    return spark.createDataFrame(made, SCHEMA)


@pytest.fixture(scope="module")
def frame(spark):
    steady = [(i, i % 5, 2.0) for i in range(20)]
    late = [(i, 3, None if i < 10 else 4.0) for i in range(6, 20)]
    return sequences.sequence_frame(panel(spark, {"a": steady, "b": late}))


def test_frame_columns(frame):
    first = frame.filter("item_id = 'b'").orderBy("date").first()
    assert first["series_id"] == "s_b" and first["time_idx"] == 6
    texts = [first[c] for c in ("has_event", "snap_flag", "day_of_week", "month")]
    assert texts == ["0", "0", "5", "1"]
    assert first["sell_price_missing"] == "1" and first["sell_price"] == 4.0
    assert dict(frame.dtypes)["sales"] == "double"


def test_given_snap_flag_is_used(spark):
    df = panel(spark, {"a": [(0, 1, 1.0)]}).withColumn("snap_flag", F.lit(1.0))
    assert sequences.sequence_frame(df).first()["snap_flag"] == "1"


def brute_windows(n, encoder, horizon, first=0):
    return [
        (end, list(range(end - encoder + 1, end + 1)), list(range(end + 1, end + horizon + 1)))
        for end in range(first + encoder - 1, n - horizon)
    ]


def listed(windows):
    return sorted(
        (r["encoder_end_idx"], [s["time_idx"] for s in r["encoder"]], [s["time_idx"] for s in r["decoder"]])
        for r in windows.collect()
    )


def test_training_windows_match_brute_force(frame):
    got = sequences.training_windows(frame, encoder=6, horizon=3)
    last = 19 - 3 + 1
    assert listed(got.filter("series_id = 's_a'")) == brute_windows(last, 6, 3)
    assert listed(got.filter("series_id = 's_b'")) == brute_windows(last, 6, 3, first=6)
    row = got.first()
    assert row["encoder_length"] == 6 and row["relative_idx"] == list(range(-5, 4))


@pytest.mark.parametrize("chunk", [1, 4, 7, 64])
def test_chunks_give_the_same_windows(frame, chunk):
    """However finely a long series is cut, each window turns up once, and each step only nearby."""
    chunks = sequences.window_chunks(frame, encoder=6, horizon=3, chunk=chunk)
    got = sequences.cut_windows(chunks)
    assert listed(got) == listed(sequences.training_windows(frame, encoder=6, horizon=3))
    assert max(len(r["steps"]) for r in chunks.collect()) <= chunk + 6 + 3 - 1
    for r in got.collect():
        logs = [(math.log1p(s["sales"]) - r["target_center"]) / r["target_scale"] for s in r["encoder"]]
        assert r["encoder_target"] == pytest.approx(logs)


def test_stride_thins_the_ends(frame):
    got = sequences.training_windows(frame, encoder=6, horizon=3, stride=4)
    assert sorted({r["encoder_end_idx"] for r in got.collect()}) == [5, 9, 13]


def test_validation_window_is_the_last_one(frame):
    got = sequences.validation_windows(frame, encoder=6, horizon=3)
    assert listed(got) == [brute_windows(20, 6, 3)[-1]] * 2


def test_gaps_are_reported_and_never_bridged(spark):
    days = [(i, 1, 1.0) for i in range(30) if i != 14]
    frame = sequences.sequence_frame(panel(spark, {"a": days}))
    assert rows(sequences.missing_steps(frame), "time_idx", "step") == [(15, 2)]
    with pytest.raises(ValueError, match="gap"):
        sequences.require_dense(frame)
    got = sequences.training_windows(frame, encoder=6, horizon=3)
    for _, back, ahead in listed(got):
        assert back + ahead == list(range(back[0], back[0] + 9))


def test_scaling_uses_training_rows_only(frame):
    train = sequences.before_cutoff(frame, horizon=3)
    scaling = {r["series_id"]: r for r in sequences.target_scaling(train).collect()}
    logs = [math.log1p(i % 5) for i in range(17)]
    center = sum(logs) / 17
    spread = math.sqrt(sum((x - center) ** 2 for x in logs) / 16)
    assert scaling["s_a"]["target_center"] == pytest.approx(center)
    assert scaling["s_a"]["target_scale"] == pytest.approx(spread + 2**-10)
    scaled = sequences.scale_target(train, sequences.target_scaling(train))
    assert scaled.filter("series_id = 's_b'").first()["sales_scaled"] == pytest.approx(0.0)


def test_windows_hold_their_real_columns_as_arrays(frame):
    """Whoever reads only those cuts no structs, and no place is looked at by a function inside an array."""
    chunks = sequences.window_chunks(frame, encoder=6, horizon=3, chunk=7)
    for got in (sequences.cut_windows(chunks), sequences.validation_windows(frame, encoder=6, horizon=3)):
        for r in got.collect():
            for name in sequences.REALS:
                assert r[f"encoder_{name}"] == [s[name] for s in r["encoder"]]
                assert r[f"decoder_{name}"] == [s[name] for s in r["decoder"]]
    reals = sequences.cut_windows(chunks).select("encoder_end_idx", "encoder_sales", "decoder_sales", "encoder_target")
    text = plan(reals)
    assert "slice(steps" not in text and "filter(sequence" not in text
