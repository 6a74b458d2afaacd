"""Sequence frame, encoder/decoder windows and per-series target scaling."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daytally.functions.columns import flag
from daytally.functions.series import fill_both_ways, with_series_windows
from daytally.schemas import ROW, SERIES, require_columns

# Window lengths, static and step columns of the training set.
ENCODER = 120
HORIZON = 28
STATIC = ["store_id", "item_id", "dept_id", "cat_id", "state_id"]
KNOWN_CATEGORIES = ["has_event", "day_of_week", "month", "sell_price_missing"]
KNOWN_REALS = ["time_idx", "sell_price"]
# Smallest half-precision step, added to the deviation so that it is never zero.
SCALE_EPSILON = 2.0**-10

GROUP = ["series_id"]
# Window ends per stored chunk.
CHUNK_DAYS = 512
# Columns of the steps that windows also hold as arrays of their own.
REALS = [*KNOWN_REALS, "sales"]
# What the windows read of the sequence frame; the features it carries besides need not be stored.
WINDOW_COLUMNS = [*GROUP, *STATIC, *REALS, *KNOWN_CATEGORIES]


def sequence_frame(features: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Day index, series name, categories as text, and prices filled within their own series."""
    require_columns(features, [*ROW, *STATIC[2:], "sales", "sell_price"], "feature table")
    start = features.select(F.min("date")).scalar()
    snap = F.col("snap_flag") if "snap_flag" in features.columns else F.lit(0)

    def category(value: Column) -> Column:
        return value.cast("int").cast("string")

    rows = features.withColumns(
        {
            "time_idx": F.datediff("date", start).cast("bigint"),
            "series_id": F.concat(F.col("store_id"), F.lit("_"), F.col("item_id")),
            **{name: F.col(name).cast("string") for name in STATIC},
            "has_event": category(F.coalesce("has_event", F.lit(0))),
            "snap_flag": category(F.coalesce(snap, F.lit(0))),
            "sales": F.col("sales").cast("double"),
            "sell_price_missing": flag(F.col("sell_price").isNull()).cast("string"),
            "day_of_week": category(F.col("day_of_week")),
            "month": category(F.col("month")),
        }
    )
    return fill_both_ways(rows, "sell_price", hot=hot)


def training_cutoff(frame: DataFrame, horizon: int = HORIZON) -> Column:
    """Last day index of the training part, as a scalar subquery."""
    return frame.select(F.max("time_idx") - horizon).scalar()


def before_cutoff(frame: DataFrame, horizon: int = HORIZON) -> DataFrame:
    return frame.filter(F.col("time_idx") <= training_cutoff(frame, horizon))


def missing_steps(frame: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Rows whose series skips or repeats a day index just before them."""

    def step(w: WindowSpec) -> dict[str, Column]:
        return {"step": F.col("time_idx") - F.lag("time_idx").over(w)}

    rows = with_series_windows(frame, step, back=1, hot=hot)
    return rows.filter("step <> 1").select(*GROUP, *ROW, "time_idx", "step")


def require_dense(frame: DataFrame, hot: DataFrame | None = None) -> None:
    example = missing_steps(frame, hot).take(1)
    if example:
        raise ValueError(f"a series has a gap or a repeated day: {example[0].asDict()}")


def target_scaling(train: DataFrame) -> DataFrame:
    """Centre and scale of log1p(sales) per series, from training rows only."""
    level = F.log1p("sales")
    return train.groupBy(*GROUP).agg(
        F.avg(level).alias("target_center"),
        (F.stddev_samp(level) + SCALE_EPSILON).alias("target_scale"),
    )


def scaled_target(sales: Column) -> Column:
    return (F.log1p(sales) - F.col("target_center")) / F.col("target_scale")


def scale_target(frame: DataFrame, scaling: DataFrame) -> DataFrame:
    return frame.join(scaling, GROUP).withColumn("sales_scaled", scaled_target(F.col("sales")))


def step_struct() -> Column:
    return F.struct(*KNOWN_REALS, "sales", *KNOWN_CATEGORIES)


def window_chunks(
    frame: DataFrame, encoder: int = ENCODER, horizon: int = HORIZON, chunk: int = CHUNK_DAYS
) -> DataFrame:
    """The training part as arrays to cut windows from: one row per series and ``chunk`` window ends.

    A chunk holds the days of its own ends, those the first encoder reaches back to, and those of the
    last decoder, so a step is stored about 1 + (encoder + horizon) / chunk times instead of once per
    window. ``targets`` are the scaled sales of ``steps``. Chunks bound what a task gathers, however
    long a series is; rows without a date are left out. Rows hashed by series are not shuffled.
    """
    train = before_cutoff(frame, horizon).filter("time_idx IS NOT NULL")

    def of(day: Column) -> Column:
        return F.floor(day / chunk)

    reach = F.sequence(of(F.col("time_idx") - horizon), of(F.col("time_idx") + (encoder - 1)))
    steps = F.sort_array(F.collect_list(step_struct())).alias("steps")
    rows = train.withColumn("chunk", F.explode(reach))
    chunks = rows.groupBy(*SERIES, *GROUP, *STATIC[2:], "chunk").agg(steps)
    chunks = chunks.filter(F.size("steps") >= encoder + horizon).join(target_scaling(train), GROUP)
    targets = F.transform("steps", lambda step: scaled_target(step["sales"]))
    own = F.struct(F.lit(encoder).alias("encoder"), F.lit(horizon).alias("horizon"), F.lit(chunk).alias("days"))
    return chunks.select(*GROUP, *STATIC, "chunk", own.alias("layout"), "target_center", "target_scale", "steps", targets.alias("targets"))


def _ends(stride: int) -> tuple[Column, Callable[[Column, Column], Column]]:
    """Places in ``steps`` that may end a window, and which of them end a complete, gap-free one, by the
    array of day indices. A chunk counts only the ends on its own days."""
    encoder, horizon, days = (F.col(f"layout.{n}") for n in ("encoder", "horizon", "days"))

    def complete(place: Column, time_idx: Column) -> Column:
        def day(at: Column) -> Column:
            return F.get(time_idx, at - 1)

        own = F.floor(day(place) / days) == F.col("chunk")
        dense = day(place + horizon) - day(place - encoder + 1) == encoder + horizon - 1
        kept = F.pmod(day(place) - (encoder - 1), F.lit(stride)) == 0
        return own & dense & kept

    return F.sequence(encoder, F.size("steps") - horizon), complete


def window_index(chunks: DataFrame, stride: int = 1) -> DataFrame:
    """``chunks`` with ``ends``: the places in ``steps`` that end a window. ``stride`` thins them by day index."""
    places, complete = _ends(stride)
    timed = chunks.withColumn("_time_idx", F.col("steps.time_idx"))
    return timed.withColumn("ends", F.filter(places, lambda place: complete(place, F.col("_time_idx")))).drop("_time_idx")


def cut_windows(chunks: DataFrame, stride: int = 1) -> DataFrame:
    """The windows themselves, as slices of the chunks; nothing is shuffled.

    The real columns of the steps are there as arrays of their own too (``encoder_sales`` and so on), cut
    from the chunk's array of that column. Who reads only those does not pay for slices of structs.
    """
    encoder, horizon = F.col("layout.encoder"), F.col("layout.horizon")
    reals = {f"_{name}": F.col(f"steps.{name}") for name in REALS}
    carried = [*GROUP, *STATIC, "chunk", "layout", "target_center", "target_scale", "steps", "targets", *reals]
    places, complete = _ends(stride)
    # Every place is a row before the choice: a filter inside an array would run uncompiled.
    placed = chunks.withColumns(reals).select(*carried, F.explode(places).alias("_at"))
    placed = placed.filter(complete(F.col("_at"), F.col("_time_idx")))

    def parts(values: str, name: str) -> tuple[Column, Column]:
        back = F.slice(values, F.col("_at") - encoder + 1, encoder)
        return back.alias(f"encoder{name}"), F.slice(values, F.col("_at") + 1, horizon).alias(f"decoder{name}")

    return placed.select(
        *GROUP,
        *STATIC,
        F.get("_time_idx", F.col("_at") - 1).alias("encoder_end_idx"),
        encoder.alias("encoder_length"),
        F.sequence(1 - encoder, horizon).alias("relative_idx"),
        "target_center",
        "target_scale",
        *parts("steps", ""),
        *parts("targets", "_target"),
        *(part for name in REALS for part in parts(f"_{name}", f"_{name}")),
    )


def training_windows(
    frame: DataFrame, encoder: int = ENCODER, horizon: int = HORIZON, stride: int = 1
) -> DataFrame:
    """Every window inside the training part; ``stride`` thins the window ends by day index.

    To keep windows, store ``window_chunks`` and cut them on reading: written out, a row would turn
    up in up to encoder + horizon windows.
    """
    return cut_windows(window_chunks(frame, encoder, horizon), stride)


def _described(windows: DataFrame, scaling: DataFrame, encoder: int, horizon: int) -> DataFrame:
    relative = F.sequence(F.lit(1 - encoder), F.lit(horizon))

    def target(steps: str) -> Column:
        return F.transform(steps, lambda step: scaled_target(step["sales"])).alias(f"{steps}_target")

    return windows.join(scaling, GROUP).select(
        *GROUP,
        *STATIC,
        "encoder_end_idx",
        F.size("encoder").alias("encoder_length"),
        relative.alias("relative_idx"),
        "target_center",
        "target_scale",
        "encoder",
        "decoder",
        target("encoder"),
        target("decoder"),
        *(F.col(f"{part}.{name}").alias(f"{part}_{name}") for name in REALS for part in ("encoder", "decoder")),
    )


def validation_windows(
    frame: DataFrame, encoder: int = ENCODER, horizon: int = HORIZON
) -> DataFrame:
    """The last window of each series: its decoder is the series' final ``horizon`` days.

    At most encoder + horizon rows per series are gathered; the rank limit drops the others
    before the shuffle.
    """
    length = encoder + horizon
    newest = Window.partitionBy(*GROUP).orderBy(F.desc("time_idx"))
    steps = F.sort_array(F.collect_list(step_struct()))
    tails = (
        frame.withColumn("_age", F.row_number().over(newest))
        .filter(F.col("_age") <= length)
        .groupBy(*GROUP, *STATIC)
        .agg(steps.alias("_steps"), (F.max("time_idx") - F.min("time_idx")).alias("_span"))
        .filter((F.size("_steps") == length) & (F.col("_span") == length - 1))
    )
    windows = tails.withColumns(
        {
            "encoder": F.slice("_steps", 1, encoder),
            "decoder": F.slice("_steps", encoder + 1, horizon),
            "encoder_end_idx": F.get("_steps", F.lit(encoder - 1))["time_idx"],
        }
    )
    return _described(windows, target_scaling(before_cutoff(frame, horizon)), encoder, horizon)
