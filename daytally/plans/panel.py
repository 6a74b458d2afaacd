"""A daily panel derived from the order tables: brand is the item, supplier region the store.

Every frame has the shape the operators expect from raw retail data (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daytally.schemas import PASS_THROUGH, ROW, SERIES, WIDE_IDS
from daytally.sources.files import read_table

# Fixed values of the mapping.
STORE = "AMERICA"
STATE = "AM"
PARTS_PER_ITEM = 4000
TOP_ITEMS = 100
TRAIN_END = "2001-07-01"
VAL_START = "2001-07-02"
VAL_END = "2001-07-29"
GATE_FIRST = "1995-01-01"
GATE_LAST = "2001-12-31"
WEEK_BASE = 10000
QUARTER_DAYS = 91
HALF_DAYS = 182
HORIZON = 28
# Longest requested forecast, in weeks.
REQUEST_WEEKS = 4
# Panel rows or order lines of one task, about, so that its sums, sorts and windows stay the same at every size.
TASK_ROWS = 250_000


# The columns of the given tables that the mapping reads; naming them saves a schema job per scan.
COLUMNS = {
    "lineitem": "l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_brand string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", COLUMNS[name])


def ship_day() -> Column:
    return F.col("l_shipdate").cast("date")


def first_day(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "lineitem").select(F.min(ship_day())).scalar()


def last_day(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "lineitem").select(F.max(ship_day())).scalar()


def item_name() -> Column:
    """Parts of a brand are told apart by key range, so the number of series grows with the data."""
    group = F.expr(f"p_partkey div {PARTS_PER_ITEM}").cast("string")
    return F.concat_ws("_", "p_brand", group)


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sales of an item in a store on a day.

    Joins are left to statistics and AQE: a dimension is broadcast only below Spark's size limit,
    and a hot part or supplier key is split by the skew-join rule. Each dimension is joined on its
    own, because the size estimate of a join of dimensions is their product.
    """
    items = table(spark, sf_dir, "part").select("p_partkey", item_name().alias("item_id"))
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_name", "store_id")
    return (
        table(spark, sf_dir, "lineitem")
        .join(items, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            *SERIES,
            ship_day().alias("date"),
            F.col("l_quantity").cast("bigint").alias("units"),
            # Half up for positive prices, without the decimal detour of round().
            F.floor(F.col("l_extendedprice") * 100 + 0.5).alias("cents"),
        )
    )


def daily_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units and cents per (item, store, date) that saw a sale.

    Few lines are partly summed before the shuffle. More than ``TASK_ROWS`` a core are dealt by the
    keys before they are summed: a sum's table in memory would grow with the split read, and with
    the rows of one of a fixed number of partitions. A hot series is spread by its days.
    """
    sums = [F.sum(name).alias(name) for name in ("units", "cents")]
    lines = sale_lines(spark, sf_dir)
    tasks = -(-table(spark, sf_dir, "lineitem").count() // TASK_ROWS)
    if tasks > spark.sparkContext.defaultParallelism:
        lines = lines.repartition(tasks, *ROW)
    return lines.groupBy(*ROW).agg(*sums)


def panel_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks among which the filled panel is dealt by series, at most ``TASK_ROWS`` rows each.

    What is shuffled are the days with a sale; filling makes them many times as large, which AQE
    cannot see when it joins small partitions. The number of items may be off by a few percent.
    """
    items = table(spark, sf_dir, "part").select(F.approx_count_distinct(item_name()))
    stores = table(spark, sf_dir, "region").select(F.count_distinct("r_name"))
    lines = table(spark, sf_dir, "lineitem").agg(
        F.count("*").alias("lines"), (F.datediff(F.max(ship_day()), F.min(ship_day())) + 1).alias("days")
    )
    found = lines.select("*", items.scalar().alias("items"), stores.scalar().alias("stores")).first()
    # No more series than order lines, whatever the product says.
    series = min(found["items"] * found["stores"], found["lines"])
    return max(1, -(-series * (found["days"] or 0) // TASK_ROWS))


def dealt_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily units, each series in one of ``panel_tasks`` partitions; a panel that needs no more tasks than
    there are cores is left to AQE."""
    return dealt(spark, sf_dir, daily_units(spark, sf_dir), SERIES)


def dealt(spark: SparkSession, sf_dir: str, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of series by ``keys`` in ``panel_tasks`` partitions, if those are more than there are cores."""
    tasks = panel_tasks(spark, sf_dir)
    return rows.repartition(tasks, *keys) if tasks > spark.sparkContext.defaultParallelism else rows


def day_number(first: Column | str) -> Column:
    return F.datediff("date", first) + 1


def week_key(number: str) -> Column:
    return F.expr(f"cast({WEEK_BASE} + ({number} - 1) div 7 as int)")


def every_day(daily: DataFrame, first: Column, last: Column) -> DataFrame:
    """Each series on each day of the panel: a sale row stretches until the next one with zeros.

    No calendar is joined, so there is no product of series and days to shuffle.
    """
    w = Window.partitionBy(*SERIES).orderBy("date")
    begins = F.when(F.row_number().over(w) == 1, first).otherwise(F.col("date"))
    ends = F.date_sub(F.lead("date").over(w), 1)
    spans = daily.withColumns({"_from": begins, "_to": ends})
    days = spans.select(
        *SERIES,
        F.col("date").alias("_sold"),
        "units",
        "cents",
        F.explode(F.sequence("_from", F.coalesce("_to", last))).alias("date"),
    )
    sold = F.col("date") == F.col("_sold")
    return days.select(
        *SERIES,
        "date",
        F.when(sold, F.col("units")).otherwise(0).alias("units"),
        F.when(sold, F.col("cents")).otherwise(0).alias("cents"),
    )


def day_name(number: str) -> Column:
    return F.concat(F.lit("d_"), F.col(number).cast("string"))


def identity_columns() -> dict[str, Column]:
    return {
        "dept_id": F.concat(F.lit("DEPT_"), "item_id"),
        "cat_id": F.lit("CAT"),
        "state_id": F.upper(F.substring("store_id", 1, 2)),
    }


def calendar_attributes(number: str) -> dict[str, Column]:
    """Week key, events and the three flags, all from the 1-based day number."""
    quarter = (F.col(number) - 1) % QUARTER_DAYS == 0
    half = (F.col(number) - 1) % HALF_DAYS == 0
    dom = F.dayofmonth("date")
    return {
        "wm_yr_wk": week_key(number),
        "event_name_1": F.when(quarter, "Quarter"),
        "event_type_1": F.when(quarter, "Cycle"),
        "event_name_2": F.when(half, "Half"),
        "event_type_2": F.when(half, "Cycle"),
        "snap_CA": (dom <= 10).cast("int"),
        "snap_TX": dom.between(11, 20).cast("int"),
        "snap_WI": (dom > 20).cast("int"),
    }


def unit_price(cents: Column, units: Column) -> Column:
    return cents.cast("double") / F.nullif(units, F.lit(0)).cast("double") / 100.0


def sales_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined long table. Week prices come from the same pass, as sums over each week."""
    first, last = first_day(spark, sf_dir), last_day(spark, sf_dir)
    week = Window.partitionBy(*SERIES, "wm_yr_wk")
    return (
        every_day(dealt_days(spark, sf_dir), first, last)
        .withColumn("_n", day_number(first))
        .withColumns({"day": day_name("_n"), **identity_columns(), **calendar_attributes("_n")})
        .withColumn("sell_price", unit_price(F.sum("cents").over(week), F.sum("units").over(week)))
        .withColumn("sales", F.col("units").cast("smallint"))
        .select(*PASS_THROUGH)
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw calendar: one row per day between the first and last ship date, date as text."""
    ends = table(spark, sf_dir, "lineitem").agg(
        F.min(ship_day()).alias("first"), F.max(ship_day()).alias("last")
    )
    days = ends.select("first", F.explode(F.sequence("first", "last")).alias("date"))
    return (
        days.withColumn("_n", day_number("first"))
        .withColumns({"d": day_name("_n"), **calendar_attributes("_n")})
        .withColumn("date", F.date_format("date", "yyyy-MM-dd"))
        .select("d", "date", *[c for c in PASS_THROUGH[7:] if c not in ("sales", "sell_price")])
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw prices: one row per (store, item, week) with at least one sale."""
    return (
        daily_units(spark, sf_dir)
        .withColumn("_n", day_number(first_day(spark, sf_dir)))
        .groupBy("store_id", "item_id", week_key("_n").alias("wm_yr_wk"))
        .agg(F.sum("cents").alias("cents"), F.sum("units").alias("units"))
        .select(
            "store_id",
            "item_id",
            "wm_yr_wk",
            unit_price(F.col("cents"), F.col("units")).alias("sell_price"),
        )
    )


def wide_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw wide sales, one column per day of the panel; days without a sale are NULL.

    Only the two ends of the date range come to the driver, to name the columns. A series' array
    has one entry per day, so its length is the length of the calendar.
    """
    first, last = (
        table(spark, sf_dir, "lineitem").agg(F.min(ship_day()), F.max(ship_day())).first()
    )
    start, end = F.lit(first), F.lit(last)
    names = [f"d_{i}" for i in range(1, (last - first).days + 2)]
    sold = F.when(F.col("units") != 0, F.col("units").cast("int"))
    return (
        every_day(dealt_days(spark, sf_dir), start, end)
        .groupBy(*SERIES)
        .agg(F.sort_array(F.collect_list(F.struct("date", sold.alias("units")))).alias("_days"))
        .withColumns(identity_columns())
        .withColumn("_units", F.col("_days.units"))
        .selectExpr(*WIDE_IDS, *[f"_units[{i}] AS {n}" for i, n in enumerate(names)])
    )


def naive_predictions(sales_rows: DataFrame, lag: int = HORIZON) -> DataFrame:
    """Forecast by the value ``lag`` rows earlier, for every row that has one."""
    w = Window.partitionBy(*SERIES).orderBy("date")
    guess = F.lag("sales", lag).over(w).cast("double")
    rows = sales_rows.withColumn("predicted", guess).filter(F.col("predicted").isNotNull())
    return rows.select(*ROW, F.col("sales").alias("actual"), "predicted")
