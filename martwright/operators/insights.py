"""Rule-based text insights over the KPI row and the daily series.

Each rule yields zero or one ``(rule, insight)`` row; ``insights_all``
numbers the emitted rows 1.. in rule order. Inputs are the one-row KPI and
the daily mart (one row per day), so the global windows here are bounded
by the number of calendar days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.functions import weekday_name
from martwright.operators.features import with_position_from_end

# --- fixed values: insight texts and rule thresholds ---
TOTAL_GMV_TEXT = "Total GMV is %.2f (BRL) across the dataset period."
TREND_TEXT = "GMV is %s %.1f%% in the last 30 days vs the previous 30 days."
BEST_DAY_TEXT = "Highest average GMV day is %s."
TREND_WINDOW_ROWS = 30
TREND_MIN_ROWS = 60
WEEKDAY_MIN_ROWS = 7


def weekday_mean(daily: DataFrame) -> DataFrame:
    """Mean y per English weekday name."""
    return (daily.groupBy(weekday_name("ds").alias("weekday"))
            .agg(F.avg("y").alias("mean_y")))


def best_weekday(daily: DataFrame) -> DataFrame:
    """Weekday with the highest mean y (ties → the first of the week, from Monday)."""
    return (daily.groupBy(F.weekday("ds").alias("_dow"), weekday_name("ds").alias("weekday"))
            .agg(F.avg("y").alias("mean_y"))
            .orderBy(F.col("mean_y").desc(), F.col("_dow").asc()).limit(1).drop("_dow"))


def insight_total_gmv(kpi: DataFrame) -> DataFrame:
    return (kpi.where(F.col("total_gmv") > 0)
            .select(F.lit(1).alias("rule"),
                    F.format_string(TOTAL_GMV_TEXT, F.col("total_gmv")).alias("insight")))


def trend_stats(daily: DataFrame) -> DataFrame:
    """One row: series length, sum of the last 30 rows and of the 30 rows before."""
    p = with_position_from_end(daily)
    pos = F.col("_pos_end")
    return p.agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.when(pos <= TREND_WINDOW_ROWS, F.col("y"))).alias("last30"),
                 F.sum(F.when((pos > TREND_WINDOW_ROWS) & (pos <= 2 * TREND_WINDOW_ROWS),
                              F.col("y"))).alias("prev30"))


def insight_gmv_trend(daily: DataFrame) -> DataFrame:
    s = trend_stats(daily)
    change = (F.col("last30") - F.col("prev30")) / F.col("prev30") * 100.0
    return (s.where((F.col("n") >= TREND_MIN_ROWS) & (F.col("prev30") > 0))
            .select(F.lit(2).alias("rule"),
                    F.format_string(TREND_TEXT,
                                    F.when(change >= 0, "up").otherwise("down"),
                                    F.abs(change)).alias("insight")))


def insight_best_weekday(daily: DataFrame) -> DataFrame:
    n = daily.select(F.count(F.lit(1))).scalar()
    return (best_weekday(daily)
            .where(n >= WEEKDAY_MIN_ROWS)
            .select(F.lit(3).alias("rule"),
                    F.format_string(BEST_DAY_TEXT, F.col("weekday")).alias("insight")))


def insights_all(kpi: DataFrame, daily: DataFrame) -> DataFrame:
    """Ordered union of the three rules, numbered 1.. over the emitted ones."""
    u = (insight_total_gmv(kpi).unionByName(insight_gmv_trend(daily))
         .unionByName(insight_best_weekday(daily)))
    return u.select(F.row_number().over(Window.orderBy("rule")).alias("rank"), "insight")
