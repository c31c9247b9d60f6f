"""Q1-Q4: the star-schema questions, as lazy DataFrames over a built star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.money import whole
from starloom.plans.star import Star


def half_year_months(year: int, half: int = 1) -> list[str]:
    first = 1 if half == 1 else 7
    return [f"{year}-{m:02d}" for m in range(first, first + 6)]


def category_month_revenue(star: Star, months: list[str], total_name: str) -> DataFrame:
    """Q1: net revenue by category (rows) by month (columns) plus a total.

    Conditional sums in one hash aggregate (an explicit-list pivot); the
    month slice reaches the fact through the broadcast calendar.
    """
    d = star.date_dim("date_key", "year_month").where(F.col("year_month").between(months[0], months[-1]))
    cats = star.dim("product", "product_key", "category")
    fact = star.fact
    if "month_key" in fact.columns:  # persisted fact: prune month partitions, no join needed
        lo, hi = (int(m.replace("-", "")) for m in (months[0], months[-1]))
        fact = fact.where(F.col("month_key").between(lo, hi))
    lines = fact.select("date_key", "product_key", "net_amount").join(d, "date_key").join(cats, "product_key")
    agg = lines.groupBy("category").agg(
        *[F.sum(F.when(F.col("year_month") == m, F.col("net_amount"))).alias(m) for m in months],
        F.sum("net_amount").alias(total_name),
    )
    return agg.select(
        "category", *[whole(F.col(f"`{m}`")).alias(m) for m in months], whole(total_name).alias(total_name)
    ).orderBy(F.desc(total_name), "category")


def day_sums(fact: DataFrame, *by: str) -> DataFrame:
    """Lines, units and net revenue per day: as many rows as days, so the calendar is
    joined after the fact has been reduced."""
    return fact.groupBy(*by, "date_key").agg(
        F.count(F.lit(1)).alias("order_lines"), F.sum("quantity").alias("units"), F.sum("net_amount").alias("net")
    )


def month_sums(days: DataFrame, calendar: DataFrame, how: str = "inner", by: tuple[str, ...] = ()) -> DataFrame:
    """:func:`day_sums` added up by calendar month."""
    return (
        days.join(calendar, "date_key", how)
        .groupBy(*by, "year_month")
        .agg(
            F.sum("order_lines").alias("order_lines"),
            F.sum("units").cast("bigint").alias("units"),
            whole(F.sum("net")).alias("net_revenue"),
        )
    )


def monthly_trend(star: Star) -> DataFrame:
    """Q2: order lines, units and net revenue per calendar month."""
    return month_sums(day_sums(star.fact), star.date_dim("date_key", "year_month")).orderBy("year_month")


HISTORY_COLUMNS = (
    "customer_key",
    "customer_id",
    "segment",
    "city",
    "region",
    "valid_from",
    "valid_to",
    "is_current",
    "version",
)


def customer_history(dim_customer: DataFrame, members: int = 3) -> DataFrame:
    """Q3: full version trail of the first ``members`` multi-version members.

    The top-k is the feature here; the member list is at most ``members``
    rows, so broadcasting it is bounded.
    """
    multi = (
        dim_customer.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("customer_id")
        .orderBy("customer_id")
        .limit(members)
    )
    return (
        dim_customer.join(F.broadcast(multi), "customer_id", "left_semi")
        .select(*HISTORY_COLUMNS)
        .orderBy("customer_id", "version")
    )


def segment_attribution(star: Star, fact: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Pre-aggregated (point-in-time segment, current segment) -> net revenue.

    The fact is reduced to one row per customer version first (map-side
    partial sums), so only distinct keys meet the dimension; the two
    attributions then come from a table of at most segments^2 rows. With ``by``
    (further grouping columns of ``fact``) lines without a version are kept.
    """
    dim = star.dim_customer
    per_key = (star.fact if fact is None else fact).groupBy(*by, "customer_key").agg(F.sum("net_amount").alias("net"))
    ver = star.dim("customer", "customer_key", "customer_id", F.col("segment").alias("pit_segment"))
    cur = dim.where(F.col("is_current")).select("customer_id", F.col("segment").alias("cur_segment"))
    if "customer" in star.broadcastable:
        cur = F.broadcast(cur)
    keyed = per_key.join(ver, "customer_key", "left" if by else "inner").join(cur, "customer_id", "left")
    return keyed.groupBy(*by, "pit_segment", "cur_segment").agg(F.sum("net").alias("net"))


def segment_sides(pair: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Every (pit, current) pair feeds its amount to the point-in-time side of one
    segment and the restated side of another; one row per segment."""
    net, none = F.col("net"), F.lit(None).cast(pair.schema["net"].dataType)
    sides = F.array(
        F.struct(F.col("pit_segment").alias("segment"), net.alias("pit"), none.alias("res")),
        F.when(
            F.col("cur_segment").isNotNull(),
            F.struct(F.col("cur_segment").alias("segment"), none.alias("pit"), net.alias("res")),
        ),
    )
    return (
        pair.select(*by, F.explode(F.filter(sides, lambda x: x.isNotNull())).alias("s"))
        .select(*by, "s.*")
        .groupBy(*by, "segment")
        .agg(F.sum("pit").alias("pit"), F.sum("res").alias("res"))
    )


def segment_pit_vs_current(star: Star) -> DataFrame:
    """Q4: segment revenue at the time of sale versus restated to current.

    Both attributions come out of one pass (:func:`segment_sides`). A segment must
    appear on both sides (the two attributions are inner-joined on segment).
    """
    both = segment_sides(segment_attribution(star)).where(F.col("pit").isNotNull() & F.col("res").isNotNull())
    return both.select(
        "segment",
        whole("pit").alias("net_revenue_point_in_time"),
        whole("res").alias("net_revenue_restated_current"),
        whole(F.col("res") - F.col("pit")).alias("delta"),
    ).orderBy("segment")
