"""First-success de-duplication, slice updates and slice totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline.functions import slices
from tallyline.operators.evaluate import route_and_evaluate
from tallyline.operators.route import join_definitions
from tallyline.sources.definitions import DefinitionSet

IDENTITY = ("ref_ord", "dimension_key", "order_id")
#: Definitions of one event type from which the deliveries of an order meet before they fan out.
WIDE = 32
#: Deliveries of one order from which they are reduced where they lie.
HOT_ORDER = 10_000
#: Tasks for each usual one, in which the deliveries of orders are compared after they fanned out.
SHARES = 4


def delivery_order(definitions: DefinitionSet) -> Column:
    """What comes first: arrival, then place in the definition list."""
    return delivery_place() if definitions.repeated_refs else F.col("arrival_seq")


def delivery_place() -> Column:
    """Arrival and place in the definition list as one number, so that an aggregation by it stays a hash aggregation.

    Streams take it whatever the definitions are: it is part of their state, which outlives a definition list.
    """
    place = F.col("def_ord").cast("decimal(20,0)")
    return F.col("arrival_seq").cast("decimal(38,0)") * F.expr("10000000000000000000BD") + place


def first_success(evaluated: DataFrame, definitions: DefinitionSet, carry: tuple[str, ...] = ()) -> DataFrame:
    """The first delivery of an order whose script succeeded, per indicator and dimension key.

    Deliveries are reduced before the shuffle, so many copies of one order stay cheap, and the
    order id in the key spreads an indicator that receives most of the feed.
    """
    order = delivery_order(definitions)
    kept = ("slice_ts", "increment", *carry)
    good = evaluated.where(F.col("increment").isNotNull()).select(
        *IDENTITY, "def_ord", "arrival_seq", order.alias("place"), *kept
    )
    first = [F.min_by(c, "place").alias(c) for c in kept]
    # Definitions with names of their own are known by the key; shared names carry the winner.
    which = [F.min_by("def_ord", "place").alias("def_ord")] if definitions.repeated_refs else []
    winners = good.groupBy(*IDENTITY).agg(F.min("arrival_seq").alias("arrival_seq"), *which, *first)
    return winners if which else winners.withColumn("def_ord", F.col("ref_ord"))


def counted_orders(orders: DataFrame, definitions: DefinitionSet, folds: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """The first successes of a feed, as ``first_success`` gives them.

    Where an order matches many definitions, its deliveries meet before they fan out: an order that comes once needs no
    comparison, and the deliveries of another are compared in the task they were dealt to.  So orders travel, and not
    their pairs with indicators.  Only an order of very many deliveries is reduced where these lie.
    """

    def evaluated(rows: DataFrame) -> DataFrame:
        return route_and_evaluate(rows, definitions, folds)

    def winners(rows: DataFrame) -> DataFrame:
        return first_success(evaluated(rows), definitions, carry)

    if orders.isStreaming or definitions.repeated_refs or definitions.fan_out < WIDE:
        return winners(orders)
    times = orders.groupBy(F.col("order_id").alias("again")).agg(F.count("*").alias("times")).where("times > 1")
    same = F.col("order_id").eqNullSafe(F.col("again"))
    usual = int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    once = evaluated(orders.join(times, same, "left_anti").repartition(usual)).where(F.col("increment").isNotNull())
    once = once.select(*IDENTITY, "def_ord", "arrival_seq", "slice_ts", "increment", *carry)
    several = orders.join(times.where(F.col("times") <= HOT_ORDER), same, "left_semi")
    hot = orders.join(times.where(F.col("times") > HOT_ORDER), same, "left_semi")
    return once.unionByName(winners(several.repartition(SHARES * usual, "order_id"))).unionByName(winners(hot))


def describe(winners: DataFrame, definitions: DefinitionSet) -> DataFrame:
    """Add the definition's columns back after the shuffle, which carries numbers only."""
    names = ("ref_name", "slice_granularity", "slice_seconds", "window_slices")
    table = definitions.table.select("def_ord", *names)
    described = join_definitions(winners.drop(*names), table, "def_ord", definitions)
    return described.withColumn("granularity", F.col("slice_granularity"))


def slice_updates(described: DataFrame) -> DataFrame:
    """The slice update event of every counted order."""
    granularity = F.col("slice_granularity")
    return described.select(
        "ref_name",
        "dimension_key",
        granularity.alias("granularity"),
        "slice_ts",
        "increment",
        "order_id",
        slices.slice_key(F.col("ref_name"), F.col("dimension_key"), granularity, F.col("slice_ts")).alias("slice_key"),
        slices.ttl_seconds(F.col("slice_seconds"), F.col("window_slices")).alias("ttl_seconds"),
    )


def counted_flags(evaluated: DataFrame, definitions: DefinitionSet) -> DataFrame:
    """Every routed delivery with a flag telling whether it was the one that counted."""
    place = F.when(F.col("increment").isNotNull(), delivery_order(definitions))
    first = F.min("place").over(Window.partitionBy(*IDENTITY))
    marked = evaluated.withColumn("place", place).withColumn("first", first)
    return marked.withColumn("counted", F.coalesce(F.col("place") == F.col("first"), F.lit(False))).drop("place", "first")


def slice_totals(updates: DataFrame) -> DataFrame:
    """Sum and count per slice; partial sums are made before the shuffle."""
    return updates.groupBy("ref_name", "dimension_key", "granularity", "slice_ts").agg(
        F.sum("increment").alias("value"), F.count("*").alias("orders")
    )
