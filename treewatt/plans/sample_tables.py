"""Readings, trees and registry documents read off the sample tables.

Users act as sensors, their events as readings; customer, nation and region tables give
the tree. Everything is a projection or join of the tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treewatt.functions.running import Running, with_running
from treewatt.session import use_utc

# Second version of the customer memberships: customers divisible by 17 leave, of the
# others those divisible by 10 move to the next nation.
CHANGE_TIME = "2024-01-15 00:00:00"
START_TIME = "2024-01-01 00:00:00"
EMPTIED_TIME = "2024-01-08 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def _named(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"{kind}-"), F.col(key).cast("string"))


def measurements_of(events: DataFrame, *also: Column | str) -> DataFrame:
    time = F.col("ts").cast("timestamp")
    return events.select(
        _named("customer", "user_id").alias("identifier"),
        time.alias("event_time"),
        F.unix_millis(time).alias("payload_ts_ms"),
        F.col("value").alias("value_w"),
        F.col("event_id").alias("arrival_seq"),
        *also,
    )


def measurements(spark: SparkSession, folder: str) -> DataFrame:
    return measurements_of(table(spark, folder, "events"))


def late_places(spark: SparkSession, folder: str) -> int:
    """By how many places readings may be late: about seven hours, however dense they are."""
    last = table(spark, folder, "events").agg(F.max("event_id")).first()[0] or 0
    return max(97, last // 103)


def shuffled_arrival(readings: DataFrame, places: int) -> DataFrame:
    """The same readings, each arriving fewer than so many places late."""
    seq, span = F.col("arrival_seq"), F.lit(places).cast("bigint")
    late = seq + (seq * 7919) % span
    return readings.withColumn("arrival_seq", late * span + seq % span)


def numbered_by_source(readings: DataFrame, source: str) -> DataFrame:
    """Arrival numbers that start at 0 in every source, as in the partitions of a bus."""
    counted = with_running(
        readings.withColumn("_one", F.lit(1).cast("bigint")),
        [source],
        "arrival_seq",
        [Running("_number", "sum", "_one")],
    )
    return counted.withColumn("arrival_seq", F.col("_number") - 1).drop("_one", "_number")


def group_edges(spark: SparkSession, folder: str) -> DataFrame:
    """nation -> region -> root."""
    nations = table(spark, folder, "nation").select(
        _named("nation", "n_nationkey").alias("child"),
        _named("region", "n_regionkey").alias("parent"),
    )
    regions = table(spark, folder, "region").select(
        _named("region", "r_regionkey").alias("child"), F.lit("root").alias("parent")
    )
    return nations.unionByName(regions)


def customer_edges(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        _named("customer", "c_custkey").alias("child"),
        _named("nation", "c_nationkey").alias("parent"),
    )


def balanced_edges(spark: SparkSession, folder: str) -> DataFrame:
    """customer -> nation -> region -> root; depth 3."""
    return customer_edges(spark, folder).unionByName(group_edges(spark, folder))


def unbalanced_edges(spark: SparkSession, folder: str) -> DataFrame:
    """As balanced, but customers of region 2 hang directly under it."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    customers = (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _named("customer", "c_custkey").alias("child"),
            F.when(F.col("n_regionkey") == 2, F.lit("region-2"))
            .otherwise(_named("nation", "c_nationkey"))
            .alias("parent"),
        )
    )
    return customers.unionByName(group_edges(spark, folder))


def multi_parent_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Balanced plus customer -> segment -> root."""
    customers = table(spark, folder, "customer")
    segment = _named("segment", "c_mktsegment")
    return (
        balanced_edges(spark, folder)
        .unionByName(
            customers.select(
                _named("customer", "c_custkey").alias("child"), segment.alias("parent")
            )
        )
        .unionByName(
            customers.select(segment.alias("child"), F.lit("root").alias("parent")).distinct()
        )
    )


def second_version(spark: SparkSession, folder: str) -> DataFrame:
    """Customer edges after the change."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    moved = F.when(key % 10 == 0, (nation + 1) % 25).otherwise(nation)
    return (
        table(spark, folder, "customer")
        .where(key % 17 != 0)
        .select(
            _named("customer", "c_custkey").alias("child"),
            F.concat(F.lit("nation-"), moved.cast("string")).alias("parent"),
        )
    )


def inner_node_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Readings in which every "error" event is reported by the user's nation."""
    events = table(spark, folder, "events")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    joined = events.join(customers, F.col("user_id") == F.col("c_custkey"))
    nation = _named("nation", "c_nationkey").alias("nation")
    return (
        measurements_of(joined, "event_type", nation)
        .withColumn(
            "identifier",
            F.when(F.col("event_type") == "error", F.col("nation")).otherwise(
                F.col("identifier")
            ),
        )
        .drop("event_type", "nation")
    )


def configuration_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as configuration messages: sign-ups announce a registry change, views a
    registry status, the rest is other traffic. The payload is the user's registry."""
    kind = F.col("event_type")
    leaf = F.struct(_named("customer", "user_id").alias("identifier"))
    root = F.struct(F.lit("root").alias("identifier"), F.array(leaf).alias("children"))
    return table(spark, folder, "events").select(
        F.when(kind == "signup", "SENSOR_REGISTRY_CHANGED")
        .when(kind == "view", "SENSOR_REGISTRY_STATUS")
        .otherwise(kind)
        .alias("event_type"),
        F.to_json(root).alias("payload"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("arrival_seq"),
    )


def registry_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One registry document per customer: root > region > nation > customer."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")

    def node(identifier: Column, *children: Column) -> Column:
        fields = [identifier.alias("identifier")]
        if children:
            fields.append(F.array(*children).alias("children"))
        return F.struct(*fields)

    customer = node(_named("customer", "c_custkey"))
    nation = node(_named("nation", "c_nationkey"), customer)
    region = node(_named("region", "n_regionkey"), nation)
    return (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.lit("SENSOR_REGISTRY_CHANGED").alias("event_type"),
            F.to_json(node(F.lit("root"), region)).alias("payload"),
            F.lit(START_TIME).cast("timestamp").alias("event_time"),
            F.col("c_custkey").alias("arrival_seq"),
        )
    )


def order_edges(spark: SparkSession, folder: str) -> DataFrame:
    """part -> order for every line item; parts repeat across orders."""
    return table(spark, folder, "lineitem").select(
        _named("part", "l_partkey").alias("child"), _named("order", "l_orderkey").alias("parent")
    )


def registry_document(customers: DataFrame, nations: DataFrame, regions: DataFrame) -> DataFrame:
    """One row with the payload of a whole registry, from the edges of its three levels."""

    def level(edges: DataFrame, below: DataFrame | None) -> DataFrame:
        """(parent, children): the nodes of a level as they stand in the document."""
        node = F.struct(F.col("child").alias("identifier"))
        if below is not None:
            inner = below.withColumnRenamed("parent", "child")
            edges = edges.join(inner, "child", "left")
            node = F.struct(F.col("child").alias("identifier"), "children")
        return edges.groupBy("parent").agg(F.collect_list(node).alias("children"))

    top = level(regions, level(nations, level(customers, None)))
    return top.select(
        F.to_json(F.struct(F.col("parent").alias("identifier"), "children")).alias("payload")
    )


def doubled_arrival(readings: DataFrame) -> DataFrame:
    """Even arrival numbers, so that odd ones are free for registry events."""
    return readings.withColumn("arrival_seq", 2 * F.col("arrival_seq"))


def registry_snapshots(spark: SparkSession, folder: str, groups_move: bool) -> DataFrame:
    """Two whole registries: one before all readings, and the second version of the customer
    memberships in the middle of them. With groups_move every fourth nation then moves to the
    next region as well."""
    customers = table(spark, folder, "customer")
    regions = table(spark, folder, "region").select(
        _named("region", "r_regionkey").alias("child"), F.lit("root").alias("parent")
    )

    def nations(region: Column) -> DataFrame:
        return table(spark, folder, "nation").select(
            _named("nation", "n_nationkey").alias("child"),
            F.concat(F.lit("region-"), region.cast("string")).alias("parent"),
        )

    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    moved = F.when(key % 4 == 1, (region + 1) % 5).otherwise(region) if groups_move else region
    events = table(spark, folder, "events")
    middle = (events.agg(F.max("event_id")).first()[0] or 0) // 2
    newest = events.where(F.col("event_id") <= middle).agg(
        F.unix_micros(F.max("ts").cast("timestamp"))
    )
    changed = F.timestamp_micros(F.lit(newest.first()[0]).cast("bigint"))
    versions = [
        (registry_document(customer_edges(spark, folder), nations(region), regions), -1),
        (
            registry_document(second_version(spark, folder), nations(moved), regions),
            2 * middle * late_places(spark, folder) + 1,
        ),
    ]
    documents = [
        payload.select(F.lit(seq).cast("bigint").alias("arrival_seq"), "payload")
        for payload, seq in versions
    ]
    start = F.lit(START_TIME).cast("timestamp")
    return documents[0].unionByName(documents[1]).select(
        F.lit("SENSOR_REGISTRY_CHANGED").alias("event_type"),
        "payload",
        F.when(F.col("arrival_seq") < 0, start).otherwise(changed).alias("event_time"),
        "arrival_seq",
    )
