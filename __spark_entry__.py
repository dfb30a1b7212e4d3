"""Registered queries over the sample tables, and the same results as plain SQL.

``queries()`` maps a name to ``(spark, folder) -> DataFrame``; ``oracle_sql()`` maps the
same name to SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from treewatt import RollupConfig
from treewatt.functions.tables import new_path, sized, write_table
from treewatt.operators import attribution, late, latest, registry, rollup
from treewatt.operators.hierarchy import Hierarchy, build_hierarchy
from treewatt.plans import sample_tables as sample
from treewatt.plans.batch import build_batch, rollup_changing_membership, rollup_members
from treewatt.sources.readers import read_measurements, read_registry_events
from treewatt.sources.writers import stream_batches, write_results
from treewatt.streaming.incremental import IncrementalRollup, incremental_writer
from treewatt.streaming.members import MemberRollup, member_rows, member_writer
from treewatt.streaming.windows import final_results

HOUR_MS = 3_600_000
CFG = RollupConfig(emit_period_ms=6 * HOUR_MS, sum_scale=2)
GRACE = RollupConfig(emit_period_ms=6 * HOUR_MS, grace_period_ms=HOUR_MS, sum_scale=2)
DAILY_AVG = RollupConfig(emit_period_ms=24 * HOUR_MS, child_agg="avg", sum_scale=6)

GRACE_MAX = RollupConfig(
    emit_period_ms=6 * HOUR_MS, grace_period_ms=HOUR_MS, sum_scale=2, child_agg="max"
)
GRACE_AVG = RollupConfig(
    emit_period_ms=24 * HOUR_MS, grace_period_ms=HOUR_MS, sum_scale=6, child_agg="avg"
)

DEPTH = 3  # customer -> nation -> region -> root


def _plain(df: DataFrame) -> DataFrame:
    """Zone-free timestamps and comma-joined sets, as the SQL side returns them."""
    out = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        out.append(column.alias(field.name))
    return df.select(*out)


def _results(df: DataFrame) -> DataFrame:
    return _plain(
        df.select("window_start", "identifier", "timestamp_ms", "count", "sum_w", "average_w")
    )


def _balanced(spark: SparkSession, folder: str) -> Hierarchy:
    return build_hierarchy(sample.balanced_edges(spark, folder), depth=DEPTH)


def _customer_edges(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    edges = sample.customer_edges(spark, folder)
    return edges, edges.count()


# -- sources, projections, filters ------------------------------------------------


def measurement_scan(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(sample.measurements(spark, folder))


def registry_events(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(registry.snapshot_events(sample.configuration_events(spark, folder)))


def results_as_measurements(spark: SparkSession, folder: str) -> DataFrame:
    edges, rows = _customer_edges(spark, folder)
    results = rollup.rollup_one_level(sample.measurements(spark, folder), edges, rows, CFG)
    return _plain(rollup.results_as_measurements(results))


def merge_streams(spark: SparkSession, folder: str) -> DataFrame:
    readings = sample.measurements(spark, folder)
    edges, rows = _customer_edges(spark, folder)
    results = rollup.rollup_one_level(readings, edges, rows, CFG)
    merged = latest.merge_streams(
        readings.drop("arrival_seq"), rollup.results_as_measurements(results)
    )
    return _plain(merged)


# -- registry ---------------------------------------------------------------------


def registry_flatten(spark: SparkSession, folder: str) -> DataFrame:
    edges = registry.flatten_registry(sample.registry_documents(spark, folder))
    return _plain(edges.select("arrival_seq", "child", "parent", "level"))


def registry_duplicate_ids(spark: SparkSession, folder: str) -> DataFrame:
    return registry.duplicate_identifiers(sample.order_edges(spark, folder))


def _membership_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Change history of the customers: everyone joins, then the second version."""
    first = registry.parent_sets(sample.customer_edges(spark, folder))
    second = registry.parent_sets(sample.second_version(spark, folder))
    joined = first.select(
        "child",
        F.lit("upsert").alias("op"),
        F.lit(None).cast("array<string>").alias("old_parents"),
        "parents",
        F.lit(0).cast("bigint").alias("arrival_seq"),
        F.lit(sample.START_TIME).cast("timestamp").alias("event_time"),
    )
    changed = registry.diff_snapshots(first, second).select(
        "*",
        F.lit(1).cast("bigint").alias("arrival_seq"),
        F.lit(sample.CHANGE_TIME).cast("timestamp").alias("event_time"),
    )
    return joined.unionByName(changed)


def _written_changes(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    changes = write_table(_membership_changes(spark, folder), "changes")
    return changes, changes.count()


def registry_diff(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(
        registry.diff_snapshots(
            registry.parent_sets(sample.customer_edges(spark, folder)),
            registry.parent_sets(sample.second_version(spark, folder)),
        )
    )


def registry_history(spark: SparkSession, folder: str) -> DataFrame:
    first = sample.customer_edges(spark, folder).select(
        F.lit(0).cast("bigint").alias("arrival_seq"),
        F.lit(sample.START_TIME).cast("timestamp").alias("event_time"),
        "child",
        "parent",
    )
    second = sample.second_version(spark, folder).select(
        F.lit(1).cast("bigint").alias("arrival_seq"),
        F.lit(sample.CHANGE_TIME).cast("timestamp").alias("event_time"),
        "child",
        "parent",
    )
    return _plain(registry.diff_history(first.unionByName(second)))


def registry_emptied(spark: SparkSession, folder: str) -> DataFrame:
    """Everyone joins, the registry is emptied, the second version joins."""
    stamps = [(0, sample.START_TIME), (1, sample.EMPTIED_TIME), (2, sample.CHANGE_TIME)]
    events = spark.createDataFrame(stamps, "arrival_seq bigint, event_time string").withColumn(
        "event_time", F.col("event_time").cast("timestamp")
    )
    full = sample.customer_edges(spark, folder).withColumn("arrival_seq", F.lit(0).cast("bigint"))
    last = sample.second_version(spark, folder).withColumn("arrival_seq", F.lit(2).cast("bigint"))
    edges = full.unionByName(last).join(F.broadcast(events), "arrival_seq")
    return _plain(registry.diff_history(edges, events))


def current_parents(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(registry.current_parents(_membership_changes(spark, folder)))


def membership_retractions(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(registry.membership_retractions(_membership_changes(spark, folder)))


# -- joins and fan-out ------------------------------------------------------------


def join_current_parents(spark: SparkSession, folder: str) -> DataFrame:
    parents = write_table(
        registry.current_parents(_membership_changes(spark, folder)), "parents"
    )
    newest = latest.latest_per_sensor(sample.measurements(spark, folder))
    return _plain(
        attribution.join_current_parents(newest, parents, parents.count(), CFG.broadcast_rows)
    )


def join_parents_as_of(spark: SparkSession, folder: str) -> DataFrame:
    changes, rows = _written_changes(spark, folder)
    return _plain(
        attribution.join_parents_as_of(
            sample.measurements(spark, folder),
            registry.versioned_edges(changes),
            rows,
            CFG.broadcast_rows,
        )
    )


def _fanned(spark: SparkSession, folder: str, edges: DataFrame) -> DataFrame:
    parents = write_table(registry.parent_sets(edges), "parents")
    joined = attribution.join_current_parents(
        sample.measurements(spark, folder), parents, parents.count(), CFG.broadcast_rows
    )
    return _plain(attribution.fan_out(joined))


def fan_out(spark: SparkSession, folder: str) -> DataFrame:
    return _fanned(spark, folder, sample.balanced_edges(spark, folder))


def fan_out_multi_parent(spark: SparkSession, folder: str) -> DataFrame:
    return _fanned(spark, folder, sample.multi_parent_edges(spark, folder))


def reattribute_on_change(spark: SparkSession, folder: str) -> DataFrame:
    changes, rows = _written_changes(spark, folder)
    return _plain(
        attribution.reattribute_on_change(
            sample.measurements(spark, folder), changes, rows, CFG.broadcast_rows
        )
    )


# -- last values, windows, lateness -----------------------------------------------


def latest_per_sensor(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(latest.latest_per_sensor(sample.measurements(spark, folder)))


def tumbling_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(latest.tumbling_windows(sample.measurements(spark, folder), CFG))


def last_value_per_window(spark: SparkSession, folder: str) -> DataFrame:
    edges, rows = _customer_edges(spark, folder)
    parents = sized(edges.withColumnRenamed("child", "identifier"), rows, CFG.broadcast_rows)
    values = latest.value_per_window(sample.measurements(spark, folder), CFG)
    return _plain(values.join(parents, "identifier"))


def _shuffled(spark: SparkSession, folder: str) -> DataFrame:
    return sample.shuffled_arrival(
        sample.measurements(spark, folder), sample.late_places(spark, folder)
    )


def late_filter(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(late.with_late_flag(_shuffled(spark, folder), GRACE))


def stream_time(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(late.with_stream_time(_shuffled(spark, folder)))


# -- roll-ups ---------------------------------------------------------------------


def rollup_one_level(spark: SparkSession, folder: str) -> DataFrame:
    edges, rows = _customer_edges(spark, folder)
    return _results(
        rollup.rollup_one_level(sample.measurements(spark, folder), edges, rows, CFG)
    )


def results_upserted(spark: SparkSession, folder: str) -> DataFrame:
    """Results written in two parts that share windows of every day, and read again."""
    edges, rows = _customer_edges(spark, folder)
    results = rollup.rollup_one_level(sample.measurements(spark, folder), edges, rows, CFG)
    results = write_table(results, "results")
    path = new_path(spark, "upserted")
    write_results(results.where(F.hour("window_start") < 18), path)
    write_results(results.where(F.hour("window_start") >= 6), path)
    return _results(spark.read.schema(results.schema).parquet(path))


def rollup_child_avg(spark: SparkSession, folder: str) -> DataFrame:
    edges, rows = _customer_edges(spark, folder)
    return _results(
        rollup.rollup_one_level(sample.measurements(spark, folder), edges, rows, DAILY_AVG)
    )


def rollup_multilevel(spark: SparkSession, folder: str) -> DataFrame:
    return _results(
        rollup.rollup_multilevel(
            sample.measurements(spark, folder), _balanced(spark, folder), CFG
        )
    )


def rollup_closure(spark: SparkSession, folder: str) -> DataFrame:
    return _results(
        rollup.rollup_closure(sample.measurements(spark, folder), _balanced(spark, folder), CFG)
    )


def rollup_unbalanced(spark: SparkSession, folder: str) -> DataFrame:
    tree = build_hierarchy(sample.unbalanced_edges(spark, folder), depth=DEPTH)
    return _results(rollup.rollup_multilevel(sample.measurements(spark, folder), tree, CFG))


def rollup_multi_parent(spark: SparkSession, folder: str) -> DataFrame:
    graph = build_hierarchy(sample.multi_parent_edges(spark, folder), depth=DEPTH)
    return _results(rollup.rollup_multilevel(sample.measurements(spark, folder), graph, CFG))


def rollup_inner_node_reports(spark: SparkSession, folder: str) -> DataFrame:
    return _results(
        rollup.rollup_multilevel(
            sample.inner_node_reports(spark, folder), _balanced(spark, folder), CFG
        )
    )


def rollup_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return _results(
        build_batch(_shuffled(spark, folder), _balanced(spark, folder), GRACE, "final")
    )


def rollup_changing_members(spark: SparkSession, folder: str) -> DataFrame:
    changes, rows = _written_changes(spark, folder)
    groups = build_hierarchy(sample.group_edges(spark, folder), depth=DEPTH - 1)
    return _results(
        rollup_changing_membership(
            sample.measurements(spark, folder), changes, rows, groups, CFG
        )
    )


def throttled_upserted(spark: SparkSession, folder: str) -> DataFrame:
    """Throttled results and their corrections, written in two parts to one table."""
    out = write_table(
        build_batch(_shuffled(spark, folder), _balanced(spark, folder), GRACE, "throttled"),
        "throttled",
    )
    path = new_path(spark, "upserted")
    middle = out.agg(F.max("arrival_seq")).first()[0] or 0
    for later in (True, False):  # corrections may even come before what they correct
        write_results(out.where((F.col("arrival_seq") * 2 > middle) == later), path)
    return _plain(spark.read.schema(out.schema).parquet(path).drop("window_end", "window_date"))


def _member_inputs(
    spark: SparkSession, folder: str, groups_move: bool
) -> tuple[DataFrame, DataFrame]:
    readings = sample.doubled_arrival(_shuffled(spark, folder))
    return readings, sample.registry_snapshots(spark, folder, groups_move)


def changelog_changing_members(spark: SparkSession, folder: str) -> DataFrame:
    """Customers move and leave in the middle of the readings, in the order of arrival."""
    log = rollup_members(*_member_inputs(spark, folder, groups_move=False), GRACE)
    return _plain(log.drop("window_end"))


def changelog_moving_groups(spark: SparkSession, folder: str) -> DataFrame:
    """As before, and nations move between regions at the same time."""
    log = rollup_members(*_member_inputs(spark, folder, groups_move=True), GRACE)
    return _plain(log.drop("window_end"))


def rollup_moving_groups(spark: SparkSession, folder: str) -> DataFrame:
    return _results(rollup_members(*_member_inputs(spark, folder, groups_move=True), GRACE, "final"))


# -- changelog and emission -------------------------------------------------------


def aggregate_changelog(spark: SparkSession, folder: str) -> DataFrame:
    log = build_batch(_shuffled(spark, folder), _balanced(spark, folder), GRACE, "changelog")
    return _plain(log.drop("window_end"))


def changelog_group_reports(spark: SparkSession, folder: str) -> DataFrame:
    readings = sample.shuffled_arrival(
        sample.inner_node_reports(spark, folder), sample.late_places(spark, folder)
    )
    log = build_batch(
        readings, _balanced(spark, folder), GRACE, "changelog", groups_report=True
    )
    return _plain(log.drop("window_end"))


def changelog_child_max(spark: SparkSession, folder: str) -> DataFrame:
    """A sensor is worth its largest reading in the window so far."""
    log = build_batch(_shuffled(spark, folder), _balanced(spark, folder), GRACE_MAX, "changelog")
    return _plain(log.drop("window_end"))


def changelog_child_avg(spark: SparkSession, folder: str) -> DataFrame:
    """A sensor is worth the average of its readings in the day so far."""
    log = build_batch(_shuffled(spark, folder), _balanced(spark, folder), GRACE_AVG, "changelog")
    return _plain(log.drop("window_end"))


def changelog_any_doubles(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with binary fractions from tiny to huge, without a scale for sums; the sums of
    the SQL are exact, as are those here before the last rounding."""
    readings = _shuffled(spark, folder)
    power = F.pow(F.lit(2.0), (F.col("arrival_seq") % 5 - 2) * 20)
    wide = readings.withColumn("value_w", F.floor(F.col("value_w")) * power)
    cfg = RollupConfig(emit_period_ms=6 * HOUR_MS, grace_period_ms=HOUR_MS)
    log = build_batch(wide, _balanced(spark, folder), cfg, "changelog")
    return _plain(log.drop("window_end", "average_w"))


def rollup_final_groups_report(spark: SparkSession, folder: str) -> DataFrame:
    """Windows that stream time has closed, when nations report as well, from a stream."""
    readings = sample.inner_node_reports(spark, folder)
    source, out = new_path(spark, "arrivals"), new_path(spark, "final")
    checkpoint = new_path(spark, "final-checkpoint")
    span = readings.agg(F.max("arrival_seq")).first()[0] + 1
    step = IncrementalRollup(
        _balanced(spark, folder), CFG, new_path(spark, "state"), out, "final", groups_report=True
    )
    for part in range(3):
        place = F.floor(F.col("arrival_seq") * 3 / span)
        readings.where(place == part).write.mode("append").parquet(source)
        stream = read_measurements(spark, "parquet", source, streaming=True)
        _run(incremental_writer(stream, step, checkpoint))
    return _results(spark.read.parquet(out))


def _from_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Every kind of event is a source with arrival numbers of its own."""
    events = sample.table(spark, folder, "events")
    shuffled = sample.shuffled_arrival(
        sample.measurements_of(events, "event_type"), sample.late_places(spark, folder)
    )
    return write_table(
        sample.numbered_by_source(write_table(shuffled, "shuffled"), "event_type"), "numbered"
    )


def changelog_two_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Every kind of event is a source with a clock and arrival numbers of its own."""
    log = build_batch(
        _from_sources(spark, folder),
        _balanced(spark, folder),
        GRACE,
        "changelog",
        by=("event_type",),
    )
    return _plain(log.drop("window_end"))


def throttled_two_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Entries are released by the time that all sources have reached."""
    out = build_batch(
        _from_sources(spark, folder),
        _balanced(spark, folder),
        GRACE,
        "throttled",
        by=("event_type",),
    )
    return _plain(out.drop("window_end"))


def throttled_emission(spark: SparkSession, folder: str) -> DataFrame:
    out = build_batch(_shuffled(spark, folder), _balanced(spark, folder), GRACE, "throttled")
    return _plain(out.drop("window_end"))


# -- streaming --------------------------------------------------------------------


def _run(writer: DataStreamWriter) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def rollup_final(spark: SparkSession, folder: str) -> DataFrame:
    """Streaming run over the events file; windows the watermark has passed."""
    tree = _balanced(spark, folder)
    schema = sample.table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")
    results = final_results(sample.measurements_of(events), tree, CFG)
    out = new_path(spark, "final")
    _run(stream_batches(results, out, new_path(spark, "final-checkpoint")))
    return _results(spark.read.parquet(out))


def rollup_throttled_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The throttled emission from three micro-batches, cut along the arrival order.

    Each part is appended and taken by a run of the query that starts where the one before
    ended.
    """
    readings = _shuffled(spark, folder)
    span = readings.agg(F.max("arrival_seq")).first()[0] + 1
    source, out = new_path(spark, "arrivals"), new_path(spark, "throttled")
    checkpoint = new_path(spark, "throttled-checkpoint")
    step = IncrementalRollup(
        _balanced(spark, folder), GRACE, new_path(spark, "state"), out, "throttled"
    )
    for part in range(3):
        inside = F.floor(F.col("arrival_seq") * 3 / span) == part
        readings.where(inside).write.mode("append").parquet(source)
        stream = read_measurements(spark, "parquet", source, streaming=True)
        _run(incremental_writer(stream, step, checkpoint))
    return _plain(spark.read.parquet(out).drop("window_end", "batch_id"))


def rollup_two_sources_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Windows that all sources have passed, from a stream in which sources lag behind: each
    part has readings of one source from other places than those of the next."""
    readings = _from_sources(spark, folder)
    kinds = [r.event_type for r in readings.select("event_type").distinct().collect()]
    source, out = new_path(spark, "arrivals"), new_path(spark, "sources")
    checkpoint = new_path(spark, "sources-checkpoint")
    step = IncrementalRollup(
        _balanced(spark, folder),
        GRACE,
        new_path(spark, "state"),
        out,
        "final",
        by=("event_type",),
        sources=len(kinds),
    )
    span = readings.agg(F.max("arrival_seq")).first()[0] + 1
    lag = F.pmod(F.crc32(F.col("event_type").cast("binary")), F.lit(2))
    for part in range(3):
        # The lagging half of the sources sends its first third with the others' second.
        place = F.least(F.floor(F.col("arrival_seq") * 3 / span) + lag, F.lit(2))
        readings.where(place == part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(readings.schema).parquet(source)
        _run(incremental_writer(stream, step, checkpoint))
    return _results(spark.read.parquet(out))


def rollup_changing_members_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The changelog from a stream of readings and one of registry events, in three parts."""
    readings, events = _member_inputs(spark, folder, groups_move=False)
    events = write_table(events, "events")
    span = readings.agg(F.max("arrival_seq")).first()[0] + 1
    sources = new_path(spark, "readings"), new_path(spark, "registry")
    out, checkpoint = new_path(spark, "members"), new_path(spark, "members-checkpoint")
    step = MemberRollup(GRACE, new_path(spark, "members-state"), out, "changelog")
    for part in range(3):
        place = F.greatest(F.floor(F.col("arrival_seq") * 3 / span), F.lit(0))
        for rows, source in zip((readings, events), sources, strict=True):
            rows.where(place == part).write.mode("append").parquet(source)
        rows = member_rows(
            read_measurements(spark, "parquet", sources[0], streaming=True),
            read_registry_events(spark, "parquet", sources[1], streaming=True),
        )
        _run(member_writer(rows, step, checkpoint))
    return _plain(spark.read.parquet(out).drop("window_end", "batch_id"))


_QUERIES = (
    measurement_scan,
    registry_events,
    results_as_measurements,
    merge_streams,
    registry_flatten,
    registry_duplicate_ids,
    registry_diff,
    registry_history,
    registry_emptied,
    current_parents,
    membership_retractions,
    join_current_parents,
    join_parents_as_of,
    fan_out,
    fan_out_multi_parent,
    reattribute_on_change,
    latest_per_sensor,
    tumbling_windows,
    last_value_per_window,
    late_filter,
    stream_time,
    rollup_one_level,
    results_upserted,
    rollup_child_avg,
    rollup_multilevel,
    rollup_closure,
    rollup_unbalanced,
    rollup_multi_parent,
    rollup_inner_node_reports,
    rollup_accepted,
    rollup_changing_members,
    changelog_changing_members,
    changelog_moving_groups,
    rollup_moving_groups,
    aggregate_changelog,
    changelog_child_max,
    changelog_child_avg,
    changelog_any_doubles,
    changelog_two_sources,
    changelog_group_reports,
    throttled_emission,
    throttled_two_sources,
    throttled_upserted,
    rollup_final,
    rollup_throttled_stream,
    rollup_final_groups_report,
    rollup_two_sources_stream,
    rollup_changing_members_stream,
)


def entry(spark: SparkSession) -> DataFrame:
    """Roll-up of every level of the tree on the smallest tables."""
    return rollup_multilevel(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES} | _text_queries()


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLE

    return dict(ORACLE) | _text_sql()


# -- text operators, where they are installed -------------------------------------


def _text_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    try:
        from treewatt.llm.queries import QUERIES
    except ImportError:
        return {}
    found = dict(QUERIES)
    try:
        import corpus_pipeline
    except ImportError:
        return found
    return found | {"pipeline": corpus_pipeline.run}


def _text_sql() -> dict[str, str]:
    try:
        from treewatt.llm.queries import ORACLE_SQL
    except ImportError:
        return {}
    found = dict(ORACLE_SQL)
    try:
        from corpus_pipeline import ORACLE_SQL as pipeline_sql
    except ImportError:
        return found
    return found if pipeline_sql is None else found | {"pipeline": pipeline_sql}
