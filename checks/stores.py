"""Commits, counts taken while writing, refreshes and published copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.lake import LAKE_SQL, built_lake
from checks.registry import check
from checks.tables import NESTED_SQL, _flat_turns, conversation_documents, ddl, scratch
from checks.views import FACT_SQL, fact
from squadlake import operators as ops
from squadlake import sources
from squadlake.plans import Lake, run_lake, written_rows

CHANGED, EMPTIED = 1998, 2000


def _changed(rows: DataFrame) -> DataFrame:
    """Two seasons as a later run has them: one with other values, one without any row."""
    return rows.where(F.col("season") == CHANGED).withColumn("cents", F.col("cents") + 1)


@check(
    FACT_SQL
    + f"""
select 1 as version, o_orderkey, season, cents from fact
union all
select 2, o_orderkey, season, cents + case when season = {CHANGED} then 1 else 0 end from fact
where season <> {EMPTIED}
"""
)
def snapshot_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FACT committed, then two of its seasons replaced; both versions, read through their commits.

    A third run writes and ends before its commit; it is not seen.
    """
    layer, rows = scratch(spark, "fact-layer"), fact(spark, sf_dir)
    sources.replace_table(rows, layer, "fact")
    sources.replace_table(_changed(rows), layer, "fact", touched=[CHANGED, EMPTIED])
    sources.Change(spark, layer).write(rows.limit(10), "fact")
    versions = [
        sources.read_table(spark, layer, "fact", ddl(rows), version).select(
            F.lit(number).alias("version"), "o_orderkey", "season", "cents"
        )
        for number, version in ((1, 1), (2, None))
    ]
    return ops.union_all_by_name(versions)


@check(
    LAKE_SQL
    + """
, counts as (
    select count(*) as all_rows, count_if(foot_ok and height_ok and value_ok) as valid from judged),
documents as (select count(distinct (club, season, o_orderkey // 1000)) as n from judged)
select 'bronze' as layer, 'squads' as "table", counted, cast(rows as bigint) as rows from documents,
    (select unnest(['rows_in', 'rows_out', 'rejected', 'broken_corrupt', 'broken_team', 'broken_season']) as counted),
    lateral (select case when counted in ('rows_in', 'rows_out') then n else 0 end as rows)
union all
select 'silver', 'players_flat', counted, cast(rows as bigint) from counts,
    (select unnest(['rows_in', 'rows_out', 'rejected', 'broken_reject_reason']) as counted),
    lateral (select case counted when 'rows_in' then all_rows when 'rows_out' then valid else all_rows - valid end as rows)
union all
select 'silver', 'players', 'rows', cast(valid as bigint) from counts
union all
select 'silver', 'quarantine', 'rows', cast(all_rows - valid as bigint) from counts
"""
)
def written_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, out and rejected of the built lake, as its writing tasks counted them."""
    return written_rows(spark, built_lake(spark, sf_dir)).select("layer", "table", "counted", "rows")


@check(
    FACT_SQL
    + f"""
select run, cast(season as varchar) as partition, count(*) as rows, run = 1 or season = {CHANGED} as copied, true as same
from fact, (select unnest([1, 2]) as run)
where run = 1 or season <> {EMPTIED} group by run, season
"""
)
def publish_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FACT published twice: what was copied each time, and whether the copy's fingerprints are the source's."""
    source, copy, rows = scratch(spark, "source"), scratch(spark, "copy"), fact(spark, sf_dir)
    published = [sources.Table("fact", ddl(rows))]
    sources.replace_table(rows, source, "fact")
    first = sources.publish_tables(spark, source, copy, published)
    sources.replace_table(_changed(rows), source, "fact", touched=[CHANGED, EMPTIED])
    second = sources.publish_tables(spark, source, copy, published)
    arrived = ops.fingerprints(sources.read_table(spark, copy, "fact", ddl(rows)), ["season"])
    there = arrived.select(F.col("season").cast("string").alias("partition"), F.col("fingerprint").alias("there"))
    runs = ops.union_all_by_name([r.withColumn("run", F.lit(n)) for n, r in ((1, first), (2, second))])
    # The copy holds what the second run published; the first run's changed seasons are gone from it.
    same = F.col("there").eqNullSafe(F.col("fingerprint")) | (
        (F.col("run") == 1) & F.col("partition").isin(str(CHANGED), str(EMPTIED))
    )
    return runs.join(there, "partition", "left").select("run", "partition", "rows", "copied", same.alias("same"))


ADDED, ADDED_ID = 2003, "added"


@check(
    NESTED_SQL
    + f", cast(2000 + conv_id % 10 as integer) as season from conversations union all "
    + NESTED_SQL.replace("cast(conv_id as varchar) as id", f"'{ADDED_ID}' as id")
    + f", {ADDED} from conversations where conv_id % 10 = 3"
)
def refresh_after_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake of JSON files, and a refresh after one season got more of them: its flat table."""
    staging = scratch(spark, "staging")
    documents = conversation_documents(spark, sf_dir).withColumn(
        "folder", F.concat(F.lit("Season_"), F.col("season"))
    )
    documents.drop("season").write.partitionBy("folder").json(staging)
    lake = Lake(scratch(spark, "refreshed"))
    run_lake(spark, staging, lake, "lines")
    added = documents.where(F.col("season") == ADDED).withColumn("id", F.lit(ADDED_ID))
    added.drop("season").write.mode("append").partitionBy("folder").json(staging)
    assert run_lake(spark, staging, lake, "lines", refresh=True) == [ADDED]
    flat = sources.scan_players_flat(spark, lake.players_flat)
    return flat.select(
        "id", "updatedAt", "season", "players_id", "players_name",
        F.try_element_at("players_nationality", F.lit(2)).alias("second"), "players_signedFrom",
    )


@check(
    """
select event_type, count(*) as rows, count(distinct (user_id, value)) as pairs
from events group by event_type
"""
)
def fingerprints_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of two shuffled halves, written one after the other, are those of the whole."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", "user_id", "value")
    half = F.pmod(F.xxhash64("user_id", "value"), F.lit(2)) == 0
    mixed = ops.union_all_by_name([events.where(~half), events.where(half).select("value", "event_type", "user_id")])
    whole, parts = ops.fingerprints(events, ["event_type"]), ops.fingerprints(mixed, ["event_type"])
    pairs = events.distinct().groupBy("event_type").agg(F.count(F.lit(1)).alias("pairs"))
    return whole.join(parts, ["event_type", "rows", "fingerprint"]).join(pairs, "event_type").drop("fingerprint")
