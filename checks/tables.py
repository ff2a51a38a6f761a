"""Coverage, nesting, set, quality and file operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, table
from checks.views import FACT_SQL, fact
from squadlake import operators as ops
from squadlake import sources
from squadlake.session import shared_folder
from squadlake.sources.schemas import SQUAD


def ddl(rows: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def order_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("season")
    )


YEARS_SQL = """
with seen as (select distinct o_custkey, cast(year(o_orderdate) as integer) as season from orders),
     calendar as (select distinct season from seen),
     per_customer as (select o_custkey, list(season) as present from seen group by o_custkey),
     absent as (
         select o_custkey, unnest(list_filter((select list(season) from calendar),
                                              lambda s: not list_contains(present, s))) as season
         from per_customer)
"""


@check(YEARS_SQL + "select o_custkey, season from absent")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.coverage_gaps(order_years(spark, sf_dir), "o_custkey", "season")


@check(
    YEARS_SQL
    + """
select o_custkey, files, array_to_string(list_sort(present), ',') as seasons_present,
       coalesce(seasons_missing, '') as seasons_missing
from per_customer
join (select o_custkey, count(*) as files from orders group by o_custkey) using (o_custkey)
left join (select o_custkey, array_to_string(list_sort(list(season)), ',') as seasons_missing
           from absent group by o_custkey) using (o_custkey)
"""
)
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = ops.coverage_report(order_years(spark, sf_dir), "o_custkey", "season", "o_orderkey")
    return report.withColumns(
        {
            name: F.concat_ws(",", F.col(name).cast("array<string>"))
            for name in ("seasons_present", "seasons_missing")
        }
    )


@check(
    FACT_SQL
    + """
select team, array_to_string(list_sort(list(distinct season)), ',') as seasons
from fact group by team
"""
)
def seasons_by_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    seasons = ops.seasons_by_team(fact(spark, sf_dir))
    return seasons.withColumn("seasons", F.concat_ws(",", F.col("seasons").cast("array<string>")))


@check("select distinct cast(year(o_orderdate) as integer) as season from orders")
def list_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.list_seasons(order_years(spark, sf_dir))


# Turns per nested document: (conv_id, turn) is unique, so no array grows beyond this.
TURNS_PER_DOCUMENT = 64


def conversation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as squads: one document for every 64 turns, turns as players."""
    player = F.struct(
        F.col("turn").cast("string").alias("id"),
        F.col("role").alias("name"),
        F.array("role", F.col("turn").cast("string")).alias("nationality"),
        F.col("text").alias("signedFrom"),
    )
    return (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id", F.floor(F.col("turn") / TURNS_PER_DOCUMENT).alias("part"))
        .agg(F.collect_list(player).alias("players"))
        .select(
            F.col("conv_id").cast("string").alias("id"),
            "players",
            F.concat(F.lit("part "), F.col("part")).alias("updatedAt"),
            (2000 + F.col("conv_id") % 10).cast("int").alias("season"),
        )
    )


NESTED_SQL = """
select cast(conv_id as varchar) as id, 'part ' || cast(turn // 64 as varchar) as "updatedAt",
       cast(turn as varchar) as players_id, role as players_name,
       cast(turn as varchar) as second, text as "players_signedFrom"
"""


def _flat_turns(squads: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    flat = ops.flatten_player(ops.explode_players(squads, keep), keep)
    return flat.select(
        *keep,
        "players_id",
        "players_name",
        F.try_element_at("players_nationality", F.lit(2)).alias("second"),
        "players_signedFrom",
    )


@check(NESTED_SQL + "from conversations")
def explode_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text, parsed with the squad schema, exploded and flattened."""
    text = conversation_documents(spark, sf_dir).select(
        F.to_json(F.struct("id", "players", "updatedAt")).alias("document")
    )
    parsed = text.select(F.from_json("document", SQUAD).alias("squad")).select("squad.*")
    return _flat_turns(parsed, ("id", "updatedAt"))


@check(NESTED_SQL + ", cast(2000 + conv_id % 10 as integer) as season from conversations")
def scan_squad_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents through JSON files, the season taken from their directory."""
    folder = scratch(spark, "squad-json")
    (
        conversation_documents(spark, sf_dir)
        .withColumn("folder", F.concat(F.lit("Season_"), F.col("season")))
        .drop("season")
        .write.partitionBy("folder")
        .json(folder)
    )
    squads = sources.scan_squad_json(spark, folder, layout="lines")
    return _flat_turns(squads, ("id", "updatedAt", "season"))


def _mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """Conversations as files of four shapes, by the document's number: one document a line
    after a blank line, indented ones in a row, an array, and a single one."""
    by_shape = F.pmod(F.xxhash64("id", "updatedAt"), F.lit(4))
    shaped = conversation_documents(spark, sf_dir).select(
        F.concat(F.lit("Season_"), F.col("season")).alias("folder"),
        by_shape.alias("shape"),
        F.when(by_shape == 3, F.col("id")).alias("alone"),
        F.to_json(F.struct("id", "players", "updatedAt")).alias("line"),
        F.to_json(F.struct("id", "players", "updatedAt"), {"pretty": "true"}).alias("indented"),
    )
    file = F.concat_ws("\n", F.collect_list(F.when(F.col("shape") == 1, F.col("indented")).otherwise(F.col("line"))))
    listed = F.concat(F.lit("["), F.concat_ws(",", F.collect_list("line")), F.lit("]"))
    # A few hundred documents in a file, whatever the table's size.
    part = F.pmod(F.xxhash64("line"), F.lit(1 + shaped.count() // 10_000))
    texts = shaped.groupBy("folder", "shape", "alone", part.alias("part")).agg(
        F.when(F.col("shape") == 0, F.concat(F.lit("\n"), file))
        .when(F.col("shape") == 2, listed)
        .otherwise(file)
        .alias("value")
    )
    folder = scratch(spark, "squad-files")
    # With a separator that no text has, each row is a file's text, and each file has one row.
    (
        texts.repartition(F.col("folder"), F.col("shape"), F.col("alone"), F.col("part"))
        .select("folder", "value")
        .write.partitionBy("folder")
        .option("maxRecordsPerFile", 1)
        .text(folder)
    )
    return folder


@check(NESTED_SQL + ", cast(2000 + conv_id % 10 as integer) as season from conversations")
def scan_squad_json_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents in files of every shape, cut at their braces by the tasks that read a file together."""
    return _scanned(spark, sf_dir, "sequence")


def _scanned(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    squads = sources.scan_squad_json(spark, _mixed_files(spark, sf_dir), layout, glob="*.txt")
    return _flat_turns(squads, ("id", "updatedAt", "season"))


SEASON_SQL = ", cast(2000 + conv_id % 10 as integer) as season from conversations"


@check(NESTED_SQL + SEASON_SQL)
def scan_squad_json_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scanned(spark, sf_dir, "auto")


@check(NESTED_SQL + SEASON_SQL)
def scan_squad_json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scanned(spark, sf_dir, "document")


@check(
    YEARS_SQL
    + """
select (select count(distinct o_custkey) from orders) as o_custkeys,
       (select cast(count(*) as bigint) from orders) as files,
       (select count(*) from seen) as present, (select count(*) from absent) as missing
"""
)
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a run: every order is a file here, of a customer and a year."""
    totals = ops.run_totals(order_years(spark, sf_dir), "o_custkey", "season", "o_orderkey")
    return totals.withColumns({c: F.col(c).cast("bigint") for c in totals.columns})


@check(
    """
select event_type, count(*) as events,
       cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as total
from events group by event_type
"""
)
def json_field_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.from_json("props", "k string").getField("k")
    events = table(spark, sf_dir, "events").withColumn("k", fields.try_cast("bigint"))
    return ops.total_by_group(events, ["event_type"], "k", "total", "events")


@check("select o_orderkey, o_orderstatus, o_totalprice from orders")
def union_all_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, in two frames whose columns come in a different order."""
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    finished = F.col("o_orderstatus") == "F"
    return ops.union_all_by_name(
        [orders.where(finished), orders.where(~finished).select(*reversed(columns))]
    )


@check(FACT_SQL + "select * from fact where team = 'NATION_7' and season = 1998")
def lookup_team_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.lookup_team_season(fact(spark, sf_dir), "NATION_7", 1998)


@check(FACT_SQL + "select * replace (replace(team, '_', '') as team) from fact where team = 'NATION_7' and season = 1998")
def lookup_team_season_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By a raw name, in a table whose names have lost the suffix wherever it stood."""
    teams = fact(spark, sf_dir).withColumn("team", F.replace("team", F.lit("_"), F.lit("")))
    return sources.lookup_team_season(teams, "FCNATION7FC", 1998, "substring")


@check(FACT_SQL + "select * from fact where season >= 1998")
def layer_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FACT written by season, published to a second place and read from there with a floor."""
    written, published = scratch(spark, "fact"), scratch(spark, "fact-published")
    columns = fact(spark, sf_dir)
    sources.write_layer(columns, f"{written}/fact")
    sources.publish_layer(spark, f"{written}/fact", f"{published}/fact", ddl(columns))
    stored = sources.read_table(spark, published, "fact", ddl(columns))
    return sources.scan_season_range(stored, 1998).select(*columns.columns)


def account_rules():
    return {
        "balance": F.col("c_acctbal") > 0,
        "segment": F.col("segment") != "",
        "nation": F.col("c_nationkey").isNotNull(),
    }


def customers_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose segment is NULL or empty for some keys."""
    key = F.col("c_custkey")
    segment = F.when(key % 17 == 0, "").when(key % 13 != 0, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").withColumn("segment", segment)


GAPS_SQL = """
with customers as (
    select *, case when c_custkey % 17 = 0 then '' when c_custkey % 13 <> 0 then c_mktsegment end
              as segment,
           c_acctbal > 0 as balance_ok,
           c_custkey % 17 <> 0 and c_custkey % 13 <> 0 as segment_ok
    from customer)
"""


@check(
    GAPS_SQL
    + "select c_custkey, c_name, c_acctbal, segment from customers where balance_ok and segment_ok"
)
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.valid_rows(customers_with_gaps(spark, sf_dir), account_rules())
    return rows.select("c_custkey", "c_name", "c_acctbal", "segment")


@check(
    GAPS_SQL
    + """
select c_custkey, segment, case when not balance_ok and not segment_ok then 'balance,segment'
       when not balance_ok then 'balance' else 'segment' end as reject_reason
from customers where not (balance_ok and segment_ok)
"""
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.quarantine(customers_with_gaps(spark, sf_dir), account_rules())
    return rows.select("c_custkey", "segment", "reject_reason")


@check(
    GAPS_SQL
    + """
select 'customers' as layer, c_mktsegment, count(*) as rows_in,
       cast(count_if(balance_ok and segment_ok) as bigint) as rows_out,
       cast(count_if(not (balance_ok and segment_ok)) as bigint) as rejected,
       cast(count(distinct c_nationkey) - 1 as bigint) as duplicate_files,
       cast(0 as bigint) as empty_squads
from customers group by c_mktsegment
"""
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by segment; the nation stands in for the file a row came from."""
    rows = customers_with_gaps(spark, sf_dir)
    return ops.quality_report(rows, "customers", ["c_mktsegment"], account_rules(), "c_nationkey")
