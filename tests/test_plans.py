"""Physical plans: what reaches the scan, what is shuffled, and what happens to hot keys."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from checks import REGISTRY
from checks.lake import squads
from checks.views import fact
from squadlake import operators as ops
from squadlake import sources
from squadlake.plans import GOLD_TABLES, gold
from squadlake.plans.silver import clean_players, flatten_squads, rejected_players
from squadlake.sources import schemas
from squadlake.sources.layers import output_file_policy

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def player_rows(spark):
    """Clean players from 16 input tasks; one season and one team hold a third of the rows."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, 20_000, 1, 16).select(
        F.col("id").cast("string").alias("players_id"),
        F.concat(F.lit("Player "), F.col("id")).alias("players_name"),
        F.element_at(F.array(*map(F.lit, ["Back", "Wing"])), (1 + F.col("id") % 2).cast("int")).alias(
            "players_position"
        ),
        (18 + F.col("id") % 20).cast("int").alias("players_age"),
        F.lit(180).alias("players_height"),
        F.lit("Right").alias("players_foot"),
        F.lit("Club").alias("players_signedFrom"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) * 1000 + 1000).alias("players_marketValue"),
        F.when(F.col("id") % 7 == 0, "Injuried").otherwise("Available to play").alias("players_status"),
        F.lit("X").alias("player_first_nationality"),
        F.lit("None").alias("player_second_nationality"),
        F.when(hot, "Hot").otherwise(F.concat(F.lit("Team "), F.col("id") % 50)).alias("team"),
        F.when(hot, 2012).otherwise(2003 + F.col("id") % 12).cast("int").alias("season"),
    )


@pytest.fixture(scope="module")
def players(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("players"))
    sources.write_layer(player_rows(spark), root)
    return sources.scan_players(spark, root)


@pytest.mark.parametrize("name", REGISTRY)
def test_no_query_uses_python_or_a_product(spark, name):
    text = plan(driver.queries()[name](spark, SF_DIR))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert operator not in text


def test_season_floor_prunes_directories(players):
    text = plan(sources.scan_season_range(players, 2010))
    assert "PartitionFilters: [isnotnull(season" in text and ">= 2010)]" in text


def test_lookup_prunes_the_season_and_pushes_the_team(players):
    text = plan(sources.lookup_team_season(players, "Team_7", 2006))
    assert "= 2006)]" in text and "PushedFilters: [In(team, [Team 7,Team_7])]" in text


def test_order_date_floor_reaches_the_scan(spark):
    text = plan(fact(spark, SF_DIR, first_season=1996))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in text


def test_top_n_limits_before_the_shuffle(players):
    text = plan(ops.top_n_per_group(players, ["season"], "players_marketValue", 10, ["players_id"]))
    below_exchange = text.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_top_n_overall_is_a_top_k_per_task(players):
    text = plan(ops.top_n_overall(players, "players_marketValue", 15, ["players_id"]))
    assert "TakeOrderedAndProject(limit=15" in text and "Exchange SinglePartition" not in text


def test_large_k_salts_the_group(players):
    ranked = ops.top_n_per_group(players, ["season"], "players_marketValue", 5000, ["players_id"])
    assert plan(ranked).count("Window [row_number()") == 3
    hot = ranked.where("season = 2012").agg(F.count("*"), F.min("rank"), F.max("rank")).first()
    assert tuple(hot) == (5000, 1, 5000)


def test_salted_and_plain_ranking_agree(players):
    def ranked(salts):
        top = ops.top_n_per_group(
            players, ["season"], "players_marketValue", 10, ["players_id"], salts=salts
        )
        return sorted(map(tuple, top.collect()))

    assert ranked(1) == ranked(16)


def test_coverage_joins_nothing(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").withColumn("y", F.year("o_orderdate"))
    for df in (
        ops.coverage_gaps(orders, "o_custkey", "y"),
        ops.coverage_report(orders, "o_custkey", "y", "o_orderkey"),
    ):
        df.collect()
        text = plan(df)
        assert "Join " not in text and "ReusedExchange" in text


def test_an_odd_period_costs_nothing(spark):
    rows = [("a", 2010), ("a", 2147483000), ("b", 2010)]
    gaps = ops.coverage_gaps(spark.createDataFrame(rows, "team string, season int"))
    assert [tuple(r) for r in gaps.collect()] == [("b", 2147483000)]


def test_large_ranks_split_a_hot_group(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("g"), (F.col("id") * 7919 % 6007).alias("v"), "id"
    )
    top = ops.top_n_per_group(df, ["g"], "v", 1500, ["id"])
    text = plan(top)
    assert text.count("Exchange hashpartitioning") == 3 and "xxhash64" in text
    hot = [r.v for r in top.where("g = 0").orderBy("rank").collect()]
    assert hot == sorted((r.v for r in df.where("g = 0").collect()), reverse=True)[:1500]


def test_silver_judges_once(spark, tmp_path):
    from squadlake.plans import silver_quality

    sources.write_layer(
        spark.createDataFrame([], schemas.PLAYER_FLAT), str(tmp_path / "flat"), rebalance=False
    )
    flat = sources.scan_players_flat(spark, str(tmp_path / "flat"))
    assert "IsNull(reject_reason)" in plan(clean_players(flat))
    assert "IsNotNull(reject_reason)" in plan(rejected_players(flat))
    assert "players_" not in plan(silver_quality(flat))


def test_silver_writes_shuffle_nothing(spark):
    bronze = spark.createDataFrame([], schemas.BRONZE)
    flat = spark.createDataFrame([], schemas.PLAYER_FLAT)
    for df in (flatten_squads(bronze), clean_players(flat), rejected_players(flat)):
        assert "Exchange" not in plan(output_file_policy(df, rebalance=False))


def test_gold_reads_silver_from_the_floor_with_few_columns(spark, players):
    teams, categories = gold.team_subtotals(players), gold.category_subtotals(players)
    inputs = gold.gold_inputs(players, teams, categories)
    for table in GOLD_TABLES:
        text = plan(table.build(inputs))
        floor = 2005 if table.group == "squad_age_analysis" else 2010
        assert f">= {floor})]" in text
        assert "players_foot" not in text and "players_signedFrom" not in text


def test_a_hot_season_is_written_by_many_tasks(spark, tmp_path):
    """Adaptive execution splits the season with a third of all rows."""
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "32k")
    try:
        sources.write_layer(player_rows(spark), str(tmp_path / "out"))
    finally:
        spark.conf.set(advisory, before)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "out").glob("season=*")}
    others = [count for name, count in files.items() if name != "season=2012"]
    assert files["season=2012"] >= 4 > max(others), files
    assert sources.scan_players(spark, str(tmp_path / "out")).count() == 20_000


def test_files_are_sorted_by_team(spark, players, tmp_path):
    import pyarrow.parquet as pq

    sources.write_layer(players, str(tmp_path / "out"))
    for file in (tmp_path / "out").rglob("*.parquet"):
        teams = pq.ParquetFile(file).read(columns=["team"])["team"].to_pylist()
        assert teams == sorted(teams)


def test_a_player_is_looked_up_in_few_row_groups(spark, tmp_path):
    """Ids are spread over all files; the filters leave those that hold the one looked for."""
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "16k")
    try:
        for name, filters in (("plain", []), ("bloom", ["players_id"])):
            sources.replace_table(player_rows(spark), str(tmp_path / name), "players", bloom_filters=filters)
    finally:
        spark.conf.set(advisory, before)
    read = {}
    for name in ("plain", "bloom"):
        rows = sources.lookup_player(sources.scan_players(spark, str(tmp_path / name / "players")), "4711")
        scan = rows._jdf.queryExecution().executedPlan()
        assert scan.executeCollectPublic().__len__() == 1
        while scan.children().size():
            scan = scan.children().head()
        read[name] = scan.metrics().apply("numOutputRows").value()
    assert read["bloom"] < 2_000 and read["bloom"] * 4 < read["plain"]


def test_players_of_a_squad_are_made_behind_the_shuffle(spark):
    text = plan(squads(spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 1
    # Written from the last step to the first: narrow rows are dealt out, then collected where they arrive.
    assert text.index("partial_collect_list") < text.index("Exchange hashpartitioning")


def test_costly_texts_of_a_player_are_made_once(spark):
    flat = spark.createDataFrame([], schemas.PLAYER_FLAT)
    text = plan(clean_players(flat))
    assert text.count("regexp_replace(team") == 1
    assert "lower(players_marketValue" not in text
