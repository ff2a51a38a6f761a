"""Cleaning rules on texts built from the given tables, good and bad values mixed by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, table
from squadlake import functions as rule


def by_remainder(key: str, cases: list[Column | str | None]) -> Column:
    """The value for ``key % len(cases)``."""
    remainder = F.col(key) % len(cases)
    values = [F.lit(value) if not isinstance(value, Column) else value for value in cases]
    return F.coalesce(*[F.when(remainder == i, value) for i, value in enumerate(values)])


def cleaned(
    df: DataFrame, key: str, text: Column, clean: Callable[[str], Column], alias: str
) -> DataFrame:
    """A rule applied to a text column, as it is to a stored one."""
    return df.select(key, text.alias("text")).select(key, clean("text").alias(alias))


def amount_text(key: str, price: str) -> Column:
    """A price as ``€112k``, ``€1.12m`` and so on, or as text that holds no amount."""
    units = F.floor(price).cast("bigint")
    thousands = F.floor(F.col(price) / 1000).cast("bigint")
    hundreds = F.floor(thousands / 100).cast("bigint").cast("string")
    rest = F.lpad((thousands % 100).cast("string"), 2, "0")
    return by_remainder(
        key,
        [
            F.concat(F.lit("€"), thousands.cast("string"), F.lit("k")),
            F.concat(F.lit("€"), hundreds, F.lit("."), rest, F.lit("m")),
            "",
            None,
            "0",
            "-",
            "€1.20bn",
            F.concat(F.lit(" €"), units.cast("string"), F.lit("K ")),
            units.cast("string"),
        ],
    )


def amount_sql(key: str, price: str) -> str:
    units = f"cast(floor({price}) as bigint)"
    thousands = f"cast(floor({price} / 1000) as bigint)"
    return f"""case {key} % 9 when 0 then {thousands} * 1000 when 1 then {thousands} * 10000
        when 2 then 0 when 3 then 0 when 4 then 0 when 7 then {units} * 1000
        when 8 then {units} end"""


@check(
    f"select o_orderkey, cast({amount_sql('o_orderkey', 'o_totalprice')} as bigint) as amount from orders"
)
def parse_market_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = amount_text("o_orderkey", "o_totalprice")
    return cleaned(
        table(spark, sf_dir, "orders"), "o_orderkey", text, rule.parse_market_value, "amount"
    )


@check(
    """
select p_partkey, cast(case p_partkey % 5 when 0 then 100 + p_size when 3 then 100 + p_size end
                       as integer) as height
from part
"""
)
def parse_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    centimetres = F.lpad(F.col("p_size").cast("string"), 2, "0")
    text = by_remainder(
        "p_partkey",
        [
            F.concat(F.lit("1,"), centimetres, F.lit("m")),
            F.concat(F.lit("1."), centimetres, F.lit("m")),
            "",
            F.concat(F.lit("1"), centimetres, F.lit(" cm")),
            None,
        ],
    )
    return cleaned(
        table(spark, sf_dir, "part"), "p_partkey", text, rule.parse_height, "height"
    )


@check(
    """
select p_partkey, case p_partkey % 6 when 0 then p_size when 1 then p_size end as age from part
"""
)
def parse_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    text = by_remainder(
        "p_partkey",
        [size, F.concat(F.lit(" "), size, F.lit(" ")), "", "n/a", F.concat(size, F.lit(".5")), None],
    )
    return cleaned(
        table(spark, sf_dir, "part"), "p_partkey", text, rule.parse_age, "age"
    )


@check(
    """
select p_partkey,
       coalesce(case when p_partkey % 3 = 0 then null else words[1] end, 'None') as first_word,
       coalesce(case when p_partkey % 3 = 1 then words[2] end, 'None') as second_word
from (select p_partkey, string_split(p_name, ' ') as words from part)
"""
)
def array_first_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_name", " ")
    shapes = F.when(F.col("p_partkey") % 3 == 1, words).when(
        F.col("p_partkey") % 3 == 2, F.slice(words, 1, 1)
    )
    return (
        table(spark, sf_dir, "part")
        .withColumn("words", shapes)
        .select(
            "p_partkey",
            rule.nth_or_default("words", 1).alias("first_word"),
            rule.nth_or_default("words", 2).alias("second_word"),
        )
    )


@check(
    """
select p_partkey, case p_partkey % 6 when 0 then p_name when 1 then p_name when 5 then p_name
                  else 'No team' end as club
from part
"""
)
def clean_club_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    text = by_remainder(
        "p_partkey",
        [
            F.concat(name, F.lit(": fee: 3m")),
            F.concat(F.lit("\t "), name, F.lit("\u00a0 ")),
            F.concat(F.lit(":"), name),
            "",
            None,
            name,
        ],
    )
    return cleaned(
        table(spark, sf_dir, "part"), "p_partkey", text, rule.clean_club_name, "club"
    )


@check(
    """
select c_custkey, case c_custkey % 4 when 0 then c_name when 3 then ' ' else 'None' end as origin
from customer
"""
)
def fill_signed_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = by_remainder("c_custkey", [F.col("c_name"), "", None, " "])
    return cleaned(
        table(spark, sf_dir, "customer"), "c_custkey", text, rule.fill_signed_from, "origin"
    )


@check(
    """
select o_orderkey, case o_orderkey % 6 when 4 then 'Injuried' when 5 then 'Injuried'
                   else 'Available to play' end as status
from orders
"""
)
def clean_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = by_remainder(
        "o_orderkey",
        [
            None,
            "",
            "Team captain",
            "available TO play",
            F.col("o_orderpriority"),
            F.concat(F.lit("team captain, "), F.col("o_orderstatus")),
        ],
    )
    return cleaned(
        table(spark, sf_dir, "orders"), "o_orderkey", text, rule.clean_status, "status"
    )


@check(
    """
select o_orderkey, case when o_orderstatus = 'P' then 'available to play' else o_orderpriority end
       as status
from orders
"""
)
def default_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return cleaned(
        table(spark, sf_dir, "orders"), "o_orderkey", text, rule.default_status, "status"
    )


@check(
    """
select doc_id, case when doc_id % 7 = 0 then null
                    else upper(text[1]) || lower(text[2:]) end as text
from documents
"""
)
def capitalize_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("text"))
    return cleaned(
        table(spark, sf_dir, "documents"), "doc_id", text, rule.capitalize_first, "text"
    )


def club_name(name: Column, key: str) -> Column:
    return by_remainder(
        key,
        [
            F.concat(name, F.lit("_FC")),
            F.concat(F.lit("FC_"), name),
            F.concat(F.lit("AFC_"), name),
            F.concat(name, F.lit("_FC_United")),
            name,
        ],
    )


def club_sql(name: str, key: str) -> str:
    return f"""case {key} % 5 when 0 then {name} || '_FC' when 1 then 'FC_' || {name}
        when 2 then 'AFC_' || {name} when 3 then {name} || '_FC_United' else {name} end"""


@check(
    f"""
select n_nationkey, array_to_string(
           list_filter(string_split(club, '_'), lambda word: word <> 'FC' and word <> ''), ' ')
           as team,
       trim(replace(replace(replace(replace(club, '_FC', ''), 'FC_', ''), 'FC', ''), '_', ' '))
           as short_team
from (select n_nationkey, {club_sql('n_name', 'n_nationkey')} as club from nation)
"""
)
def normalize_team_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    club = club_name(F.col("n_name"), "n_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", club.alias("club"))
    return nations.select(
        "n_nationkey",
        rule.normalize_team_name("club").alias("team"),
        rule.normalize_team_name("club", mode="substring").alias("short_team"),
    )


@check(
    """
select o_orderkey, 'Club & ' || o_orderpriority as team, cast(year(o_orderdate) as integer) as season
from orders
"""
)
def path_to_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percent-encoded paths, as the file metadata gives them."""
    year = F.year("o_orderdate").cast("string")
    file = F.concat_ws("_", F.concat(F.lit("Club%20&%20"), F.col("o_orderpriority")), "o_orderkey", year)
    path = rule.decode_path(F.concat(F.lit("s3a://b/DATA_1/Season_"), year, F.lit("/"), file, F.lit(".json")))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", path.alias("path"))
        .select(
            "o_orderkey",
            rule.team_from_file_name(rule.file_name_of("path")).alias("team"),
            rule.season_from_path("path").alias("season"),
        )
    )


@check(
    """
select p_partkey, case when p_partkey % 11 = 0 then 'Unknown' when p_size <= 19 then 'Under 20'
    when p_size <= 23 then '20-23' when p_size <= 27 then '24-27' when p_size <= 31 then '28-31'
    else 'Over 31' end as age_group,
    case when p_partkey % 11 = 0 then 'Over 31' when p_size <= 19 then 'Under 20'
    when p_size <= 23 then '20-23' when p_size <= 27 then '24-27' when p_size <= 31 then '28-31'
    else 'Over 31' end as plain_age_group
from part
"""
)
def age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.when(F.col("p_partkey") % 11 != 0, F.col("p_size"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        rule.age_band(age, null_label="Unknown").alias("age_group"),
        rule.age_band(age).alias("plain_age_group"),
    )
