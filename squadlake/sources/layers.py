"""Reading and writing the layers of the lake.

Layout: the season is the partition directory, and rows are sorted by team within
every file. There are a few dozen seasons but any number of teams, so directories
and files grow with the bytes and not with the number of teams; a season filter
prunes directories, and a team filter skips row groups and pages by their
statistics. ``partition_by=("team", "season")`` gives the two-level directory tree
where the number of teams is known to be small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squadlake.functions.cleaning import normalize_team_name

PARTITION_BY = ("season",)
CLUSTER_BY = ("team",)
CODEC = "snappy"

# Shuffle partitions of a rebalanced write. Seasons that share one are split together,
# and a small season then leaves a scrap in every split of a hot one. A few dozen
# seasons rarely meet in this many; the empty ones cost next to nothing.
REBALANCE_PARTITIONS = 1024


# Schemes that name the same store.
SAME_STORE = {"s3": "s3a", "s3n": "s3a"}


def _location(spark: SparkSession, path: str) -> list[str]:
    """Scheme, authority and the parts of a path, as its file system names them.

    A path without scheme or authority gets those of the default file system, and dots are
    resolved; that looks at the configuration only, not at the store. A scheme
    without a file system on the class path is compared as written.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    given = jvm.org.apache.hadoop.fs.Path(path)
    default = jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(conf)
    uri = given.toUri().normalize()
    scheme, authority = uri.getScheme(), uri.getAuthority()
    if scheme is None or (scheme == default.getScheme() and not authority):
        scheme, authority = default.getScheme(), default.getAuthority()
    where = uri.getPath()
    if not where.startswith("/"):
        where = f"{spark.sparkContext._jvm.java.lang.System.getProperty('user.dir')}/{where}"
    parts: list[str] = []
    for part in where.split("/"):
        if part == "..":
            parts = parts[:-1]
        elif part not in ("", "."):
            parts.append(part)
    return [SAME_STORE.get(scheme.lower(), scheme.lower()), (authority or "").lower(), *parts]


def _overlap(spark: SparkSession, one: str, other: str) -> bool:
    left, right = _location(spark, one), _location(spark, other)
    shared = min(len(left), len(right))
    return left[:shared] == right[:shared]


def output_file_policy(
    df: DataFrame,
    partition_by: Sequence[str] = PARTITION_BY,
    cluster_by: Sequence[str] = CLUSTER_BY,
    rebalance: bool = True,
    watched: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Arrange rows so that every partition gets few, evenly sized files.

    ``rebalance`` lets adaptive execution merge small shuffle partitions and split
    large ones at ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: the number
    of files follows the bytes, with no count beforehand and no upper limit, and
    one season with a third of all rows is written by many tasks. Leave it off
    when the input already lies by partition; then nothing is shuffled at all.
    ``watched`` is applied behind the last shuffle, in the very tasks that write.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", REBALANCE_PARTITIONS, *partition_by)
    if watched is not None:
        df = watched(df)
    order = [*partition_by, *cluster_by]
    return df.sortWithinPartitions(*order) if order else df


def write_parquet_overwrite(
    df: DataFrame,
    target: str,
    reads: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    only_touched_partitions: bool = False,
    max_records_per_file: int | None = None,
    bloom_filters: Sequence[str] = (),
) -> None:
    """Replace ``target``, or with ``only_touched_partitions`` the partitions in ``df``.

    ``reads`` names the paths ``df`` is read from. Overwriting one of them would
    delete the input before it is read, so that is refused here. Columns in ``bloom_filters`` get a
    filter in every row group, so that looking a value up reads only the groups that may hold it.
    """
    for source in reads:
        if _overlap(df.sparkSession, source, target):
            raise ValueError(f"refusing to overwrite {target}: the data is read from {source}")
    writer = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        mode = "dynamic" if only_touched_partitions else "static"
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", mode)
    for column in bloom_filters:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if bloom_filters:
        # Sized by the values met, a megabyte at most.
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(target)


def write_layer(
    df: DataFrame,
    target: str,
    reads: Sequence[str] = (),
    rebalance: bool = True,
    partition_by: Sequence[str] = PARTITION_BY,
    cluster_by: Sequence[str] = CLUSTER_BY,
    only_touched_partitions: bool = False,
) -> None:
    write_parquet_overwrite(
        output_file_policy(df, partition_by, cluster_by, rebalance),
        target,
        reads,
        partition_by,
        only_touched_partitions,
    )


def write_bronze(squads: DataFrame, target: str, reads: Sequence[str] = (), **layout) -> None:
    """File raw squads by season and team, fields untouched, every document kept.

    Thousands of small documents of mixed seasons share an input task, so this is
    the one layer that needs the shuffle.
    """
    write_layer(squads, target, reads, rebalance=True, **layout)


def scan_season_range(df: DataFrame, floor: int, season: str = "season") -> DataFrame:
    """Seasons from ``floor`` on; on a partitioned table this prunes directories."""
    return df.where(F.col(season) >= floor)


def lookup_player(df: DataFrame, players_id: str, first_season: int | None = None) -> DataFrame:
    """All seasons of one player. Ids lie in no order, so row groups are told apart by their filters."""
    rows = df if first_season is None else scan_season_range(df, first_season)
    return rows.where(F.col("players_id") == players_id)


def lookup_team_season(
    df: DataFrame, team: str, season: int, team_name_mode: str = "token"
) -> DataFrame:
    """One squad of one season. ``team`` may be the raw or the readable name, the latter in
    the mode the table was built with.

    The name is normalised as a constant, so the filter still reaches the scan.
    """
    wanted = F.col("team").isin(F.lit(team), normalize_team_name(F.lit(team), team_name_mode))
    return df.where((F.col("season") == season) & wanted)
