"""Build a lake from a staging folder: ``python -m squadlake --staging URI --lake URI``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from squadlake import fixed_values as fixed
from squadlake.plans import LAYERS, Floors, Lake, publish_lake, run_lake
from squadlake.session import SETTINGS
from squadlake.sources import expire_versions
from squadlake.sources.snapshots import KEEP
from squadlake.sources.squads import LAYOUTS


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="squadlake", description=__doc__)
    parser.add_argument("--staging", required=True, help="folder of squad documents")
    parser.add_argument("--lake", required=True, help="root folder of the tables to write")
    parser.add_argument("--publish", help="root folder of a second copy of the tables")
    parser.add_argument(
        "--refresh", action="store_true", help="only seasons whose files changed since the last run"
    )
    parser.add_argument("--keep-versions", type=int, default=KEEP, help="of every layer")
    parser.add_argument("--layout", choices=LAYOUTS, default="auto", help="of the documents")
    parser.add_argument("--team-names", choices=("token", "substring"), default="token")
    parser.add_argument("--market-floor", type=int, default=fixed.MARKET_FLOOR)
    parser.add_argument("--age-floor", type=int, default=fixed.SQUAD_AGE_FLOOR)
    options = parser.parse_args(arguments)

    builder = SparkSession.builder.appName("squadlake")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    lake = Lake(options.lake.rstrip("/"))
    floors = Floors(options.market_floor, options.age_floor)
    run_lake(
        spark, options.staging, lake, options.layout, options.team_names, floors, refresh=options.refresh
    )
    places = [lake]
    if options.publish:
        places.append(Lake(options.publish.rstrip("/")))
        publish_lake(spark, *places)
    for place in places:
        for layer in LAYERS:
            expire_versions(spark, place.layer(layer), options.keep_versions)


if __name__ == "__main__":
    main()
