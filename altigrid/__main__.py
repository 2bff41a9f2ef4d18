"""Jobs for spark-submit: ``python -m altigrid tiles --source IN --out OUT``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from altigrid.functions.grid import MAX_ZOOM, ZOOM_LIMIT
from altigrid.functions.palette import PALETTES
from altigrid.plans import jobs
from altigrid.sources.points import COMPAT, STRICT


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="altigrid", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    def command(name: str, note: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=note)
        sub.add_argument("--source", required=True)
        sub.add_argument("--out", required=True)
        sub.add_argument("--shuffle-partitions", type=int,
                         help="upper bound; the adaptive planner joins small ones")
        return sub

    tiles = command("tiles", "elevation files to pixel and tile tables")
    tiles.add_argument("--kind", choices=["text", "hgt"], default="text")
    tiles.add_argument("--max-zoom", type=int, default=MAX_ZOOM, choices=range(ZOOM_LIMIT + 1), metavar="0..19")
    tiles.add_argument("--min-zoom", type=int, default=0, choices=range(ZOOM_LIMIT + 1), metavar="0..19")
    finer = [command("tile-table", "elevation files to a tile table that can be updated"),
             command("update-tiles", "elevation files into a stored tile table")]
    for sub in finer:
        sub.add_argument("--kind", choices=["text", "hgt"], default="text")
        sub.add_argument("--max-zoom", type=int, default=MAX_ZOOM, choices=range(ZOOM_LIMIT + 1), metavar="0..19")
        sub.add_argument("--min-zoom", type=int, default=0, choices=range(ZOOM_LIMIT + 1), metavar="0..19")
    render = command("render", "a stored tile table to colour rasters")
    render.add_argument("--palette", choices=sorted(PALETTES), default="gps")
    command("upsert-points", "points into a stored point table")
    visits = command("gps-visits", "GPS text to visits per pixel")
    visits.add_argument("--zoom", type=int, default=9)
    others = [
        command("hgt-to-text", "binary elevation files to text"),
        command("elevation-stats", "statistics and histograms of heights"),
        command("gps-stats", "statistics and histograms of longitudes"),
    ]
    for sub in (tiles, visits, *finer, *others):
        sub.add_argument("--mode", choices=[STRICT, COMPAT], default=STRICT)
    others[0].add_argument("--drop-shared-edge", action="store_true", help="of neighbour files")
    upsert = command("points", "points under their geohash")
    upsert.add_argument("--fraction", type=float, help="store a sample only")
    upsert.add_argument("--mode", choices=[STRICT, COMPAT], default=STRICT)
    served = command("serve", "answers to a Parquet table of requests from a tile table (--source)")
    served.add_argument("--requests", required=True)
    served.add_argument("--kind", choices=["lookup", "box", "missing", "key"], required=True)
    served.add_argument("--banded", action="store_true", help="the source is a tile-table")
    cities = command("cities", "cities joined with regions, one per geohash")
    cities.add_argument("--regions", required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"altigrid {args.job}").getOrCreate()
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", args.shuffle_partitions)
    if args.job == "tiles":
        readings = jobs.read_elevation(spark, args.source, args.kind, args.mode)
        jobs.build_tiles(spark, readings, args.out, args.max_zoom, args.min_zoom)
    elif args.job in ("tile-table", "update-tiles"):
        readings = jobs.read_elevation(spark, args.source, args.kind, args.mode)
        run = jobs.build_tile_table if args.job == "tile-table" else jobs.update_tile_table
        run(spark, readings, args.out, args.max_zoom, args.min_zoom)
    elif args.job == "render":
        jobs.render(spark, args.source, args.out, args.palette)
    elif args.job == "upsert-points":
        jobs.upsert_points(spark, args.source, args.out)
    elif args.job == "gps-visits":
        jobs.gps_visits(spark, args.source, args.out, args.zoom, args.mode)
    elif args.job == "hgt-to-text":
        jobs.hgt_to_text(spark, args.source, args.out, args.mode, args.drop_shared_edge)
    elif args.job == "elevation-stats":
        jobs.elevation_stats(spark, args.source, args.out, args.mode)
    elif args.job == "gps-stats":
        jobs.gps_stats(spark, args.source, args.out, args.mode)
    elif args.job == "points":
        jobs.store_points(spark, args.source, args.out, args.fraction, args.mode)
    elif args.job == "serve":
        jobs.serve(spark, args.source, args.requests, args.out, args.kind, args.banded)
    else:
        jobs.store_cities(spark, args.source, args.regions, args.out)


if __name__ == "__main__":
    main()
