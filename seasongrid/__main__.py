"""Load seasons: ``spark-submit … -m seasongrid --root <path> 2023 2024``."""

from __future__ import annotations

import argparse

from seasongrid.config import Assets
from seasongrid.operators.quality import Limits
from seasongrid.plans import job
from seasongrid.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="seasongrid", description="Load landed seasons and rebuild the star.")
    parser.add_argument("seasons", nargs="*", type=int, help="none: those that are complete and not yet loaded as they are")
    parser.add_argument("--root", required=True, help="folder with bronze/, gets silver/ and gold/")
    parser.add_argument("--season-dir", default="{year}", help="name of a season's folder below bronze/")
    parser.add_argument("--default-photo", default=Assets.default_photo)
    parser.add_argument("--logo-base", default=Assets.logo_base)
    parser.add_argument("--rejects", help="folder for records that were not accepted")
    parser.add_argument("--team-at-race", action="store_true", help="results count for the team of the day, not of the season")
    parser.add_argument("--format", default="parquet", help="format of the written tables")
    parser.add_argument("--catalog", help="start of the tables' names in the catalog, such as 'lake.'")
    parser.add_argument("--rescue", action="store_true", help="store which undeclared fields the landed records have")
    parser.add_argument("--max-duplicate-keys", type=int, help="refuse a load with more repeated dimension keys")
    parser.add_argument("--max-orphan-keys", type=int, help="refuse a load with more fact keys without a dimension row")
    options = parser.parse_args()
    assets = Assets(options.default_photo, options.logo_base)
    watched = options.max_duplicate_keys is not None or options.max_orphan_keys is not None
    report = job.run(
        build_session("seasongrid-load"),
        options.seasons or None,
        options.root,
        options.season_dir,
        assets,
        rejects_root=options.rejects,
        fmt=options.format,
        team_at_race=options.team_at_race,
        catalog=options.catalog,
        limits=Limits(options.max_duplicate_keys, options.max_orphan_keys) if watched else None,
        rescue=options.rescue,
    )
    print(f"loaded {report.seasons or 'nothing'}", *[f"{name}: {counts}" for name, counts in report.counts.items()], sep="\n")


if __name__ == "__main__":
    main()
