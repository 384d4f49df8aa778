"""Loads that are published whole or not at all, declared schemas, gates, and loads that find their seasons."""

from __future__ import annotations

import re
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_job import _land
from test_plans import plan

from seasongrid.operators.quality import Limits, LoadRejected, Watch
from seasongrid.plans import job, star
from seasongrid.schemas import Added, Schemas
from seasongrid.session import fresh_dir
from seasongrid.sources import landing, ledger, sinks
from seasongrid.sources.files import Folder
from seasongrid.sources.stores import CatalogStore, FolderStore
from seasongrid.sources.tables import read_table, register_star


def _facts(table):
    return rows(table, "Race_Key", "Race_Points")


def _prefix() -> str:
    return f"t{uuid.uuid4().hex[:10]}_"


@pytest.mark.parametrize("named", [False, True])
def test_a_load_that_fails_midway_changes_nothing(spark, make, monkeypatch, named):
    root, names = fresh_dir(spark, "midway"), _prefix() if named else None
    for year in (2023, 2024):
        _land(make, root, year, [1.0, 3.0])
    job.run(spark, [2023, 2024], root, catalog=names)
    _land(make, root, 2024, [7.0])

    def fails(*_args, **_more):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:  # all typed tables are staged by then
        patch.setattr(job, "load_star", fails)
        with pytest.raises(RuntimeError):
            job.run(spark, [2024], root, catalog=names)
    lost = F.raise_error(F.lit("lost")).cast("timestamp")
    with pytest.raises(Exception, match="lost"):
        job.run(spark, [2024], root, loaded_at=lost, catalog=names)
    typed, gold = job.stores(spark, root, catalog=names)
    want = [(202301, 1.0), (202302, 2.0), (202401, 1.0), (202402, 2.0)]
    assert _facts(gold.published("fact_team_results")) == want
    assert rows(typed.published("drivers_standings"), "meeting_key") == [(202301,), (202302,), (202401,), (202402,)]
    assert not [f for f in Folder(spark, typed.path("circuits")).folders() if f.name.startswith("_old")]
    job.run(spark, [2024], root, catalog=names)
    assert _facts(gold.published("fact_team_results")) == [*want[:2], (202401, 7.0)]


def test_a_switched_season_leaves_old_files_to_their_readers(spark, make):
    root, names = fresh_dir(spark, "switch"), _prefix()
    _land(make, root, 2023, [1.0])
    _land(make, root, 2024, [1.0, 3.0])
    job.run(spark, [2023, 2024], root, catalog=names)
    _, gold = job.stores(spark, root, catalog=names)
    old = spark.read.parquet(gold.location("fact_team_results", "2024"))
    _land(make, root, 2024, [7.0])
    job.run(spark, [2024], root, catalog=names)
    assert _facts(gold.published("fact_team_results")) == [(202301, 1.0), (202401, 7.0)]
    assert old.count() == 2  # still there
    assert gold.drop_unused("fact_team_results") == 0  # 2023 still lies in the folder of the first load
    job.run(spark, [2023], root, catalog=names)
    assert gold.drop_unused("fact_team_results") == 1 and gold.drop_unused("dim_race") == 2
    assert _facts(gold.published("fact_team_results")) == [(202301, 1.0), (202401, 7.0)]
    assert spark.newSession().table(f"{names}gold_dim_race").count() == 2


def test_seasons_that_end_without_rows(spark, make):
    for store in (FolderStore(spark, fresh_dir(spark, "f")), CatalogStore(spark, fresh_dir(spark, "c"), _prefix())):
        table = make("meeting_key long, team_name string, year int", (1, "a", 2023), (2, "b", 2024), (3, "c", None))
        store.replace("teams_standings", table)
        assert rows(store.read("teams_standings"), "meeting_key") == [(1,), (2,), (3,)]
        store.publish()
        store.replace("teams_standings", table.where("year = 2023"), [2023, 2024])
        assert rows(store.read("teams_standings"), "meeting_key", "year") == [(1, 2023), (3, None)]
        assert store.read("teams_standings", [2024]).count() == 0
        assert rows(store.published("teams_standings"), "meeting_key") == [(1,), (2,), (3,)]
        store.publish()
        assert rows(store.published("teams_standings"), "meeting_key", "year") == [(1, 2023), (3, None)]


def test_an_overwrite_that_fails_keeps_the_season(spark, make):
    path = fresh_dir(spark, "t")
    sinks.overwrite_seasons(make("k int, year int", (1, 2023), (2, 2024)), path)
    bad = make("k int, year int", (3, 2024)).withColumn("k", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        sinks.overwrite_seasons(bad, path, seasons=[2023, 2024])
    assert rows(read_table(spark, path), "k", "year") == [(1, 2023), (2, 2024)]
    sinks.overwrite_seasons(make("k int, year int", (4, 2024)), path, seasons=[2023, 2024])
    assert rows(read_table(spark, path), "k", "year") == [(4, 2024)]


def test_formats_with_a_log_replace_seasons_themselves(spark, make, monkeypatch):
    """No file is touched, and one write names the seasons it replaces."""
    options: dict[str, str] = {}

    class Writer:
        def option(self, key, value):
            options[key] = value
            return self

        def partitionBy(self, *_by):
            return self

        def save(self, path):
            options["path"] = path

    monkeypatch.setattr(sinks, "_overwriting", lambda _df, fmt, scope: options.update(fmt=fmt, scope=scope) or Writer())
    monkeypatch.setattr(sinks, "Folder", lambda *_: pytest.fail("files are the format's"))
    store = FolderStore(spark, "/nowhere", "logged")
    store.replace("teams", make("team_name string, year int", ("a", 2024)), [2023, 2024])
    store.publish()
    assert options == {"fmt": "logged", "scope": "static", "replaceWhere": "year IN (2023, 2024)", "path": "/nowhere/teams"}


@pytest.mark.parametrize("named", [False, True])
def test_columns_that_later_files_bring(spark, make, named):
    root, names = fresh_dir(spark, "growth"), _prefix() if named else None
    _land(make, root, 2023, [1.0])
    job.run(spark, [2023], root, catalog=names)
    _land(make, root, 2024, [2.0, 5.0])
    more = "driver_number long, position_current long, points_current double, meeting_key long, grid string, race_folder string"
    sinks.land_json(make(more, (8, 2, 1.0, 202401, "3", "01_R1"), (9, 3, 1.0, 202401, "x", "01_R1")), f"{root}/bronze/2024", "drivers_standings", ["race_folder"])
    grown = Schemas((Added("drivers_standings", "grid", "grid_position", "int", "0"), Added("drivers_standings", "note", "note", "string")))
    job.run(spark, [2024], root, catalog=names, schemas=grown)
    typed, gold = job.stores(spark, root, catalog=names, schemas=grown)
    table = typed.read("drivers_standings")
    assert rows(table, "year", "driver_number", "grid_position", "note") == [
        (2023, 7, 0, None), (2024, 7, 0, None), (2024, 7, 0, None), (2024, 8, 3, None), (2024, 9, 0, None),
    ]
    assert rows(table.where("grid_position = 0"), "year") == [(2023,), (2024,), (2024,), (2024,)]
    before, _ = job.stores(spark, root, catalog=names)
    assert "grid_position" not in before.read("drivers_standings").columns
    assert gold.read("fact_driver_results").count() == 5


def test_stored_tables_have_their_declared_schema(spark, make):
    root = fresh_dir(spark, "declared")
    _land(make, root, 2023, [1.0])
    job.run(spark, [2023], root)
    for store in job.stores(spark, root):
        for folder in Folder(spark, store.root).folders():
            declared = Schemas().table(folder.name)
            if not any(name.endswith(".parquet") for name in folder.files()):
                continue  # nothing landed for it
            found = {f.name: f.dataType for f in spark.read.parquet(folder.path).schema}
            assert found == {f.name: f.dataType for f in declared}, folder.name


def test_a_load_counts_and_refuses(spark, make):
    root = fresh_dir(spark, "watch")
    _land(make, root, 2023, [1.0, 2.0])
    counts = job.run(spark, [2023], root, limits=Limits(0, 0)).counts
    assert counts["fact_driver_results"] == {"rows": 2, "orphans_Race_Key": 0, "orphans_Team_Key": 0, "orphans_Driver_Key": 0}
    assert counts["dim_driver"] == {"rows": 1, "duplicate_keys": 0}
    stranger = "driver_number long, position_current long, points_current double, meeting_key long, race_folder string"
    sinks.land_json(make(stranger, (99, 2, 1.0, 202301, "01_R1")), f"{root}/bronze/2023", "drivers_standings", ["race_folder"])
    with pytest.raises(LoadRejected, match="fact_driver_results: 1 orphans_Driver_Key, 0 allowed"):
        job.run(spark, [2023], root, limits=Limits(orphan_keys=0))
    _, gold = job.stores(spark, root)
    assert gold.read("fact_driver_results").count() == 2
    assert job.run(spark, [2023], root, limits=Limits(orphan_keys=1)).counts["fact_driver_results"]["orphans_Driver_Key"] == 1
    assert gold.read("fact_driver_results").count() == 3


def test_counts_come_without_a_second_scan(spark, make):
    watch, path = Watch(), fresh_dir(spark, "w")
    dimension = make("k string, v int", ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2))
    watched = watch.dimension("d", dimension, "k")
    assert watched.columns == dimension.columns
    watched.write.parquet(path)
    facts = make("k string, n int", ("a", 1), ("z", 2), ("z", 3), (None, 4))
    looked = watch.fact("f", facts, {"k": dimension})
    assert rows(looked) == rows(facts)
    assert watch.counts() == {"d": {"rows": 5, "duplicate_keys": 2}, "f": {"rows": 4, "orphans_k": 2}}


def test_a_second_load_of_an_unchanged_season_opens_no_json(spark, make, monkeypatch):
    root = fresh_dir(spark, "due")
    session = "meeting_key long, session_key long, session_name string, session_type string, date_start string, race_folder string"
    for year in (2023, 2024):
        _land(make, root, year, [1.0, 3.0])
        races = [(year * 100 + i, i, "Race", "Race", f"{year}-0{i}-01", f"0{i}_Race_{i}") for i in (1, 2)]
        sinks.land_json(make(session, *races), f"{root}/bronze/{year}", "sessions", ["race_folder"])
    # folders are to be named by the catalog: move the records of one season there
    assert job.run(spark, None, root).seasons == []  # R1 and R2 are not what the catalog calls them
    typed, _ = job.stores(spark, root)
    catalog = job.catalog_of(*[landing.accepted(landing.scan_entity(spark, f"{root}/bronze", e)) for e in ("circuits", "sessions")])
    renamed = sinks.stored(catalog.withColumn("folder_name", F.regexp_replace("folder_name", "Race_", "R")), "catalog")
    monkeypatch.setattr(job, "catalog_of", lambda *_: renamed)
    assert job.run(spark, None, root).seasons == [2023, 2024]
    _land(make, root, 2024, [5.0, 6.0])
    assert ledger.changed_seasons(typed, ledger.landed_seasons(spark, f"{root}/bronze")) == [2024]
    assert job.run(spark, None, root).seasons == [2024]
    monkeypatch.setattr(landing, "scan_json", lambda *_: pytest.fail("JSON was read"))
    monkeypatch.setattr(job, "scan_entity", lambda *_: pytest.fail("JSON was read"))
    assert job.run(spark, None, root).seasons == []


def test_unknown_fields_are_kept_and_reported(spark, make, tmp_path):
    season = tmp_path / "bronze" / "2023" / "01_R1"
    season.mkdir(parents=True)
    (season / "drivers.json").write_text(
        '[{"driver_number": 1, "helmet": {"colour": "red"}, "age": 30}, {"driver_number": "2", "age": null}]\n\n'
        '{"driver_number": 3}\n{"driver_number": 4\n{"detail": "later"}\n[]\n[5]\n'
    )
    scan = landing.scan_rescued(spark, str(tmp_path / "bronze"), landing.entity_files("drivers"), ["driver_number", "full_name"])
    good = landing.accepted(scan)
    assert rows(good, "driver_number", "full_name") == [("1", None), ("2", None), ("3", None)]
    rescued = {r["driver_number"]: r["rescued"] for r in scan.where("driver_number is not null").collect()}
    assert rescued == {"1": {"helmet": '{"colour":"red"}', "age": "30"}, "2": {"age": None}, "3": None}
    assert rows(landing.quarantined(scan), "reason", "payload") == [
        ("error payload", "later"), ("malformed", "[5]"), ("malformed", '{"driver_number": 4'),
    ]
    assert rows(landing.unknown_fields(scan)) == [(2023, "age", 2, "30"), (2023, "helmet", 1, '{"colour":"red"}')]


def test_a_load_with_rescue_is_the_same_load(spark, make):
    root = fresh_dir(spark, "rescue")
    _land(make, root, 2023, [10.0, 25.5])
    job.run(spark, [2023], root)
    job.run(spark, [2023], f"{root}", rejects_root=f"{root}/rejects", rescue=True)
    typed, gold = job.stores(spark, root)
    assert _facts(gold.read("fact_driver_results")) == [(202301, 10.0), (202302, 15.5)]
    assert rows(typed.read("unknown_fields"), "entity", "field") == []


def test_a_season_of_the_star_reads_its_partition_only(spark, make):
    root = fresh_dir(spark, "pruned")
    for year in (2023, 2024):
        _land(make, root, year, [1.0, 3.0])
    job.run(spark, [2023, 2024], root)
    tables = register_star(spark, f"{root}/gold")
    whole = star.team_star(tables["fact_team_results"], tables["dim_team"], tables["dim_race"])
    text = plan(whole.where("Year = 2024"))
    assert len(re.findall(r"PartitionFilters: \[[^\]]*(?:season|Year)[^\]]*2024", text)) == 2  # fact and teams
    assert rows(whole.where("Year = 2024"), "Race_Key", "Team", "Year") == [(202401, "Alpha", 2024), (202402, "Alpha", 2024)]
    drivers = star.driver_star(*(tables[n] for n in ("fact_driver_results", "dim_driver", "dim_race", "dim_team")))
    assert len(re.findall(r"PartitionFilters: \[[^\]]*(?:season|Year)[^\]]*2024", plan(drivers.where("Year = 2024")))) == 3
    assert drivers.where("Driver is null or Team is null or Date is null").count() == 0


def test_dimensions_of_a_season_come_from_its_typed_tables(spark, make, monkeypatch):
    """Loaded season by season the star is that of a full rebuild, codes shared over seasons included."""
    root = fresh_dir(spark, "dims")
    for year in (2023, 2024, 2025):
        _land(make, root, year, [1.0, 3.0][: 2025 - year + 1])
    read = FolderStore.read
    asked = []
    monkeypatch.setattr(FolderStore, "read", lambda self, name, seasons=None: asked.append((name, seasons)) or read(self, name, seasons))
    for year in (2023, 2024, 2025, 2023):
        job.run(spark, [year], root)
    monkeypatch.undo()
    assert {seasons is None for name, seasons in asked if not name.startswith("dim_")} == {False}
    job.load_gold(spark, f"{root}/silver", f"{root}/again")
    for name in ("dim_driver", "dim_team", "dim_race", "ui_play_timeline", "fact_driver_results", "fact_team_results"):
        found, again = (read(FolderStore(spark, f"{root}/{where}"), name) for where in ("gold", "again"))
        assert rows(found) == rows(again) and found.count() > 0
