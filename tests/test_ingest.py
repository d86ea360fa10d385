"""End-to-end import runs over hand-made archives (FIXTURES.md §3)."""

import pytest

from lading.plans.ingest import import_landing
from lading.plans.status import UnknownProvider, status

STOPS_HDR = "stop_id,stop_name,stop_lat,stop_lon"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def run(spark, landing, workdir, **kw):
    return import_landing(spark, landing, f"{workdir}/wh", **kw)


def test_edge_records(spark, land, workdir):
    body = (
        "﻿" + STOPS_HDR + "\r\n"
        'S1,"Name, A",3.5,101.1\r\n'
        "\r\n"  # blank line: not a record
        "S2,,3.5,101.2\n"  # empty cell stays ''
        'S3,"",x,101.2\n'  # "" stays '', x is a rejected real
        'S4,"q ""z""",1e3,5.\n'
        "S5,short\n"  # ragged: dropped
        "S6,a,1,2,extra\n"  # ragged: dropped
        'S7,"two\nlines",1,2\n'  # quoted line break: one record
        "S8,a\\b,1,2\n"  # backslash literal
    ).encode("utf-8") + b"S9,\xff\xfe,1,2\n" + b"S10,late,25,26\n"
    landing = land("ktmb", "e1", {"stops.txt": body})
    res = run(spark, landing, workdir, max_rows=None)
    t = res.table("stops")
    got = {r["stop_id"]: r for r in t.collect()}
    assert set(got) == {"S1", "S2", "S3", "S4", "S7", "S8", "S10"}
    assert got["S1"]["stop_name"] == "Name, A"
    assert got["S2"]["stop_name"] == "" and got["S3"]["stop_name"] == ""
    assert got["S3"]["stop_lat"] is None
    assert got["S4"]["stop_name"] == 'q "z"' and got["S4"]["stop_lat"] == 1000.0 and got["S4"]["stop_lon"] == 5.0
    assert got["S7"]["stop_name"] == "two\nlines"
    assert got["S8"]["stop_name"] == "a\\b"
    assert got["S1"]["stop_code"] is None  # not declared for this provider
    prog = {r["FileName"]: r for r in res.progress().collect()}
    assert prog["stops.txt"]["Status"] == 0
    assert prog["stops.txt"]["LastProcessedLine"] == 10  # records after the header, malformed included
    rej = spark.read.parquet(f"{workdir}/wh/rejects").collect()
    assert [(r["column"], r["text"]) for r in rej] == [("stop_lat", "x")]


def test_headers_entries_and_layouts(spark, land, workdir):
    landing = land("ktmb", "e1", {
        "stops.txt": "stop_lon,Stop_ID,stop_id,extra,stop_id,stop_name\n1,X,S1,e,S1b,One\n",  # reordered, dup, case
        "trips.txt": "route_id,trip_id\nR1,T1\n",  # missing columns → NULL
        "routes.txt": "foo,bar\n1,2\n",  # no match → no rows, status 0
        "agency.txt": "agency_id,agency_name\n",  # header only
        "calendar.txt": "",  # empty file
        "dir/stops.txt": STOPS_HDR + "\nD,d,1,1\n",
        "__MACOSX/._stops.txt": STOPS_HDR + "\nM,m,1,1\n",
        "._x.txt": "a\n1\n",
        "readme.md": "x",
        "unknown.txt": "a\n1\n",
        "import_progress.txt": "Provider,FileName\nx,y\n",
    })
    res = run(spark, landing, workdir)
    assert rows(res.table("stops"), "stop_id", "stop_name", "stop_lon", "stop_lat") == [("S1", "One", 1.0, None)]
    assert rows(res.table("trips"), "trip_id", "route_id", "service_id", "direction_id") == [("T1", "R1", None, None)]
    assert res.table("routes").count() == 0
    prog = {r["FileName"]: (r["Status"], r["LastProcessedLine"]) for r in res.progress().collect()}
    assert set(prog) == {"stops.txt", "trips.txt", "routes.txt", "agency.txt", "calendar.txt"}
    assert all(s == 0 for s, _ in prog.values())


def test_two_runs_and_version_change(spark, land, workdir):
    landing = land("ktmb", "e1", {"stops.txt": STOPS_HDR + "\nA,a,1,1\nB,b,2,2\nA,a2,3,3\n",
                                  "trips.txt": "route_id,service_id,trip_id,direction_id\nR,S,T,0\n"})
    r1 = run(spark, landing, workdir)
    assert r1.rows_imported() == 4
    assert rows(r1.table("stops"), "stop_id", "stop_name") == [("A", "a2"), ("B", "b")]  # later line wins
    r2 = run(spark, landing, workdir)
    assert r2.rows_imported() == 0 and r2.providers[0]["action"] == "skip"
    # New version: stops changed (row B gone, C new), trips unchanged (same CRC → skipped).
    land("ktmb", "e2", {"stops.txt": STOPS_HDR + "\nA,a3,1,1\nC,c,2,2\n",
                        "trips.txt": "route_id,service_id,trip_id,direction_id\nR,S,T,0\n"})
    r3 = run(spark, landing, workdir)
    assert {f["file"] for f in r3.files} == {"stops.txt"}
    assert rows(r3.table("stops"), "stop_id", "stop_name") == [("A", "a3"), ("B", "b"), ("C", "c")]  # no deletes
    assert [r["ETag"] for r in r3.versions().collect()] == ["e2"]


def test_keyless_appends(spark, land, workdir):
    hdr = "leg_group_id,from_area_id,to_area_id,fare_product_id\n"
    landing = land("mybas-johor", "e1", {"fare_leg_rules.txt": hdr + "g,a,b,f\n"})
    run(spark, landing, workdir)
    land("mybas-johor", "e2", {"fare_leg_rules.txt": hdr + "g,a,b,f\n "})  # other CRC
    res = run(spark, landing, workdir)
    assert res.table("fare_leg_rules").count() == 2


@pytest.mark.parametrize("budget,first_status", [(3, 0), (2, 1)])
def test_budget_exact_and_short(spark, land, workdir, budget, first_status):
    landing = land("ktmb", "e1", {"stops.txt": STOPS_HDR + "\nA,a,1,1\nB,b,1,1\nC,c,1,1\n"})
    r1 = run(spark, landing, workdir, max_rows=budget)
    st = {r["FileName"]: r["Status"] for r in r1.progress().collect()}
    assert st["stops.txt"] == first_status
    r2 = run(spark, landing, workdir, max_rows=budget)
    assert r2.rows_imported() == (0 if first_status == 0 else 1)
    assert r2.reused == (0 if first_status == 0 else 1)  # resumed file is not expanded again
    assert rows(r2.table("stops"), "stop_id") == [("A",), ("B",), ("C",)]


def test_budget_across_files_and_malformed_before_offset(spark, land, workdir):
    landing = land("ktmb", "e1", {
        "agency.txt": "agency_id,agency_name\nX,x\nbroken\nY,y\n",
        "stops.txt": STOPS_HDR + "\nA,a,1,1\nB,b,1,1\n",
    })
    r1 = run(spark, landing, workdir, max_rows=2)  # agency first (name order): X, Y
    assert {f["file"]: f["rows"] for f in r1.files} == {"agency.txt": 2, "stops.txt": 0}
    r2 = run(spark, landing, workdir, max_rows=1)
    r3 = run(spark, landing, workdir, max_rows=1)
    assert r2.rows_imported() == 1 and r3.rows_imported() == 1
    assert rows(r3.table("agency"), "agency_id") == [("X",), ("Y",)]
    assert rows(r3.table("stops"), "stop_id") == [("A",), ("B",)]
    assert all(r["Status"] == 0 for r in r3.progress().collect())


def test_crash_before_progress_repeats_work(spark, land, workdir, monkeypatch):
    """A run killed after the data commit but before progress: the next run
    redoes the file and the state equals one clean run."""
    import lading.plans.ingest as ingest

    landing = land("ktmb", "e1", {"stops.txt": STOPS_HDR + "\nA,a,1,1\nB,b,2,2\n"})
    real = ingest.write_table
    calls = {"n": 0}

    def failing(df, root, name):
        calls["n"] += 1
        raise RuntimeError("executor lost")

    monkeypatch.setattr(ingest, "write_table", failing)
    with pytest.raises(RuntimeError):
        run(spark, landing, workdir)
    monkeypatch.setattr(ingest, "write_table", real)
    res = run(spark, landing, workdir)
    assert rows(res.table("stops"), "stop_id", "stop_name") == [("A", "a"), ("B", "b")]
    assert [r["Status"] for r in res.progress().collect()] == [0]


def test_status_query(spark, land, workdir):
    landing = land("ktmb", "e1", {"stops.txt": STOPS_HDR + "\nA,a,1,1\n"})
    run(spark, landing, workdir)
    st = status(spark, f"{workdir}/wh", "ktmb", known=["ktmb"]).collect()
    assert len(st) == 1 and '"FileName":"stops.txt"' in st[0]["json"] and '"Status":0' in st[0]["json"]
    with pytest.raises(UnknownProvider):
        status(spark, f"{workdir}/wh", "nope", known=["ktmb"])


def test_failed_table_does_not_stop_siblings(spark, land, workdir, monkeypatch):
    import lading.plans.ingest as ingest

    landing = land("ktmb", "e1", {"stops.txt": STOPS_HDR + "\nA,a,1,1\n",
                                  "agency.txt": "agency_id,agency_name\nX,x\n"})
    real = ingest.apply_upserts

    def flaky(spark_, root, table, *a, **k):
        if table == "agency":
            raise RuntimeError("store unavailable")
        return real(spark_, root, table, *a, **k)

    monkeypatch.setattr(ingest, "apply_upserts", flaky)
    with pytest.raises(ingest.ImportFailed) as err:
        run(spark, landing, workdir)
    res = err.value.result
    assert set(res.errors) == {"agency"}
    log = {r["file"]: (r["rows"], r["file_error"], r["provider_error"]) for r in res.run_log().collect()}
    assert log == {"stops.txt": (1, False, True), "agency.txt": (0, True, True)}
    assert rows(res.table("stops"), "stop_id") == [("A",)]
    prog = {r["FileName"]: (r["Status"], r["LastProcessedLine"]) for r in res.progress().collect()}
    assert prog == {"stops.txt": (0, 1), "agency.txt": (1, 0)}
    monkeypatch.setattr(ingest, "apply_upserts", real)
    again = run(spark, landing, workdir)  # unchanged version, one open file: resume
    assert again.providers[0]["action"] == "resume"
    assert {f["file"] for f in again.files} == {"agency.txt"}
    assert rows(again.table("agency"), "agency_id") == [("X",)]


def test_new_version_without_changed_files_is_recorded(spark, land, workdir):
    files = {"stops.txt": STOPS_HDR + "\nA,a,1,1\n"}
    landing = land("ktmb", "e1", files)
    run(spark, landing, workdir)
    land("ktmb", "e2", files)  # same content, same CRC
    r2 = run(spark, landing, workdir)
    assert r2.providers[0]["action"] == "import" and r2.files == []
    assert [r["ETag"] for r in r2.versions().collect()] == ["e2"]
    r3 = run(spark, landing, workdir)
    assert r3.providers[0]["action"] == "skip"


def test_unreadable_archive_is_retried(spark, land, workdir):
    landing = land("ktmb", "e1", {"stops.txt": STOPS_HDR + "\nA,a,1,1\n"})
    run(spark, landing, workdir)
    import os
    bad = f"{landing}/provider=ktmb/version=e2/feed.zip"
    os.makedirs(os.path.dirname(bad.replace("file:", "")), exist_ok=True)
    with open(bad.replace("file:", ""), "wb") as fh:
        fh.write(b"not a zip")
    r2 = run(spark, landing, workdir)
    assert r2.providers[0]["action"] == "import"
    assert [r["ETag"] for r in r2.versions().collect()] == ["e1"]


def test_budget_cut_inside_and_between_count_blocks(spark, land, workdir, monkeypatch):
    """The last granted line is found inside its block of lines, wherever the
    malformed lines and the block edges are."""
    import lading.plans.ingest as ingest

    monkeypatch.setattr(ingest, "COUNT_BLOCK", 7)
    body = STOPS_HDR + "\n" + "".join(f"S{i},n{i},1,1\n" for i in range(30)) + "bad\n" + "S99,x,1,1\n"
    landing = land("ktmb", "e1", {"stops.txt": body})
    r1 = run(spark, landing, workdir, max_rows=25)
    assert r1.rows_imported() == 25
    assert [r["LastProcessedLine"] for r in r1.progress().collect()] == [25]
    r2 = run(spark, landing, workdir, max_rows=25)
    assert r2.rows_imported() == 6
    assert r2.table("stops").count() == 31


def test_widened_schema_reimports_unchanged_file(spark, land, workdir):
    from lading.registry import build_registry, LOGICAL_TABLES_TEXT

    two = build_registry(LOGICAL_TABLES_TEXT, "[ktmb]\nstops: stop_id stop_name")
    three = build_registry(LOGICAL_TABLES_TEXT, "[ktmb]\nstops: stop_id stop_name stop_lat")
    files = {"stops.txt": STOPS_HDR + "\nA,a,1.5,2\n"}
    landing = land("ktmb", "e1", files)
    r1 = run(spark, landing, workdir, registry=two)
    assert rows(r1.table("stops"), "stop_id", "stop_lat") == [("A", None)]
    land("ktmb", "e2", files)  # new version, same file, same CRC
    r2 = run(spark, landing, workdir, registry=two)
    assert r2.files == []  # same schema: skipped
    land("ktmb", "e3", files)
    r3 = run(spark, landing, workdir, registry=three)
    assert {f["file"] for f in r3.files} == {"stops.txt"}
    assert rows(r3.table("stops"), "stop_id", "stop_lat") == [("A", 1.5)]
    assert r3.reused == 1  # records are the same: staged ones are read again
    crc = r3.progress().collect()[0]["CRC"]
    assert len(crc) == 17 and crc[8] == ":"


def test_keyless_replace_file_option(spark, land, workdir):
    hdr = "leg_group_id,from_area_id,to_area_id,fare_product_id\n"
    landing = land("mybas-johor", "e1", {"fare_leg_rules.txt": hdr + "g,a,b,f\ng2,a,b,f\n"})
    run(spark, landing, workdir, keyless="replace_file")
    land("mybas-johor", "e2", {"fare_leg_rules.txt": hdr + "g,a,b,f\n "})
    res = run(spark, landing, workdir, keyless="replace_file")
    assert rows(res.table("fare_leg_rules"), "leg_group_id", "_source_file") == [("g", "fare_leg_rules.txt")]


def test_archive_writer_leaves_only_complete_archives(spark, workdir):
    import glob
    import zipfile

    from lading.sources.archive import write_archives

    landing = f"{workdir}/landed"
    lines = spark.range(0, 1000, numPartitions=3).selectExpr("cast(id as string) AS line")
    written = write_archives(lines, landing, "v1", "t", "id", "p").collect()
    assert sum(w["rows"] for w in written) == 1000
    local = landing.replace("file:", "")
    files = sorted(glob.glob(f"{local}/**/*", recursive=True))
    assert not [f for f in files if ".attempt-" in f]
    zips = [f for f in files if f.endswith(".zip")]
    assert len(zips) == len(written)
    total = 0
    for z in zips:
        with zipfile.ZipFile(z) as zf:
            total += len(zf.read("t.txt").decode().splitlines()) - 1
    assert total == 1000


def test_same_file_in_two_archives_of_a_version_fails_that_file(spark, land, workdir):
    from lading.plans.ingest import ImportFailed

    landing = land("ktmb", "e1", {"stops.txt": STOPS_HDR + "\nA,a,1,1\n", "agency.txt": "agency_id,agency_name\nX,x\n"}, name="one.zip")
    land("ktmb", "e1", {"stops.txt": STOPS_HDR + "\nB,b,1,1\n"}, name="two.zip")
    with pytest.raises(ImportFailed, match="two archives") as err:
        run(spark, landing, workdir)
    res = err.value.result
    assert set(res.file_errors) == {("ktmb", "stops.txt")}
    assert rows(res.table("agency"), "agency_id") == [("X",)]
    assert res.table("stops").count() == 0


def test_one_unreadable_archive_of_several_keeps_the_version_open(spark, land, workdir):
    from lading.plans.ingest import ImportFailed
    from lading.streaming.feed_stream import import_stream

    stops, agency = STOPS_HDR + "\nA,a,1,1\nB,b,1,1\n", "agency_id,agency_name\nX,x\n"
    landing = land("ktmb", "e1", {"stops.txt": stops}, name="one.zip")
    land("ktmb", "e1", {"agency.txt": agency}, name="two.zip")
    run(spark, landing, workdir, max_rows=2)  # agency and the first stop; stops.txt stays open
    broken = f"{landing}/provider=ktmb/version=e1/one.zip".replace("file:", "")
    with open(broken, "wb") as fh:
        fh.write(b"not a zip")
    with pytest.raises(ImportFailed) as err:
        run(spark, landing, workdir)
    res = err.value.result
    assert {f.rsplit("/")[-1] for _, f in res.file_errors} == {"one.zip", "stops.txt"}
    assert {r["FileName"]: (r["Status"], r["LastProcessedLine"]) for r in res.progress().collect()} == {"stops.txt": (1, 1), "agency.txt": (0, 1)}
    # a new version with a broken archive: what can be read loads, the version is not stored
    land("ktmb", "e2", {"agency.txt": agency + "Y,y\n"}, name="two.zip")
    with open(broken.replace("e1", "e2"), "wb") as fh:
        fh.write(b"not a zip")
    with pytest.raises(ImportFailed) as err:
        run(spark, landing, workdir)
    assert rows(err.value.result.table("agency"), "agency_id") == [("X",), ("Y",)]
    assert [r["ETag"] for r in err.value.result.versions().collect()] == ["e1"]
    with pytest.raises(Exception, match="cannot be read"):
        import_stream(spark, landing, f"{workdir}/wh")
    land("ktmb", "e2", {"stops.txt": stops}, name="one.zip")
    done = run(spark, landing, workdir)
    assert rows(done.table("stops"), "stop_id") == [("A",), ("B",)]
    assert [r["ETag"] for r in done.versions().collect()] == ["e2"]
    assert all(r["Status"] == 0 for r in done.progress().collect())


def break_member(path: str, name: str, where: str) -> None:
    """Damage one member: its local header, or a byte of its body."""
    import zipfile

    path = path.replace("file:", "")
    with zipfile.ZipFile(path) as zf:
        info = zf.getinfo(name)
    with open(path, "r+b") as fh:
        fh.seek(info.header_offset + (0 if where == "header" else 30 + len(name) + 2))
        fh.write(b"\xff\xff\xff")


@pytest.mark.parametrize("where", ["header", "body"])
def test_broken_member_leaves_siblings_and_its_old_offset(spark, land, workdir, where):
    from lading.plans.ingest import ImportFailed

    body = STOPS_HDR + "\n" + "".join(f"S{i},n{i},1,1\n" for i in range(500))
    landing = land("ktmb", "e1", {"stops.txt": body, "agency.txt": "agency_id,agency_name\nX,x\n"})
    land("mybas-johor", "e1", {"stops.txt": "stop_id,stop_name\nM,m\n"})
    break_member(f"{landing}/provider=ktmb/version=e1/feed.zip", "stops.txt", where)
    with pytest.raises(ImportFailed) as err:
        run(spark, landing, workdir)
    res = err.value.result
    assert set(res.file_errors) == {("ktmb", "stops.txt")} and res.errors == {}
    assert rows(res.table("agency"), "agency_id") == [("X",)]
    assert rows(res.table("stops"), "provider", "stop_id") == [("mybas-johor", "M")]
    prog = {(r["Provider"], r["FileName"]): (r["Status"], r["LastProcessedLine"]) for r in res.progress().collect()}
    assert prog["ktmb", "stops.txt"] == (1, 0) and prog["ktmb", "agency.txt"] == (0, 1)
    log = {r["file"]: r["file_error"] for r in res.run_log().where("provider = 'ktmb'").collect()}
    assert log == {"stops.txt": True, "agency.txt": False}
    # once the archive is whole again, the open file is resumed
    land("ktmb", "e1", {"stops.txt": body, "agency.txt": "agency_id,agency_name\nX,x\n"})
    again = run(spark, landing, workdir)
    assert {f["file"] for f in again.files} == {"stops.txt"} and again.table("stops").count() == 501


def test_half_written_folders_are_passed_over(spark, land, workdir):
    import os

    landing = land("ktmb", "e1", {"stops.txt": STOPS_HDR + "\nA,a,1,1\n"})
    run(spark, landing, workdir)
    local = f"{workdir}/wh".replace("file:", "")
    for name in ("tables/stops", "control/import_progress", "control/manifest", "control/dataset_versions", "control/staged_entries"):
        have = sorted(d for d in os.listdir(f"{local}/{name}") if d.startswith("v="))
        os.makedirs(f"{local}/{name}/v={int(have[-1][2:]) + 1:08d}/_temporary")
    land("ktmb", "e2", {"stops.txt": STOPS_HDR + "\nB,b,2,2\n"})
    res = run(spark, landing, workdir)
    assert rows(res.table("stops"), "stop_id") == [("A",), ("B",)]


def test_crash_between_table_and_versions_does_not_double_keyless_rows(spark, land, workdir, monkeypatch):
    import lading.plans.ingest as ingest

    hdr = "leg_group_id,from_area_id,to_area_id,fare_product_id\n"
    landing = land("mybas-johor", "e1", {"fare_leg_rules.txt": hdr + "g,a,b,f\n"})
    real = ingest.write_tables

    def dying(tables, root):
        if ingest.VERSIONS in tables:
            raise RuntimeError("driver lost")
        return real(tables, root)

    monkeypatch.setattr(ingest, "write_tables", dying)
    with pytest.raises(RuntimeError, match="driver lost"):
        run(spark, landing, workdir)
    monkeypatch.setattr(ingest, "write_tables", real)
    res = run(spark, landing, workdir)
    assert res.table("fare_leg_rules").count() == 1


def test_progress_is_open_while_a_table_loads(spark, land, workdir, monkeypatch):
    import lading.plans.ingest as ingest

    landing = land("ktmb", "e1", {"stops.txt": STOPS_HDR + "\nA,a,1,1\n"})
    real, seen = ingest.apply_upserts, []

    def spying(spark_, root, *a, **k):
        seen.extend((r["FileName"], r["Status"]) for r in status(spark_, root, "ktmb").collect())
        return real(spark_, root, *a, **k)

    monkeypatch.setattr(ingest, "apply_upserts", spying)
    res = run(spark, landing, workdir)
    assert seen == [("stops.txt", 1)]
    assert [(r["FileName"], r["Status"]) for r in res.progress().collect()] == [("stops.txt", 0)]
    assert spark.read.parquet(f"{workdir}/wh/control/run_log").count() >= 1


def test_vanished_open_files_are_closed(spark, land, workdir):
    body = STOPS_HDR + "\nA,a,1,1\nB,b,1,1\n"
    landing = land("ktmb", "e1", {"stops.txt": body})
    run(spark, landing, workdir, max_rows=1)
    land("ktmb", "e2", {"agency.txt": "agency_id,agency_name\nX,x\n"})
    r2 = run(spark, landing, workdir)
    assert {r["FileName"]: r["Status"] for r in r2.progress().collect()} == {"stops.txt": 0, "agency.txt": 0}
    assert run(spark, landing, workdir).providers[0]["action"] == "skip"


def test_untouched_buckets_keep_their_files(spark, land, workdir, monkeypatch):
    import lading.sinks.feed_tables as feed_tables
    from lading.sinks.feed_tables import read_manifest

    monkeypatch.setattr(feed_tables, "BUCKET_ROWS", 10)
    body = STOPS_HDR + "\n" + "".join(f"S{i},n{i},1,1\n" for i in range(100))
    landing = land("ktmb", "e1", {"stops.txt": body})
    run(spark, landing, workdir)
    before = {r["bucket"]: r["version"] for r in read_manifest(spark, f"{workdir}/wh").collect()}
    assert {r["buckets"] for r in read_manifest(spark, f"{workdir}/wh").collect()} == {16}
    land("ktmb", "e2", {"stops.txt": STOPS_HDR + "\nS5,new,1,1\n"})
    res = run(spark, landing, workdir)
    after = {r["bucket"]: r["version"] for r in read_manifest(spark, f"{workdir}/wh").collect()}
    assert sum(before[b] != after[b] for b in before) == 1
    t = {r["stop_id"]: r["stop_name"] for r in res.table("stops").collect()}
    assert len(t) == 100 and t["S5"] == "new" and t["S6"] == "n6"
    # far more rows than the buckets were meant for: the provider is dealt anew
    land("ktmb", "e3", {"stops.txt": STOPS_HDR + "\n" + "".join(f"S{i},m{i},1,1\n" for i in range(900))})
    res = run(spark, landing, workdir)
    assert res.table("stops").count() == 900
    assert {r["buckets"] for r in read_manifest(spark, f"{workdir}/wh").collect()} == {128}


def test_provider_names_with_special_characters(spark, workdir):
    import os

    from tests.conftest import make_zip
    from lading.registry import build_registry

    reg = build_registry("t: k text, v text | k", "[a:b%c]\nt: k v")
    make_zip(f"{workdir}/landing/provider=a%3Ab%25c/version=e1/feed.zip".replace("file:", ""), {"t.txt": "k,v\n1,x\n"})
    res = run(spark, f"{workdir}/landing", workdir, registry=reg)
    assert rows(res.table("t"), "provider", "k", "v") == [("a:b%c", "1", "x")]
    assert os.path.isdir(f"{workdir}/wh/tables/t".replace("file:", ""))


def test_keyless_provider_that_declares_the_key_column_appends(spark, land, workdir):
    from lading.registry import build_registry

    reg = build_registry("t: k text, v text | k", "[p]\nt (keyless): k v\n\n[q]\nt: k v")
    landing = land("p", "e1", {"t.txt": "k,v\n1,x\n1,y\n"})
    land("q", "e1", {"t.txt": "k,v\n1,x\n1,y\n"})
    res = run(spark, landing, workdir, registry=reg)
    assert rows(res.table("t"), "provider", "k", "v") == [("p", "1", "x"), ("p", "1", "y"), ("q", "1", "y")]


def test_csv_quote_rules_end_to_end(spark, land, workdir):
    body = STOPS_HDR + '\rA,"x\r\ny",1,1\rB,"q"uote,1,1\r\nC,"a ""b"" c"d"e,1,1\n' + 'D,' + '"' + "long " * 300_000 + '\n",1,1\nE,"open,1,1\n'
    landing = land("ktmb", "e1", {"stops.txt": body})
    res = run(spark, landing, workdir, max_rows=None)
    t = {r["stop_id"]: r["stop_name"] for r in res.table("stops").collect()}
    assert set(t) == {"A", "B", "C", "D"}
    assert (t["A"], t["B"], t["C"]) == ("x\r\ny", "quote", 'a "b" cd"e')
    assert len(t["D"]) == 1_500_001


def test_more_rows_than_the_default_cap(spark, workdir):
    from lading.plans import feed_queries as Q
    from lading.plans.ingest import MAX_ROWS_PER_RUN

    n = MAX_ROWS_PER_RUN + 20_000
    src = spark.range(0, n, numPartitions=1).selectExpr(
        "id AS c_custkey", "concat('c', id) AS c_name", "id % 25 AS c_nationkey", "cast(id AS double) AS c_acctbal", "'M' AS c_mktsegment")
    src.coalesce(1).write.parquet(f"{workdir}/sf/customer.parquet")
    out = Q.feed_import(spark, f"{workdir}/sf")
    assert out.count() == n and out.select("c_custkey").distinct().count() == n


def test_vacuum_keeps_what_commits_name(spark, workdir):
    from lading.sinks.snapshots import _versions, read_table, vacuum, write_table

    df = spark.range(3).toDF("n")
    for k in range(4):
        write_table(df.where(f"n >= {k}"), workdir, "t")
    vacuum(workdir, keep=2)
    assert _versions(workdir, "t") == [3, 4]
    assert read_table(spark, workdir, "t", df.schema).count() == 0


def test_a_repeated_feed_rewrites_only_buckets_with_a_difference(spark, land, workdir, monkeypatch):
    import lading.sinks.feed_tables as feed_tables
    from lading.sinks.feed_tables import read_manifest

    monkeypatch.setattr(feed_tables, "BUCKET_ROWS", 10)
    line = "S{0},n{0},{1},\n".format
    body = STOPS_HDR + "\n" + "".join(line(i, i % 9) for i in range(100))
    landing = land("ktmb", "e1", {"stops.txt": body})
    run(spark, landing, workdir)
    before = {r["bucket"]: (r["version"], r["rows"]) for r in read_manifest(spark, f"{workdir}/wh").collect()}
    assert len(before) > 10 and sum(n for _, n in before.values()) == 100
    land("ktmb", "e2", {"stops.txt": body.replace(line(42, 42 % 9), line(42, 3))})  # the whole feed, one row changed
    run(spark, landing, workdir)
    after = {r["bucket"]: (r["version"], r["rows"]) for r in read_manifest(spark, f"{workdir}/wh").collect()}
    assert sum(before[b] != after[b] for b in before) == 1
    land("ktmb", "e3", {"stops.txt": body.replace(line(42, 42 % 9), line(42, 3)) + "short\n"})  # the same rows, another CRC
    res = run(spark, landing, workdir)
    assert {r["bucket"]: (r["version"], r["rows"]) for r in read_manifest(spark, f"{workdir}/wh").collect()} == after
    got = {r["stop_id"]: r["stop_lat"] for r in res.table("stops").collect()}
    assert len(got) == 100 and got["S42"] == 3.0 and got["S41"] == 5.0
    assert [r["Status"] for r in res.progress().collect()] == [0]


def test_a_failing_batch_in_mid_file_resumes_there(spark, land, workdir):
    """The lines before the earliest failed batch load; the file stays open at
    its start, and nothing is loaded twice, keyless tables included."""
    from pyspark.sql import functions as F

    from lading.plans.ingest import ImportFailed
    from lading.registry import build_registry

    reg = build_registry("t: k integer, v text | k\nu: w text | w", "[p]\nt: k v\nu (keyless): w")
    lines = [f"{i},x{i}" for i in range(1, 101)]
    lines[63] = "64,poison"
    lines[91] = "92,poison"
    landing = land("p", "e1", {"t.txt": "k,v\n" + "\n".join(lines) + "\n", "u.txt": "w\n" + "\n".join(["a"] * 30 + ["poison"] + ["b"] * 9) + "\n"})
    with pytest.raises(ImportFailed, match="after line 60 was refused") as err:
        run(spark, landing, workdir, registry=reg, batch_rows=10, refuse=lambda t: F.col(t.column_names[-1]) == "poison")
    res = err.value.result
    assert {(r["FileName"], r["Status"], r["LastProcessedLine"]) for r in res.progress().collect()} == {("t.txt", 1, 60), ("u.txt", 1, 30)}
    assert res.table("t").count() == 60 and res.table("u").count() == 30
    assert {f["file"]: (f["rows"], f["last_line"], f["status"]) for f in res.files} == {"t.txt": (60, 60, 1), "u.txt": (30, 30, 1)}
    assert {(r["item"], r["attempts"]) for r in res.failures().collect()} == {("t.txt", 1), ("u.txt", 1)}
    done = run(spark, landing, workdir, registry=reg)  # the store takes them now
    assert done.rows_imported() == 50 and done.reused == 2
    assert done.table("t").count() == 100 and done.table("u").count() == 40
    assert all(r["Status"] == 0 for r in done.progress().collect()) and done.failures().count() == 0
