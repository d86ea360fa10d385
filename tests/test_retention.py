import os

from pyspark.sql import functions as F

from lading.operators.control import PROGRESS_SCHEMA
from lading.plans.ingest import PROGRESS, import_landing
from lading.plans.status import status
from lading.sinks import snapshots
from lading.sinks.retention import remove_unreferenced, unreferenced

HDR = "stop_id,stop_name,stop_lat,stop_lon"


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def progress_row(provider, file, line):
    return (provider, file, "c", line, 0, None)


def test_a_parted_write_replaces_only_the_named_parts(spark, workdir):
    a, b = "a", next(k for k in map(chr, range(98, 123)) if snapshots.part_of(k) != snapshots.part_of("a"))

    def write(rows, keys):
        snapshots.write_tables({"t": snapshots.Parted(spark.createDataFrame(rows, PROGRESS_SCHEMA), "Provider", keys)}, workdir)

    write([progress_row(a, "x", 1), progress_row(b, "y", 1), progress_row(None, "z", 1)], [a, b, None])
    before = snapshots._committed(workdir)
    write([progress_row(a, "x", 2), progress_row(b, "y", 9)], [a])  # b's part is not named: stays
    after = snapshots._committed(workdir)
    assert {k for k in before if before[k] != after[k]} == {f"t/_p={snapshots.part_of(a)}"}
    got = snapshots.read_table(spark, workdir, "t", PROGRESS_SCHEMA)
    assert got.columns == PROGRESS_SCHEMA.names
    assert sorted((r[0] or "", r[3]) for r in got.collect()) == [("", 1), (a, 2), (b, 1)]
    # a part without rows left is no longer named
    write([], [b])
    assert f"t/_p={snapshots.part_of(b)}" not in snapshots._committed(workdir)
    assert snapshots.read_table(spark, workdir, "t", PROGRESS_SCHEMA, [b]).where(F.col("Provider") == b).count() == 0
    # nothing touched: a commit without a new version
    write([], [])
    assert snapshots.read_table(spark, workdir, "t", PROGRESS_SCHEMA).count() == 2
    # old parts go, parts in use stay
    removed = snapshots.vacuum(workdir, keep=1)
    assert any("/v=00000001/_p=" in p for p in removed)
    assert snapshots.read_table(spark, workdir, "t", PROGRESS_SCHEMA).count() == 2


def test_a_table_written_whole_becomes_parted(spark, workdir):
    whole = spark.createDataFrame([progress_row("a", "x", 1), progress_row("b", "y", 1)], PROGRESS_SCHEMA)
    snapshots.write_table(whole, workdir, "t")
    held = snapshots.read_table(spark, workdir, "t", PROGRESS_SCHEMA, ["a"])
    snapshots.write_tables({"t": snapshots.Parted(held.withColumn("LastProcessedLine", F.lit(2).cast("long")), "Provider", ["a"])}, workdir)
    assert "t" not in snapshots._committed(workdir)
    assert rows_of(snapshots.read_table(spark, workdir, "t", PROGRESS_SCHEMA), "Provider", "LastProcessedLine") == [("a", 2), ("b", 2)]


def test_status_reads_one_part_and_a_run_writes_its_providers(spark, land, workdir):
    root = f"{workdir}/wh"
    landing = land("ktmb", "e1", {"stops.txt": HDR + "\nA,a,1,1\n"})
    land("rapid-rail-kl", "e1", {"stops.txt": HDR + "\nB,b,1,1\n"})
    import_landing(spark, landing, root)
    before = snapshots._committed(root)
    land("ktmb", "e2", {"stops.txt": HDR + "\nA,a,2,2\n"})
    import_landing(spark, landing, root)
    after = snapshots._committed(root)
    assert {k for k in after if k.startswith(PROGRESS) and after[k] != before.get(k)} == {f"{PROGRESS}/_p={snapshots.part_of('ktmb')}"}
    found = status(spark, root, "rapid-rail-kl")
    assert rows_of(found, "Provider", "FileName", "Status") == [("rapid-rail-kl", "stops.txt", 0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_p" in plan or "PartitionFilters: [(_p" in plan or "_p#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_unreferenced_folders_are_listed_and_removed(spark, land, workdir):
    root = f"{workdir}/wh"
    landing = land("ktmb", "e1", {"stops.txt": HDR + "\nA,a,1,1\nB,b,1,x\n"})
    import_landing(spark, landing, root)
    land("ktmb", "e2", {"stops.txt": HDR + "\n" + "".join(f"S{k},s,1,1\n" for k in range(40))})
    first = import_landing(spark, landing, root, max_rows=10)  # stays open: its staged records are needed
    assert rows_of(first.progress(), "Status") == [(1,)]
    kept = unreferenced(spark, root, keep=1)
    assert any("/tables/stops/v=00000001/" in p for p in kept) and not any("/tables/stops/v=00000002/" in p for p in kept)
    removed = remove_unreferenced(spark, root, keep=1, keep_reject_runs=1)
    assert set(kept) <= set(removed) and any("/rejects/" in p for p in removed)
    local = root.replace("file:", "")
    assert not any(os.path.exists(p.replace("file:", "")) for p in removed)
    assert len([d for d in os.listdir(f"{local}/staging") if not d.endswith("_typed")]) == 1
    # the import goes on from the staged records, and nothing is lost
    again = import_landing(spark, landing, root, max_rows=None)
    assert again.reused == 1 and again.table("stops").count() == 42
    assert rows_of(again.progress(), "Status") == [(0,)]
    # all is done: no staged folder is named any more
    remove_unreferenced(spark, root, keep=1)
    assert os.listdir(f"{local}/staging") == [] and unreferenced(spark, root, keep=1) == []
    assert again.table("stops").count() == 42
