from pyspark.sql import functions as F

from lading.operators.drift import drift_report
from lading.operators.parse import declared_columns
from lading.registry import CONTROL_TABLES, DEFAULT, registry_df


def test_registry_shape():
    assert len(DEFAULT.declared) == 50
    assert DEFAULT.providers() == sorted(
        ["mybas-johor", "ktmb", "rapid-bus-mrtfeeder", "rapid-rail-kl", "rapid-bus-kl", "rapid-bus-penang"]
    )
    assert len(DEFAULT.tables) == 15
    assert DEFAULT.tables["calendar"].key == ("service_id", "start_date", "end_date")
    assert DEFAULT.tables["fare_leg_rules"].key == ()
    assert DEFAULT.declared[("rapid-bus-mrtfeeder", "agency")][1] is False
    assert DEFAULT.declared[("ktmb", "agency")][1] is True
    assert DEFAULT.declared[("rapid-rail-kl", "shapes")][0][:3] == ("shape_id", "shape_pt_lon", "shape_pt_lat")
    assert not set(CONTROL_TABLES) & set(DEFAULT.tables)


def test_registry_rows(spark):
    r = registry_df(spark, DEFAULT)
    assert r.where("provider = 'ktmb' AND table = 'stops'").count() == 4
    keys = r.where("provider = 'ktmb' AND table = 'stop_times' AND key_ordinal IS NOT NULL")
    assert sorted((x["column"], x["key_ordinal"]) for x in keys.collect()) == [("stop_sequence", 2), ("trip_id", 1)]
    assert r.where("provider = 'rapid-bus-mrtfeeder' AND table = 'agency' AND key_ordinal IS NOT NULL").count() == 0


def listed_headers() -> dict:
    """(provider, table) → columns, as FIXTURES.md lists the feeds' headers."""
    import os
    import re

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "FIXTURES.md")
    out, provider = {}, None
    for line in open(path, encoding="utf-8").read().split("### 1.2 By provider")[1].splitlines():
        if m := re.match(r"#### `([^`]+)`", line):
            provider = m[1]
        elif line.startswith(("## ", "### ")):
            break
        elif provider and (m := re.match(r"\| `([^`]+)` \| ([^|]+) \|", line)):
            out[provider, m[1]] = [c.split()[0] for c in m[2].split(", ")]
    return out


def test_golden_drift_50_exact_matches(spark, land):
    """Feeds with the listed headers, landed as archives: every table matches
    exactly, and a changed header shows."""
    from lading.operators.drift import drift_from_landing

    headers = listed_headers()
    assert len(headers) == 50
    for provider in {p for p, _ in headers}:
        root = land(provider, "e1", {f"{t}.txt": ",".join(h) + "\r\n1,2\r\n" for (p, t), h in headers.items() if p == provider})
    declared = declared_columns(registry_df(spark, DEFAULT))
    rep = drift_from_landing(spark, root, declared)
    out = rep.groupBy("outcome").count().collect()
    assert {r["outcome"]: r["count"] for r in out} == {"exact_match": 50}
    assert rep.where(~F.col("importer_exact")).count() == 0
    land("ktmb", "e2", {"stops.txt": "stop_id,stop_name,stop_lat,new\n", "empty.txt": "", "agency.txt": '\ufeff"agency_id",\n'})
    changed = {r["table"]: r for r in drift_from_landing(spark, root, declared).where("provider = 'ktmb'").collect()}
    assert changed["stops"]["outcome"] == "missing_and_extra" and changed["stops"]["missing_in_db"] == ["new"]
    assert changed["empty"]["outcome"] == "file_not_in_schema"
    assert changed["trips"]["outcome"] == "table_without_file"


def test_drift_six_outcomes(spark):
    declared = spark.createDataFrame(
        [("p", "a", ["x", "y"]), ("p", "b", ["x", "y"]), ("p", "c", ["x", "y", "z"]),
         ("p", "d", ["x", "y"]), ("p", "e", ["x"])],
        "provider string, table string, declared array<string>",
    )
    headers = spark.createDataFrame(
        [("p", "a.txt", ["﻿X ", "y"]), ("p", "b.txt", ["x", "y", "w"]), ("p", "c.txt", ["x", "y"]),
         ("p", "d.txt", ["y", "x"]), ("p", "f.txt", ["q"]), ("p", "__MACOSX/a.txt", ["x"])],
        "provider string, file string, header array<string>",
    )
    rep = {r["table"]: r for r in drift_report(headers, declared).collect()}
    assert rep["a"]["outcome"] == "exact_match" and rep["a"]["importer_exact"] is False
    assert rep["b"]["outcome"] == "missing_in_db" and rep["b"]["missing_in_db"] == ["w"]
    assert rep["c"]["outcome"] == "extra_in_db" and rep["c"]["extra_in_db"] == ["z"]
    assert rep["d"]["outcome"] == "order_mismatch"
    assert rep["e"]["outcome"] == "table_without_file"
    assert rep["f"]["outcome"] == "file_not_in_schema"
    assert len(rep) == 6
