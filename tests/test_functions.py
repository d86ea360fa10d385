import zlib

import pytest
from pyspark.sql import functions as F

from lading.functions import (
    binding_name,
    crc32_hex,
    entry_table_name,
    integer_affinity,
    is_feed_entry,
    path_segments,
    real_affinity,
    saturating_sub,
)
from lading.plans.status import parse_status_path
from tests.conftest import SF_SMALL


def test_crc32_known_answer(spark):
    assert spark.range(1).select(crc32_hex(F.lit("hello"))).first()[0] == "3610a686"


def test_crc32_matches_zlib(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", crc32_hex("text").alias("c"))
    for r in docs.collect():
        assert r["c"] == f"{zlib.crc32(r['text'].encode('utf-8')):08x}"


def test_entry_filter_fixture(spark):
    names = ["stops.txt", "dir/stops.txt", "__MACOSX/._stops.txt", "._x.txt", "readme.md",
             "unknown.txt", "import_progress.txt"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    kept = [r["t"] for r in df.where(is_feed_entry("name")).select(entry_table_name("name").alias("t")).collect()]
    assert kept == ["stops", "dir/stops", "unknown", "import_progress"]


AFFINITY = [
    ("5", 5, 5.0), (" 5 ", 5, 5.0), ("007", 7, 7.0), ("1.0", 1, 1.0), ("1.5", None, 1.5),
    ("1e3", 1000, 1000.0), ("", None, None), ("abc", None, None), ("nan", None, None),
    ("1d", None, None), ("0x1F", None, None), ("9223372036854775808", None, 9.223372036854776e18),
    ("+3", 3, 3.0), (".5", None, 0.5), ("5.", 5, 5.0), ("25:30:00", None, None),
]


@pytest.mark.parametrize("text,as_int,as_real", AFFINITY)
def test_affinity(spark, text, as_int, as_real):
    r = spark.createDataFrame([(text,)], "t string").select(
        integer_affinity("t").alias("i"), real_affinity("t").alias("r")
    ).first()
    assert r["i"] == as_int
    assert r["r"] == as_real


def test_names(spark):
    r = spark.createDataFrame([("rapid-bus-kl", "/ktmb/status/", 3, 5)], "p string, path string, a int, b int").select(
        binding_name("p").alias("b"), path_segments("path").alias("s"), saturating_sub("a", "b").alias("d")
    ).first()
    assert r["b"] == "DB_RAPID_BUS_KL"
    assert r["s"] == ["ktmb", "status"]
    assert r["d"] == 0
    assert parse_status_path("/ktmb/status") == "ktmb"
    assert parse_status_path("/") is None


def test_status_json_keeps_null_fields(spark):
    from lading.operators.control import PROGRESS_SCHEMA
    from lading.plans.status import provider_status

    prog = spark.createDataFrame([("p", "a.txt", "c", None, None, None)], PROGRESS_SCHEMA)
    js = provider_status(prog, "p").first()["json"]
    assert js == ('{"Provider":"p","FileName":"a.txt","CRC":"c","LastProcessedLine":null,'
                  '"Status":null,"UpdatedAt":null}')
