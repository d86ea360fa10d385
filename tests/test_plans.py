"""Plan shapes that the design relies on at scale."""

from pyspark.sql import functions as F

from lading.functions.json_rows import json_rows
from lading.operators.parse import build_plan, declared_columns, parse_lines
from lading.operators.upsert import last_wins, upsert
from lading.registry import DEFAULT, build_registry, registry_df


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_runs_from_csv_once_with_broadcast_plan(spark):
    lines = spark.createDataFrame(
        [("ktmb", "stops.txt", i, f"S{i},n{i},1.5,2.5", False) for i in range(1, 200)],
        "provider string, file string, line_no long, line string, bad_utf8 boolean",
    )
    headers = spark.createDataFrame(
        [("ktmb", "stops.txt", "stops", ["stop_id", "stop_name", "stop_lat", "stop_lon"])],
        "provider string, file string, table string, header array<string>",
    )
    t = DEFAULT.tables["stops"]
    plan = build_plan(headers, declared_columns(registry_df(spark)), t)
    p = executed(parse_lines(lines, plan, t, 4))
    assert p.count("from_csv(") == 1
    assert "BroadcastHashJoin" in p and "BroadcastNestedLoopJoin" not in p


def test_records_of_one_file_are_joined_in_many_tasks(spark):
    lines = spark.range(1, 5000).select(F.lit("p").alias("provider"), F.lit("f").alias("file"), F.col("id").alias("line_no"),
                                        F.concat(F.col("id").cast("string"), F.lit(",x")).alias("line"))
    reg = build_registry("t: a integer, b text | a", "[p]\nt: a b")
    headers = spark.createDataFrame([("p", "f", "t", ["a", "b"])], "provider string, file string, table string, header array<string>")
    plan = build_plan(headers, declared_columns(registry_df(spark, reg)), reg.tables["t"])
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        got = parse_lines(lines, plan, reg.tables["t"], 2)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 4999 and len(sizes) > 1 and max(sizes) < 2500


def test_json_objects_are_parsed_once_for_all_fields(spark):
    df = spark.createDataFrame([(1, '[{"a": "1", "b": "x"}, {"b": null, "a": 2}, {}]'), (2, "[]"), (3, "[oops"), (4, None)], "n int, payload string")
    out = json_rows(df, "payload", {"a": "bigint", "b": "string"})
    assert out.dtypes == [("n", "int"), ("a", "bigint"), ("b", "string")]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 1, "x"), (1, 2, None), (1, None, None)]
    p = executed(out)
    assert "get_json_object" not in p and p.count("Generate json_tuple") == 1


def test_reduce_aggregates_before_the_shuffle(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("k"), F.col("id").alias("line_no"), F.lit("x").alias("v"))
    p = executed(last_wins(df, ["k"], ["line_no"]))
    partial = p.find("partial_max")
    exchange = p.find("Exchange hashpartitioning(k")
    assert partial != -1 and exchange != -1
    assert p.rfind("partial_max") > exchange  # printed tree: the child (partial) is below the exchange
    assert "Window" not in p


def test_null_keys_bypass_the_join(spark):
    old = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    new = spark.createDataFrame([(1, "c", 1), (None, "d", 2)], "k long, v string, line_no long")
    df = upsert(old, new, ["k"], order_cols=["line_no"])
    p = executed(df)
    assert "LeftAnti" in p
    assert sorted(str(r["v"]) for r in df.collect()) == ["b", "c", "d"]


def test_resume_offset_is_pushed_to_the_scan(spark, land, workdir):
    from lading.plans.ingest import STAGED, STAGED_SCHEMA, import_landing, staged_records
    from lading.sinks.snapshots import read_table

    hdr = "stop_id,stop_name,stop_lat,stop_lon\n"
    landing = land("ktmb", "e1", {"stops.txt": hdr + "".join(f"S{i},n,1,1\n" for i in range(50))})
    root = f"{workdir}/wh"
    import_landing(spark, landing, root, max_rows=20)
    ctl = read_table(spark, root, STAGED, STAGED_SCHEMA).collect()
    plan_rows = [{"provider": "ktmb", "file": "stops.txt", "offset": 20}]
    plan_df = spark.createDataFrame([("ktmb", "stops.txt", ctl[0]["crc"])], "provider string, file string, raw_crc string")
    df = staged_records(spark, [ctl[0]["path"]], plan_df, plan_rows)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = executed(df)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln][0]
    pushed = scan[scan.index("PushedFilters"):]
    assert "GreaterThan(line_no,20)" in pushed
    assert df.where("line_no > 0").agg(F.min("line_no")).first()[0] == 21
    res = import_landing(spark, landing, root, max_rows=20)
    assert res.reused == 1 and res.rows_imported() == 20
