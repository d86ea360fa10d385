from pyspark.sql import functions as F

from lading.operators import control
from lading.operators.lines import file_quotas, number_rows, number_text_lines, read_text_lines
from lading.operators.upsert import last_wins, upsert, upsert_latest


def test_upsert_rules(spark):
    old = spark.createDataFrame(
        [(1, "a", 10.0), (2, "b", 20.0), (None, "n", 0.0), (3, "c", 30.0)], "k long, v string, x double"
    )
    new = spark.createDataFrame(
        [(1, "a1", None, 1), (1, "a2", None, 2), (4, "d", 4.0, 1), (None, "n2", 1.0, 1), (None, "n3", 1.0, 2)],
        "k long, v string, x double, line_no long",
    )
    out = sorted(upsert(old, new, ["k"], order_cols=["line_no"]).collect(), key=lambda r: (r["k"] is None, r["k"] or 0, r["v"]))
    assert [(r["k"], r["v"], r["x"]) for r in out] == [
        (1, "a2", None),  # later line wins, missing column NULL, not the old value
        (2, "b", 20.0), (3, "c", 30.0),  # rows gone from the feed stay
        (4, "d", 4.0),
        (None, "n", 0.0), (None, "n2", 1.0), (None, "n3", 1.0),  # NULL keys never conflict
    ]
    keyless = upsert(old, new.drop("line_no"), [])
    assert keyless.count() == 9


def test_last_wins_hot_key(spark):
    df = spark.range(0, 20000).select(F.lit(7).alias("k"), F.col("id").alias("line_no"), (F.col("id") * 2).alias("v"))
    r = last_wins(df, ["k"], ["line_no"]).collect()
    assert [(x["k"], x["line_no"], x["v"]) for x in r] == [(7, 19999, 39998)]


def test_upsert_latest_out_of_order(spark):
    old = spark.createDataFrame([(1, 5, "new")], "k long, ord long, v string")
    late = spark.createDataFrame([(1, 3, "old"), (2, 1, "x")], "k long, ord long, v string")
    r = sorted((x["k"], x["v"]) for x in upsert_latest(old, late, ["k"], ["ord"]).collect())
    assert r == [(1, "new"), (2, "x")]


def test_number_rows_hot_group(spark):
    df = spark.range(0, 5000).select(
        F.when(F.col("id") < 4000, F.lit("hot")).otherwise(F.lit("cold")).alias("g"), (F.col("id") * 3).alias("o")
    )
    out = number_rows(df, ["g"], ["o"], num_partitions=7).collect()
    by = {}
    for r in out:
        by.setdefault(r["g"], []).append((r["o"], r["row_no"]))
    for g, pairs in by.items():
        pairs.sort()
        assert [n for _, n in pairs] == list(range(1, len(pairs) + 1)), g


def test_number_text_lines_many_splits(spark, workdir):
    path = f"{workdir}/text"
    spark.range(0, 30000, numPartitions=3).select(F.format_string("%08d", "id").alias("value")).write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        text = read_text_lines(spark, path, group_col=F.lit("all"))
        assert text.rdd.getNumPartitions() > 3
        got = sorted((int(r["value"]), r["line_no"]) for r in number_text_lines(text, "file").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i, i + 1) for i in range(30000)]


def test_text_lines_are_numbered_in_the_scan_stage(spark, workdir, monkeypatch):
    import lading.operators.lines as lines

    path = f"{workdir}/text"
    spark.range(0, 3000, numPartitions=4).select(F.format_string("%08d", "id").alias("value")).write.text(path)
    text = read_text_lines(spark, path, group_col=F.when(F.col("value") >= "00001000", F.lit("rest")))  # a null group
    numbered = number_text_lines(text, "file")
    want = [(i, i + 1 if i < 1000 else i - 999) for i in range(3000)]
    assert sorted((int(r["value"]), r["line_no"]) for r in numbered.collect()) == want
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    # beyond the bound the offsets are joined by a shuffle, with the same result
    monkeypatch.setattr(lines, "BROADCAST_SPLITS", 0)
    assert sorted((int(r["value"]), r["line_no"]) for r in number_text_lines(text, "file").collect()) == want


def test_resume_states_and_versions(spark):
    entries = spark.createDataFrame(
        [("p", f, "c1") for f in ["none", "crc", "done", "open", "null"]], "provider string, file string, crc string"
    )
    progress = spark.createDataFrame(
        [("p", "crc", "c0", 9, 1, None), ("p", "done", "c1", 9, 0, None),
         ("p", "open", "c1", 9, 1, None), ("p", "null", "c1", 9, None, None)],
        control.PROGRESS_SCHEMA,
    )
    st = {r["file"]: (r["action"], r["offset"]) for r in control.resume_state(entries, progress).collect()}
    assert st == {"none": ("new", 0), "crc": ("restart", 0), "done": ("skip", None),
                  "open": ("resume", 9), "null": ("resume", 9)}
    remote = spark.createDataFrame([("eq", "a"), ("diff", "b"), ("empty", ""), ("missing", "x")],
                                   "provider string, remote_version string")
    stored = spark.createDataFrame([("eq", "a", None), ("diff", "a", None), ("empty", "a", None)], control.VERSIONS_SCHEMA)
    ch = {r["provider"]: r["changed"] for r in control.version_changes(remote, stored).collect()}
    assert ch == {"eq": False, "diff": True, "empty": False, "missing": True}


def test_two_failed_batches_roll_back_to_earliest(spark):
    b = spark.createDataFrame(
        [("f", 500, 500, True), ("f", 1000, 500, False), ("f", 1500, 500, True), ("g", 200, 200, False)],
        "file string, last_line long, size long, failed boolean",
    )
    r = {x["file"]: (x["LastProcessedLine"], x["Status"]) for x in control.rollback_points(b, ["file"]).collect()}
    assert r == {"f": (0, 1), "g": (200, 0)}


def test_quotas(spark):
    f = spark.createDataFrame([("p", "a", 5), ("p", "b", 5), ("p", "c", 5), ("q", "a", 1)],
                              "provider string, file string, rows long")
    q = {(r["provider"], r["file"]): (r["quota"], r["file_done"]) for r in file_quotas(f, 7).collect()}
    assert q == {("p", "a"): (5, True), ("p", "b"): (2, False), ("p", "c"): (0, False), ("q", "a"): (1, True)}


def test_progress_close_without_row_creates_nothing(spark):
    empty = spark.createDataFrame([], control.PROGRESS_SCHEMA)
    opened = control.open_progress(empty, spark.createDataFrame(
        [("p", "a", "c", 0)], "Provider string, FileName string, CRC string, LastProcessedLine long"))
    closed = control.close_progress(opened, spark.createDataFrame(
        [("p", "a", 7, 0), ("p", "b", 3, 0)], "Provider string, FileName string, LastProcessedLine long, Status int"))
    assert [(r["FileName"], r["LastProcessedLine"], r["Status"]) for r in closed.collect()] == [("a", 7, 0)]
