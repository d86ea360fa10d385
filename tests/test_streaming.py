from lading.streaming.available_now import upsert_stream


def test_available_now_twice(spark, workdir):
    landing = f"{workdir}/in"
    schema = "k long, ord long, v string"
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], schema).write.parquet(f"{landing}/f1")
    df = spark.createDataFrame([], schema)
    root = f"{workdir}/tables"
    out = upsert_stream(spark, landing + "/*", df.schema, root, "t", ["k"], ["ord"])
    assert sorted((r["k"], r["v"]) for r in out.collect()) == [(1, "a"), (2, "b")]
    out2 = upsert_stream(spark, landing + "/*", df.schema, root, "t", ["k"], ["ord"])
    assert out2.count() == 2
    from lading.sinks.snapshots import _versions
    n = len(_versions(root, "t"))
    spark.createDataFrame([(1, 2, "a2")], schema).write.parquet(f"{landing}/f2")
    out3 = upsert_stream(spark, landing + "/*", df.schema, root, "t", ["k"], ["ord"])
    assert sorted((r["k"], r["v"]) for r in out3.collect()) == [(1, "a2"), (2, "b")]
    assert len(_versions(root, "t")) == n + 1


def test_import_stream_passes(spark, land, workdir):
    from lading.streaming.feed_stream import import_stream

    hdr = "stop_id,stop_name,stop_lat,stop_lon\n"
    landing = land("ktmb", "e1", {"stops.txt": hdr + "A,a,1,1\nB,b,1,1\nC,c,1,1\n"})
    root = f"{workdir}/wh"
    r1 = import_stream(spark, landing, root, max_rows=2)  # new archive, capped once in this pass
    assert sum(r.rows_imported() for r in r1) == 2
    r1 = import_stream(spark, landing, root, max_rows=2)  # the next pass takes the rest
    assert sum(r.rows_imported() for r in r1) == 1
    assert r1[-1].table("stops").count() == 3
    r2 = import_stream(spark, landing, root, max_rows=2)  # nothing new, nothing open
    assert r2 == []
    land("ktmb", "e2", {"stops.txt": hdr + "A,a2,1,1\n"})
    r3 = import_stream(spark, landing, root, max_rows=2)
    assert sum(r.rows_imported() for r in r3) == 1
    assert sorted((x["stop_id"], x["stop_name"]) for x in r3[-1].table("stops").collect()) == [
        ("A", "a2"), ("B", "b"), ("C", "c")]


def test_a_failing_provider_does_not_block_the_others(spark, land, workdir):
    """``a`` has a damaged member, ``b`` is healthy, ``c`` comes later: ``c``
    loads in the next pass, and ``a`` is retried without a new arrival until it
    is repaired."""
    import pytest

    from lading.registry import build_registry
    from lading.streaming.feed_stream import PassFailed, import_stream, to_retry
    from tests.test_ingest import break_member

    reg = build_registry("t: k integer, v text | k", "\n".join(f"[{p}]\nt: k v" for p in "abc"))
    root = f"{workdir}/wh"
    body = {"t.txt": "k,v\n" + "".join(f"{i},x{i}\n" for i in range(200))}
    landing = land("a", "e1", body)
    land("b", "e1", body)
    break_member(f"{landing}/provider=a/version=e1/feed.zip", "t.txt", "body")

    def loaded(results):
        return {r["provider"] for r in results[-1].table("t").select("provider").distinct().collect()}

    with pytest.raises(PassFailed) as err:
        import_stream(spark, landing, root, registry=reg)
    assert loaded(err.value.results) == {"b"} and to_retry(spark, root) == ["a"]
    land("c", "e1", body)
    with pytest.raises(PassFailed) as err:
        import_stream(spark, landing, root, registry=reg)
    assert loaded(err.value.results) == {"b", "c"}
    ledger = err.value.results[-1].failures().collect()
    assert [(r["provider"], r["item"], r["attempts"]) for r in ledger] == [("a", "t.txt", 2)]
    assert ledger[0]["first_failed_at"] < ledger[0]["last_failed_at"]
    with open(f"{landing}/provider=a/version=e1/feed.zip".replace("file:", ""), "wb") as fh:
        fh.write(b"not a zip")  # now the archive itself cannot be read
    with pytest.raises(PassFailed):
        import_stream(spark, landing, root, registry=reg)
    assert to_retry(spark, root) == ["a"]
    land("a", "e1", body)  # repaired in place: the stream's source sees nothing new
    results = import_stream(spark, landing, root, registry=reg)
    assert loaded(results) == {"a", "b", "c"} and results[-1].table("t").count() == 600
    assert results[-1].failures().count() == 0 and import_stream(spark, landing, root, registry=reg) == []
