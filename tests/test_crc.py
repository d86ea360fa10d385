import glob
import random
import zipfile
import zlib

from pyspark.sql import functions as F

from lading.functions.crc import combine_crc32, crc32_shift, joined_crc32, record_pieces
from lading.sources import archive


def test_shift_is_the_crc_of_what_follows(spark):
    rng = random.Random(1)
    parts = [(rng.randbytes(rng.randrange(40)), rng.randbytes(rng.choice([0, 1, 7, 1000, 100_003]))) for _ in range(20)]
    rows = [(k, zlib.crc32(a), len(b), zlib.crc32(b), zlib.crc32(a + b)) for k, (a, b) in enumerate(parts)]
    df = spark.createDataFrame(rows, "k int, crc long, n long, other long, want long")
    got = df.select("other", "want", crc32_shift("crc", "n").alias("moved")).collect()
    assert all(r.moved ^ r.other == r.want for r in got)


def test_pieces_in_many_tasks_give_the_entrys_crc(spark):
    rows = [(p, "t.txt", n, f"{p}-{n}-" + "é" * (n % 5)) for p in ("a", "b") for n in range(3000)] + [("c", "t.txt", 0, "")]
    lines = spark.createDataFrame(rows, "provider string, file string, line_no long, line string").repartition(7, "line_no")
    pieces = record_pieces(lines.sortWithinPartitions("provider", "line_no"))
    got = {r.provider: (r.crc, r.bytes, r.records) for r in combine_crc32(pieces, ["provider", "file"]).collect()}
    for p in "abc":
        text = "".join(line + "\n" for q, _, _, line in rows if q == p).encode()
        assert got[p] == (f"{zlib.crc32(text):08x}", len(text), sum(q == p for q, *_ in rows))
    assert combine_crc32(record_pieces(lines.limit(0)), ["provider", "file"]).collect() == []


def test_joined_crc_is_the_crc_of_both():
    rng = random.Random(2)
    for n in (0, 1, 300, 70_000):
        a, b = rng.randbytes(50), rng.randbytes(n)
        assert joined_crc32(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)


def test_archives_in_pieces_are_whole_and_no_task_writes_a_member(spark, workdir, monkeypatch):
    """Every task deflates its own lines; the pieces joined are one valid member."""
    rows = spark.range(0, 30_000, 1, 6)
    lines = rows.selectExpr("cast(id % 3 as int) archive", "concat(id, ',', if(id % 5 = 0, 'é', 'x')) line")
    pieces = []
    monkeypatch.setattr(archive, "remove_dir", lambda folder: pieces.extend(glob.glob(f"{folder}/*/*")))
    archive.write_archives_in_pieces(lines, workdir, "v1", "t", "id,x", "p", damaged=(2,))
    assert len(pieces) == 18
    for k in range(2):
        with zipfile.ZipFile(f"{workdir}/provider=p{k}/version=v1/t.zip") as zf:
            assert zf.namelist() == ["t.txt"] and zf.testzip() is None
            assert zf.read("t.txt").decode().split("\n") == ["id,x", *[f"{i},{'x' if i % 5 else 'é'}" for i in range(k, 30_000, 3)], ""]
    entries = archive.list_entries(archive.read_archives(spark, workdir))
    got = archive.expand_entries(entries).groupBy("provider").agg(F.sum((F.col("line_no") >= 0).cast("int")).alias("n"), F.max("error").alias("error")).collect()
    assert {r.provider: r.n for r in got if r.error is None} == {"p0": 10_001, "p1": 10_001}
    assert sum(r.error is not None for r in got) == 1


def test_no_lines_give_no_archive(spark, workdir):
    none = spark.range(0).selectExpr("cast(id as int) archive", "cast(id as string) line")
    archive.write_archives_in_pieces(none, workdir, "v1", "t", "id", "p")
    assert glob.glob(f"{workdir}/*") == []
