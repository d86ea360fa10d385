import re

import corpus_pipeline as P
from pyspark.sql import functions as F

from tokenizers import Tokenizer

from lading.llm.graph import written
from lading.llm.token_counts import vocabulary_path
from tests_llm_prose import SF_SMALL, prose

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    counts = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        out = written(stage(spark, docs, SF_SMALL), name)
        assert out.columns == docs.columns and out.join(docs, "doc_id", "left_anti").isEmpty()
        docs = out
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[-1] > 0.7 * counts[0]
    assert docs.where(F.col("n_chars") != F.length("text")).isEmpty()
    assert not any(re.search(r"AKIA[A-Z0-9]{12}|[0-9a-f]{32}", r.text) for r in docs.collect())
    packed = P.packing(spark, docs, SF_SMALL)
    tok = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    need = sum(len(tok.encode(r.text or "", add_special_tokens=False)) for r in docs.select("text").collect())
    assert packed.agg(F.sum("n_tokens")).first()[0] == need


def test_run_is_the_stages(spark):
    out = P.run(spark, SF_SMALL)
    assert out.columns[:2] == ["doc_id", "part"] and out.count() > 0


def test_language_rejects_only_texts_without_one(spark):
    rows = [(1, "plain english words in here"), (2, None), (3, "12 34"), (4, ""), (None, "more plain words")]
    got = P.language(spark, make(spark, rows), SF_SMALL).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "None"]


def test_one_document_of_each_group_stays(spark):
    text = prose(1, 60)
    rows = [(5, text), (3, text), (3, text), (9, text + " tail"), (7, prose(2, 60)), (None, text), (8, None), (10, "")]
    got = P.near_duplicates(spark, make(spark, rows), SF_SMALL).collect()
    group = [r for r in got if (r.text or "").startswith(text)]
    assert len(group) == 1 and sorted(str(r.doc_id) for r in got if r not in group) == ["10", "7", "8"]


def test_ids_do_not_stand_for_texts(spark):
    """Different texts under one id both stay; copies without an id do not."""
    a, b, c = prose(3, 80), prose(4, 80), prose(5, 80)
    rows = [(1, a), (1, b), (None, a), (None, a), (None, c), (2, None), (2, None), (2, "")]
    docs = make(spark, rows).withColumns({n: F.lit("x") for n in ("row_key", "place", "component_id", "text_key")})
    got = P.near_duplicates(spark, docs, SF_SMALL)
    assert got.columns == docs.columns
    kept = got.collect()
    assert sorted(r.text for r in kept if r.text) == sorted([a, b, c])
    assert sorted((r.doc_id, r.text) for r in kept if not r.text and r.text is not None) == [(2, "")]
    assert sum(r.text is None for r in kept) == 1


def test_rows_without_a_copy_are_not_moved(spark):
    """Whole rows go through a shuffle only where some of their kind may go."""
    texts = [prose(100 + k, 60) for k in range(40)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100, texts[0]), (101, texts[1] + " tail")]
    docs = written(make(spark, rows).repartition(4), "docs").withColumn("source", F.input_file_name())
    got = P.near_duplicates(spark, docs, SF_SMALL).select("doc_id", "source", F.spark_partition_id().alias("part")).collect()
    files = {r.part: r.source for r in docs.select("source", F.spark_partition_id().alias("part")).distinct().collect()}
    assert len(got) == 40 and all(files.get(r.part) == r.source for r in got if 2 <= r.doc_id < 100)


def test_secrets_are_replaced(spark):
    got = P.secrets(spark, make(spark, [(1, "a password=abcdefgh1 b"), (2, "clean"), (3, None)]), SF_SMALL).collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in got} == {(1, "a [SECRET] b", 12), (2, "clean", 5), (3, None, 0)}


def test_empty_table(spark):
    docs = make(spark, [])
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.collect() == []


def test_stages_bound_what_a_python_worker_gets_at_once(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = make(spark, [(i, prose(i, 20)) for i in range(20)])
    old = spark.conf.get(key)
    try:
        for name, stage in P.STAGES:
            if name != "secrets":  # no Python worker
                spark.conf.set(key, str(64 << 20))
                stage(spark, docs, SF_SMALL)
                assert int(spark.conf.get(key)) <= 4 << 20, name
    finally:
        spark.conf.set(key, old)
