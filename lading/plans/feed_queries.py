"""Registered queries: each turns test tables into feed form and runs one
operator of the library over the whole table.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame; the
matching DuckDB SQL lives in :mod:`lading.plans.oracle`.  Output columns
carry the same names and types as the SQL's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lading.functions.crc import combine_crc32, record_pieces
from lading.functions.json_rows import json_rows
from lading.functions.names import (
    binding_name,
    crc32_hex,
    entry_table_name,
    is_feed_entry,
    path_segments,
)
from lading.operators import control, lines as L
from lading.operators.drift import drift_from_landing
from lading.operators.parse import (
    build_plan,
    declared_columns,
    drop_malformed,
    parse_lines,
    registered_entries,
    type_columns,
)
from lading.operators.upsert import last_wins, upsert
from lading.registry import LogicalTable, build_registry, registry_df
from lading.session import scratch_path
from lading.sources.archive import expand_entries, list_entries, read_archives, write_archives, write_archives_in_pieces
from lading.sources.catalogue import active_providers

LI_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
BUDGET = 25_000
BATCH = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _csv(*cols) -> Column:
    return F.concat_ws(",", *[_s(c) for c in cols])


def _headers(spark, rows: list[tuple[str, str, str, list[str]]]) -> DataFrame:
    return spark.createDataFrame(
        rows, "provider string, file string, table string, header array<string>"
    )


def _header_rows(files: DataFrame, header_by_file: Column, table_name: str) -> DataFrame:
    """Header records (line 0) for a set of files given as a DataFrame."""
    return files.select(
        "provider", "file", F.lit(table_name).alias("table"), header_by_file.alias("header")
    )


# --- sources ----------------------------------------------------------------

def provider_active_urls(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    catalogue = s.select(
        F.col("s_name").alias("name"),
        (F.col("s_acctbal") > 0).alias("is_active"),
        F.lit("https://feeds.example.org/gtfs-static/").alias("static_url"),
        F.concat(F.lit("nation-"), _s("s_nationkey")).alias("static_provider"),
        F.when(F.col("s_nationkey") % 5 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("db-"), _s("s_suppkey")))
        .alias("database_id"),
    )
    return active_providers(catalogue)


def _land_tables(spark, sf_dir, landing, specs):
    for name, cols, prefix in specs:
        df = table(spark, sf_dir, name)
        write_archives(df.select(_csv(*cols).alias("line")), landing, "v1", name,
                       ",".join(cols), prefix).collect()


def archive_expand(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    _land_tables(spark, sf_dir, landing, [
        ("nation", ["n_nationkey", "n_name", "n_regionkey"], "nat"),
        ("region", ["r_regionkey", "r_name"], "reg"),
    ])
    archives = read_archives(spark, landing)
    entries = list_entries(archives).where(is_feed_entry("file"))
    recs = expand_entries(entries)
    return recs.where(F.col("line_no") > 0).select("file", "line")


def entry_filter(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    base = F.concat(F.split_part("url", F.lit("/"), F.lit(4)), F.lit("_"), _s("page_id"))
    v = F.col("page_id") % 5
    entry = (
        F.when(v == 0, F.concat(base, F.lit(".txt")))
        .when(v == 1, F.concat(F.lit("__MACOSX/"), base, F.lit(".txt")))
        .when(v == 2, F.concat(F.lit("dir/._"), base, F.lit(".txt")))
        .when(v == 3, F.concat(F.lit("dir/"), base, F.lit(".txt")))
        .otherwise(F.concat(base, F.lit(".TXT")))
    )
    e = p.select("page_id", entry.alias("entry"))
    return e.select(
        "page_id", "entry", is_feed_entry("entry").alias("keep"),
        F.when(is_feed_entry("entry"), entry_table_name("entry")).alias("table_name"),
    )


def entry_registry_join(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    entries = ev.select(
        "event_id", F.concat("event_type", F.lit(".txt")).alias("file"),
        entry_table_name(F.concat("event_type", F.lit(".txt"))).alias("table_name"),
    )
    # A three-table schema: one table declares no columns and is dropped too.
    declared = spark.createDataFrame(
        [("click", ["x", "y"]), ("view", ["x"]), ("signup", [])],
        "table_name string, declared array<string>",
    )
    return registered_entries(entries, declared, ["table_name"]).select(
        "event_id", "file", "table_name", F.size("declared").alias("n_columns")
    )


def entry_crc32(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", crc32_hex(F.col("text")).alias("crc"))


def _dealt_to(key: str, archives: int) -> Column:
    """The archive of a row; rows without a key are in the first."""
    return F.coalesce(F.pmod(key, F.lit(archives)), F.lit(0)).cast("int").alias("archive")


CRC_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
CRC_ARCHIVES = 4


def entry_crc_check(spark, sf_dir):
    """CRC-32 of every landed entry of ``lineitem``, combined from pieces of its
    staged records wherever they lie, against the one its archive states."""
    landing = scratch_path(spark, "landing")
    li = table(spark, sf_dir, "lineitem")
    write_archives_in_pieces(li.select(_dealt_to("l_orderkey", CRC_ARCHIVES), _csv(*CRC_COLS).alias("line")), landing, "v1", "lineitem",
                             ",".join(CRC_COLS), "li")
    entries = list_entries(read_archives(spark, landing))
    staged = scratch_path(spark, "staged")
    expand_entries(entries).where(F.col("line_no") >= 0).write.parquet(staged)
    content = combine_crc32(record_pieces(spark.read.parquet(staged)), ["provider", "file"]).withColumnRenamed("crc", "computed")
    return entries.join(content, ["provider", "file"], "left").select(
        "provider", "file", (F.col("records") - 1).alias("records"), "bytes",
        F.coalesce((F.col("computed") == F.col("crc")) & (F.col("bytes") == F.col("size")), F.lit(False)).alias("crc_matches"))


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus"]
ORDER_FEEDS = 4


def _order_feeds(spark, sf_dir, landing: str, damaged: tuple[int, ...] = (), only: tuple[int, ...] | None = None) -> None:
    """``orders`` landed as feeds ``ord0`` … by o_orderkey; the tasks that write
    the ``damaged`` ones spoil their member."""
    o = table(spark, sf_dir, "orders").select(_dealt_to("o_orderkey", ORDER_FEEDS), _csv(*ORDER_COLS).alias("line"))
    if only is not None:
        o = o.where(F.col("archive").isin(*only))
    write_archives_in_pieces(o, landing, "v1", "orders", ",".join(ORDER_COLS), "ord", damaged=damaged)


def _order_registry():
    return build_registry("orders: o_orderkey integer, o_custkey integer, o_orderstatus text | o_orderkey",
                          "\n".join(f"[ord{k}]\norders: {' '.join(ORDER_COLS)}" for k in range(ORDER_FEEDS)))


def import_isolates_failures(spark, sf_dir):
    """Feeds of ``orders`` of which one has a damaged member: the others load,
    the damaged file stays open."""
    from lading.plans.ingest import ImportFailed, import_landing

    landing = scratch_path(spark, "landing")
    _order_feeds(spark, sf_dir, landing, damaged=(1,))
    try:
        result = import_landing(spark, landing, scratch_path(spark, "warehouse"), registry=_order_registry(), max_rows=None)
    except ImportFailed as exc:
        result = exc.result
    progress = result.progress().select(F.col("Provider").alias("provider"), F.col("FileName").alias("file"), F.col("Status").alias("status"))
    rows = result.table("orders").join(progress, "provider").select(*ORDER_COLS, "provider", "status")
    still_open = progress.where(F.col("status") != 0).select(
        *[F.lit(None).cast("bigint").alias(c) for c in ORDER_COLS[:2]], F.col("file").alias(ORDER_COLS[2]), "provider", "status")
    return rows.unionByName(still_open)


def stream_isolates_failures(spark, sf_dir):
    """Two passes of the periodic import over feeds of ``orders``.  In the first
    ``ord0`` loads while ``ord1`` and ``ord3`` are damaged; then ``ord2`` lands
    and ``ord1`` is repaired in place.  The second pass loads both, and the
    ledger still names ``ord3``, tried twice."""
    from lading.streaming.feed_stream import PassFailed, import_stream

    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "warehouse")
    _order_feeds(spark, sf_dir, landing, damaged=(1, 3), only=(0, 1, 3))
    for repaired in ((), (1, 2)):
        if repaired:
            _order_feeds(spark, sf_dir, landing, only=repaired)
        try:
            results = import_stream(spark, landing, root, registry=_order_registry(), max_rows=None)
        except PassFailed as exc:
            results = exc.results
    rows = results[-1].table("orders").select(*ORDER_COLS, "provider", F.lit(0).cast("long").alias("attempts"))
    ledger = results[-1].failures().select(
        *[F.lit(None).cast("bigint").alias(c) for c in ORDER_COLS[:2]], F.col("item").alias(ORDER_COLS[2]), "provider", "attempts")
    return rows.unionByName(ledger)


# --- parse and project -------------------------------------------------------

ORDERS_REG = build_registry(
    "orders: o_orderkey integer, o_custkey integer, o_orderstatus text, o_totalprice real, o_orderpriority text | o_orderkey",
    "[tpch]\norders: o_orderkey o_custkey o_orderstatus o_totalprice o_orderpriority",
)
ORDERS_T = ORDERS_REG.tables["orders"]
_LAYOUT_A = ["o_custkey", "o_comment", "o_orderkey", "o_orderpriority", "o_orderstatus"]
_LAYOUT_B = ["o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority", "o_totalprice"]


def _orders_lines(o: DataFrame, mutate: bool = False, layout_a: bool = True) -> DataFrame:
    in_a = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM") if layout_a else F.lit(False)
    comment = F.concat(F.lit('"note, '), F.col("o_orderpriority"), F.lit('"'))
    line_a = _csv("o_custkey", comment, "o_orderkey", "o_orderpriority", "o_orderstatus")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    line_b = _csv("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority", price)
    line = F.when(in_a, line_a).otherwise(line_b)
    if mutate:
        line = (
            F.when(F.col("o_orderstatus") == "P", F.concat(line, F.lit(",extra")))
            .when(F.col("o_orderpriority") == "5-LOW", F.regexp_replace(line, ",[^,]*$", ""))
            .otherwise(line)
        )
    return o.select(
        F.lit("tpch").alias("provider"),
        F.concat("o_orderpriority", F.lit(".txt")).alias("file"),
        (F.col("o_orderkey") + 1).alias("line_no"),
        line.alias("line"),
    )


def _orders_plan(spark, o: DataFrame, layout_a: bool = True) -> DataFrame:
    files = o.select(
        F.lit("tpch").alias("provider"), F.concat("o_orderpriority", F.lit(".txt")).alias("file")
    ).distinct()
    in_a = F.col("file").isin("1-URGENT.txt", "2-HIGH.txt", "3-MEDIUM.txt") if layout_a else F.lit(False)
    hdr = F.when(in_a, F.array(*map(F.lit, _LAYOUT_A))).otherwise(F.array(*map(F.lit, _LAYOUT_B)))
    headers = _header_rows(files, hdr, "orders")
    return build_plan(headers, declared_columns(registry_df(spark, ORDERS_REG)), ORDERS_T)


def csv_project_by_header(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    plan = _orders_plan(spark, o)
    parsed = drop_malformed(parse_lines(_orders_lines(o), plan, ORDERS_T, 5))
    return parsed.select("provider", "file", "line_no", *ORDERS_T.column_names)


def csv_drop_malformed(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    plan = _orders_plan(spark, o, layout_a=False)
    parsed = drop_malformed(parse_lines(_orders_lines(o, mutate=True, layout_a=False), plan, ORDERS_T, 5))
    typed = type_columns(parsed, ORDERS_T)
    return typed.select(*ORDERS_T.column_names)


CUSTOMER_REG = build_registry(
    "customer: c_custkey integer, c_name text, c_mktsegment text, c_nationkey integer | c_custkey",
    "[tpch]\ncustomer: c_custkey c_name c_mktsegment c_nationkey",
)
CUSTOMER_T = CUSTOMER_REG.tables["customer"]


QUOTE_T = build_registry("q: k integer, a text, b text | k", "[tpch]\nq: k a b")


def csv_quote_rules(spark, sf_dir):
    """Text after a closing quote continues the field; bytes inside quotes stay
    as they are, line ends too; a quote inside a plain field is a character."""
    o = table(spark, sf_dir, "orders")
    v = F.col("o_orderkey") % 4
    a = (F.when(v == 0, F.concat(F.lit('"'), "o_orderpriority", F.lit('"tail"'), "o_orderstatus"))
         .when(v == 1, F.concat(F.lit('"a,'), "o_orderstatus", F.lit('\r\n""'), "o_orderpriority", F.lit('"')))
         .when(v == 2, F.concat("o_orderstatus", F.lit('"x"')))
         .otherwise(F.lit('""')))
    lines = o.select(F.lit("tpch").alias("provider"), F.lit("q.txt").alias("file"), (F.col("o_orderkey") + 1).alias("line_no"),
                     F.concat_ws(",", _s("o_orderkey"), a, _s("o_custkey")).alias("line"))
    plan = build_plan(_headers(spark, [("tpch", "q.txt", "q", ["k", "a", "b"])]),
                      declared_columns(registry_df(spark, QUOTE_T)), QUOTE_T.tables["q"])
    out = drop_malformed(parse_lines(lines, plan, QUOTE_T.tables["q"], 3, broadcast_plan=True))  # one file
    return out.select(F.col("k").cast("bigint").alias("o_orderkey"), "a", F.col("b").cast("bigint").alias("o_custkey"))


def csv_empty_is_string(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    seg = (
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(""))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit('""'))
        .otherwise(F.col("c_mktsegment"))
    )
    lines = c.select(
        F.lit("tpch").alias("provider"), F.lit("customer.txt").alias("file"),
        (F.col("c_custkey") + 1).alias("line_no"),
        _csv("c_custkey", "c_name", seg, "c_nationkey").alias("line"),
    )
    headers = _headers(spark, [("tpch", "customer.txt", "customer",
                                ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"])])
    plan = build_plan(headers, declared_columns(registry_df(spark, CUSTOMER_REG)), CUSTOMER_T)
    parsed = drop_malformed(parse_lines(lines, plan, CUSTOMER_T, 4, broadcast_plan=True))  # one file
    return type_columns(parsed, CUSTOMER_T).select("c_custkey", "c_mktsegment")


REGION_REG = build_registry(
    "region: r_regionkey integer, r_name text | r_regionkey", "[tpch]\nregion: r_regionkey r_name"
)
REGION_T = REGION_REG.tables["region"]


def no_match_skip(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    files = r.select(F.lit("tpch").alias("provider"), F.concat("r_name", F.lit(".txt")).alias("file"))
    hdr = F.when(F.col("file").startswith("A"), F.array(F.lit("x"), F.lit("y"))).otherwise(
        F.array(F.lit("r_regionkey"), F.lit("r_name"))
    )
    plan = build_plan(_header_rows(files, hdr, "region"),
                      declared_columns(registry_df(spark, REGION_REG)), REGION_T)
    lines = r.select(
        F.lit("tpch").alias("provider"), F.concat("r_name", F.lit(".txt")).alias("file"),
        F.lit(1).cast("long").alias("line_no"), _csv("r_regionkey", "r_name").alias("line"),
    )
    loaded = drop_malformed(parse_lines(lines, plan, REGION_T, 2)).groupBy("provider", "file").agg(
        F.count(F.lit(1)).alias("rows_loaded")
    )
    done = plan.join(loaded, ["provider", "file"], "left").withColumn(
        "rows_loaded", F.coalesce("rows_loaded", F.lit(0)).cast("long"))
    # A file without a matching column takes no rows and ends where it began.
    ends = control.rollback_points(done.select(
        "file", F.col("rows_loaded").alias("last_line"), F.col("rows_loaded").alias("size"), F.lit(False).alias("failed")), ["file"])
    return done.join(ends, "file").select("file", "n_matched", F.col("Status").alias("status"), "rows_loaded")


PART_T = LogicalTable("part_text", (("size", "integer"), ("price", "real")), ("p_partkey",))


def numeric_affinity(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    s = _s("p_size")
    v = F.col("p_partkey") % 8
    size_text = (
        F.when(v == 0, s)
        .when(v == 1, F.concat(F.lit(" "), s, F.lit(" ")))
        .when(v == 2, F.concat(F.lit("00"), s))
        .when(v == 3, F.concat(s, F.lit(".0")))
        .when(v == 4, F.concat(s, F.lit("e0")))
        .when(v == 5, F.concat(F.lit("+"), s))
        .when(v == 6, F.concat(s, F.lit(".5")))
        .otherwise(F.concat(F.lit("x"), s))
    )
    price = _s(F.col("p_retailprice").cast("decimal(8,2)"))
    w = F.col("p_partkey") % 4
    price_text = (
        F.when(w == 0, price)
        .when(w == 1, F.concat(F.lit(" "), price))
        .when(w == 2, F.lit("nan"))
        .otherwise(F.lit(""))
    )
    texts = p.select("p_partkey", size_text.alias("size"), price_text.alias("price"))
    kept = texts.withColumns({"size_text": F.col("size"), "price_text": F.col("price")})
    return type_columns(kept, PART_T).select(
        "p_partkey", "size_text", F.col("size").alias("size_value"),
        "price_text", F.col("price").alias("price_value"), F.size("_rejects").alias("n_rejects"))


def json_batch_explode(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rec = F.struct(*[_s(c).alias(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")])
    batches = (
        o.withColumn("batch_no", L.batch_number(F.col("o_orderkey") + 1, BATCH))
        .groupBy("batch_no")
        .agg(F.to_json(F.collect_list(rec)).alias("payload"))
    )
    return json_rows(batches, "payload", {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_orderpriority": "string"})


# --- positions, batches, offsets, budget -------------------------------------

def line_numbers(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = scratch_path(spark, "lineitem-text")
    li.orderBy(*LI_ORDER).select(_csv(*LI_ORDER).alias("value")).write.text(out)
    text = L.read_text_lines(spark, out, group_col=F.lit("lineitem.txt"))
    numbered = L.number_text_lines(text, "file")
    parts = F.split("value", ",")
    return numbered.select(
        parts[0].cast("bigint").alias("l_orderkey"),
        parts[1].cast("int").alias("l_linenumber"),
        parts[2].cast("bigint").alias("l_partkey"),
        parts[3].cast("bigint").alias("l_suppkey"),
        "line_no",
    )


def _lineitem_files(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("file"), *LI_ORDER)
    return L.number_rows(li, ["file"], LI_ORDER, out="line_no")


def microbatch_number(spark, sf_dir):
    rows = _lineitem_files(spark, sf_dir).withColumn("batch_no", L.batch_number("line_no", BATCH))
    return rows.groupBy("file", "batch_no").agg(
        F.count(F.lit(1)).alias("batch_rows"),
        F.min("line_no").alias("first_line"),
        F.max("line_no").alias("last_line"),
    )


def _offsets(files: DataFrame) -> DataFrame:
    return files.select(
        "file",
        F.when(F.col("file") == "A", 0).when(F.col("file") == "N", 100).otherwise(1_000_000_000)
        .cast("long").alias("resume_from"),
    )


def resume_offset(spark, sf_dir):
    rows = _lineitem_files(spark, sf_dir)
    offs = _offsets(table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("file")).distinct())
    return L.after_offset(rows, offs, ["file"], offset_col="resume_from").select(
        "file", "line_no", *LI_ORDER
    )


def row_budget(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("file"))
    counts = li.groupBy("file").agg(F.count(F.lit(1)).alias("total"))
    files = _offsets(counts.select("file")).join(counts, "file")
    avail = files.select(
        F.lit("tpch").alias("provider"), "file", "resume_from",
        F.greatest(F.col("total") - F.col("resume_from"), F.lit(0)).cast("long").alias("rows"),
    )
    q = L.file_quotas(avail, BUDGET)
    return q.select(
        "file", "resume_from", "rows", "taken_before", "quota", "file_done",
        (F.col("resume_from") + F.col("quota")).alias("last_line"),
    )


# --- versions, gate, resume ---------------------------------------------------

def _nation_versions(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    remote = n.select(
        F.col("n_name").alias("provider"),
        F.when(F.col("n_regionkey") == 4, F.lit(""))
        .otherwise(F.concat(F.lit("v"), _s("n_regionkey")))
        .alias("remote_version"),
    )
    # Providers of region 0 have never been imported: no stored version.
    stored = n.where(F.col("n_regionkey") != 0).select(
        F.col("n_name").alias("Provider"),
        F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("v"), _s("n_regionkey")))
        .otherwise(F.concat(F.lit("v"), _s(F.col("n_regionkey") + 1)))
        .alias("ETag"),
    )
    return control.version_changes(remote, stored)


def version_change_detect(spark, sf_dir):
    return _nation_versions(spark, sf_dir).select(
        "provider", "stored_version", "remote_version", "changed"
    )


def provider_gate(spark, sf_dir):
    changes = _nation_versions(spark, sf_dir)
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    progress = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("Provider"),
        F.concat(F.lit("c"), _s("c_custkey")).alias("FileName"),
        F.when(F.col("c_acctbal") < 0, F.lit(1)).when(F.col("c_acctbal") > 9000, F.lit(None))
        .otherwise(F.lit(0)).cast("int").alias("Status"),
    )
    gate = control.provider_gate(changes, control.incomplete_counts(progress))
    return gate.select("provider", "changed", "incomplete", "action")


def _doc_file(c="doc_id") -> Column:
    return F.concat(F.lit("doc_"), _s(c), F.lit(".txt"))


def resume_plan(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    entries = d.select(F.col("source").alias("provider"), _doc_file().alias("file"),
                       F.md5("text").alias("crc"))
    progress = d.where(F.col("lang") != "en").select(
        F.col("source").alias("Provider"),
        _doc_file().alias("FileName"),
        F.when(F.col("lang") == "fr", F.md5(F.concat("text", F.lit("x")))).otherwise(F.md5("text")).alias("CRC"),
        F.when(F.col("lang") == "fr", F.lit(5)).otherwise(F.col("n_chars") % 1000).cast("long").alias("LastProcessedLine"),
        F.when(F.col("lang").isin("fr", "de"), F.lit(0))
        .when(F.col("n_chars") % 2 == 0, F.lit(1))
        .otherwise(F.lit(None)).cast("int").alias("Status"),
    )
    return control.resume_state(entries, progress).select("provider", "file", "action", "offset")


def incomplete_count(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    progress = o.select(
        F.concat(F.lit("c"), _s("o_custkey")).alias("Provider"),
        F.concat(F.lit("o"), _s("o_orderkey")).alias("FileName"),
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1)
        .otherwise(F.lit(None)).cast("int").alias("Status"),
    )
    return control.incomplete_counts(progress)


def run_metrics(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.select(
        F.concat(F.lit("u"), _s(F.floor(F.col("user_id") / 50))).alias("provider"),
        F.concat("event_type", F.lit(".txt")).alias("file"),
        F.col("event_id").alias("line_no"),
        ((F.col("event_type") == "error") & (F.col("value") > 50)).alias("error"),
    )
    return control.run_metrics(rows)


# --- upserts ----------------------------------------------------------------

EVENT_KEY = ["user_id", "event_type"]
EVENT_COLS = ["user_id", "event_type", "event_id", "value"]


def _event_halves(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(*EVENT_COLS)
    half = e.select(F.max("event_id") / 2).scalar()
    return e.where(F.col("event_id") <= half), e.where(F.col("event_id") > half)


def upsert_last_wins(spark, sf_dir):
    old_rows, new_rows = _event_halves(spark, sf_dir)
    old = last_wins(old_rows, EVENT_KEY, ["event_id"])
    return upsert(old, new_rows, EVENT_KEY, order_cols=["event_id"])


def upsert_missing_null(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    new = c.where(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", F.lower("c_name").alias("c_name"), "c_nationkey",
        F.lit(None).cast("double").alias("c_acctbal"), "c_mktsegment",
    )
    return upsert(c, new, ["c_custkey"])


def upsert_null_keys(spark, sf_dir):
    old_rows, new_rows = _event_halves(spark, sf_dir)
    old = last_wins(old_rows, EVENT_KEY, ["event_id"])
    new = new_rows.withColumn(
        "user_id", F.when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.col("user_id"))
    )
    return upsert(old, new, EVENT_KEY, order_cols=["event_id"])


def upsert_keyless(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    first = upsert(spark.createDataFrame([], r.schema), r, [])
    return upsert(first, r, [])


def version_upsert(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    empty = spark.createDataFrame([], control.VERSIONS_SCHEMA)
    run1 = n.select(F.col("n_name").alias("Provider"), F.concat(F.lit("e1-"), _s("n_regionkey")).alias("ETag"))
    run2 = n.where(F.col("n_regionkey").isin(1, 2)).select(
        F.col("n_name").alias("Provider"), F.concat(F.lit("e2-"), _s("n_nationkey")).alias("ETag")
    )
    v = control.set_versions(control.set_versions(empty, run1), run2)
    return v.select("Provider", "ETag")


def _doc_progress_open(d: DataFrame) -> DataFrame:
    return d.where(F.col("lang") != "de").select(
        F.col("source").alias("Provider"), _doc_file().alias("FileName"),
        F.md5("text").alias("CRC"), F.lit(0).cast("long").alias("LastProcessedLine"),
    )


def progress_lifecycle(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    empty = spark.createDataFrame([], control.PROGRESS_SCHEMA)
    opened = control.open_progress(empty, _doc_progress_open(d))
    closes = d.select(
        F.col("source").alias("Provider"), _doc_file().alias("FileName"),
        F.col("n_chars").alias("LastProcessedLine"),
        F.when(F.col("n_chars") < 5000, 0).otherwise(1).alias("Status"),
    )
    closed = control.close_progress(opened, closes)
    return closed.select("Provider", "FileName", "CRC", "LastProcessedLine", "Status")


def progress_rollback(spark, sf_dir):
    rows = _lineitem_files(spark, sf_dir).withColumn("batch_no", L.batch_number("line_no", BATCH))
    batches = rows.groupBy("file", "batch_no").agg(
        F.max("line_no").alias("last_line"), F.count(F.lit(1)).alias("size")
    ).withColumn("failed", F.col("batch_no") % 7 == 3)
    return control.rollback_points(batches, ["file"])


# --- user-facing queries -----------------------------------------------------

STATUS_PROVIDER = "src3"


def status_json(spark, sf_dir):
    from lading.plans.status import provider_status

    d = table(spark, sf_dir, "documents")
    progress = d.select(
        F.col("source").alias("Provider"), _doc_file().alias("FileName"),
        F.substring(F.md5("text"), 1, 8).alias("CRC"),
        F.col("n_chars").alias("LastProcessedLine"),
        F.when(F.col("lang") == "en", 0).otherwise(1).cast("int").alias("Status"),
        F.current_timestamp().alias("UpdatedAt"),
    )
    st = provider_status(progress, STATUS_PROVIDER, drop=["UpdatedAt"])
    return st.select("FileName", binding_name(F.lit(STATUS_PROVIDER)).alias("binding"), "json")


DRIFT_DECLARED = [
    ("tpch", "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
    ("tpch", "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]),
    ("tpch", "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", "p_comment"]),
    ("tpch", "supplier", ["s_name", "s_suppkey", "s_nationkey", "s_acctbal"]),
    ("tpch", "region", ["r_regionkey", "r_comment"]),
    ("tpch", "lineitem", ["l_orderkey", "l_linenumber"]),
]
DRIFT_FEEDS = ["customer", "orders", "part", "supplier", "region", "nation"]


def schema_drift_report(spark, sf_dir):
    """Two providers land every table as a feed archive; the headers of the
    report come from the archives."""
    landing = scratch_path(spark, "drift-landing")
    for name in DRIFT_FEEDS:
        df = table(spark, sf_dir, name)
        cols = df.columns
        header = ["\ufeff C_CustKey ", *cols[1:]] if name == "customer" else cols
        write_archives_in_pieces(df.select(_dealt_to(cols[0], 2), _csv(*cols).alias("line")), landing, "v1", name,
                                 ",".join(header), "tpch")
    declared = spark.createDataFrame(
        [(p, t, c) for p in ("tpch0", "tpch1") for _, t, c in DRIFT_DECLARED],
        "provider string, table string, declared array<string>")
    r = drift_from_landing(spark, landing, declared)
    return r.select(
        "provider", "table", "file", "outcome",
        F.array_join("missing_in_db", ",").alias("missing_in_db"),
        F.array_join("extra_in_db", ",").alias("extra_in_db"),
        "importer_exact",
    )


def scalar_names(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    path = F.regexp_extract("url", r"^[a-z]+://[^/?#]+([^?#]*)", 1)
    seg = path_segments(path)
    return p.select(
        "page_id",
        path.alias("path"),
        seg[0].alias("seg1"),
        F.try_element_at(seg, F.lit(2)).alias("seg2"),
        binding_name(seg[0]).alias("binding"),
        (F.coalesce(F.try_element_at(seg, F.lit(2)), F.lit("")) == "status").alias("is_status"),
    )


def stream_available_now(spark, sf_dir):
    from lading.streaming.available_now import upsert_stream

    e = table(spark, sf_dir, "events").select(*EVENT_COLS)
    landing = scratch_path(spark, "events-landing")
    e.repartition(4).write.parquet(landing)
    root = scratch_path(spark, "events-tables")
    return upsert_stream(
        spark, landing, e.schema, root, "events_latest", EVENT_KEY, ["event_id"],
        max_files_per_trigger=1,
    )


def _customer_feeds(spark, sf_dir):
    """``customer`` landed as feed archives (one per partition) and a
    registry declaring them."""
    landing = scratch_path(spark, "feeds")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    c = table(spark, sf_dir, "customer")
    written = write_archives(c.select(_csv(*cols).alias("line")), landing, "v1", "customer",
                             ",".join(cols), "cust-").collect()  # one row per archive
    reg = build_registry(
        "customer: c_custkey integer, c_name text, c_nationkey integer, c_acctbal real, c_mktsegment text | c_custkey",
        "\n".join(f"[{w['provider']}]\ncustomer: {' '.join(cols)}" for w in written),
    )
    return landing, reg, cols


def stream_feed_import(spark, sf_dir):
    """The periodic import as an availableNow stream over the landing folder:
    the pass sees the new archives and imports their providers (no row cap
    here; capped passes and their resume are covered by the tests)."""
    from lading.streaming.feed_stream import import_stream

    landing, reg, cols = _customer_feeds(spark, sf_dir)
    root = scratch_path(spark, "warehouse")
    results = import_stream(spark, landing, root, registry=reg, max_rows=None)
    return results[-1].table("customer").select(*cols)


def feed_import(spark, sf_dir):
    from lading.plans.ingest import import_landing

    landing, reg, cols = _customer_feeds(spark, sf_dir)
    root = scratch_path(spark, "warehouse")
    result = import_landing(spark, landing, root, registry=reg, max_rows=None)
    return result.table("customer").select(*cols)
