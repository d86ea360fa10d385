"""CSV records → declared columns, by header name.

Input is a *lines* DataFrame: one row per CSV record with
``(provider, file, line_no, line[, bad_utf8])``; ``line_no`` 0 is the header.
Per file, a small *plan* says where each declared column sits in the header.
One pass per logical table parses every file of that table, whatever its
header layout: the plan is broadcast (its size is the number of files), the
records are parsed JVM-side by ``from_csv``, and each declared column is
picked by its index in the file's header.

A record is malformed when its field count differs from its header's, or when
it is not valid UTF-8.  The field count is computed from the record text
(fields that start with a quote may hold commas), not from the parser's
corrupt-record column, which Catalyst may prune away with unused fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.functions.affinity import typed_value
from lading.registry import LogicalTable

# CSV dialect of the feeds: comma, double quote, a doubled quote escapes
# itself, nothing trimmed, no comment lines.
CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# A quoted field: starts right after a delimiter (or at the record start),
# doubled quotes inside, taken greedily (possessive, like a streaming CSV
# reader); left open, it takes the rest of the record.  Removing these leaves
# only delimiters that separate fields.
_QUOTED_FIELD = r'(\A|,)"[^"]*+(?:""[^"]*+)*+"?'
# Records whose fields ``from_csv`` would not give as they are: text after a
# closing quote, a quote left open, line ends inside quotes.
_ODD_RECORD = r'(?:\A|,)"[^"]*+(?:""[^"]*+)*+(?:"[^,]|\z)|[\r\n]'
# One field with the comma before it: quoted text and what follows, or plain.
_ONE_FIELD = r',("[^"]*+(?:""[^"]*+)*+(?:"[^,]*+|\z)|[^,]*+)'
_QUOTED_VALUE = r'(?s)\A"((?:[^"]|"")*+)"?(.*)\z'


#: Keys over which the records of one file are spread where the plan is joined
#: by key: one file may hold most of the records.
SALTS = 64


def field_count(line) -> Column:
    """Number of CSV fields in one record."""
    ln = F.col(line) if isinstance(line, str) else line
    stripped = F.when(ln.contains('"'), F.regexp_replace(ln, _QUOTED_FIELD, "$1")).otherwise(ln)
    return F.length(stripped) - F.length(F.replace(stripped, F.lit(","), F.lit(""))) + 1


def split_fields(line: Column) -> Column:
    """Field texts of one record, by the rules of a streaming CSV reader: the
    text after a closing quote continues the field, bytes inside quotes stay."""
    fields = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_ONE_FIELD), F.lit(1))
    return F.transform(fields, lambda f: F.when(
        f.startswith('"'),
        F.concat(F.replace(F.regexp_extract(f, _QUOTED_VALUE, 1), F.lit('""'), F.lit('"')),
                 F.regexp_extract(f, _QUOTED_VALUE, 2)),
    ).otherwise(f))


def odd_record(line: Column) -> Column:
    return line.contains('"') & line.rlike(_ODD_RECORD)


def idx_col(column: str) -> str:
    return f"_idx_{column}"


def declared_columns(registry: DataFrame) -> DataFrame:
    """``(provider, table, declared array<string>, keyed boolean)`` per declared
    table, declared columns in order."""
    return registry.groupBy("provider", "table").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("ordinal", "column"))), lambda s: s["column"]
        ).alias("declared"),
        F.max(F.col("key_ordinal").isNotNull()).alias("keyed"),
    )


def registered_entries(entries: DataFrame, declared: DataFrame, keys: list[str]) -> DataFrame:
    """Entries whose table is declared with at least one column, with that
    declaration (fixed size, not growing with the data: broadcast)."""
    return entries.join(F.broadcast(declared.where(F.size("declared") > 0)), keys, "inner")


def build_plan(headers: DataFrame, declared: DataFrame, table: LogicalTable) -> DataFrame:
    """Per file of ``table``: header width, and for every superset column of
    the logical table the 1-based position of the first header equal to it
    (exact, case-sensitive) — NULL when the provider does not declare the
    column or the header lacks it.

    ``headers``: ``(provider, file, table, header array<string>)``.
    ``declared``: output of :func:`declared_columns` (small, fixed size).
    """
    d = declared.where(F.col("table") == table.name)
    h = headers.where(F.col("table") == table.name).join(
        F.broadcast(d), ["provider", "table"], "inner"
    )
    idx = []
    for c in table.column_names:
        pos = F.array_position(F.col("header"), c).cast("int")
        idx.append(
            F.when(F.array_contains(F.col("declared"), c) & (pos > 0), pos).alias(idx_col(c))
        )
    plan = h.select(
        "provider", "file", "table", "keyed",
        F.size("header").alias("width"),
        *idx,
    )
    matched = sum(F.when(F.col(idx_col(c)).isNotNull(), 1).otherwise(0) for c in table.column_names)
    return plan.withColumn("n_matched", matched)


def parse_lines(lines: DataFrame, plan: DataFrame, table: LogicalTable, max_width: int,
                broadcast_plan: bool = False, bounded: bool = False) -> DataFrame:
    """Parse the data records of ``table``'s files and project them onto the
    superset columns (text).

    Returns ``provider, file, line_no, valid`` and one string column per
    superset column.  A column absent from a file's header (or not declared
    for its provider) is NULL; a present but empty cell is ``''``.
    ``max_width`` is the widest header among the plan's files; it only sizes
    the parse schema.  The plan has one row per file; its join is left to the
    optimizer, with each file's records spread over ``SALTS`` keys, unless the
    caller knows the plan's size and asks to ``broadcast_plan``.  ``bounded``: the plan also names the entry's ``crc``
    and the lines to take (after ``offset``, up to ``upto``), so that one join
    selects and parses.

    Records that the expander has looked at carry ``n_fields`` and ``odd``;
    for others both follow from the text.  A record without a quote is split at
    its commas, ``from_csv`` is for those with quoted fields, and only odd ones
    need the full rules.
    """
    schema = ", ".join(f"c{i} string" for i in range(max(max_width, 1)))
    keys = ["provider", "file", *(["crc"] if bounded else [])]
    plan_cols = [*keys, "width"] + [idx_col(c) for c in table.column_names]
    src = lines if "bad_utf8" in lines.columns else lines.withColumn("bad_utf8", F.lit(False))
    p = plan.where(F.col("n_matched") > 0).select(*plan_cols, *([F.col("offset").alias("_from"), "upto"] if bounded else []))
    src = src.where(F.col("line_no") > 0)
    if broadcast_plan:
        p = F.broadcast(p)
    else:
        src = src.withColumn("_salt", F.pmod("line_no", F.lit(SALTS)).cast("int"))
        p = p.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        keys = [*keys, "_salt"]
    rows = src.join(p, keys, "inner")
    if bounded:
        rows = rows.where((F.col("line_no") > F.col("_from")) & (F.col("line_no") <= F.col("upto")))
    idx = [idx_col(c) for c in table.column_names]
    line = F.col("line")
    fields, odd = field_count(line), odd_record(line)
    if "n_fields" in lines.columns:
        fields, odd = F.coalesce("n_fields", fields), F.coalesce("odd", odd)
    # Three projections on purpose: the parsed struct and the cell array are
    # each referenced many times downstream, and Catalyst does not inline a
    # non-trivial expression into several consumers — so each record is
    # parsed once.  Inlined into per-column CASE branches, ``from_csv`` would
    # run once per output column.
    quoted = line.contains('"')
    parsed = rows.select(
        "provider", "file", "line_no", *idx,
        (~F.col("bad_utf8") & (fields == F.col("width"))).alias("valid"),
        F.when(quoted, F.from_csv(line, schema, CSV_OPTIONS)).alias("_r"),
        F.when(odd, split_fields(line)).when(~quoted, F.split(line, ",", -1)).alias("_plain"),
    )
    cells = parsed.select(
        "provider", "file", "line_no", "valid", *idx,
        F.coalesce("_plain", F.array(*[F.col("_r")[f"c{i}"] for i in range(max(max_width, 1))])).alias("_cells"),
    )
    out = [
        F.when(
            F.col(idx_col(c)).isNotNull(),
            F.coalesce(F.try_element_at(F.col("_cells"), F.col(idx_col(c))), F.lit("")),
        ).alias(c)
        for c in table.column_names
    ]
    return cells.select("provider", "file", "line_no", "valid", *out)


def drop_malformed(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("valid")).drop("valid")


def type_columns(df: DataFrame, table: LogicalTable) -> DataFrame:
    """Typed values by affinity plus ``_rejects``: the columns whose non-empty
    text did not fit the declared type, with that text.

    Each value is typed once; the reject check reads the typed column in a
    second projection instead of typing the text again."""
    numeric = [c for c, aff in table.columns if aff != "text"]
    keep = [x for x in df.columns if x not in set(table.column_names)]
    typed = df.select(
        *keep,
        *[typed_value(F.col(c), aff).alias(c) for c, aff in table.columns],
        *[F.col(c).alias(f"_raw_{c}") for c in numeric],
    )
    parts = [
        F.when(
            F.col(f"_raw_{c}").isNotNull() & (F.trim(F.col(f"_raw_{c}")) != "") & F.col(c).isNull(),
            F.struct(F.lit(c).alias("column"), F.col(f"_raw_{c}").alias("text")),
        )
        for c in numeric
    ]
    rejects = (
        F.filter(F.array(*parts), lambda x: x.isNotNull())
        if parts
        else F.array().cast("array<struct<column:string,text:string>>")
    )
    return typed.select(*keep, *table.column_names, rejects.alias("_rejects"))
