"""Property: records written by a standard CSV writer come back field for
field through the field count and the parse."""

import csv
import io

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lading.operators.parse import build_plan, declared_columns, field_count, parse_lines
from lading.registry import build_registry, registry_df
from lading.sources.archive import _records

CELL = st.text(alphabet=st.sampled_from(list('ab ,"\\x') + ["é", "\n", "\r"]), max_size=6)
ROW = st.lists(CELL, min_size=3, max_size=3)

REG = build_registry("t: a text, b text, c text | a", "[p]\nt: a b c")


def render(row):
    buf = io.StringIO()
    csv.writer(buf, lineterminator="\n").writerow(row)
    return buf.getvalue()[:-1]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=40, max_size=80))
def test_fields_round_trip(spark, rows):
    lines = [(i + 1, render(r)) for i, r in enumerate(rows)]
    df = spark.createDataFrame([("p", "f", n, ln) for n, ln in lines],
                               "provider string, file string, line_no long, line string")
    counts = {r["line_no"]: r["n"] for r in df.select("line_no", field_count("line").alias("n")).collect()}
    assert all(counts[n] == 3 for n, _ in lines)
    headers = spark.createDataFrame([("p", "f", "t", ["a", "b", "c"])],
                                    "provider string, file string, table string, header array<string>")
    t = REG.tables["t"]
    plan = build_plan(headers, declared_columns(registry_df(spark, REG)), t)
    got = {r["line_no"]: (r["valid"], [r["a"], r["b"], r["c"]]) for r in parse_lines(df, plan, t, 3).collect()}
    for n, r in enumerate(rows, start=1):
        assert got[n] == (True, r), (n, lines[n - 1], got[n])


def reference_records(text: str) -> list[list[str]]:
    """A character-by-character reader with the rules of a streaming CSV
    parser: CR, LF and CRLF end records, a quote opens a field only at its
    start, text after the closing quote continues the field."""
    out, row, field, state, quoted = [], [], "", "start", False
    k = 0
    while k <= len(text):
        c = text[k] if k < len(text) else None
        if state == "quoted":
            if c is None:
                out.append([*row, field])
                return out
            if c == '"' and text[k + 1: k + 2] == '"':
                field += '"'
                k += 1
            elif c == '"':
                state = "field"
            else:
                field += c
        elif c in ("\r", "\n", None):
            if row or field or quoted:
                out.append([*row, field])
            row, field, state, quoted = [], "", "start", False
        elif c == ",":
            row, field, state = [*row, field], "", "start"
        elif c == '"' and state == "start":
            state, quoted = "quoted", True
        else:
            field, state = field + c, "field"
        k += 1
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='ab,"\r\n', max_size=40), st.sampled_from([1, 2, 3, 7, 100]))
def test_records_and_fields_match_a_plain_reader(text, chunk):
    from lading.sources.archive import split_record

    got = [split_record(r.decode()) for r in _records(io.BytesIO(text.encode()), chunk) if r]
    assert got == reference_records(text)


def test_record_scan_is_linear():
    import time

    for text in (b'h,i\nx,"stray\n' + b"1,2,3,4,5,6\n" * 430_000, b'h\n"' + b"y\r\n" * 1_500_000 + b'"\nz\n'):
        began = time.perf_counter()
        assert len([r for r in _records(io.BytesIO(text)) if r]) in (2, 3)
        assert time.perf_counter() - began < 5


@settings(max_examples=30, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=20), st.sampled_from(["\n", "\r\n"]))
def test_expander_records_round_trip(rows, eol):
    text = eol.join(render(r) for r in rows) + eol
    data = io.BytesIO(("﻿" + text).encode("utf-8"))
    recs = [r.decode("utf-8") for r in _records(data, chunk=7) if r]
    parsed = [next(csv.reader([r])) for r in recs]
    assert parsed == [r for r in rows if render(r) != ""]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='a,"\r\n\x00é', max_size=12), min_size=1, max_size=8))
def test_the_scanners_arity_is_the_number_of_fields(records):
    import pyarrow as pa

    from lading.sources.archive import arities, split_record

    fields, odd = arities(pa.array(records))
    assert fields.tolist() == [len(split_record(r)) for r in records]
    for r, o in zip(records, odd.tolist()):
        if not o and '"' in r:  # a field is then plain, or one quoted text
            assert ",".join('"' + f.replace('"', '""') + '"' if q else f for f, q in _fields(r)) == r


def _fields(record):
    from lading.sources.archive import split_record

    out, at = [], 0
    for f in split_record(record):
        quoted = record[at:at + 1] == '"'
        out.append((f, quoted))
        at += len('"' + f.replace('"', '""') + '"' if quoted else f) + 1
    return out
