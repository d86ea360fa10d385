"""Chat formatting with a verified grammar round trip, in Spark SQL functions.

A conversation is rendered turn by turn::

    <s>[INST role]⏎text⏎[/INST]</s>⏎

The role is percent-encoded.  The control strings are ``<s>``, ``</s>``,
``[INST`` and ``[/INST``.  The grammar is deterministic: ``</s>⏎`` ends a
turn, the first ``]⏎`` ends its head.  Rendering starts with the plain texts.
They are parsed back and compared to the source; a conversation whose texts
hold a control string (or an escaped one), or that does not come back
identical, is rendered again with a backslash behind the first character of
each such string and parsed again.  Escaping lengthens every run of
backslashes at such a place by one and parsing shortens it by one, so it is
reversible for any text.  ``identical`` reports the last comparison.

Turns are ordered by turn, role, text (nulls first), so ties and repeated rows
have one order.  Null text and null role are empty; rows with a null
conversation id form one conversation.  Extra columns are ignored; an empty
table gives no rows.  A formatted conversation is one string value, so it is
bounded by Spark's 2 GB a value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, HEAD_END = "<s>[INST ", "]\n"
TAIL, TURN_END = "\n[/INST]", "</s>\n"
_CONTROL = r"([<\[])(\\*)(/?s>|/?INST)"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def conflicts(text: Column) -> Column:
    """The text holds a control string, plain or escaped."""
    return text.rlike(_CONTROL)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` refers
    to it inside other lambda functions."""
    return F.transform(F.array(value), use)[0]


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), F.url_encode(role), F.lit(HEAD_END), text, F.lit(TAIL + TURN_END))


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of (role, text)."""
    pieces = F.filter(F.split(formatted, TURN_END), lambda p: p != "")

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, HEAD_END, 1)
        start = F.length(head) + len(HEAD_END)
        return F.struct(
            F.url_decode(F.substring(head, F.lit(len(HEAD) + 1), F.length(head))).alias("role"),
            unescape(F.substring(piece, start + 1, F.length(piece) - start - len(TAIL))).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def format_chats(chats: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: the id, formatted, turns (parsed back from
    it), loss_spans (code points of ``formatted`` that carry loss, end
    exclusive: the texts of ``loss_role``), escaped, identical."""
    empty = F.lit("")
    rows = chats.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), empty).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), empty).alias("text"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    # Offsets of both renderings as running sums, in the shuffle that the grouping needs anyway.
    rows = rows.withColumns({"safe": escape(F.col("text")), "head": F.length(F.url_encode("role")) + len(HEAD + HEAD_END)})
    frame = len(TAIL + TURN_END)
    rows = rows.withColumns({
        "place": F.row_number().over(order),
        "end0": F.sum(F.col("head") + F.length("text") + frame).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "end1": F.sum(F.col("head") + F.length("safe") + frame).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    convs = rows.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "text", "safe", "end0", "end1"))).alias("source"),
        F.max(conflicts(F.col("text"))).alias("conflict"))

    def render(which: str) -> Column:
        return F.array_join(F.transform("source", lambda t: _turn(t["role"], t[which])), "")

    wanted = F.transform("source", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    # Round one: plain texts.  Round two, where they conflict or come back different: escaped.
    first = F.when(~F.col("conflict"), bound(render("text"), lambda f: F.struct(f.alias("formatted"), parse(f).alias("turns"))))
    convs = convs.withColumn("plain", first).withColumn("escaped", F.col("conflict") | ~F.coalesce(F.col("plain.turns") == wanted, F.lit(False)))
    second = F.when(F.col("escaped"), bound(render("safe"), lambda f: F.struct(f.alias("formatted"), parse(f).alias("turns"))))
    convs = convs.withColumn("out", F.coalesce(second, F.col("plain")))

    def span(t: Column) -> Column:
        length = F.length(F.when(F.col("escaped"), t["safe"]).otherwise(t["text"]))
        end = F.when(F.col("escaped"), t["end1"]).otherwise(t["end0"]) - frame
        return F.struct((end - length).cast("int").alias("start"), end.cast("int").alias("end"))

    spans = F.transform(F.filter("source", lambda t: t["role"] == loss_role), span)
    return convs.select(
        F.col("conv").alias(conv_col), F.col("out.formatted").alias("formatted"), F.col("out.turns").alias("turns"),
        spans.alias("loss_spans"), "escaped", (F.col("out.turns") == wanted).alias("identical"))


def digest(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The contract's columns, read back from the formatted text."""
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.withColumn("loss", loss).select(
        conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "identical")


ORACLE = r"""
WITH src AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v
), per AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(length(url_encode(role)) + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST)', '\1\\\2\3', 'g')) + 24) AS chars
    FROM src GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
    CAST(chars AS BIGINT) AS formatted_chars, true AS identical FROM per
"""
