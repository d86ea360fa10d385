"""Conversation structure repair: the cheapest edits that make a conversation
alternate.

A repaired conversation's role initials match ``(s?(ua)+)?``.  Each row is
kept (cost 0), given the role user or assistant (3) or deleted (4; the only
choice for a blank or a repeated row), empty turns may be inserted anywhere
(3), and an undeleted truncated row adds 3.  Rows consumed by grammar states
form the edit lattice.  ``search`` runs Dijkstra's algorithm on it from both
ends: two heaps meet, all crossings of equal cost are finished, and of these
the ASCII-least audit (the edits' initials in order) is taken.

Rows are range-partitioned by conversation and place, so a long conversation
spreads over many tasks.  A partition is streamed; rows become one code each,
and codes are cut into segments of ``SEGMENT`` rows.  A conversation that lies
whole in one segment is solved there.  Of others each segment yields its least
(cost, audit) between every two grammar states, and the same search runs over
the segments; what one group then holds is of the order of the audit itself.

Order: by turn, nulls first; equal turns by role, then by the text's md5.
A row's first fault counts: blank (no character but white space), duplicate
(role and text seen earlier), truncated (the last character that is not white
space is none of ``.!?``).  A null role or text is one space, so such a text
is blank and such a role can only be changed.  Null conversation ids are one
conversation.  Conversations of ``ids`` without rows get zeros and an empty
audit.  Extra columns are ignored; an empty table gives the ids' rows only.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.graph import written
from lading.session import ship_package

SEGMENT = 512
#: Segments joined at once when a long conversation's are put together.
FAN = 64
SPACE = "\t\n\x0b\x0c\r "
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3
#: Next grammar state by state and role initial; states 0 and 3 accept.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPT = (0, 3)
STATES = range(4)
LEGAL = {"su", "ua", "au"}

Node = tuple[int, int]
Edge = tuple[Node, int, str]
Label = tuple[int, str]


def search(starts: list[Node], ends: list[Node], after: Callable[[Node], list[Edge]], before: Callable[[Node], list[Edge]]) -> Label | None:
    """Least cost and, among equal costs, least audit between two node sets.

    ``after`` and ``before`` give a node's edges (other end, cost, audit).
    Edges of cost 0 lead to a larger first coordinate, so nodes of equal cost
    leave a heap in an order in which their audits are final.  At one node no
    audit of equal cost is a prefix of another, so least parts make the least
    whole.  None if no path exists."""
    sides = []
    for nodes, edges, sign in ((starts, after, 1), (ends, before, -1)):
        heap = [(0, sign * x[0], x) for x in nodes]
        heapq.heapify(heap)
        sides.append((heap, {x: (0, "") for x in nodes}, set(), edges, sign))
    best = min((0 for x in starts if x in sides[1][1]), default=None)
    while sides[0][0] and sides[1][0]:
        if best is not None and sides[0][0][0][0] + sides[1][0][0][0] > best:
            break
        turn = 0 if sides[0][0][0][0] <= sides[1][0][0][0] else 1
        heap, labels, done, edges, sign = sides[turn]
        cost, _, node = heapq.heappop(heap)
        if node in done:
            continue
        done.add(node)
        audit = labels[node][1]
        other = sides[1 - turn][1]
        for end, step, piece in edges(node):
            label = (cost + step, audit + piece if sign > 0 else piece + audit)
            old = labels.get(end)
            if old is None or label < old:
                labels[end] = label
                if old is None or label[0] < old[0]:
                    heapq.heappush(heap, (label[0], sign * end[0], end))
                    if end in other and (best is None or label[0] + other[end][0] < best):
                        best = label[0] + other[end][0]
    if best is None:
        return None
    forth, back = sides[0][1], sides[1][1]
    return best, min(forth[x][1] + back[x][1] for x in forth.keys() & back.keys() if forth[x][0] + back[x][0] == best)


def _row_edits(code: str) -> list[tuple[str, str, int]]:
    """Edits that leave a row, as (role initial, edit, cost); a code is the
    role initial (or ``o``) and ``.``, ``t`` (truncated) or ``x`` (must go)."""
    out = []
    if code[1] != "x":
        extra = TRUNCATED if code[1] == "t" else 0
        out.append((code[0], "K", COST["K"] + extra))
        out += [(r, "R", COST["R"] + extra) for r in "ua"]
    return out


def lattice(codes: list[str]) -> tuple[Callable[[Node], list[Edge]], Callable[[Node], list[Edge]]]:
    """Edges out of and into a node (rows consumed, grammar state)."""
    into: dict[int, list[tuple[int, str]]] = {}
    for (g, role), to in STEPS.items():
        into.setdefault(to, []).append((g, role))
    edits = {c: _row_edits(c) for c in set(codes)}

    def after(node: Node) -> list[Edge]:
        i, g = node
        out = [((i, STEPS[g, r]), COST["I"], "I") for r in "ua" if (g, r) in STEPS]
        if i < len(codes):
            out.append(((i + 1, g), COST["D"], "D"))
            out += [((i + 1, STEPS[g, r]), cost, edit) for r, edit, cost in edits[codes[i]] if (g, r) in STEPS]
        return out

    def before(node: Node) -> list[Edge]:
        i, g = node
        out = [((i, h), COST["I"], "I") for h, r in into.get(g, ()) if r in "ua"]
        if i:
            out.append(((i - 1, g), COST["D"], "D"))
            out += [((i - 1, h), cost, edit) for r, edit, cost in edits[codes[i - 1]] for h, role in into.get(g, ()) if role == r]
        return out

    return after, before


def solve(codes: list[str]) -> Label:
    """Cost and audit of a whole conversation."""
    after, before = lattice(codes)
    return search([(0, 0)], [(len(codes), g) for g in ACCEPT], after, before)


def between(codes: list[str]) -> list[Label | None]:
    """Cost and audit from every grammar state to every other (row by row)."""
    after, before = lattice(codes)
    return [search([(0, g)], [(len(codes), h)], after, before) for g in STATES for h in STATES]


def _over(parts: list[list[Label | None]]):
    def after(node: Node) -> list[Edge]:
        k, g = node
        return [((k + 1, h), *parts[k][4 * g + h]) for h in STATES if parts[k][4 * g + h]] if k < len(parts) else []

    def before(node: Node) -> list[Edge]:
        k, h = node
        return [((k - 1, g), *parts[k - 1][4 * g + h]) for g in STATES if parts[k - 1][4 * g + h]] if k else []

    return after, before


def compose(parts: list[list[Label | None]]) -> Label:
    """Cost and audit of a conversation from its segments' tables."""
    while len(parts) > FAN:
        joined = []
        for k in range(0, len(parts), FAN):
            some = parts[k: k + FAN]
            joined.append([search([(0, g)], [(len(some), h)], *_over(some)) for g in STATES for h in STATES])
        parts = joined
    return search([(0, 0)], [(len(parts), g) for g in ACCEPT], *_over(parts))


_SOLVED = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PART_FIELDS = [("whole", pa.bool_()), ("has_turn", pa.bool_()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.string()),
                ("seq", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("least", pa.int64()), ("most", pa.int64()), ("turns", pa.int64()),
                ("first", pa.string()), ("last", pa.string()), ("solved", _SOLVED)]
_PART_DDL = ("whole boolean, has_turn boolean, turn long, role string, digest string, seq long, blank long, duplicate long, truncated long, "
             "illegal long, least long, most long, turns long, first string, last string, solved array<struct<cost: bigint, audit: string>>")


class _Segment:
    """Codes and counts of successive rows of one conversation."""

    def __init__(self, seq: int, key: tuple):
        self.seq, self.key = seq, key
        self.codes: list[str] = []
        self.count = dict.fromkeys(_COUNTS, 0)
        self.least = self.most = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        if fault:
            self.count[fault] += 1
        if self.codes and self.codes[-1][0] + initial not in LEGAL:
            self.count["illegal"] += 1
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most, self.turns = turn, self.turns + 1
        self.codes.append(initial + {"": ".", "truncated": "t"}.get(fault, "x"))

    def row(self, whole: bool) -> dict:
        solved = [solve(self.codes)] if whole else between(self.codes)
        return {"whole": whole, **dict(zip(("has_turn", "turn", "role", "digest"), self.key, strict=True)), "seq": self.seq, **self.count,
                "least": self.least, "most": self.most, "turns": self.turns, "first": self.codes[0][0], "last": self.codes[-1][0],
                "solved": [s and {"cost": s[0], "audit": s[1]} for s in solved]}


def _segments(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Stream the sorted rows of a partition; one row per segment.  Only a
    conversation strictly inside the partition is known to be whole."""
    now, conv, previous, seq, first = None, None, None, 0, True
    kind, rows = None, []

    def flush() -> pa.RecordBatch:
        names = ["conv", *[n for n, _ in _PART_FIELDS]]
        out = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), *[pa.array([r[1][n] for r in rows], t) for n, t in _PART_FIELDS]], names=names)
        rows.clear()
        return out

    for batch in batches:
        kind = batch.column(0).type
        columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        for c, has, turn, role, digest, blank, truncated, seen_has, seen_turn in zip(*columns, strict=True):
            if now is None or c != conv:
                if now is not None:
                    rows.append((conv, now.row(not first)))
                    first = False
                now, conv, previous = _Segment(seq, (has, turn, role, digest)), c, None
                seq += 1
            elif len(now.codes) >= size:
                rows.append((conv, now.row(False)))
                now, first = _Segment(seq, (has, turn, role, digest)), True
                seq += 1
            key = (has, turn, role, digest)
            again = key == previous or (seen_has is not None and (has, turn or 0) > (seen_has, seen_turn or 0))
            previous = key
            now.add(turn, role[:1] if role[:1] in ("s", "u", "a") else "o",
                    "blank" if blank else "duplicate" if again else "truncated" if truncated else "")
            if len(rows) >= 1024:
                yield flush()
    if now is not None:
        rows.append((conv, now.row(False)))
        yield flush()


def _put_together(group: pa.Table) -> pa.Table:
    """One conversation's segments as one row, the conversation's."""
    rows = sorted(group.to_pylist(), key=lambda r: (r["has_turn"], r["turn"] or 0, r["role"], r["digest"], r["seq"]))
    count = {c: sum(r[c] for r in rows) for c in _COUNTS}
    count["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(rows, rows[1:], strict=False))
    bounds = [(r["least"], r["most"]) for r in rows if r["least"] is not None]
    turns = sum(r["turns"] for r in rows) - sum(a[1] == b[0] for a, b in zip(bounds, bounds[1:], strict=False))
    cost, audit = compose([[s and (s["cost"], s["audit"]) for s in r["solved"]] for r in rows])
    one = {"gaps": bounds[-1][1] - bounds[0][0] + 1 - turns if bounds else 0, **count, "cost": cost, "audit": audit}
    return pa.table({"conv": group["conv"].slice(0, 1), **{k: pa.array([v], pa.string() if k == "audit" else pa.int64()) for k, v in one.items()}})


def _ordered(chats: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, has_turn, turn, role, digest (of the text) and text; nulls filled."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    return chats.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).isNotNull().alias("has_turn"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), F.md5(text.cast("binary")).alias("digest"), text.alias("text"))


def audit_conversations(chats: DataFrame, *, ids: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """One row per conversation: its id, gaps (turn numbers missing between the
    least and the most), counts of faulty rows by first fault, illegal (adjacent
    initials other than su, ua, au), cost and audit.  ``ids`` names further
    conversations (its ``conv_col``)."""
    ship_package(chats.sparkSession)
    rows = _ordered(chats, conv_col, turn_col, role_col, text_col)
    kept = F.rtrim("text", F.lit(SPACE))
    rows = written(rows.select("conv", "has_turn", "turn", "role", "digest", (kept == "").alias("blank"),
                               (~F.right(kept, F.lit(1)).isin(".", "!", "?")).alias("truncated")), "chat-rows")
    place = F.struct("has_turn", "turn")
    seen = (rows.groupBy("conv", "role", "digest").agg(F.min(place).alias("seen"), F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(F.col("conv").alias("conv2"), F.col("role").alias("role2"), F.col("digest").alias("digest2"),
                    F.col("seen.has_turn").alias("seen_has"), F.col("seen.turn").alias("seen_turn")))
    same = F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("role") == F.col("role2")) & (F.col("digest") == F.col("digest2"))
    marked = written(rows.join(seen, same, "left").drop("conv2", "role2", "digest2"), "chat-marks")
    order = ["conv", "has_turn", "turn", "role", "digest"]
    kind = rows.schema["conv"].dataType.simpleString()
    # A conversation's rows may lie in several ranges; equal keys never do.
    parts = written(marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        lambda b: _segments(b, segment), f"conv {kind}, {_PART_DDL}"), "chat-segments")
    counts = [F.col(c) for c in _COUNTS]
    whole = parts.where("whole").select(
        "conv", F.when(F.col("turns") == 0, F.lit(0)).otherwise(F.col("most") - F.col("least") + 1 - F.col("turns")).cast("long").alias("gaps"),
        *counts, F.col("solved")[0]["cost"].alias("cost"), F.col("solved")[0]["audit"].alias("audit"))
    pieces = parts.where("not whole").groupBy("conv").applyInArrow(
        _put_together, f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    out = whole.unionByName(pieces)
    if ids is not None:
        named = ids.select(F.col(conv_col).alias("named")).distinct()
        out = (named.join(out, F.col("named").eqNullSafe(F.col("conv")), "left")
               .select(F.col("named").alias("conv"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", *_COUNTS, "cost")],
                       F.coalesce("audit", F.lit("")).alias("audit")))
    return out.withColumnRenamed("conv", conv_col)


class _Repair:
    """Applies an audit to the rows of a conversation, one at a time."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2

    def _turn(self, role: str, text: str, edit: str) -> tuple[int, str, str, str]:
        self.at += 1
        self.place += 1
        return self.place - 1, edit, role, text

    def _role(self) -> str:
        return ("user", "assistant")[(self.place - self.odd) % 2]

    def inserts(self) -> Iterator[tuple[int, str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield self._turn(self._role(), "", "I")

    def row(self, role: str, text: str) -> Iterator[tuple[int, str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        if edit == "D":
            self.at += 1
        else:
            yield self._turn(role if edit == "K" else self._role(), text, edit)


def _stream(chats: DataFrame, report: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """A conversation's audit, then its rows in order, conversation by conversation."""
    rows = _ordered(chats, conv_col, turn_col, role_col, text_col).withColumn("kind", F.lit(1))
    heads = report.select(F.col(conv_col).alias("conv"), F.lit(None).cast("boolean").alias("has_turn"), F.lit(None).cast("long").alias("turn"),
                          F.lit("").alias("role"), F.lit("").alias("digest"), F.col("audit").alias("text"), F.lit(0).alias("kind"))
    both = heads.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "kind", "has_turn", "turn", "role", "digest")
    return both.select("conv", "kind", "role", "text")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, turn of the repaired one or None at its start)."""
    repair, conv = None, None
    for some in (batch.slice(at, 256) for batch in batches for at in range(0, batch.num_rows, 256)):
        for c, kind, role, text in zip(*[some.column(k).to_pylist() for k in range(4)], strict=True):
            if kind == 0:
                if repair:
                    yield from ((conv, x) for x in repair.inserts())
                repair, conv = _Repair(text), c
                yield conv, None
            else:
                yield from ((conv, x) for x in repair.row(role, text))
    if repair:
        yield from ((conv, x) for x in repair.inserts())


def repaired_turns(chats: DataFrame, report: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """The repaired conversations: id, place (from 0), edit (K, R or I), role
    and text.  ``report`` is ``audit_conversations`` of the same rows."""
    ship_package(chats.sparkSession)
    rows = _stream(chats, report, conv_col, turn_col, role_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, out, size = None, [], 0

        def kinds(it):
            nonlocal kind
            for b in it:
                kind = b.column(0).type
                yield b

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            types = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["conv", "place", "edit", "role", "text"])

        for conv, turn in _walk(kinds(batches)):
            if turn is not None:
                out.append((conv, *turn))
                size += len(turn[3]) + 64
                if size > 4 << 20:
                    yield flush()
                    out, size = [], 0
        if out:
            yield flush()

    kind = rows.schema["conv"].dataType.simpleString()
    return (rows.mapInArrow(run, f"conv {kind}, place long, edit string, role string, text string")
            .select(F.col("conv").alias(conv_col), "place", "edit", F.col("role").alias(role_col), F.col("text").alias(text_col)))


def digest(chats: DataFrame, report: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``report`` with repaired_sha256: the hash of the repaired conversation
    (``role:text`` lines), taken while its rows stream by; the hash is
    sequential, so a conversation passes one task, a row at a time."""
    ship_package(chats.sparkSession)
    report = written(report, "chat-report")
    rows = _stream(chats, report, conv_col, turn_col, role_col, text_col)
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        type_, out, state = None, [], None

        def kinds(it):
            nonlocal type_
            for b in it:
                type_ = b.column(0).type
                yield b

        def flush() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], type_), pa.array([h for _, h in out])], names=["conv", "sha"])
            out.clear()
            return got

        for conv, turn in _walk(kinds(batches)):
            if turn is None:
                if state:
                    out.append((state[0], state[1].hexdigest()))
                    if len(out) >= 4096:
                        yield flush()
                state = conv, hashlib.sha256()
            else:
                place, _, role, text = turn
                state[1].update((("\n" if place else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        if state:
            out.append((state[0], state[1].hexdigest()))
            yield flush()

    hashes = rows.mapInArrow(run, f"conv {kind}, sha string")
    return (report.join(hashes, F.col(conv_col).eqNullSafe(F.col("conv")), "left").drop("conv")
            .withColumnRenamed("sha", "repaired_sha256"))


def damage(chats: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Reproducible damage by crc32 of ``conv:turn`` modulo 20: 0 drops the row,
    1 empties its text, 2 removes ``.!?``, 3 repeats the row, 4 makes its role
    user.  Nulls count as one space."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(*[F.coalesce(F.col(c).cast("string"), space) if c else F.lit(":") for c in (conv_col, None, turn_col)]).cast("binary")) % 20
    rows = chats.select(F.col(conv_col), F.col(turn_col), F.coalesce(F.col(role_col).cast("string"), space).alias(role_col),
                        F.coalesce(F.col(text_col).cast("string"), space).alias(text_col), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text_col, ".!?", "")).otherwise(F.col(text_col))
    return rows.where("kind <> 0").select(
        conv_col, turn_col, F.when(F.col("kind") == 4, "user").otherwise(F.col(role_col)).alias(role_col), text.alias(text_col),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")
