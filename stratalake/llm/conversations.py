"""Repair of the structure of conversations by iterative-deepening A*.

A conversation is its rows by turn, nulls first; rows of equal turn by role and text. A null role or text
is one space. Each row's first fault counts: blank (no character but white space), duplicate (role and text
seen in an earlier row), truncated (the last such character is none of ``.!?``).

Edits, in ASCII order of their initials: Delete costs 4, Insert of an empty text by the user or the
assistant 3, Keep 0, Rerole to user or assistant 3; blank and duplicate rows have to be deleted, and a
truncated row that stays adds 3. The initials of the roles of the repaired conversation are ``(s?(ua)+)?``:
nothing, or user and assistant in turns after a system row at most. That leaves one role for each Insert and
Rerole, so the initials of the edits say all. The cheapest edits win, of these the ASCII-least.

The search goes depth first through (row, state), edits in ASCII order, under a bound on the cost, which
rises to the least cost that exceeded it until a path is accepted: the first one is the answer. What can't be
avoided is estimated by deletes and additions that faults force, and by a best matching of neighbouring rows
whose roles can't follow one another. A table of transpositions holds what is proven of states that failed:
the least they would have cost.

Rows are sorted by conversation and turn over all tasks, so a conversation with a third of all rows is
the work of many. A task searches its rows of a conversation in pieces of ``PIECE`` rows or ``PIECE_CHARS``
characters at most; inserts stand before a row of a piece, or at the end of the conversation. A piece that
may not be a whole conversation is searched from each state to each state. No answer of a piece is the beginning of another, so
that the cheapest and ASCII-least whole is chained from those. The digest of such a conversation is taken
from a stream of its rows; no conversation is held as a whole.

Nulls, empty and long texts have no other rules. A null conv_id is a conversation; null turns count for no gap. Repeated rows are rows; their
copies are duplicates. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.shared import lean, size_bounded, written

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
PIECE, PIECE_CHARS = 4096, 1 << 24
#: More conversations than this are joined by shuffle.
BROADCAST_ROWS = 300_000
BLANK, DUPLICATE, CUT = 1, 2, 3
#: What was last: nothing, a system row, a user's, or an assistant's.
START, SYSTEM, USER, PAIR = range(4)
STATES = (START, SYSTEM, USER, PAIR)
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": PAIR}, {"u": USER})
_NEXT = (USER, USER, PAIR, USER)
_ROLE = {USER: "user", PAIR: "assistant"}
_LEGAL = {"su", "ua", "au"}
_MOST = (1 << 63) - 1

Node = tuple[int, int]


def cheapest(
    start: Node,
    moves: Callable[[Node], list[tuple[str, int, Node]]],
    estimate: Callable[[Node], int],
    accepts: Callable[[Node], bool],
) -> tuple[int, str]:
    """The cost and the edits of the first accepting path under the least bound that has one.

    ``moves`` gives (edit, cost, node) in ASCII order; ``estimate`` is never more than what is to come.
    """
    proven: dict[Node, int] = {}
    bound = estimate(start)
    while True:
        edits: list[str] = []
        frames = [[start, bound, iter(moves(start)), _MOST, 0]]  # the last: what the edit to it cost
        if accepts(start):
            return 0, ""
        while frames:
            frame = frames[-1]
            node, budget, rest = frame[:3]
            for edit, cost, after in rest:
                to_come = proven.get(after)
                if to_come is None:
                    to_come = estimate(after)
                if cost + to_come > budget:
                    if cost + to_come < frame[3]:
                        frame[3] = cost + to_come
                    continue
                edits.append(edit)
                if accepts(after):
                    return bound - budget + cost, "".join(edits)
                frames.append([after, budget - cost, iter(moves(after)), _MOST, cost])
                break
            else:
                proven[node] = frame[3]
                frames.pop()
                if frames:
                    edits.pop()
                    frames[-1][3] = min(frames[-1][3], frame[4] + frame[3])
        bound = proven[start]


def _estimates(initials: list[str], faults: list[int]) -> list[int]:
    """For each row, what the edits from there on cost at least."""
    made = [0] * (len(initials) + 1)
    forced = 0
    # best matchings from the next row that may stay on, and from the one after it
    best = after = 0
    following = None
    for i in range(len(initials) - 1, -1, -1):
        if faults[i] in (BLANK, DUPLICATE):
            forced += DELETE
        else:
            cut = faults[i] == CUT
            forced += TRUNCATED if cut else 0
            pair = 0
            if following is not None and initials[i] + initials[following] not in _LEGAL:
                pair = DELETE - TRUNCATED if cut or faults[following] == CUT else min(INSERT, REROLE, DELETE)
            best, after = max(best, pair + after), best
            following = i
        made[i] = forced + best
    return made


def search(initials: list[str], faults: list[int], start: int, targets: tuple[int, ...], last: bool) -> tuple[int, str] | None:
    """Cost and edits that lead from a state to one of the targets, with inserts behind the last row if it is the end."""
    n = len(initials)
    estimates = _estimates(initials, faults)
    if not _reachable(initials, faults, start, targets, last):
        return None

    def moves(node: Node) -> list[tuple[str, int, Node]]:
        i, state = node
        following = _NEXT[state]
        if i == n:
            return [("I", INSERT, (n, following))] if last else []
        fault = faults[i]
        made = [("D", DELETE, (i + 1, state)), ("I", INSERT, (i, following))]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED if fault == CUT else 0
            kept = _KEPT[state].get(initials[i])
            if kept is not None:
                made.append(("K", more, (i + 1, kept)))
            made.append(("R", REROLE + more, (i + 1, following)))
        return made

    return cheapest((0, start), moves, lambda node: estimates[node[0]], lambda node: node[0] == n and node[1] in targets)


def _reachable(initials: list[str], faults: list[int], start: int, targets: tuple[int, ...], last: bool) -> bool:
    if start in targets or (last and PAIR in targets):
        return True
    if not initials:
        return False
    if USER in targets or PAIR in targets:
        return True
    # only a system row that stays leads to it
    return start == START and SYSTEM in targets and any(c == "s" and f in (0, CUT) for c, f in zip(initials, faults, strict=True))


class Repaired:
    """The digest of a repaired conversation, row by row."""

    def __init__(self) -> None:
        self.state, self.digest, self.empty = START, hashlib.sha256(), True

    def _add(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.empty else chr(10)}{role}:".encode())
        self.digest.update(text.encode())
        self.empty = False

    def insert(self) -> None:
        self.state = _NEXT[self.state]
        self._add(_ROLE[self.state], "")

    def row(self, edit: str, role: str, text: str) -> None:
        if edit == "K":
            self.state = _KEPT[self.state][role[:1]]
            self._add(role, text)
        elif edit == "R":
            self.state = _NEXT[self.state]
            self._add(_ROLE[self.state], text)

    def rows(self, edits: str, rows: Iterator[tuple[str, str]]) -> str:
        """Apply all edits, and give the digest."""
        for edit in edits:
            if edit == "I":
                self.insert()
            else:
                self.row(edit, *next(rows))
        return self.digest.hexdigest()


@dataclass
class Piece:
    """Rows of one conversation that follow one another in a task."""

    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    faults: list[int] = field(default_factory=list)
    turns: list[int | None] = field(default_factory=list)
    chars: int = 0

    def add(self, role: str, text: str, fault: int, turn: int | None) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)
        self.turns.append(turn)
        self.chars += len(text)

    @property
    def full(self) -> bool:
        return len(self.roles) >= PIECE or self.chars >= PIECE_CHARS

    def summary(self, part: bool) -> dict:
        """Its counts, its answer if it is a whole conversation, and those from state to state if it may be part of one."""
        initials = [role[:1] for role in self.roles]
        turns = [t for t in self.turns if t is not None]
        cost, audit = search(initials, self.faults, START, (START, PAIR), True)
        paths = []
        if part:
            for start in STATES:
                for target in STATES:
                    found = search(initials, self.faults, start, (target,), False)
                    if found is not None:
                        paths.append({"start": start, "target": target, "cost": found[0], "audit": found[1]})
        return {
            "turns": len(set(turns)),
            "least": min(turns, default=None),
            "most": max(turns, default=None),
            "first": initials[0],
            "last": initials[-1],
            **{name: self.faults.count(fault) for name, fault in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT))},
            "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": Repaired().rows(audit, zip(self.roles, self.texts, strict=True)),
            "paths": paths,
        }


_PATHS = "array<struct<start: int, target: int, cost: long, audit: string>>"
_COUNTS = "blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_PIECES = f"conv_id long, part int, piece long, turns long, least long, most long, first string, last string, {_COUNTS}, paths {_PATHS}"
_PIECE_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int32()),
        ("piece", pa.int64()),
        *[(name, pa.int64()) for name in ("turns", "least", "most")],
        *[(name, pa.string()) for name in ("first", "last")],
        *[(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal", "cost")],
        *[(name, pa.string()) for name in ("audit", "repaired_sha256")],
        (
            "paths",
            pa.list_(pa.struct([("start", pa.int32()), ("target", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])),
        ),
    ]
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of a task's rows, which are sorted. Its first and last conversation may be parts of longer ones."""
    part = TaskContext.get().partitionId()
    piece, conv_id, number, first = Piece(), None, 0, True
    made: list[dict] = []

    def close(is_part: bool) -> None:
        nonlocal piece, number
        made.append({"conv_id": conv_id, "part": part, "piece": number, **piece.summary(is_part)})
        piece, number = Piece(), number + 1

    cut = False  # whether the conversation has earlier pieces here
    for batch in batches:
        for own, turn, role, text, fault in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if piece.roles and (own != conv_id or piece.full):
                same = own == conv_id
                close(first or cut or same)
                cut, first = same, first and same
            conv_id = own
            piece.add(role, text, fault, turn)
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=_PIECE_SCHEMA)
            made.clear()
    if piece.roles:
        close(True)
        yield pa.RecordBatch.from_pylist(made, schema=_PIECE_SCHEMA)


def _chained(pieces: list[dict]) -> dict:
    """The answer of a conversation by its pieces in order."""
    best: dict[int, tuple[int, list[str]]] = {START: (0, [])}
    for piece in pieces:
        found: dict[int, tuple[int, list[str]]] = {}
        for path in piece["paths"]:
            if path["start"] in best:
                cost, audits = best[path["start"]]
                offer = (cost + path["cost"], [*audits, path["audit"]])
                target = path["target"]
                found[target] = min(found.get(target, offer), offer)
        best = found
    ends = []
    for state, (cost, audits) in best.items():
        more, tail = search([], [], state, (START, PAIR), True)
        ends.append((cost + more, [*audits, tail]))
    cost, audits = min(ends)
    turns, before, illegal = 0, None, 0
    for i, piece in enumerate(pieces):
        turns += piece["turns"] - (piece["least"] is not None and piece["least"] == before)
        before = piece["most"] if piece["most"] is not None else before
        illegal += piece["illegal"] + (i > 0 and pieces[i - 1]["last"] + piece["first"] not in _LEGAL)
    return {
        "conv_id": pieces[0]["conv_id"],
        "turns": turns,
        "least": min((p["least"] for p in pieces if p["least"] is not None), default=None),
        "most": before,
        **{name: sum(p[name] for p in pieces) for name in ("blank", "duplicate", "truncated")},
        "illegal": illegal,
        "cost": cost,
        "audit": "".join(audits),
    }


_CHAINED = "conv_id long, turns long, least long, most long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _chain(table: pa.Table) -> pa.Table:
    pieces = sorted(table.to_pylist(), key=lambda p: (p["part"], p["piece"]))
    names = [f.split()[0] for f in _CHAINED.split(", ")]
    kinds = [pa.string() if name == "audit" else pa.int64() for name in names]
    return pa.Table.from_pylist([_chained(pieces)], schema=pa.schema(list(zip(names, kinds, strict=True))))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, repaired_sha256) of conversations that come as their edits and then their rows."""
    conv_id, repaired, audit, at = None, None, "", 0

    def close() -> pa.RecordBatch:
        for _ in range(audit.count("I", at)):
            repaired.insert()
        columns = [pa.array([conv_id], pa.int64()), pa.array([repaired.digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "repaired_sha256"])

    for batch in batches:
        for own, role, text, edits in zip(*(batch.column(name) for name in ("conv_id", "role", "text", "audit")), strict=True):
            if edits.is_valid:
                if repaired is not None:
                    yield close()
                conv_id, repaired, audit, at = own.as_py(), Repaired(), edits.as_py(), 0
                continue
            while audit[at] == "I":
                repaired.insert()
                at += 1
            repaired.row(audit[at], role.as_py(), text.as_py())
            at += 1
    if repaired is not None:
        yield close()


def _filled(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with one space for a null role or text."""
    return rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    )


def _with_faults(rows: DataFrame) -> DataFrame:
    earlier = F.row_number().over(Window.partitionBy("conv_id", "role", F.sha2(F.col("text").cast("binary"), 256)).orderBy("turn"))
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(BLANK))
        .when(earlier > 1, F.lit(DUPLICATE))
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), F.lit(CUT))
        .otherwise(F.lit(0))
    )
    return rows.withColumn("fault", fault)


def _ascending(*more: str) -> list[Column]:
    return [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", *more)]


def repair(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text), or per different conv_id of ``ids`` if they are given.

    Columns gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.
    """
    filled = _filled(rows)
    ids = (rows if ids is None else ids).select(F.col("conv_id").cast("long")).distinct()
    # a row's place needs its whole text only among rows with the same beginning
    faulty = _with_faults(filled).withColumn("begin", F.substring("text", 1, 32))
    ordered = faulty.repartitionByRange(*_ascending("begin")).sortWithinPartitions(*_ascending("text"))
    pieces = written(ordered.select("conv_id", "turn", "role", "text", "fault").mapInArrow(lean(_pieces), _PIECES))
    edge = pieces.where("size(paths) > 0")
    several = written(edge.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select("conv_id", F.lit(True).alias("several")))
    several = size_bounded(several, BROADCAST_ROWS).withColumnRenamed("conv_id", "own_id")
    own = F.col("conv_id").eqNullSafe(F.col("own_id"))
    whole = pieces.join(several, own, "left_anti")
    chained = written(edge.join(several, own, "left_semi").groupBy("conv_id").applyInArrow(_chain, _CHAINED))
    # edits first, then the rows they are for
    head = chained.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "audit", F.lit(0).alias("kind"))
    body = filled.join(several, own, "left_semi").withColumn("audit", F.lit(None).cast("string")).withColumn("kind", F.lit(1))
    stream = head.union(body).repartition("conv_id")
    stream = stream.sortWithinPartitions(F.asc_nulls_first("conv_id"), "kind", *_ascending("text")[1:])
    digests = stream.mapInArrow(lean(_digests), "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "digest_id")
    chained = chained.join(digests, F.col("conv_id").eqNullSafe(F.col("digest_id"))).drop("digest_id")
    columns = ["conv_id", "turns", "least", "most", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = whole.select(columns).union(chained.select(columns)).withColumnRenamed("conv_id", "found_id")
    made = ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    span = F.col("most").cast("decimal(20,0)") - F.col("least") + 1 - F.col("turns")
    zero = F.lit(0).cast("long")
    return made.select(
        "conv_id",
        F.coalesce(F.when(span <= _MOST, span).otherwise(F.when(span > _MOST, _MOST)).cast("long"), zero).alias("gaps"),
        *[F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def damage(rows: DataFrame) -> DataFrame:
    """Rows with known faults, by crc32 of ``conv_id:turn`` modulo 20: dropped, emptied, cut, repeated, or made the user's."""
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv_id, F.lit(":"), turn)
    kind = F.crc32(key.cast("binary")) % 20
    marked = _filled(rows).withColumn("kind", kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")
