"""Conversation structure repair: a square-root checkpointed DP.

Every row of a conversation is kept, reroled or deleted, and empty turns are
inserted, so that the roles read ``(s?(ua)+)?`` at the least cost. The DP runs
over four states (nothing yet, system, user, assistant). Going backward, the
vector of the states' remaining costs is stored at every square root of the
rows only; walking forward, the vectors of one block after the other are
computed again, and of the tight edits (those that keep the cost) the
ASCII-least is emitted.

A conversation may be larger than a task. Rows are sorted by range and cut
into pieces. A conversation that lies inside one piece is repaired where it
is read. Of others, each piece gives the min-plus matrix of its rows, the
matrices turn into the cost vector behind each piece (a pass from the last
piece to the first that holds one vector), each piece is walked from every
state it may be entered in, and a pass from the first piece to the last picks
the walk that fits. Only pieces of such conversations move a second time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, arrow_rows, written

DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
#: Added for a row that is cut off and stays.
CUT_COST = 3
#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. NEXT: the state that an added or reroled turn leads to.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
#: Where a kept row of this initial leads, by state.
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
NEVER = 1 << 60
#: Remaining cost at the end: a user turn needs an answer, a system turn both.
END = (0, 2 * COST[INSERT], COST[INSERT], 0)
LEGAL = frozenset({"su", "ua", "au"})
BLANK = " \t\n\x0b\x0c\r"
PIECE_ROWS = 1 << 14
PIECE_BYTES = 4 << 20
#: Characters of role and text that range bounds carry.
BOUND_CHARS = 32


class Step(NamedTuple):
    """Equal rows of one turn: at most one of them live, the rest must go."""

    initial: str
    cut: int
    live: bool
    dead: int


Vector = tuple[int, ...]


def back(step: Step, v: Vector) -> Vector:
    """Remaining costs before the step from those behind it."""
    v = tuple(min(NEVER, x + COST[DELETE] * step.dead) for x in v)
    if not step.live:
        return v
    kept = KEPT.get(step.initial, (None,) * 4)
    out = [min(v[s] + COST[DELETE], v[NEXT[s]] + COST[REROLE] + step.cut, NEVER if kept[s] is None else v[kept[s]] + step.cut) for s in range(4)]
    out[2], out[3] = min(out[2], COST[INSERT] + out[3]), min(out[3], COST[INSERT] + out[2])
    return min(out[0], COST[INSERT] + out[2], NEVER), min(out[1], COST[INSERT] + out[2], NEVER), min(out[2], NEVER), min(out[3], NEVER)


def matrix(steps: list[Step]) -> list[int]:
    """Min-plus matrix (row by row) from the costs behind the steps to those before."""
    columns = []
    for j in range(4):
        v: Vector = tuple(0 if s == j else NEVER for s in range(4))
        for step in reversed(steps):
            v = back(step, v)
        columns.append(v)
    return [columns[j][s] for s in range(4) for j in range(4)]


def apply(m: list[int], v: Vector) -> Vector:
    return tuple(min(min(m[4 * s + j] + v[j] for j in range(4)), NEVER) for s in range(4))


def _edit(step: Step, before: Vector, v: Vector, state: int) -> tuple[str, int]:
    """The ASCII-least tight edits up to and with the step, and the state behind them."""
    if not step.live:
        return DELETE * step.dead, state
    v = tuple(x + COST[DELETE] * step.dead for x in v)  # its dead copies follow
    done = ""
    while True:
        need, kept = before[state], KEPT.get(step.initial, (None,) * 4)[state]
        if v[state] + COST[DELETE] == need:
            done += DELETE
        elif before[NEXT[state]] + COST[INSERT] == need:
            state, done = NEXT[state], done + INSERT
            continue
        elif kept is not None and v[kept] + step.cut == need:
            state, done = kept, done + KEEP
        else:
            state, done = NEXT[state], done + REROLE
        return done + DELETE * step.dead, state


def walk(steps: list[Step], end: Vector, state: int = 0, last: bool = True) -> tuple[str, int, int]:
    """The cheapest edits of the steps from ``state``, of equals the ASCII-least,
    the state behind them, and the cost from here to the end. ``end``: costs
    behind the steps; at the end of the conversation (``last``) missing turns
    are added."""
    n, block = len(steps), max(1, isqrt(len(steps)))
    stored, v = {n: end}, end
    for i in range(n - 1, -1, -1):
        v = back(steps[i], v)
        if i % block == 0:
            stored[i] = v
    done, cost = [], stored[0][state]
    for start in range(0, n, block):
        stop = min(start + block, n)
        vectors = [stored[stop]]
        for i in range(stop - 1, start, -1):
            vectors.append(back(steps[i], vectors[-1]))
        vectors.append(stored[start])
        vectors.reverse()
        for i in range(start, stop):
            edit, state = _edit(steps[i], vectors[i - start], vectors[i - start + 1], state)
            done.append(edit)
    while last and END[state]:
        state = NEXT[state]
        done.append(INSERT)
    return "".join(done), state, cost


def repaired(rows: list[tuple[str, str]], audit: str, state: int = 0) -> list[tuple[str, str]]:
    """The turns that the edits leave of ``rows`` (role, text), entered in ``state``."""
    out, at = [], 0
    for c in audit:
        if c == INSERT:
            state = NEXT[state]
            out.append((ROLE[state], ""))
            continue
        role, text = rows[at]
        at += 1
        if c == KEEP:
            state = KEPT[role[0]][state]
            out.append((role, text))
        elif c == REROLE:
            state = NEXT[state]
            out.append((ROLE[state], text))
    return out


class Stats(NamedTuple):
    """Of a run of rows; what two runs share at their border is mended by ``merge``."""

    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    min_turn: int | None = None
    max_turn: int | None = None
    head: str = ""
    tail: str = ""


def merge(a: Stats, b: Stats) -> Stats:
    """Of the rows of ``a`` followed by those of ``b``."""
    if not a.rows or not b.rows:
        return a if a.rows else b
    shared = a.max_turn is not None and a.max_turn == b.min_turn
    return Stats(a.rows + b.rows, a.blank + b.blank, a.duplicate + b.duplicate, a.truncated + b.truncated,
                 a.illegal + b.illegal + (a.tail + b.head not in LEGAL), a.turns + b.turns - shared,
                 a.min_turn if a.min_turn is not None else b.min_turn, b.max_turn if b.max_turn is not None else a.max_turn, a.head, b.tail)


def examine(turn: int | None, role: str, text: str, n: int, first: bool) -> tuple[Step, Stats]:
    """``n`` equal rows; ``first``: nothing before them has their role and text."""
    said, initial = text.rstrip(BLANK), role[:1]
    alone = Stats(n, 0, 0, 0, n - 1, int(turn is not None), turn, turn, initial, initial)  # a role never follows itself
    if not said:
        return Step(initial, 0, False, n), alone._replace(blank=n)
    if not first:
        return Step(initial, 0, False, n), alone._replace(duplicate=n)
    cut = said[-1] not in ".!?"
    return Step(initial, CUT_COST * cut, True, n - 1), alone._replace(duplicate=n - 1, truncated=int(cut))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by crc32(``conv_id:turn``) % 20,
    nulls read as one space: 0 drops a row, 1 empties its text, 2 takes its
    sentence ends, 3 repeats it, 4 makes it a user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), kind.alias("kind"))
    return rows.where("kind <> 0").select("conv_id", "turn", "role", "text", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def _rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Equal rows as one with their number, and whether their role and text come first there."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    none = F.lit(None)
    full = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    full = full.withColumn("said", said)
    named = ids.select(F.col("conv_id").cast("long").alias("conv_id"), none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("string").alias("text"), F.lit("").alias("said"))
    keyed = [key("conv_id").alias("ck"), key("turn").alias("tk")]
    once = (full.unionByName(named).select(*keyed, "*").groupBy("ck", "tk", "said")
            .agg(*(F.first(c).alias(c) for c in ("conv_id", "turn", "role", "text")), F.count("*").alias("n")))
    place = F.struct(F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"), F.col("tk").alias("c"))
    first = (full.select(*keyed, "turn", "said").groupBy("ck", "said").agg(F.min(place).alias("p"))
             .select(F.col("ck").alias("fck"), F.col("said").alias("fsaid"), F.col("p.c").alias("ftk")))
    # met by turn as well: a text said a thousand times in one conversation is no hot key
    same = (F.col("ck") == F.col("fck")) & (F.col("tk") == F.col("ftk")) & (F.col("said") == F.col("fsaid"))
    return once.join(first, same, "left").select("ck", "conv_id", "turn", "role", "text", "n", F.col("fck").isNotNull().alias("first"))


_STATS = "struct<rows: bigint, blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, turns: bigint, min_turn: bigint, max_turn: bigint, head: string, tail: string>"
_STEPS = "array<struct<initial: string, cut: bigint, live: boolean, dead: bigint>>"
_ROWS = "array<struct<role: string, text: string>>"
PIECES = f"ck string, conv_id long, piece long, whole boolean, cost long, audit string, steps {_STEPS}, matrix array<bigint>, turns {_ROWS}, stats {_STATS}"


def _arrow(ddl: str, spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


class _Piece:
    """Rows of one conversation as they are read."""

    def __init__(self, ck: str, conv_id: int | None):
        self.ck, self.conv_id, self.size = ck, conv_id, 0
        self.steps: list[Step] = []
        self.rows: list[tuple[str, str]] = []
        self.stats = Stats()

    def add(self, turn: int | None, role: str | None, text: str | None, n: int, first: bool) -> None:
        if role is None:  # only names the conversation
            return
        step, stats = examine(turn, role, text or "", n, first)
        self.steps.append(step)
        # rows that must go are only counted
        self.rows.append((role, text or "") if step.live else ("", ""))
        self.stats = merge(self.stats, stats)
        self.size += len(role) + len(text or "") + 64

    def expanded(self) -> list[tuple[str, str]]:
        out = []
        for step, row in zip(self.steps, self.rows, strict=True):
            out += [row] * step.live + [("", "")] * step.dead
        return out

    def row(self, number: int, whole: bool) -> tuple:
        if not whole:
            return (self.ck, self.conv_id, number, False, None, None, [x._asdict() for x in self.steps], matrix(self.steps), [{"role": r, "text": t} for r, t in self.rows], self.stats._asdict())
        audit, _, cost = walk(self.steps, END)
        return (self.ck, self.conv_id, number, True, cost, audit, [], [], [{"role": r, "text": t} for r, t in repaired(self.expanded(), audit)], self.stats._asdict())


def _pack(ordered: DataFrame, piece_rows: int, piece_bytes: int) -> DataFrame:
    """Pieces of the rows in their order. The first and the last conversation
    of a partition, and any beyond a piece, may go on elsewhere: not ``whole``."""
    schema = _arrow(PIECES, ordered.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            number = TaskContext.get().partitionId() << 32
            piece, starts = None, True
            closed = False  # whether the conversation began in this partition and in this piece
            for ck, conv_id, turn, role, text, n, first in arrow_rows(batches):
                if piece is None or ck != piece.ck:
                    if piece is not None:
                        yield piece.row(number, closed)
                        number += 1
                    closed, starts = not starts, False
                    piece = _Piece(ck, conv_id)
                elif len(piece.steps) >= piece_rows or piece.size >= piece_bytes:
                    yield piece.row(number, False)
                    number += 1
                    closed, piece = False, _Piece(ck, conv_id)
                piece.add(turn, role, text, n, first)
            if piece is not None:
                yield piece.row(number, False)
        return arrow_out(schema, rows(), size=512, weight=lambda r: sum(len(t["text"]) for t in r[8]) + 64 * len(r[6]))

    return ordered.mapInArrow(run, PIECES)


def _behind(open_pieces: DataFrame) -> DataFrame:
    """(bck, bpiece, end, last, before): costs behind and before each piece, from its conversation's last to its first."""
    ddl = "bck string, bpiece long, end array<bigint>, last boolean, before array<bigint>"
    schema = _arrow(ddl, open_pieces.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            now, v = None, END
            for ck, piece, m in arrow_rows(batches):
                last = ck != now
                now, end = ck, END if last else v
                v = apply(m, end)
                yield ck, piece, list(end), last, list(v)
        return arrow_out(schema, rows())

    return open_pieces.select("ck", "piece", "matrix").repartition("ck").sortWithinPartitions("ck", F.desc("piece")).mapInArrow(run, ddl)


def _walks(open_pieces: DataFrame, behind: DataFrame) -> DataFrame:
    """Each open piece's edits from every state (``audits``), and the states they lead to."""
    ddl = "ck string, piece long, before array<bigint>, audits array<string>, ends array<bigint>"
    schema = _arrow(ddl, open_pieces.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for ck, piece, steps, end, last, before in arrow_rows(batches):
                own = [Step(**s) for s in steps]
                done = [walk(own, tuple(end), s, last) if before[s] < NEVER else ("", s, 0) for s in range(4)]
                yield ck, piece, before, [d[0] for d in done], [d[1] for d in done]
        return arrow_out(schema, rows(), size=64)

    both = open_pieces.select("ck", "piece", "steps").join(behind, (F.col("ck") == F.col("bck")) & (F.col("piece") == F.col("bpiece")))
    return both.select("ck", "piece", "steps", "end", "last", "before").mapInArrow(run, ddl)


def _chosen(walks: DataFrame) -> DataFrame:
    """(cck, cpiece, state, cost, audit): the walk that fits what came before; cost: the conversation's, at its first piece."""
    ddl = "cck string, cpiece long, state int, whole_cost long, edits string"
    schema = _arrow(ddl, walks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            now, state = None, 0
            for ck, piece, before, audits, ends in arrow_rows(batches):
                opens = ck != now
                now, state = ck, 0 if opens else state
                yield ck, piece, state, before[0] if opens else None, audits[state]
                state = ends[state]
        return arrow_out(schema, rows(), size=64)

    return walks.repartition("ck").sortWithinPartitions("ck", "piece").mapInArrow(run, ddl)


def _mended(open_pieces: DataFrame, chosen: DataFrame) -> DataFrame:
    ddl = f"ck string, conv_id long, piece long, whole boolean, cost long, audit string, turns {_ROWS}, stats {_STATS}"
    schema = _arrow(ddl, open_pieces.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for ck, conv_id, piece, steps, turns, stats, state, cost, edits in arrow_rows(batches):
                p = _Piece(ck, conv_id)
                p.steps, p.rows = [Step(**s) for s in steps], [(t["role"], t["text"]) for t in turns]
                yield ck, conv_id, piece, False, cost, edits, [{"role": r, "text": t} for r, t in repaired(p.expanded(), edits, state)], stats
        return arrow_out(schema, rows(), size=64, weight=lambda r: sum(len(t["text"]) for t in r[6]))

    both = open_pieces.join(chosen, (F.col("ck") == F.col("cck")) & (F.col("piece") == F.col("cpiece")))
    return both.select("ck", "conv_id", "piece", "steps", "turns", "stats", "state", "whole_cost", "edits").mapInArrow(run, ddl)


def repair(conversations: DataFrame, ids: DataFrame | None = None, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Repaired conversations in pieces: ck, conv_id, piece, whole, cost,
    audit, turns (role, text) and stats. A conversation is one ``whole`` piece,
    or several in the order of ``piece``, with its cost at the first.

    Reads conv_id, turn, role and text; other columns, also ones with the
    names used here, are ignored. A null role or text is one space. Rows go by
    turn, null turns first, then by role and text; rows equal in all of them
    follow each other. A null conv_id is a conversation of its own. A role
    whose initial is not s, u or a (an empty one too) cannot be kept. ``ids``
    (conv_id) names conversations that may have no rows. An empty table gives
    no rows. A conversation of any length is repaired in pieces; a text of any
    length is one row of one piece.
    """
    rows = written(_rows(conversations, conversations.select("conv_id") if ids is None else ids), "rows")
    start = F.when(F.length("role") <= BOUND_CHARS, F.substring("text", 1, BOUND_CHARS))  # the start of a longer role decides alone
    bound = ["ck", F.col("turn").asc_nulls_first(), F.substring("role", 1, BOUND_CHARS).asc_nulls_first(), start.asc_nulls_first()]
    ordered = (rows.repartitionByRange(*bound)
               .sortWithinPartitions("ck", F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()))
    packed = written(_pack(ordered.select("ck", "conv_id", "turn", "role", "text", "n", "first"), piece_rows, piece_bytes), "pieces")
    unfinished = packed.where("not whole")
    behind = written(_behind(unfinished), "behind")
    chosen = written(_chosen(_walks(unfinished, behind)), "chosen")
    out = ["ck", "conv_id", "piece", "whole", "cost", "audit", "turns", "stats"]
    return packed.where("whole").select(out).unionByName(written(_mended(unfinished, chosen), "mended"))


def turns(pieces: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, piece, position there, role, text."""
    return pieces.select("conv_id", "piece", F.posexplode("turns").alias("position", "t")).select("conv_id", "piece", "position", "t.role", "t.text")


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def report(pieces: DataFrame) -> DataFrame:
    """REPORT, one row per conversation. The digest of a conversation in
    several pieces is taken in one pass over its turns, in order, a row at a
    time: a SHA-256 has no other way."""
    gaps = F.coalesce(F.col("stats.max_turn") - F.col("stats.min_turn") + 1 - F.col("stats.turns"), F.lit(0))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = pieces.where("whole").select("conv_id", gaps.alias("gaps"), *(F.col(f"stats.{c}").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")),
                                         "cost", "audit", F.sha2(spoken, 256).alias("repaired_sha256"))
    ddl = "conv_id long, ck string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    merged, digest_ddl = _arrow(ddl, pieces.sparkSession), "dck string, repaired_sha256 string"
    digest_schema = _arrow(digest_ddl, pieces.sparkSession)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            key, held = None, None
            for ck, conv_id, cost, audit, stats in arrow_rows(batches):
                s = Stats(**stats)
                if held is None or ck != key:
                    if held is not None:
                        yield _folded(*held)
                    key, held = ck, (conv_id, ck, cost, [audit], s)
                else:
                    held[3].append(audit)
                    held = (*held[:4], merge(held[4], s))
            if held is not None:
                yield _folded(*held)
        return arrow_out(merged, rows(), size=512, weight=lambda r: len(r[8]))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            key, sha = None, None
            for ck, role, text in arrow_rows(batches):
                if ck != key:
                    if sha is not None:
                        yield key, sha.hexdigest()
                    key, sha = ck, hashlib.sha256()
                elif role is not None:
                    sha.update(b"\n")
                if role is not None:
                    sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if sha is not None:
                yield key, sha.hexdigest()
        return arrow_out(digest_schema, rows())

    parts = pieces.where("not whole")
    folded = (parts.select("ck", "piece", "conv_id", "cost", "audit", "stats").repartition("ck").sortWithinPartitions("ck", "piece")
              .select("ck", "conv_id", "cost", "audit", "stats").mapInArrow(fold, ddl))
    spoken_rows = parts.select("ck", "piece", F.posexplode("turns").alias("position", "t")).select("ck", "piece", "position", "t.role", "t.text")
    digests = spoken_rows.repartition("ck").sortWithinPartitions("ck", "piece", "position").select("ck", "role", "text").mapInArrow(digest, digest_ddl)
    empty = F.sha2(F.lit(""), 256)
    joined = folded.join(digests, F.col("ck") == F.col("dck"), "left").withColumn("repaired_sha256", F.coalesce("repaired_sha256", empty))
    return whole.unionByName(joined.select(whole.columns))


def _folded(conv_id: int | None, ck: str, cost: int, audits: list[str], s: Stats) -> tuple:
    gaps = 0 if s.max_turn is None else s.max_turn - s.min_turn + 1 - s.turns
    return conv_id, ck, gaps, s.blank, s.duplicate, s.truncated, s.illegal, cost, "".join(audits)
