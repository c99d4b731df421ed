"""Conversation structure repair: the cheapest edits that turn a conversation into s?(ua)+, in one sorted stream.

Rows are dealt by conversation and sorted by turn; the faults that need a second look (an earlier equal row) come from a
window over the same partitioning. ``mapInPandas`` then walks the sorted rows. What it carries over Arrow batches is the
dynamic program's front: for each of four grammar states the cost of the best edits so far and the order of their texts.
Differences of costs are bounded, so there are few fronts, and one step is a lookup in a memo.

Choices are known when a conversation ends. Its rows wait in a block until then. A block that grows beyond its row or
byte limit is spilled: its rows leave with compact backpointers, the edits each row has for each of the four states in
which the block may end, and only the block's map from end state to start state stays in memory. At the end of the
conversation the maps are walked backwards, one end state a block is given out, and a join by (conversation, block)
settles the spilled rows. So no task holds more than one block of texts, however long a conversation is.

Ties between cheapest edits go to the ASCII-least edit string. Two edit strings over the same rows that end in different
states differ before either of them ends, so the order of prefixes decides the order of whole strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import Work

# Prices of the edits; a truncated row that stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# A state that costs this much more than another one never leads to the cheapest edits: any state can go on as another
# one would for at most ten more (two inserts).
FAR = 20
BLOCK_ROWS, BLOCK_BYTES = 20_000, 8 << 20
OUT_ROWS, OUT_BYTES = 10_000, 8 << 20
START, SYSTEM, USER, ASSISTANT = range(4)
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
# The role that may be put in or given next, by state: inserted as U or A, given as u or a.
_NEXT = (USER, USER, ASSISTANT, USER)
_CODE = {USER: "U", ASSISTANT: "A"}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_SHOWN = str.maketrans("UAua", "IIRR")
_SPACE = " \t\n\x0b\x0c\r"  # \x20 and \x09-\x0D
FRESH = ((0, 0), None, None, None)


@lru_cache(maxsize=None)
def advance(front: tuple, initial: str, forced: bool, cut: bool) -> tuple[tuple, int, tuple]:
    """(next front, cost taken off all its states, how each state was reached) after one row.

    A front has (cost, rank of its edit string) or None for each state. A state was reached by (state before, code).
    """
    best: list = [None] * 4
    for before, held in enumerate(front):
        if held is None:
            continue
        at, code = before, ""
        for _ in range(3):
            edits = [(DELETE, at, "D")]
            if not forced:
                extra = TRUNCATED if cut else 0
                edits.append((REROLE + extra, _NEXT[at], _CODE[_NEXT[at]].lower()))
                if (at, initial) in _KEPT:
                    edits.append((extra, _KEPT[at, initial], "K"))
            for price, to, edit in edits:
                made = code + edit
                found = (held[0] + len(code) * INSERT + price, held[1], made.translate(_SHOWN), before, made)
                if best[to] is None or found < best[to]:
                    best[to] = found
            code += _CODE[_NEXT[at]]
            at = _NEXT[at]
    least = min(b[0] for b in best if b)
    order = sorted((b[1], b[2], to) for to, b in enumerate(best) if b)
    rank = {to: i for i, (_, _, to) in enumerate(order)}
    after = tuple((b[0] - least, rank[to]) if b and b[0] - least < FAR else None for to, b in enumerate(best))
    return after, least, tuple((b[3], b[4]) if b else None for b in best)


def finish(front: tuple) -> tuple[int, int, str]:
    """(cost, last state, code of the rows put in after the last one) of the best whole edit."""
    ends = {START: "", SYSTEM: "UA", USER: "A", ASSISTANT: ""}
    cost, _, state = min((held[0] + INSERT * len(ends[s]), held[1], s) for s, held in enumerate(front) if held)
    return cost, state, ends[state]


def trace(moves: list, end: int) -> tuple[int, list[str]]:
    """The state before a block and the code of each of its rows, if the block ends in ``end``."""
    codes = [""] * len(moves)
    for i in range(len(moves) - 1, -1, -1):
        end, codes[i] = moves[i][end]
    return end, codes


# What the stream gives: rows (settled or with choices), the rows put in at the end, end states of spilled blocks, and
# one row of totals per conversation.
ROW, TAIL, BLOCK, TALK = "row", "tail", "block", "talk"
_OUT = ("known boolean, conv string, kind string, place long, block long, has_turn boolean, turn long, role string, "
        "text string, fault string, codes string, state int, totals array<long>")
_OUT_NAMES = [part.split()[0] for part in _OUT.split(", ")]
TOTALS = ["rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class _Sink:
    """Rows that leave the stream, handed over in bounded frames."""

    def __init__(self):
        self.rows, self.bytes = [], 0

    def put(self, known, conv, kind, place=None, block=None, has_turn=None, turn=0, role=None, text=None, fault=None,
            codes=None, state=-1, totals=None) -> None:
        self.rows.append((known, conv, kind, place or 0, block or 0, has_turn, turn, role, text, fault, codes, state, totals))
        self.bytes += len(text or "") + 64

    def full(self) -> bool:
        return len(self.rows) >= OUT_ROWS or self.bytes >= OUT_BYTES

    def take(self) -> pd.DataFrame:
        frame = pd.DataFrame.from_records(self.rows, columns=_OUT_NAMES)
        self.rows, self.bytes = [], 0
        return frame


class _Talk:
    """The conversation that the stream is in."""

    def __init__(self, known: bool, conv: str, limits: tuple[int, int], sink: _Sink):
        self.key, self.limits, self.sink = (known, conv), limits, sink
        self.front, self.cost, self.rows, self.held, self.held_bytes, self.moves = FRESH, 0, 0, [], 0, []
        self.maps: list[tuple] = []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.turns, self.first, self.last, self.before = 0, 0, None, None, None

    def add(self, has_turn, turn, role, text, fault) -> None:
        if len(self.moves) >= self.limits[0] or self.held_bytes >= self.limits[1]:
            self.spill()
        initial = role[:1]
        if self.before is not None and (self.before, initial) not in _LEGAL:
            self.illegal += 1
        self.before = initial
        if fault:
            self.faults[fault] += 1
        if has_turn and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        self.front, off, moves = advance(
            self.front, initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated")
        self.cost += off
        self.moves.append(moves)
        self.held.append((self.rows, has_turn, turn, role, text, fault))
        self.held_bytes += len(text)
        self.rows += 1

    def spill(self) -> None:
        """Give the block's rows away with their edits for each end state, and keep its map of states."""
        traced = [trace(self.moves, s) if self.front[s] else (None, [""] * len(self.moves)) for s in range(4)]
        for i, (place, has_turn, turn, role, text, fault) in enumerate(self.held):
            self.sink.put(*self.key, ROW, place, len(self.maps), has_turn, turn, role, text, fault,
                          ",".join(codes[i] for _, codes in traced))
        self.maps.append(tuple(start for start, _ in traced))
        self.held, self.held_bytes, self.moves = [], 0, []

    def close(self) -> None:
        left, end, tail = finish(self.front)
        state, codes = trace(self.moves, end)
        for (place, has_turn, turn, role, text, fault), code in zip(self.held, codes):
            self.sink.put(*self.key, ROW, place, None, has_turn, turn, role, text, fault, code, 0)
        if tail:
            self.sink.put(*self.key, TAIL, self.rows, codes=tail, state=0)
        for block in range(len(self.maps) - 1, -1, -1):
            self.sink.put(*self.key, BLOCK, block=block, state=state)
            state = self.maps[block][state]
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, 2 ** 63 - 1)
        self.sink.put(*self.key, TALK, totals=[self.rows, gaps, *self.faults.values(), self.illegal, self.cost + left])


def _stream(limits: tuple[int, int]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sink, talk = _Sink(), None
        for frame in frames:
            for known, conv, present, *row in zip(*(frame[c].tolist() for c in _IN_NAMES)):
                if talk is None or talk.key != (known, conv):
                    if talk:
                        talk.close()
                    talk = _Talk(known, conv, limits, sink)
                if present:
                    talk.add(*row)
                if sink.full():
                    yield sink.take()
        if talk:
            talk.close()
        yield sink.take()

    return run


_IN_NAMES = ["known", "conv", "present", "has_turn", "turn", "role", "text", "fault"]


def _faults(rows: DataFrame) -> DataFrame:
    """The first fault of each row: blank, duplicate, truncated, or an empty text."""
    trimmed = F.rtrim(F.col("text"), F.lit(_SPACE))
    same = Window.partitionBy("known", "conv", "present", "role", F.sha2("text", 256)).orderBy("has_turn", "turn")
    return rows.withColumn("again", F.row_number().over(same) > 1).withColumn("fault", (
        F.when(trimmed == "", "blank").when(F.col("again"), "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")))


def repair(rows: DataFrame, work: Work, conv: Column, turn: Column, role: Column, text: Column, present: Column | None = None,
           block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lines, talks): every edit of every conversation with its row, and one row of totals per conversation.

    Lines: conv_id, place (row in its conversation by turn, nulls first, then role and text), step (inserts come before
    the row they precede), turn, edit (K, R, D or I), role and text after it, fault. Deleted rows are lines, too.
    Talks: conv_id, rows, gaps, blank, duplicate, truncated, illegal, cost. A row whose ``present`` is false only
    announces its conversation, which has a row of zeros if nothing else is there.

    A null conversation is one of its own; a null turn comes before all others and counts in no gap; a null role or text
    reads as one space, an empty or unknown role is never legal. Equal rows are each a row, and all but the first are
    duplicates. An empty table gives no rows. ``turn`` must be integral; other columns of ``rows`` do not matter.
    """
    kind = rows.select(conv.alias("c")).schema["c"].dataType
    source = rows.select(
        conv.isNotNull().alias("known"), F.coalesce(conv.cast("string"), F.lit("")).alias("conv"),
        F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("present"),
        turn.isNotNull().alias("has_turn"), F.coalesce(turn.cast("long"), F.lit(0)).alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"))
    source = source.withColumns({c: F.when(F.col("present"), F.col(c)).otherwise("") for c in ("role", "text")})
    ordered = _faults(source.repartition("known", "conv")).sortWithinPartitions(
        "known", "conv", "present", "has_turn", "turn", "role", "text", "again")
    done = work.save(ordered.select(*_IN_NAMES).mapInPandas(_stream((block_rows, block_bytes)), _OUT), "edits")

    settled = done.where(F.col("kind").isin(ROW, TAIL) & (F.col("state") >= 0))
    spilled = done.where((F.col("kind") == ROW) & (F.col("state") < 0)).drop("state")
    ends = done.where(F.col("kind") == BLOCK).select("known", "conv", "block", "state")
    chosen = spilled.join(ends, ["known", "conv", "block"]).withColumn(
        "codes", F.element_at(F.split("codes", ","), F.col("state") + 1))
    conv_id = F.when(F.col("known"), F.col("conv").cast(kind)).alias("conv_id")
    code, given = F.col("code"), F.lower("code") == F.col("code")
    lines = settled.unionByName(chosen).select("*", F.posexplode(F.split("codes", "")).alias("step", "code")).select(
        conv_id, "place", "step", F.when(F.col("has_turn") & (F.lower(code).isin("k", "d") | given), F.col("turn")).alias("turn"),
        F.translate(code, "UAua", "IIRR").alias("edit"),
        F.when(F.lower(code) == "u", "user").when(F.lower(code) == "a", "assistant").otherwise(F.col("role")).alias("role"),
        F.when(code.isin("U", "A"), "").otherwise(F.col("text")).alias("text"),
        F.when(~code.isin("U", "A"), F.col("fault")).alias("fault"))
    talks = done.where(F.col("kind") == TALK).select(
        conv_id, *[F.element_at("totals", i + 1).alias(n) for i, n in enumerate(TOTALS)])
    return lines, talks


def _fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audit string and digest of each conversation, from its lines in order."""
    key, edits, digest, empty, out = None, [], hashlib.sha256(), True, []

    def close():
        out.append((*key, "".join(edits), digest.hexdigest()))

    for frame in frames:
        for known, conv, edit, role, text in zip(*(frame[c].tolist() for c in ("known", "conv", "edit", "role", "text"))):
            if key != (known, conv):
                if key:
                    close()
                key, edits, digest, empty = (known, conv), [], hashlib.sha256(), True
            edits.append(edit)
            if edit != "D":
                digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False
        if len(out) >= OUT_ROWS:
            yield pd.DataFrame(out, columns=["known", "conv", "audit", "repaired_sha256"])
            out.clear()
    if key:
        close()
    yield pd.DataFrame(out, columns=["known", "conv", "audit", "repaired_sha256"])


def digests(lines: DataFrame, talks: DataFrame) -> DataFrame:
    """``talks`` with the edits of each conversation as one string and the SHA-256 of what is left of it.

    What is left are the lines ``role:text`` without deleted rows, joined by newlines.
    """
    kind = talks.schema["conv_id"].dataType
    slim = lines.select(
        F.col("conv_id").isNotNull().alias("known"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        "place", "step", "edit", "role", "text")
    folded = slim.repartition("known", "conv").sortWithinPartitions("known", "conv", "place", "step").mapInPandas(
        _fold, "known boolean, conv string, audit string, repaired_sha256 string")
    told = folded.select(F.when(F.col("known"), F.col("conv").cast(kind)).alias("talk"), "audit", "repaired_sha256")
    return talks.join(told, talks["conv_id"].eqNullSafe(told["talk"]), "left").select(
        *[talks[c] for c in talks.columns], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
