"""Transcript parsing: a hidden Markov model over lines recovers who speaks, then turns are rendered canonically.

A hidden state is a role that begins a turn or goes on with it. A line shows a speaker marker (or none), a length
class, whether it asks and whether it opens a row of the source. Transition and observation counts come from all labelled lines, by grouped counts on the cluster,
with a prior that ties markers to their roles; the model is a few dozen numbers.

Viterbi runs in max-plus algebra, which is associative: a conversation is cut into chunks of ``CHUNK_LINES`` lines,
each chunk gives one small matrix, the matrices of a conversation give the best state at every cut, and each chunk is
decoded between its cuts. The lines are numbered by the order of their rows, which are dealt by ranges of that order and
counted range by range. So a conversation with a third of all rows, whatever its turn numbers, is as many groups as it
has chunks, and no group has more than ``CHUNK_LINES`` lines. Only the matrices of a conversation meet in one task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gleaner.llm.common import Work

ROLES = ("system", "user", "assistant")
# Words that name a speaker, by role.
NAMES = {
    "system": ("system", "instruction", "instructions"), "user": ("user", "human", "question", "q", "prompter", "customer"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "gpt", "model", "agent")}
LENGTHS = (0, 20, 60, 120, 240, 480, 960)
CHUNK_LINES = 1024
STATES = 2 * len(ROLES)  # role r begins: 2r, goes on: 2r + 1
PRIOR, MARKER_PRIOR = 0.5, 1000.0
FEATURES = ("marker", "length", "asks", "opens")
# Whether a line opens a row, by whether it begins a turn: a transcript in one row has turns that open none.
OPENS = ((0.05, 0.95), (0.99, 0.01))
_MARKER = r"^[\s>#*\[<|(]*(" + "|".join(sorted((n for names in NAMES.values() for n in names), key=len, reverse=True)) + r")[\]>|)*]*\s*(?::|[-=]>|\|>|\])\s*"


def role_code(name: Column) -> Column:
    """0, 1, 2 for a role's names in any case, else null."""
    name = F.lower(F.trim(name))
    out = F.lit(None).cast("int")
    for i, role in enumerate(ROLES):
        out = F.when(name.isin(*NAMES[role]), i).otherwise(out)
    return out


def rows_of(rows: DataFrame, id_col: str, turn_col: str, text_col: str, *more: Column) -> DataFrame:
    """(conv_id, turn, copy, whole, n, …): turn and text without nulls, and the number of lines."""
    base = rows.select(
        F.col(id_col).alias("conv_id"), F.coalesce(F.col(turn_col).cast("long"), F.lit(-1)).alias("turn"),
        F.monotonically_increasing_id().alias("copy"), F.coalesce(F.col(text_col), F.lit("")).alias("whole"), *more)
    return base.withColumn("n", F.size(F.split("whole", "\r?\n")).cast("long"))


def lines_of(base: DataFrame, *keep: str) -> DataFrame:
    """(…, line, text, marker, length, asks, opens), one row per line of each row's text, with the ``keep`` columns."""
    out = base.select(*keep, F.posexplode(F.split("whole", "\r?\n")).alias("line", "text"))
    marker = role_code(F.regexp_extract("text", "(?i)" + _MARKER, 1))
    size = F.length("text")
    return out.select(
        *keep, "line", "text", (F.coalesce(marker, F.lit(-1)) + 1).alias("marker"),
        sum(F.when(size > n, 1).otherwise(0) for n in LENGTHS).alias("length"),
        F.rtrim("text").endswith("?").cast("int").alias("asks"), (F.col("line") == 0).cast("int").alias("opens"))


def in_order(base: DataFrame) -> DataFrame:
    """Rows dealt by ranges of (conv_id, turn, copy) and sorted, so the partitions follow each other in that order."""
    order = ("conv_id", "turn", "copy")
    return base.repartitionByRange(*order).sortWithinPartitions(*order)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and how many lines of the conversation come before each row in it."""
    part, conv, at = TaskContext.get().partitionId(), object(), 0
    for batch in batches:
        starts = []
        for own, n in zip(batch.column("conv_id").to_pylist(), batch.column("n").to_pylist()):
            if own != conv:
                conv, at = own, 0
            starts.append(at)
            at += n
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(starts), pa.int32()), pa.array(starts, pa.int64())],
            names=[*batch.schema.names, "part", "start"])


def numbered_lines(rows: DataFrame, work: Work, id_col: str = "conv_id", turn_col: str = "turn",
                   text_col: str = "text") -> DataFrame:
    """The lines of ``lines_of`` with conv_id, turn, their number in the conversation and their chunk."""
    base = in_order(rows_of(rows, id_col, turn_col, text_col)).drop("copy")
    schema = T.StructType([*base.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("start", T.LongType())])
    rows = work.save(base.mapInArrow(_number, schema), "rows")
    # Only the first conversation of a partition has lines in earlier ones, so there is at most one row per partition.
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = rows.groupBy("conv_id", "part").agg(F.sum("n").alias("n")).select(
        F.col("conv_id").alias("conv_"), F.col("part").alias("part_"), F.sum("n").over(earlier).alias("moved")).where("moved > 0")
    rows = rows.join(F.broadcast(moved), (F.col("part") == F.col("part_")) & F.col("conv_id").eqNullSafe(F.col("conv_")), "left")
    rows = rows.withColumn("start", F.col("start") + F.coalesce("moved", F.lit(0)))
    number = (F.col("start") + F.col("line")).alias("number")
    lines = lines_of(rows, "conv_id", "turn", "start")
    return lines.select("conv_id", "turn", number, F.floor(number / CHUNK_LINES).cast("long").alias("chunk"), "text", *FEATURES)


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (before, more, role) over neighbouring rows of a sorted partition and, as its edges, its first and last
    row. ``before`` is null where the row opens its conversation; role is -1 where it is unknown."""
    part, counts, first, last, kind = TaskContext.get().partitionId(), Counter(), None, None, None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "more"))):
            if last is None:
                first = row
            else:
                counts[(*last[1:], row[1]) if last[0] == row[0] else (None, None, row[1])] += 1
            last = row
    if last is None:
        return
    out = [(part, "count", None, *k, n) for k, n in counts.items()]
    out += [(part, "first", first[0], None, first[2], first[1], 1), (part, "last", last[0], None, last[2], last[1], 1)]
    kinds = [pa.int32(), pa.string(), kind, pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["part", "kind", "conv_id", "before", "more", "role", "n"])


def transitions(base: DataFrame) -> tuple[Counter, Counter]:
    """How often a role follows (role, whether its row has more lines), and how often a role opens a conversation.

    Rows (conv_id, turn, copy, role, more) follow each other as ``parse`` reads them, so each adds one count at most; a
    row of unknown role (-1) parts its neighbours. The driver sees some thirty numbers per partition.
    """
    rows = in_order(base.select("conv_id", "turn", "copy", "role", "more"))
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("kind", T.StringType()), base.schema["conv_id"],
        *[T.StructField(c, T.IntegerType()) for c in ("before", "more", "role")], T.StructField("n", T.LongType())])
    steps, first = Counter(), Counter()

    def add(before: int | None, more: int | None, role: int, n: int) -> None:
        if before is None and role >= 0:
            first[role] += n
        elif before is not None and before >= 0 and role >= 0:
            steps[before, more, role] += n

    edge = None
    found = rows.mapInArrow(_transitions, schema).collect()
    for r in sorted(found, key=lambda r: (r["part"], ("first", "count", "last").index(r["kind"]))):
        if r["kind"] == "count":
            add(r["before"], r["more"], r["role"], r["n"])
        elif r["kind"] == "last":
            edge = r
        elif edge is not None and edge["conv_id"] == r["conv_id"]:
            add(edge["role"], edge["more"], r["role"], 1)
        else:
            add(None, None, r["role"], 1)
    return steps, first


def learn(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> dict[str, np.ndarray]:
    """Log probabilities from all rows whose role is known: start, step (from, to), and marker, length, asks, opens by
    state."""
    role = F.coalesce(role_code(F.col(role_col)), F.lit(-1)).alias("role")
    base = rows_of(rows, id_col, turn_col, text_col, role).withColumn("more", (F.col("n") > 1).cast("int"))
    steps, first = transitions(base)
    labelled = base.where("role >= 0")
    features = lines_of(labelled, "role").groupBy(
        "role", (F.col("line") > 0).cast("int").alias("on"), "marker", "length", "asks").count().collect()
    lengths = labelled.groupBy("role").agg(
        F.sum((F.col("n") > 1).cast("long")).alias("more"), F.sum(F.greatest(F.col("n") - 2, F.lit(0)).cast("long")).alias("on"),
        F.count("*").alias("turns")).collect()
    start, step = np.full(STATES, 1e-3), np.full((STATES, STATES), 1e-2)
    marker, length, asks = (np.full((STATES, n), PRIOR) for n in (len(ROLES) + 1, len(LENGTHS) + 1, 2))
    for r in range(len(ROLES)):
        marker[2 * r, 0] += MARKER_PRIOR
        marker[2 * r, r + 1] += MARKER_PRIOR
        marker[2 * r + 1, 0] += 2 * MARKER_PRIOR
        start[2 * r] += PRIOR
        step[2 * r, 2 * r + 1] += PRIOR
        step[2 * r + 1, 2 * r + 1] += PRIOR
        for q in range(len(ROLES)):
            if q != r:
                step[2 * r, 2 * q] += PRIOR
                step[2 * r + 1, 2 * q] += PRIOR
    for x in features:
        s = 2 * x["role"] + x["on"]
        marker[s, x["marker"]] += x["count"]
        length[s, x["length"]] += x["count"]
        asks[s, x["asks"]] += x["count"]
    # How often labelled text lacks markers says nothing about transcripts that have them.
    marker /= marker.sum(1, keepdims=True)
    for r in range(len(ROLES)):
        marker[2 * r] = 0.5 * marker[2 * r] + 0.5 * np.where(np.arange(len(ROLES) + 1) == r + 1, 0.9997, 0.0001)
    for x in lengths:
        step[2 * x["role"], 2 * x["role"] + 1] += x["more"]
        step[2 * x["role"] + 1, 2 * x["role"] + 1] += x["on"]
    for (before, more, role), n in steps.items():
        step[2 * before + more, 2 * role] += n
    for role, n in first.items():
        start[2 * role] += n
    norm = lambda m: np.log(m / m.sum(-1, keepdims=True))
    return {"start": norm(start), "step": norm(step), "marker": np.log(marker), "length": norm(length), "asks": norm(asks), "opens": np.log(np.tile(OPENS, (len(ROLES), 1)))}


def _seen(model: dict, rows: pa.Table) -> np.ndarray:
    """Log probability of each line's observation in each state."""
    place = [rows.column(c).to_numpy() for c in FEATURES]
    return sum(model[c][:, p].T for c, p in zip(FEATURES, place))


def _ordered(rows: pa.Table) -> pa.Table:
    return rows.sort_by("number")


def chunk_matrix(model: dict, seen: np.ndarray) -> np.ndarray:
    """Best score of a chunk from the state before it to its last state."""
    out = model["step"] + seen[0]
    for row in seen[1:]:
        out = (out[:, :, None] + model["step"][None]).max(1) + row
    return out


def best_path(model: dict, seen: np.ndarray, before: int | None, last: int | None) -> np.ndarray:
    """Viterbi path of a chunk, given the state before it (None: a start) and its last state (None: the best one)."""
    score = (model["start"] if before is None else model["step"][before]) + seen[0]
    back = np.zeros(seen.shape, np.int64)
    for t in range(1, len(seen)):
        ways = score[:, None] + model["step"]
        back[t] = ways.argmax(0)
        score = ways.max(0) + seen[t]
    path = np.zeros(len(seen), np.int64)
    path[-1] = score.argmax() if last is None else last
    for t in range(len(seen) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def _matrices(model: dict):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = _ordered(rows)
        seen = _seen(model, rows)
        first = (model["start"] + seen[0])[None]  # as the first chunk of its conversation
        for row in seen[1:]:
            first = (first[:, :, None] + model["step"][None]).max(1) + row
        return pa.Table.from_arrays(
            [rows.column("conv_id").slice(0, 1), pa.array([key[1].as_py()], pa.int64()),
             pa.array([chunk_matrix(model, seen).ravel().tolist()], pa.list_(pa.float64())),
             pa.array([first[0].tolist()], pa.list_(pa.float64()))], names=["conv_id", "chunk", "matrix", "first"])

    return run


def _cuts(rows: pa.Table) -> pa.Table:
    """Best last state of every chunk of a conversation, and of the chunk before it."""
    rows = rows.sort_by("chunk")
    matrices = [np.array(m).reshape(STATES, STATES) for m in rows.column("matrix").to_pylist()]
    score, back = np.array(rows.column("first")[0].as_py()), []
    for m in matrices[1:]:
        ways = score[:, None] + m
        back.append(ways.argmax(0))
        score = ways.max(0)
    last = [int(score.argmax())]
    for b in reversed(back):
        last.insert(0, int(b[last[0]]))
    return pa.Table.from_arrays(
        [rows.column("conv_id"), rows.column("chunk"), pa.array([None, *last[:-1]], pa.int32()), pa.array(last, pa.int32())],
        names=["conv_id", "chunk", "before", "last"])


def _render(role: str, lines: list[str]) -> str:
    return f"<|{role}|>\n" + "\n".join(lines).strip() + "\n<|end|>"


def _decode(model: dict, id_type):
    import re

    marker = re.compile(_MARKER, re.I)

    def run(rows: pa.Table, cuts: pa.Table) -> pa.Table:
        names = ["conv_id", "turn_no", "source_turn", "role", "n_lines", "continues", "rendered"]
        out: list[tuple] = []
        rows = _ordered(rows)
        if rows.num_rows:
            before = cuts.column("before")[0].as_py()
            path = best_path(model, _seen(model, rows), before, cuts.column("last")[0].as_py())
            conv, numbers = rows.column("conv_id")[0].as_py(), rows.column("number").to_pylist()
            texts, turns = rows.column("text").to_pylist(), rows.column("turn").to_pylist()
            marked = rows.column("marker").to_pylist()
            starts = [t for t in range(len(path)) if not t or path[t] % 2 == 0 or path[t] // 2 != path[t - 1] // 2]
            for a, b in zip(starts, [*starts[1:], len(path)]):
                lines = texts[a:b]
                if marked[a]:
                    lines = [marker.sub("", lines[0], count=1), *lines[1:]]
                role = ROLES[path[a] // 2]
                goes_on = not a and before is not None and path[a] % 2 == 1 and path[a] // 2 == before // 2
                out.append((conv, numbers[a], turns[a], role, b - a, goes_on, _render(role, lines)))
        cols = list(zip(*out)) or [[]] * len(names)
        kinds = [id_type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return run


def parse(rows: DataFrame, model: dict, id_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """One row per recovered turn: conv_id, turn_no (its first line's number in the conversation), source_turn, role, n_lines,
    continues, rendered.

    The lines of a conversation are read in the order of ``turn`` (null: first), repeated rows one after the other. A
    null or empty text is one empty line. A turn that runs over a cut of chunks goes on in a row with ``continues``.
    Rows with a null conv_id are one conversation; an empty table gives no rows.
    """
    lines = numbered_lines(rows, Work(rows.sparkSession, "transcripts"), id_col, turn_col, text_col)
    field = T.StructField("conv_id", rows.schema[id_col].dataType)
    keys = ["conv_id", "chunk"]
    chunk = T.StructField("chunk", T.LongType())
    doubles = T.ArrayType(T.DoubleType())
    matrices = lines.drop("text").groupBy(*keys).applyInArrow(_matrices(model), T.StructType(
        [field, chunk, T.StructField("matrix", doubles), T.StructField("first", doubles)]))
    cuts = matrices.groupBy("conv_id").applyInArrow(_cuts, T.StructType(
        [field, chunk, T.StructField("before", T.IntegerType()), T.StructField("last", T.IntegerType())]))
    return lines.groupBy(*keys).cogroup(cuts.groupBy(*keys)).applyInArrow(
        _decode(model, to_arrow_type(field.dataType)), T.StructType([
            field, T.StructField("turn_no", T.LongType()), T.StructField("source_turn", T.LongType()),
            T.StructField("role", T.StringType()), T.StructField("n_lines", T.LongType()),
            T.StructField("continues", T.BooleanType()), T.StructField("rendered", T.StringType())]))
