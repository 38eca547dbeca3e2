"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is a sequence of rows (conversation, turn, text); a row's text has one or more lines,
some of which begin with a speaker marker ("User:", "### Assistant", "A:" ...). Hidden states are
role x (first line of a turn, later line). A line's features, made with DataFrame functions, are its
marker, its length class, whether it asks, and whether it begins a row. Emissions and transitions
are add-one smoothed counts over a bounded sample of labelled transcripts.

Viterbi runs over sorted range partitions, so a conversation may span any number of tasks. A first
pass gives, for the first and the last conversation of each partition, the 6 x 6 table of best
scores between its end states; the driver chains those few tables across partitions and fixes the
end states; a second pass decodes each piece between its fixed ends. Both passes read the same
checkpoint.

A canonical turn is a run of lines of one role within a row, without its marker, rendered as
``<|role|>\\ntext<|end|>``.

Defined cases: a null text is one empty line; a null conversation is one conversation; a null turn
comes first; rows that tie are ordered by their text's hash, equal rows stand next to each other;
an empty table gives an empty result; other columns are not read. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, ship

ROLES = ("system", "user", "assistant")
#: Speaker markers (fixed values): spellings of each role at the start of a line.
MARKERS = {"system": "system|sys|instructions?", "user": "user|human|question|q|customer", "assistant": "assistant|ai|bot|answer|a|agent"}
STATES = 2 * len(ROLES)
CODES = 4 * 4 * 2 * 2
#: Labelled rows that the model is fitted on.
SAMPLE_ROWS = 20_000


def marker(words: str) -> str:
    return rf"(?i)^\s*(?:#+\s*|\[|<\|?|\*\*)?(?:{words})(?:\|?>|\]|\*\*)?\s*(?::|$)\s*"


def _code(line: Column, first: Column) -> Column:
    mark = F.lit(0)
    for k, r in enumerate(ROLES, 1):
        mark = F.when(line.rlike(marker(MARKERS[r])), k).otherwise(mark)
    n = F.length(line)
    size = F.when(n == 0, 0).when(n < 60, 1).when(n < 240, 2).otherwise(3)
    ask = F.when(line.rlike(r"\?\s*$"), 1).otherwise(0)
    return (((mark * 4 + size) * 2 + ask) * 2 + F.when(first, 1).otherwise(0)).cast("int")


def features(df: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", role: str | None = None) -> DataFrame:
    """Columns c, t, x (text's hash), text, codes (a feature code for each line) and, if given, role."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    own = [F.col(role).alias("role")] if role else []
    return df.select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.xxhash64(text).alias("x"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.transform(lines, lambda v, i: _code(v, i == 0)).alias("codes"), *own)


def fit(labelled: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", role: str = "role", sample_rows: int = SAMPLE_ROWS) -> dict[str, np.ndarray]:
    """Log start, transition and emission tables from at most ``sample_rows`` labelled rows."""
    rows = features(labelled.where(F.col(role).isin(*ROLES)).limit(sample_rows), conv, turn, text, role)
    k = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("role")).cast("int") - 1
    w = Window.partitionBy("c").orderBy("t", "x")
    rows = rows.select("c", "codes", k.alias("k"), F.lag(k).over(w).alias("before")).persist()
    emit, start = np.ones((STATES, CODES)), np.ones(STATES)
    move = np.ones((STATES, STATES))
    try:
        for r in rows.select("k", F.posexplode("codes").alias("p", "code")).groupBy("k", F.least("p", F.lit(1)).alias("p"), "code").count().collect():
            emit[2 * r["k"] + r["p"], r["code"]] += r["count"]
        for r in rows.groupBy("before", "k", F.least(F.size("codes") - 1, F.lit(1)).alias("more")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("codes") - 1).alias("inner")).collect():
            if r["before"] is None:
                start[2 * r["k"]] += r["n"]
            else:  # from the last line of the row before, which is of either kind
                for p in (0, 1):
                    move[2 * r["before"] + p, 2 * r["k"]] += r["n"]
            move[2 * r["k"], 2 * r["k"] + 1] += r["n"] if r["more"] else 0
            move[2 * r["k"] + 1, 2 * r["k"] + 1] += max(0, r["inner"] - r["n"]) if r["more"] else 0
    finally:
        rows.unpersist()
    # Later lines cannot begin a row, nor change the role.
    start[1::2] = 1e-6
    for a in range(STATES):
        for b in range(1, STATES, 2):
            if a // 2 != b // 2:
                move[a, b] = 1e-6
    norm = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return {"start": norm(start), "move": norm(move), "emit": norm(emit)}


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Best scores over both tables."""
    return (a[..., :, :, None] + b[..., None, :, :]).max(axis=-2)


def chain(codes: np.ndarray, model: dict) -> np.ndarray:
    """Best score from the first line's state (with its emission) to the last line's."""
    first = np.full((STATES, STATES), -np.inf)
    np.fill_diagonal(first, model["emit"][:, codes[0]])
    steps = model["move"][None] + model["emit"].T[codes[1:]][:, None, :]
    while len(steps) > 1:
        odd = steps[-1:] if len(steps) % 2 else steps[:0]
        steps = np.concatenate((_join(steps[: len(steps) // 2 * 2 : 2], steps[1::2]), odd))
    return _join(first, steps[0]) if len(steps) else first


def viterbi(codes: np.ndarray, model: dict, first: int | None = None, last: int | None = None) -> np.ndarray:
    """The best states, with the first and the last one as given, if given."""
    emit = model["emit"].T[codes]
    best = model["start"] + emit[0] if first is None else np.where(np.arange(STATES) == first, emit[0], -np.inf)
    back = np.empty((len(codes), STATES), np.int8)
    for i in range(1, len(codes)):
        paths = best[:, None] + model["move"]
        back[i] = paths.argmax(axis=0)
        best = paths.max(axis=0) + emit[i]
    out = np.empty(len(codes), np.int64)
    out[-1] = best.argmax() if last is None else last
    for i in range(len(codes) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[dict]]]:
    """Runs of rows of one conversation within the partition."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["c"] != held[0]["c"]:
                yield held[0]["c"], held
                held = []
            held.append(row)
    if held:
        yield held[0]["c"], held


def _ends(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    """Tables of the partition's first and last conversations."""
    part, first, last = TaskContext.get().partitionId(), None, None
    for c, rows in _pieces(batches):
        last = (c, np.array([k for r in rows for k in r["codes"]]))
        if first is None:
            first = last
    if first is not None:
        for place, (c, codes) in ((0, first), (1, last)) if first is not last else ((0, first),):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([place], pa.int64()), pa.array([None if c is None else str(c)], pa.string()), pa.array([chain(codes, model).tobytes()], pa.binary())], ["part", "place", "c", "table"])


def fix_ends(found: list, model: dict) -> dict[tuple[int, int], tuple[int | None, int | None]]:
    """First and last state of the pieces of conversations that span partitions."""
    out: dict = {}
    rows = sorted(found, key=lambda r: (r["part"], r["place"]))
    a = 0
    while a < len(rows):
        b = a + 1
        while b < len(rows) and rows[b]["c"] == rows[a]["c"] and rows[b]["part"] != rows[b - 1]["part"]:
            b += 1
        if b - a > 1:
            best, backs = None, []
            for r in rows[a:b]:
                table = np.frombuffer(r["table"], np.float64).reshape(STATES, STATES)
                if best is None:
                    enter, before = model["start"], None
                else:
                    paths = best[:, None] + model["move"]
                    enter, before = paths.max(axis=0), paths.argmax(axis=0)
                full = enter[:, None] + table
                backs.append((before, full.argmax(axis=0)))
                best = full.max(axis=0)
            state = int(best.argmax())
            for k in range(b - 1, a - 1, -1):
                before, enter = backs[k - a]
                first = int(enter[state])
                out[(rows[k]["part"], rows[k]["place"])] = (None if k == a else first, state)
                state = int(before[first]) if before is not None else state
        a = b
    return out


def _turns(batches: Iterator[pa.RecordBatch], model: dict, fixed: dict, strip: dict) -> Iterator[tuple]:
    part, seen = TaskContext.get().partitionId(), 0
    held = None

    def decode(rows: list[dict], ends: tuple) -> Iterator[tuple]:
        states, at = viterbi(np.array([k for r in rows for k in r["codes"]]), model, *ends), 0
        for r in rows:
            lines = r["text"].split("\n")
            own = states[at : at + len(lines)]
            at += len(lines)
            begin = [0, *[i for i in range(1, len(lines)) if own[i] % 2 == 0 or own[i] // 2 != own[i - 1] // 2], len(lines)]
            for n, (a, b) in enumerate(zip(begin[:-1], begin[1:], strict=True)):
                role = ROLES[own[a] // 2]
                text = "\n".join([strip[role].sub("", lines[a]), *lines[a + 1 : b]]).strip()
                yield r["c"], r["t"], n, role, text, f"<|{role}|>\n{text}<|end|>"

    # The last conversation is known to be the last only when the partition ends.
    for _, rows in _pieces(batches):
        if held is not None:
            yield from decode(held, fixed.get((part, 0), (None, None)) if seen == 1 else (None, None))
        held, seen = rows, seen + 1
    if held is not None:
        yield from decode(held, fixed.get((part, 0 if seen == 1 else 1), (None, None)))


def parse(transcripts: DataFrame, model: dict, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """conv, turn, part (from 0 within the row), role, text, rendered: a row for each canonical turn."""
    import re

    ship(transcripts.sparkSession)
    rows = features(transcripts, conv, turn, text)
    kinds = [rows.schema[c].dataType.simpleString() for c in ("c", "t")]
    laid = cut(rows.withColumn("u", F.monotonically_increasing_id()).repartitionByRange("c", "t", "x", "u").sortWithinPartitions("c", "t", "x", "u").select("c", "t", "text", "codes"))
    found = laid.select("c", "codes").mapInArrow(lambda b: _ends(b, model), "part bigint, place bigint, c string, table binary").collect()
    fixed = fix_ends(found, model)
    strip = {r: re.compile(marker(w)) for r, w in MARKERS.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        schema = None
        for batch_or_row in _with_types(batches, lambda b: _turns(b, model, fixed, strip)):
            if isinstance(batch_or_row, pa.Schema):
                schema = batch_or_row
                continue
            held.append(batch_or_row)
            if len(held) == 5000:
                yield _rows(held, schema)
                held = []
        if held:
            yield _rows(held, schema)

    return laid.mapInArrow(run, f"c {kinds[0]}, t {kinds[1]}, part int, role string, text string, rendered string").withColumnsRenamed({"c": conv, "t": turn})


def _with_types(batches: Iterator[pa.RecordBatch], fn) -> Iterator:
    """The schema of the batches, then what ``fn`` makes of them."""
    first = next(batches, None)
    if first is None:
        return
    yield first.schema

    def again():
        yield first
        yield from batches

    yield from fn(again())


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    kinds = [schema.field("c").type, schema.field("t").type, pa.int32(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["c", "t", "part", "role", "text", "rendered"])


def transcripts(conversations: DataFrame) -> DataFrame:
    """Raw transcripts of labelled conversations: markers in the style of the conversation, missing in a seventh of the rows."""
    style, lost = F.pmod(F.xxhash64("conv_id"), F.lit(4)), F.pmod(F.xxhash64("conv_id", "turn", F.lit("lost")), F.lit(7)) == 0
    names = {"system": ["System: ", "### System:\n", "[SYSTEM]: ", "<|system|>: "], "user": ["User: ", "### Human:\n", "Q: ", "<|user|>: "], "assistant": ["Assistant: ", "### Assistant:\n", "A: ", "<|assistant|>: "]}
    mark = F.lit("")
    for r, spellings in names.items():
        for k, s in enumerate(spellings):
            mark = F.when((F.col("role") == r) & (style == k), s).otherwise(mark)
    return conversations.withColumn("text", F.when(lost, F.col("text")).otherwise(F.concat(mark, F.coalesce("text", F.lit("")))))
