"""Chat formatting: a hidden Markov model recovers who speaks in a transcript.

A transcript is a run of lines, given as one text or as several (a row each, in
the order of their turns); some lines begin with a speaker marker ("User:",
"Assistant:", "### Response" and the like), on their own or before words.  A
state of the model is a role together with whether the line begins a message or
goes on with it ("user", "user+"); a line's observations are its marker (which
may be missing or wrong) together with whether it opens its row, its length
class, its end, list or code marks, and being the transcript's first.  A row's
first line always begins a message; inside a row the model decides, so markers
in the middle of a text count and unmarked lines stay with their message.
Start, transition and observation probabilities are counted over lines with
known states (one row per pair of states or feature value reaches the driver).
Viterbi finds the likeliest states, and turns are rendered in one canonical
form: consecutive messages of a role become one turn.

Viterbi runs in blocks of ``BLOCK`` lines, so no transcript has to fit in one
task.  A block is a max-plus matrix (best score from any entry state to any exit
state), and ``SPAN`` blocks multiply to the matrix of a span.  A scan over a
transcript's spans, 65,536 times shorter than the transcript, fixes the states
at the borders of spans; each span then fixes those of its blocks, and the blocks
trace their own lines, always between fixed borders.  The result is that of one pass, ties
included (the state first in STATES wins).  A running sum of the blocks' role
changes numbers the turns, and the pieces that blocks hold of a turn are joined.

Blocks are cut by the position of a line, which range-partitioned rows give, and
not by turn numbers: missing or repeated turns fill no block beyond its size.

Edge cases: null texts are empty messages; a row with a null conversation id is a
transcript of its own; rows of equal turn number are ordered by text, null turns come
first; exact repeats of a row with a conversation and a turn are one message,
other repeats are messages of their own; a marker is taken off where it opens a row or a
turn or names a speaker, and is text inside a turn else ("Answer: 42"); unknown roles train nothing; with nothing
to learn from the smoothing alone decides (markers still count); an empty table
gives an empty result; texts are kept whole but for markers and outer space.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from nextbest.llm.common import checkpointed, slices
from nextbest.operators.ranking import positions

ROLES = ("system", "user", "assistant")
#: A line begins a message of a role, or goes on with one.
STATES = ROLES + tuple(f"{r}+" for r in ROLES)
BLOCK = 256
#: Blocks of a span.
SPAN = 256

#: Speaker markers at the start of a message's first line, by role.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q", "instruction", "prompt"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "response", "model"),
}
#: Markers that are names of a speaker; the others ("Answer:") also stand inside messages.
SPEAKERS = frozenset("system user human customer assistant ai bot agent model".split())
_ROLE_OF = {word: role for role, some in MARKERS.items() for word in some}
_MARKER = re.compile(r"\s*(?:#{1,6}\s*|\*\*|<\||\[)?\s*([A-Za-z]{1,12})\s*(?:\*\*|\|>|\])?\s*"
                     r"(?::(?:\*\*)?[ \t]*\n?|(?<=[>\]])[ \t]*\n?|\n)")


def split_marker(text: str) -> tuple[str, str]:
    """(role named by the first line's marker or "none", the text behind it)."""
    m = _MARKER.match(text)
    if m and m.group(1).lower() in _ROLE_OF:
        head = m.group(0)
        if ":" in head or any(c in head for c in "#<["):
            return _ROLE_OF[m.group(1).lower()], text[m.end():]
    return "none", text


def names_speaker(line: str) -> bool:
    """Does the line's marker name a speaker, or is it set off as a heading or in brackets?"""
    m = _MARKER.match(line + "\n")
    return bool(m) and (m.group(1).lower() in SPEAKERS or any(c in m.group(0) for c in "#<[*"))


#: Observations of a line; a marker with "+" is met inside a row, not at its start.
FEATURES = {"marker": [*MARKERS, "none", *(f"{m}+" for m in MARKERS), "none+"],
            "words": [str(i) for i in range(11)], "end": ["?", ".", "other"],
            "list": ["True", "False"], "first": ["True", "False"]}
_INDEX = {k: {v: i for i, v in enumerate(some)} for k, some in FEATURES.items()}
_LISTED = re.compile(r"\s*(?:[-*•]\s|\d+[.)]\s|```)")


def observe(line: str, opens: bool, first: bool) -> dict[str, str]:
    """feature -> value of a line that opens its row or not."""
    marker, body = split_marker(line + "\n")
    body = body.strip()
    return {
        "marker": marker + ("" if opens else "+"),
        "words": str(min(10, len(body.split()).bit_length())),
        "end": "?" if body.endswith("?") else "." if body[-1:] in (".", "!", "…") else "other",
        "list": str(_LISTED.match(body) is not None),
        "first": str(first),
    }


def encode(observed: dict[str, str]) -> int:
    code = 0
    for name, some in FEATURES.items():
        code = code * len(some) + _INDEX[name][observed[name]]
    return code


def decoded(code: int) -> dict[str, str]:
    out = {}
    for name, some in reversed(FEATURES.items()):
        code, i = divmod(code, len(some))
        out[name] = some[i]
    return out


class RoleModel:
    """Log probabilities, add-one smoothed; markers are trusted in advance."""

    def __init__(self, counts: dict[tuple[str, str, str], int], roles: tuple[str, ...] = ROLES,
                 marker_trust: float = 50.0) -> None:
        self.roles = roles
        goes_on = np.array([r.endswith("+") for r in roles])
        self.start = np.where(goes_on, -np.inf, self._rows(counts, "start", [""], roles)[0])
        self.step = self._rows(counts, "step", roles, roles)
        for i, a in enumerate(roles):  # only a message of the same role can go on
            for j, b in enumerate(roles):
                if b.endswith("+") and b.rstrip("+") != a.rstrip("+"):
                    self.step[i, j] = -np.inf
        self.table = np.zeros((1, len(roles)))  # code -> log probability by state
        for name, some in FEATURES.items():
            trust = {(r, v): marker_trust for r in roles for v in (
                ("none+",) if r.endswith("+") else (r, f"{r}+", "none"))} if name == "marker" else {}
            seen = self._rows(counts, name, roles, some, trust)
            if name == "marker":
                opens = np.array([not v.endswith("+") for v in some])
                seen = np.where(goes_on[:, None] & opens[None, :], -np.inf, seen)
            self.table = (self.table[:, None, :] + seen.T[None, :, :]).reshape(-1, len(roles))

    @staticmethod
    def _rows(counts, kind, froms, tos, more=None) -> np.ndarray:
        n = np.array([[counts.get((kind, a, b), 0) + 1 + (more or {}).get((a, b), 0)
                       for b in tos] for a in froms], dtype=float)
        return np.log(n / n.sum(axis=1, keepdims=True))

    def emits(self, codes: list[int]) -> np.ndarray:
        return self.table[codes]


def block_matrix(model: RoleModel, emits: np.ndarray, begins: bool) -> np.ndarray:
    """Best score from each entry role (of the message before) to each exit role.

    The first block of a transcript has the start probabilities in every row.
    """
    k = len(model.roles)
    best = np.tile(model.start, (k, 1)) + emits[0] if begins else model.step + emits[0]
    for e in emits[1:]:
        best = (best[:, :, None] + model.step[None, :, :]).max(axis=1) + e
    return best


def trace(model: RoleModel, emits: np.ndarray, entry: int, leave: int, begins: bool) -> list[int]:
    """Roles of a block's messages between a fixed role before it and its fixed last role."""
    score = (model.start if begins else model.step[entry]) + emits[0]
    backs = []
    for e in emits[1:]:
        ways = score[:, None] + model.step
        backs.append(ways.argmax(axis=0))
        score = ways.max(axis=0) + e
    path = [leave]
    for back in reversed(backs):
        path.append(int(back[path[-1]]))
    return path[::-1]


def borders(matrices: list[np.ndarray], entry: int = 0, leave: int | None = None
            ) -> list[tuple[int, int]]:
    """(entry state, exit state) of every part in order, from ``entry`` to ``leave`` (None: the
    likeliest).  A transcript's first part has the same row for every entry."""
    score, backs = matrices[0][entry], []
    for m in matrices[1:]:
        ways = score[:, None] + m
        backs.append(ways.argmax(axis=0))
        score = ways.max(axis=0)
    exits = [int(score.argmax()) if leave is None else leave]
    for back in reversed(backs):
        exits.append(int(back[exits[-1]]))
    exits.reverse()
    return list(zip([entry, *exits[:-1]], exits))


def product(matrices: list[np.ndarray]) -> np.ndarray:
    """The max-plus matrix of parts in a row."""
    out = matrices[0]
    for m in matrices[1:]:
        out = (out[:, :, None] + m[None, :, :]).max(axis=1)
    return out


def _by_key(keys: list[str], work: Callable[[list[dict]], list[tuple]], names: list[str],
            types: list[pa.DataType]):
    """For mapInArrow over rows sorted by ``keys``: ``work`` gets the rows of one key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[tuple] = []

        def table() -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [()] * len(names)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, types)], names=names)
            out.clear()
            return batch

        for batch in batches:
            for row in batch.to_pylist():
                if held and any(row[k] != held[0][k] for k in keys):
                    out += work(held)
                    held = []
                held.append(row)
            if len(out) > 2000:
                yield table()
        if held:
            out += work(held)
        if out:
            yield table()

    return run


def lines(rows: DataFrame, conv: str, turn: str, text: str, role: str | None) -> DataFrame:
    """One row a line: key, conv, block, pos, turn, line, label (its state if known), code."""
    picked = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                         F.col(text).alias("text"),
                         (F.col(role) if role else F.lit(None).cast("string")).alias("role"))
    conv_type, kind = picked.schema["conv"].dataType, picked.schema["conv"].dataType.simpleString()
    role_kind = picked.schema["role"].dataType.simpleString()
    whole = role_kind.startswith("array")
    # nothing tells which rows without a conversation belong together
    own = F.concat(F.lit("n"), F.md5(F.to_json(F.struct("turn", "text", "role")).cast("binary")),
                   F.lit("#"), F.col("copy"))
    # a repeat at a known place is the same message, elsewhere it was said again
    known_place = F.col("conv").isNotNull() & F.col("turn").isNotNull()
    picked = picked.groupBy("conv", "turn", "text", "role").agg(F.count(F.lit(1)).alias("copies"))
    picked = picked.withColumn("copy", F.explode(F.sequence(
        F.lit(1).cast("long"), F.when(known_place, F.lit(1).cast("long")).otherwise(F.col("copies")))))
    picked = picked.drop("copies").withColumn("key", F.coalesce(
        F.concat(F.lit("c"), F.col("conv").cast("string")), own))
    picked = picked.withColumn("n", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long"))
    placed = positions(picked, ["turn", "text", "role", "copy"], ["key"], weight="n")
    names = ["key", "conv", "block", "pos", "turn", "line", "label", "code"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            for r in batch.to_pylist():
                known = r["role"] or ([] if whole else None)
                for i, line in enumerate((r["text"] or "").split("\n")):
                    pos = r["pos"] - r["n"] + i
                    if whole:
                        label = known[i] if i < len(known) else None
                    else:
                        label = known if not i or known is None else f"{known}+"
                    out.append((r["key"], r["conv"], pos // BLOCK, pos, r["turn"], line, label,
                                encode(observe(line, i == 0, pos == 0))))
                    if len(out) == 20_000:
                        yield _batch(out, names, types)
                        out = []
            if out:
                yield _batch(out, names, types)

    types = [pa.string(), to_arrow_type(conv_type), pa.int64(), pa.int64(), pa.int64(), pa.string(),
             pa.string(), pa.int32()]
    return placed.select("key", "conv", "turn", "text", "role", "n", "pos").mapInArrow(
        run, f"key string, conv {kind}, block long, pos long, turn long, line string, "
        "label string, code int")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)


def learn(found: DataFrame, train: Column) -> RoleModel:
    """Counts over lines with a known state; transitions inside blocks."""
    def work(rows: list[dict]) -> list[tuple]:
        totals: dict[tuple, int] = {}
        before = None
        for r in rows:
            state = r["label"] if r["label"] in STATES else None
            if state:
                totals["code", str(r["code"]), state] = totals.get(
                    ("code", str(r["code"]), state), 0) + 1
                ahead = ("start", "", state) if r["pos"] == 0 else ("step", before, state)
                if ahead[1] is not None:
                    totals[ahead] = totals.get(ahead, 0) + 1
            before = state
        return [(*k, n) for k, n in totals.items()]

    rows = found.where(train).select("key", "block", "pos", "label", "code").repartition(
        "key", "block").sortWithinPartitions("key", "block", "pos")
    seen = rows.mapInArrow(
        _by_key(["key", "block"], work, ["kind", "a", "b", "n"],
                [pa.string(), pa.string(), pa.string(), pa.int64()]),
        "kind string, a string, b string, n long").groupBy("kind", "a", "b").agg(F.sum("n"))
    counts: dict[tuple[str, str, str], int] = {}
    for kind, a, b, n in seen.collect():
        if kind == "code":
            for name, value in decoded(int(a)).items():
                counts[name, b, value] = counts.get((name, b, value), 0) + n
        else:
            counts[kind, a, b] = n
    return RoleModel(counts, STATES)


def decode(found: DataFrame, model: RoleModel) -> DataFrame:
    """Pieces of turns: key, conv, block, starts (turns begun in the block up to and including
    this one), turn, role, role_pred, marker, body.  A block's pieces of 0 starts go on with
    the turn of the block before."""
    conv_type, kind = found.schema["conv"].dataType, found.schema["conv"].dataType.simpleString()
    shared = found.sparkSession.sparkContext.broadcast(model)
    n = len(model.roles)

    def matrix(rows: list[dict]) -> list[tuple]:
        m = block_matrix(shared.value, shared.value.emits([r["code"] for r in rows]),
                         rows[0]["pos"] == 0)
        return [(rows[0]["key"], rows[0]["block"], m.reshape(-1).tolist())]

    def unpacked(rows: list[dict]) -> list[np.ndarray]:
        return [np.array(r["m"]).reshape(n, n) for r in rows]

    def span(rows: list[dict]) -> list[tuple]:
        return [(rows[0]["key"], rows[0]["span"], product(unpacked(rows)).reshape(-1).tolist())]

    def scan(rows: list[dict]) -> list[tuple]:
        return [(r["key"], r["span"], a, b) for r, (a, b) in zip(rows, borders(unpacked(rows)))]

    def inside(rows: list[dict]) -> list[tuple]:
        ends = borders(unpacked(rows), rows[0]["entry"], rows[0]["leave"])
        return [(r["key"], r["block"], a, b) for r, (a, b) in zip(rows, ends)]

    def path(rows: list[dict]) -> list[tuple]:
        states = shared.value.roles
        found = trace(shared.value, shared.value.emits([r["code"] for r in rows]),
                      rows[0]["entry"], rows[0]["leave"], rows[0]["pos"] == 0)
        before = None if rows[0]["pos"] == 0 else states[rows[0]["entry"]].rstrip("+")
        pieces, starts = [], 0
        for r, p in zip(rows, found):
            role, begins = states[p].rstrip("+"), not states[p].endswith("+")
            opens = not decoded(r["code"])["marker"].endswith("+")
            marker, body = split_marker(r["line"] + "\n") if begins and (
                opens or role != before or names_speaker(r["line"])) else ("none", r["line"])
            if role != before or not pieces:
                starts += role != before
                label = r["label"] and r["label"].rstrip("+")
                pieces.append(((r["key"], r["conv"], r["block"], starts, r["turn"], label, role,
                                marker), []))
            if marker == "none":
                pieces[-1][1].append(r["line"])
            elif body.strip():
                pieces[-1][1].append(body.removesuffix("\n"))
            before = role
        return [(*head, "\n".join(some) if some else None) for head, some in pieces]

    keys = ["key", "block"]
    matrices = found.select(*keys, "pos", "code").repartition(*keys).sortWithinPartitions(
        *keys, "pos").mapInArrow(
        _by_key(keys, matrix, [*keys, "m"], [pa.string(), pa.int64(), pa.list_(pa.float64())]),
        "key string, block long, m array<double>")
    # written, as the spans' scan and their blocks' both read them
    matrices = checkpointed(matrices.withColumn("span", F.floor(F.col("block") / SPAN)))
    spanned = ["key", "span"]
    spans = matrices.repartition(*spanned).sortWithinPartitions(*spanned, "block").mapInArrow(
        _by_key(spanned, span, [*spanned, "m"], [pa.string(), pa.int64(), pa.list_(pa.float64())]),
        "key string, span long, m array<double>")
    fixed = spans.repartition("key").sortWithinPartitions(*spanned).mapInArrow(
        _by_key(["key"], scan, [*spanned, "entry", "leave"],
                [pa.string(), pa.int64(), pa.int32(), pa.int32()]),
        "key string, span long, entry int, leave int")
    ends = matrices.join(fixed, spanned).repartition(*spanned).sortWithinPartitions(
        *spanned, "block").mapInArrow(
        _by_key(spanned, inside, [*keys, "entry", "leave"],
                [pa.string(), pa.int64(), pa.int32(), pa.int32()]),
        "key string, block long, entry int, leave int")
    placed = found.join(ends, keys).repartition(*keys).sortWithinPartitions(*keys, "pos")
    names = [*keys[:1], "conv", "block", "starts", "turn", "role", "role_pred", "marker", "body"]
    types = [pa.string(), to_arrow_type(conv_type), pa.int64(), pa.int64(), pa.int64(),
             *[pa.string()] * 4]
    return placed.mapInArrow(
        _by_key(keys, path, names, types),
        f"key string, conv {kind}, block long, starts long, turn long, role string, "
        "role_pred string, marker string, body string")


def turns(pieces: DataFrame) -> DataFrame:
    """One row a turn: key, seq (1, 2, ... in its transcript), head, body."""
    begun = pieces.groupBy("key", "block").agg(F.max("starts").alias("n"))
    earlier = Window.partitionBy("key").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    begun = begun.select("key", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("off"))
    parts = pieces.join(begun, ["key", "block"]).withColumn("seq", F.col("off") + F.col("starts"))
    bodies = F.array_sort(F.collect_list(F.when(
        F.col("body").isNotNull(), F.struct("block", "body"))))
    return parts.groupBy("key", "seq").agg(
        F.min_by(F.struct("conv", "turn", "role", "role_pred", "marker"), "block").alias("head"),
        F.array_join(F.transform(bodies, lambda x: x["body"]), "\n").alias("body"))


def render(role: Column, body: Column) -> Column:
    """The canonical form of one turn."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), body, F.lit("\n<|end|>\n"))


def format_chats(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text",
                 role: str | None = "role", train: Column | None = None,
                 model: RoleModel | None = None) -> DataFrame:
    """One row a rendered turn: conv_id, turn, seq, role, role_pred, marker, rendered.

    ``turn``, ``role`` and ``marker`` are those of the turn's first line; ``seq``
    numbers the turns of a transcript.  ``role`` is the role of a row that is one
    message, or for a row of several an array with the state of each line.  It is
    only read from the rows that ``train`` picks (a condition on the column
    ``conv``); it is never an observation.
    """
    found = checkpointed(lines(rows, conv, turn, text, role))
    if model is None:
        model = learn(found, F.lit(True) if train is None else train)
    done = turns(checkpointed(decode(found, model)))
    body = F.regexp_replace("body", r"^\s+|\s+$", "")
    return done.select(F.col("head.conv").alias("conv_id"), "head.turn", "seq", "head.role",
                       "head.role_pred", "head.marker",
                       render(F.col("head.role_pred"), body).alias("rendered"))
