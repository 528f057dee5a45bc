"""Transcript parsing: a hidden Markov model recovers who speaks, then turns are rendered.

The hidden state of a line is a role and whether the line begins a turn.  What is seen is
the line alone: a speaker marker (``User:``, ``[assistant]``, ``Q:`` ...), whether it is
blank, how it ends, its length.  Viterbi finds the best sequence of states, so a turn
without a marker, or a text line that looks like one, is settled by its neighbours.

Scale.  Lines are sorted by conversation and place and cut into blocks of equal size, so
a conversation with a third of all lines is spread over many blocks.  Viterbi is
associative over (max, +) matrices: a block sends the 7 x 6 matrix of the conversations
that it shares with its neighbours; per conversation (as many rows as blocks) the best
states at the block borders are fixed; each block then decodes its lines between them.
Scores are whole numbers, and beside each matrix goes the order in which equally likely
readings are preferred, so the result is that of one pass over the whole conversation,
wherever it is cut.  Turns are numbered over the blocks (a block's count of openings and
what the blocks before it counted), and the parts of a turn are joined by that number;
only turns at a block border are shuffled for it.

Defined results: a NULL text is one blank line; lines with a NULL conversation are one
conversation; NULL turns sort first; lines of one conversation, turn and line sort by a
hash of their text, then by the given role; columns other than conversation, turn, line,
text and the given role are not passed on.  A turn is one row, opened and closed once.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import written

ROLES = ("user", "assistant", "system")
STATES = [(r, b) for r in ROLES for b in (True, False)]  # (role, begins a turn)
START = len(STATES)

#: Names that open a line, by role.
NAMES = {
    "user": ("user", "human", "q", "question", "customer", "prompter"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "model"),
    "system": ("system", "instruction", "context"),
}
_ROLE_OF = {n: r for r, ns in NAMES.items() for n in ns}
MARKER = re.compile(rf"^\s*(?:\[|\*\*|#+\s*|<\|)?({'|'.join(sorted(_ROLE_OF, key=len, reverse=True))})(?:\]\s*:?|:?\*\*\s*:?|\|>|\s*[:>])\s*", re.I)

#: Log-probabilities are kept as whole multiples of 1 / UNIT: their sums do not depend on the order of adding.
UNIT = 1 << 24

#: Probabilities of the model.
P_MARKED, P_WRONG, P_INSIDE_MARK = 0.85, 0.01, 0.002
P_STAY, P_AGAIN, P_SYSTEM = 0.6, 0.02, 0.01


def _transitions() -> np.ndarray:
    """Log-probabilities from each state, or START in the last row, to each state."""
    t = np.full((START + 1, START), 1e-9)
    for i, (r, _) in enumerate(STATES):
        for j, (s, begins) in enumerate(STATES):
            if not begins:
                t[i, j] = P_STAY if r == s else 1e-9
            elif r == s:
                t[i, j] = P_AGAIN
            else:
                t[i, j] = P_SYSTEM if s == "system" else 1 - P_STAY - P_AGAIN - P_SYSTEM
    for j, (s, begins) in enumerate(STATES):
        t[START, j] = {"user": 0.7, "assistant": 0.2, "system": 0.1}[s] if begins else 1e-9
    return np.rint(np.log(t) * UNIT).astype(np.int64)


MOVES = _transitions()


def marker(line: str) -> tuple[str | None, str]:
    """(role of the marker, text behind it)"""
    m = MARKER.match(line)
    return (_ROLE_OF[m[1].lower()], line[m.end():]) if m else (None, line)


def emission(line: str) -> np.ndarray:
    """Log-likelihood of the line's features in each state."""
    said, rest = marker(line)
    blank, asks, long_ = not rest.strip(), rest.rstrip().endswith("?"), len(rest) > 400
    out = np.zeros(START, np.int64)
    for j, (role, begins) in enumerate(STATES):
        if not begins:
            p = P_INSIDE_MARK if said else 1 - 3 * P_INSIDE_MARK
        else:
            p = P_MARKED if said == role else P_WRONG if said else 1 - P_MARKED - 2 * P_WRONG
        p *= (0.02 if said is None and begins else 0.2) if blank else 0.9
        p *= {"user": 0.3, "assistant": 0.1, "system": 0.02}[role] if asks else {"user": 0.7, "assistant": 0.9, "system": 0.98}[role]
        p *= {"user": 0.2, "assistant": 0.5, "system": 0.3}[role] if long_ else {"user": 0.8, "assistant": 0.5, "system": 0.7}[role]
        out[j] = round(math.log(p) * UNIT)
    return out


def matrix(seen: list[np.ndarray]) -> np.ndarray:
    """Two tables, from each state before the lines to each state of the last: best score, and preference.

    Of equally good readings, viterbi() takes the smallest last state, then the smallest
    state before it, and so on; the second table ranks the states before the lines by that.
    """
    m, rank = MOVES + seen[0], np.repeat(np.arange(START + 1)[:, None], START, axis=1)
    for e in seen[1:]:
        all_ = m[:, :, None] + MOVES[None, :START]
        by = all_.argmax(axis=1)
        m = all_.max(axis=1) + e
        rank = (by * (START + 1) + np.take_along_axis(rank, by, axis=1)).argsort(axis=0).argsort(axis=0)
    return np.stack([m, rank])


def viterbi(seen: list[np.ndarray], before: int = START, last: int | None = None) -> list[int]:
    """Best states of the lines, with the state before them and the last one given."""
    score, back = MOVES[before] + seen[0], []
    for e in seen[1:]:
        all_ = score[:, None] + MOVES[:START]
        back.append(all_.argmax(axis=0))
        score = all_.max(axis=0) + e
    state = int(score.argmax()) if last is None else last
    out = [state]
    for b in reversed(back):
        state = int(b[state])
        out.append(state)
    return out[::-1]


def borders(parts: list[np.ndarray]) -> list[tuple[int, int]]:
    """(state before, last state) of each part of one conversation, from the parts' matrices."""
    score, back = parts[0][0, START], []
    for m, rank in parts[1:]:
        all_ = score[:, None] + m[:START]
        score = all_.max(axis=0)
        back.append(np.where(all_ == score, rank[:START], START + 1).argmin(axis=0))
    ends = [int(score.argmax())]
    for b in reversed(back):
        ends.append(int(b[ends[-1]]))
    ends.reverse()
    return list(zip([START, *ends[:-1]], ends))


def flatten(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Transcript lines (conv_id, turn, line, given, text) as people paste them.

    The marker style goes by conversation; one turn in eight has no marker.
    """
    style = F.pmod(F.xxhash64(F.col(conv_col)), F.lit(4))
    role = F.col(role_col)
    names = [{"user": u, "assistant": a, "system": s} for u, a, s in (
        ("User: ", "Assistant: ", "System: "), ("Human: ", "AI: ", "System: "), ("Q: ", "A: ", "Context: "), ("[user] ", "[assistant] ", "[system] "))]
    mark = F.lit("")
    for k, by in enumerate(names):
        for r, text in by.items():
            mark = F.when((style == k) & (role == r), F.lit(text)).otherwise(mark)
    mark = F.when(F.pmod(F.xxhash64(F.col(conv_col), F.col(turn_col)), F.lit(8)) == 0, F.lit("")).otherwise(mark)
    lines = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("given"), mark.alias("mark"),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line", "said"),
    )
    text = F.when(F.col("line") == 0, F.concat("mark", "said")).otherwise(F.col("said"))
    return lines.select("conv_id", "turn", F.col("line").cast("long").alias("line"), "given", text.alias("text"))


def _conversations(table: pa.Table):
    """(conversation, rows) of a block, in order."""
    low = lambda x: (x is not None, x if x is not None else 0)
    rows = table.select(["conv_id", "turn", "line", "given", "text", "tie"]).to_pylist()
    rows.sort(key=lambda r: (low(r["conv_id"]), low(r["turn"]), low(r["line"]), r["tie"], (r["given"] is not None, r["given"] or "")))
    out: list[tuple] = []
    for r in rows:
        if not out or out[-1][0] != r["conv_id"]:
            out.append((r["conv_id"], []))
        out[-1][1].append(r)
    return out


def rendered(role: Column, text: Column) -> Column:
    """The canonical form of a turn."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def recover_roles(lines: DataFrame, block_lines: int = 50_000) -> DataFrame:
    """Recovered turns of ``lines`` (conv_id, turn, line, given, text), one row each.

    Columns: conv_id, turn and line of the first line, ``given`` (its given role, never
    read by the model), ``role``, ``n_lines``, ``continues`` (false: no turn comes in
    parts) and ``rendered``.
    """
    spark = lines.sparkSession
    n = lines.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // block_lines))
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "line")]
    tied = lines.withColumn("tie", F.xxhash64("text"))
    dealt = tied.repartitionByRange(parts, *keys, "tie", F.col("given").asc_nulls_first()).withColumn("block", F.spark_partition_id())
    dealt = written(dealt, "transcript_lines")
    conv_type = dict(lines.dtypes)["conv_id"]
    turn_type = dict(lines.dtypes)["turn"]

    def edges(table: pa.Table) -> pa.Table:
        found = _conversations(table)
        ends = [found[0], found[-1]] if len(found) > 1 else found
        block = table.column("block")[0].as_py()
        return pa.table({
            "conv_id": pa.array([c for c, _ in ends], table.schema.field("conv_id").type), "block": pa.array([block] * len(ends), pa.int32()),
            "m": pa.array([matrix([emission(r["text"] or "") for r in rows]).ravel().tolist() for _, rows in ends], pa.list_(pa.int64())),
        })

    def settle(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        got = borders([np.array(m).reshape(2, START + 1, START) for m in table.column("m").to_pylist()])
        table = table.drop_columns(["m"]).append_column("before", pa.array([a for a, _ in got], pa.int32())).append_column("last", pa.array([b for _, b in got], pa.int32()))
        return table.append_column("more", pa.array([k + 1 < len(got) for k in range(len(got))], pa.bool_()))

    def decode(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {r["conv_id"]: (r["before"], r["last"], r["more"]) for r in right.to_pylist()}
        block = left.column("block")[0].as_py() if left.num_rows else 0
        out = []
        for conv, rows in _conversations(left):
            before, last, more = known.get(conv, (START, None, False))
            states = viterbi([emission(r["text"] or "") for r in rows], before, last)
            opened, previous = 0, before
            for k, (r, s) in enumerate(zip(rows, states)):
                role, begins = STATES[s]
                opens = begins or previous == START or STATES[previous][0] != role
                if opens or k == 0:
                    opened += opens
                    out.append({
                        "conv_id": conv, "turn": r["turn"], "line": r["line"], "given": r["given"], "role": role, "block": block,
                        "opened": opened, "shared": more or before != START, "border": not opens, "text": [],
                    })
                out[-1]["text"].append(marker(r["text"] or "")[1] if begins else r["text"] or "")
                previous = s
            out[-1]["border"] |= more
        types = {"conv_id": left.schema.field("conv_id").type, "turn": left.schema.field("turn").type, "line": pa.int64()}
        return pa.table({
            **{c: pa.array([o[c] for o in out], types.get(c, pa.string())) for c in ("conv_id", "turn", "line", "given", "role")},
            "n_lines": pa.array([len(o["text"]) for o in out], pa.int64()), "text": pa.array(["\n".join(o["text"]) for o in out], pa.string()),
            "block": pa.array([o["block"] for o in out], pa.int32()), "opened": pa.array([o["opened"] for o in out], pa.int64()),
            "shared": pa.array([o["shared"] for o in out], pa.bool_()), "border": pa.array([o["border"] for o in out], pa.bool_()),
        })

    sent = dealt.groupBy("block").applyInArrow(edges, f"conv_id {conv_type}, block int, m array<long>")
    fixed = sent.groupBy("conv_id").applyInArrow(settle, f"conv_id {conv_type}, block int, before int, last int, more boolean")
    found = dealt.groupBy("block").cogroup(fixed.groupBy("block")).applyInArrow(
        decode,
        f"conv_id {conv_type}, turn {turn_type}, line long, given string, role string, n_lines long, text string,"
        " block int, opened long, shared boolean, border boolean",
    )
    found = written(found, "transcript_parts")
    out = ["conv_id", "turn", "line", "given", "role", "n_lines", "text"]
    # Turns opened in the blocks before: one row per block of a conversation that several blocks share.
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counted = found.filter("shared").groupBy("conv_id", "block").agg(F.max("opened").alias("n"))
    counted = counted.select(F.col("conv_id").alias("of"), F.col("block").alias("at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    parts_ = found.filter("border").join(counted, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
    part = F.struct("block", "turn", "line", "given", "role", "n_lines", "text")
    turns = parts_.groupBy("conv_id", (F.col("earlier") + F.col("opened")).alias("number")).agg(F.sort_array(F.collect_list(part)).alias("parts"))
    first = F.col("parts")[0]
    joined = turns.select(
        "conv_id", *[first[c].alias(c) for c in ("turn", "line", "given", "role")],
        F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x["n_lines"]).alias("n_lines"),
        F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("text"),
    )
    whole = found.filter("not border").select(*out).union(joined.select(*out))
    return whole.select(*out[:-1], F.lit(False).alias("continues"), rendered(F.col("role"), F.col("text")).alias("rendered"))
