"""Conversation repair as shortest paths, found by auction.

The turns of a conversation, in order, span a lattice: a node is (turns read, state of the
role pattern ``(s?(ua)+)?``), an arc is an edit with an integer cost, the target lies behind
the last turn in an accepting state.  Costs are fixed: Keep 0, Rerole to user or assistant 1,
Delete 2, Insert an empty user or assistant turn 5, and 5 more for a truncated turn that is
not deleted; blank and repeated turns can only be deleted.

**Auction.**  Every node has a price, at first the least of the layer behind it, which never exceeds
cost + price along an arc.  A path grows from an origin: where its end has an arc without slack, the path is
extended along it; otherwise the end's price rises to the least cost + price and the path
contracts.  It stops at a node whose price is known to be exact.  Origins are taken from the
last layer to the first and keep the prices, so each takes a few steps.  At the end a node's
price is its distance to the target, the arcs without slack are the ones of shortest paths,
and following the least letter along them traces the least of all cheapest edit strings.

**In Spark.**  Equal turns are counted before any shuffle by key.  Turns are sorted by range of
(conversation, turn, beginning of role and text), so a conversation with a third of all rows
spreads over many tasks, and a map over each sorted partition repairs the conversations that
lie within it, one at a time.  Those that may cross a border, or are long, are left as
fragments of bounded size.  A fragment is a 4 x 4 matrix of distances between states (one
auction a target state); the matrices of a conversation are combined from its end, each
fragment is then traced from each state with exact prices behind it, and the states are
chained from the start.  Only the SHA-256 of a repaired conversation, which cannot be split, is
taken in one stream, in constant memory.

Defined results.  NULL roles and texts are one space.  Order: turn, NULL first; equal turns by
role, then text (bytes).  Equal rows are copies: all but the first are duplicates.  A NULL
conversation is one of its own.  ``gaps`` counts missing turn numbers between the first and the
last and is NULL beyond a long.  An empty table gives empty results.  Other columns of the
input are not used.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from orderlens.llm.common import written

ROWS, BYTES = 20_000, 8 << 20  # of one fragment: no limit of a conversation
SPACE = " \t\n\v\f\r"

RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired turns so far end with
KEEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FAR = 1 << 50  # farther than any real distance
ENDS = (0, FAR, FAR, 0)
LEGAL = {"su", "ua", "au"}


def follower(state: int) -> int:
    """The state behind a turn whose role is free to choose."""
    return ASSISTANT if state == USER else USER


# --- lattice ----------------------------------------------------------------------------------

# A step is a turn that may be kept, as the first letter of its role (``o`` for others; in
# capitals where truncated), or the number of turns in a row that must be deleted.


def arcs(steps: list, k: int, state: int):
    """(letter, cost, layer, state) of each edit at a node, by letter."""
    if k < len(steps):
        step = steps[k]
        if isinstance(step, int):
            yield "D", DELETE * step, k + 1, state
        else:
            yield "D", DELETE, k + 1, state
    yield "I", INSERT, k, follower(state)
    if k < len(steps) and not isinstance(step, int):
        more = TRUNCATED if step.isupper() else 0
        kept = KEEPS.get(step.lower(), {}).get(state)
        if kept is not None:
            yield "K", more, k + 1, kept
        yield "R", RETYPE + more, k + 1, follower(state)


def prices(steps: list, ends=ENDS) -> list[list[int]]:
    """Distances of all nodes to a target that lies ``ends[state]`` behind the last layer, by auction."""
    last = len(steps)
    price = [[0] * 4 for _ in range(last + 1)]
    exact = [[False] * 4 for _ in range(last + 1)]
    # States only move on: where the target can be reached from START or SYSTEM alone, the states behind never lead there.
    for closed in (SYSTEM, USER):
        if all(e >= FAR for e in ends[closed:]):
            for k in range(last + 1):
                for state in range(closed, 4):
                    price[k][state], exact[k][state] = FAR, True
            break
    for k in range(last, -1, -1):
        # Every path passes the next layer, so its least price bounds this one's; without that, prices would climb from 0.
        least = min(price[k + 1] if k < last else ends)
        price[k] = [p if known else least for p, known in zip(price[k], exact[k])]
        for state in range(4):
            if exact[k][state]:
                continue
            path = [(k, state)]
            while True:
                at, q = path[-1]
                best, to = (ends[q], None) if at == last else (FAR * 4, None)
                for _, cost, layer, s in arcs(steps, at, q):
                    if cost + price[layer][s] < best:
                        best, to = cost + price[layer][s], (layer, s)
                if price[at][q] < best:
                    price[at][q] = best
                    if len(path) > 1:
                        path.pop()
                elif to is None or exact[to[0]][to[1]]:
                    break
                else:
                    path.append(to)
            for at, q in path:
                exact[at][q] = True
    return price


def trace(steps: list, price: list[list[int]], state: int, ends=ENDS) -> tuple[str, int]:
    """Letters of the least cheapest path from ``state``, and the state behind the last turn."""
    out, k = [], 0
    while k < len(steps) or price[k][state] < ends[state]:
        for letter, cost, layer, s in arcs(steps, k, state):
            if price[k][state] == cost + price[layer][s]:
                out.append(letter * (steps[k] if layer > k and isinstance(steps[k], int) else 1))
                k, state = layer, s
                break
        else:
            raise ArithmeticError("no arc without slack")
    return "".join(out), state


def matrix(steps: list) -> list[int]:
    """Distances from each state before to each state behind, by rows."""
    by_target = [prices(steps, tuple(0 if s == t else FAR for s in range(4)))[0] for t in range(4)]
    return [by_target[t][s] for s in range(4) for t in range(4)]


@lru_cache(20_000)
def _solved(steps: tuple) -> tuple[int, str]:
    price = prices(list(steps))
    return price[0][START], trace(list(steps), price, START)[0]


def cheapest(steps: list) -> tuple[int, str]:
    """Cost and letters of a whole conversation; short ones are remembered."""
    return (_solved if len(steps) <= 40 else _solved.__wrapped__)(tuple(steps))


def applied(rows, letters: str, state: int = START):
    """(letter, role, text) of the turns that stay; ``rows`` are (step of the first copy or '', further deletions, role, text)."""
    at = 0

    def inserted():
        nonlocal at, state
        while letters[at:at + 1] == "I":
            at += 1
            state = follower(state)
            yield "I", "assistant" if state == ASSISTANT else "user", ""

    for free, forced, role, text in rows:
        if free:
            yield from inserted()
            letter, at = letters[at], at + 1
            if letter == "K":
                state = KEEPS[free.lower()][state]
                yield letter, role, text
            elif letter == "R":
                state = follower(state)
                yield letter, "assistant" if state == ASSISTANT else "user", text
        if forced:
            yield from inserted()
            at += forced
    yield from inserted()


def steps_of(rows) -> list:
    return [s for free, forced, *_ in rows for s in (free, forced) if s]


class Digest:
    """SHA-256 of ``role:text`` lines without a last newline."""

    def __init__(self):
        self.hash, self.empty = hashlib.sha256(), True

    def add(self, role: str, text: str) -> None:
        self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False


# --- rows -------------------------------------------------------------------------------------


def _faults(turns: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """One row for equal turns: conv, turn, role, text, copies, blank, first (no equal role and text before), truncated."""
    rows = turns.select(
        conv.alias("conv"), turn.alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"),
    ).groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    ended = F.rtrim("text", F.lit(SPACE))
    rows = rows.withColumns({
        "blank": ended == "", "truncated": ~F.right(ended, F.lit(1)).isin(".", "!", "?"),
        "place": F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn")), "key": F.unhex(F.sha2("text", 256)),
    })
    # Only what occurs in several turns comes back to the rows.
    again = rows.filter(~F.col("blank")).groupBy("conv", "role", "key").agg(F.min("place").alias("first_place"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    a, b = rows.alias("a"), again.alias("b")
    same = F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.key") == F.col("b.key"))
    first = F.col("b.first_place").isNull() | (F.col("b.first_place") == F.col("a.place"))
    return a.join(b, same, "left").select("a.*", first.alias("first")).drop("place", "key")


def _counts(rows: DataFrame) -> DataFrame:
    later = F.when(F.col("blank"), 0).when(F.col("first"), F.col("copies") - 1).otherwise(F.col("copies"))
    by_turn = rows.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"), F.sum(later).alias("duplicate"),
        F.sum((~F.col("blank") & F.col("first") & F.col("truncated")).cast("long")).alias("truncated"),
    )
    wide = F.max(F.col("turn").cast("decimal(38,0)")) - F.min(F.col("turn").cast("decimal(38,0)")) + 1 - F.count("turn")
    return by_turn.groupBy("conv").agg(
        F.coalesce(wide, F.lit(0)).try_cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )


def _codes(rows: DataFrame) -> DataFrame:
    """The step of the first copy (empty where it must go), the deletions behind it, the role's first letter."""
    initial = F.left("role", F.lit(1))
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    stays = ~F.col("blank") & F.col("first")
    return rows.select(
        "conv", "turn", "role", "text", F.when(~stays, "").when(F.col("truncated"), F.upper(kind)).otherwise(kind).alias("free"),
        (F.col("copies") - stays.cast("long")).alias("forced"), initial.alias("initial"), "copies",
    )


def illegal_pairs(rows, before: str | None) -> tuple[int, str | None]:
    """Neighbours that may not follow each other; ``rows`` are (initial, copies), ``before`` the initial ahead of them."""
    count = 0
    for initial, copies in rows:
        count += copies - 1 + (before is not None and before + initial not in LEGAL)
        before = initial
    return count, before


TURN, DONE, OPEN = range(3)  # kinds of rows that the sorted map makes


def _sorted_schema(kind) -> StructType:
    fields = "kind int, part int, chunk long, seq long, letter string, role string, text string, free string, forced long, initial string, copies long, illegal long, cost long, audit string, digest string"
    return StructType([StructField("conv", kind), *StructType.fromDDL(fields).fields])


def _sorted_map(schema: StructType):
    def run(batches):
        names, arrow = schema.names, to_arrow_schema(schema)
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        held: list[tuple] = []  # rows of the conversation at hand
        size = chunk = chunk_rows = chunk_bytes = seq = 0
        current, is_open, begun = None, True, False

        def left_open(row):
            nonlocal chunk, chunk_rows, chunk_bytes, seq
            conv, role, text, free, forced, initial, copies = row
            if chunk_rows and (chunk_rows >= ROWS or chunk_bytes + len(text) > BYTES):
                chunk, chunk_rows, chunk_bytes = chunk + 1, 0, 0
            chunk_rows, chunk_bytes, seq = chunk_rows + 1, chunk_bytes + len(text), seq + 1
            out.append(dict(conv=conv, kind=OPEN, part=part, chunk=chunk, seq=seq, role=role, text=text, free=free, forced=forced, initial=initial, copies=copies))

        def close():
            nonlocal seq
            rows = [(free, forced, role, text) for _, role, text, free, forced, _, _ in held]
            cost, letters = cheapest(steps_of(rows))
            digest = Digest()
            for letter, role, text in applied(rows, letters):
                seq += 1
                digest.add(role, text)
                out.append(dict(conv=current, kind=TURN, part=part, chunk=0, seq=seq, letter=letter, role=role, text=text))
            illegal, _ = illegal_pairs([(r[5], r[6]) for r in held], None)
            out.append(dict(conv=current, kind=DONE, part=part, illegal=illegal, cost=cost, audit=letters, digest=digest.hash.hexdigest()))

        def flushed():
            table = pa.RecordBatch.from_pydict({n: [r.get(n) for r in out] for n in names}, schema=arrow)
            out.clear()
            return table

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or row[0] != current:
                    if begun and not is_open:
                        close()
                    # The first conversation may have begun in the partition before.
                    is_open, begun, current, size = not begun, True, row[0], 0
                    held.clear()
                if not is_open:
                    held.append(row)
                    size += len(row[2])
                    if len(held) > ROWS or size > BYTES:
                        is_open = True
                        for h in held:
                            left_open(h)
                        held.clear()
                else:
                    left_open(row)
                if len(out) >= 2_000:
                    yield flushed()
        for h in held:  # the last one may go on in the next partition
            left_open(h)
        if out:
            yield flushed()

    return run


def _like(df: DataFrame, fields: str) -> StructType:
    return StructType([StructField("conv", df.schema["conv"].dataType), *StructType.fromDDL(fields).fields])


def _table(schema: StructType, columns: dict) -> pa.Table:
    return pa.Table.from_pydict(columns, schema=to_arrow_schema(schema))


def _fragments(codes: DataFrame) -> DataFrame:
    """A row a fragment: its matrix, its illegal pairs and its first and last initial."""
    schema = _like(codes, "part int, chunk long, m array<long>, illegal long, head string, tail string")

    def run(key, table):
        rows = table.sort_by("seq")
        free, forced, initial, copies = (rows.column(c).to_pylist() for c in ("free", "forced", "initial", "copies"))
        illegal, tail = illegal_pairs(zip(initial, copies), None)
        conv, part, chunk = (k.as_py() for k in key)
        return _table(schema, dict(conv=[conv], part=[part], chunk=[chunk], m=[matrix(steps_of(zip(free, forced)))], illegal=[illegal], head=[initial[0]], tail=[tail]))

    return codes.groupBy("conv", "part", "chunk").applyInArrow(run, schema)


def _behind(fragments: DataFrame) -> DataFrame:
    """Exact prices behind each fragment; the conversation's cost and illegal pairs with its first one."""
    schema = _like(fragments, "part int, chunk long, ends array<long>, cost long, illegal long")

    def run(key, table):
        rows = table.sort_by([("part", "ascending"), ("chunk", "ascending")]).to_pylist()
        ends, behind = [list(ENDS)], list(ENDS)
        for r in rows[::-1]:
            m = r["m"]
            behind = [min(FAR, min(m[4 * s + t] + behind[t] for t in range(4))) for s in range(4)]
            ends.append(behind)
        ends.reverse()
        illegal = sum(r["illegal"] for r in rows) + sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(rows, rows[1:]))
        none = [None] * (len(rows) - 1)
        return _table(schema, dict(
            conv=[r["conv"] for r in rows], part=[r["part"] for r in rows], chunk=[r["chunk"] for r in rows], ends=ends[1:],
            cost=[ends[0][START], *none], illegal=[illegal, *none],
        ))

    return fragments.groupBy("conv").applyInArrow(run, schema)


def _traced(codes: DataFrame, behind: DataFrame) -> DataFrame:
    """Letters and next state of each fragment from each state."""
    schema = _like(codes, "part int, chunk long, letters array<string>, states array<int>")

    def run(key, left, right):
        rows, ends = left.sort_by("seq"), tuple(right.column("ends")[0].as_py())
        steps = steps_of(zip(rows.column("free").to_pylist(), rows.column("forced").to_pylist()))
        price = prices(steps, ends)
        found = [trace(steps, price, s, ends) if price[0][s] < FAR else ("", s) for s in range(4)]
        conv, part, chunk = (k.as_py() for k in key)
        return _table(schema, dict(conv=[conv], part=[part], chunk=[chunk], letters=[[f[0] for f in found]], states=[[f[1] for f in found]]))

    keys = ("conv", "part", "chunk")
    return codes.groupBy(*keys).cogroup(behind.groupBy(*keys)).applyInArrow(run, schema)


def _chosen(traced: DataFrame) -> DataFrame:
    """The state before each fragment and its letters."""
    schema = _like(traced, "part int, chunk long, before int, letters string")

    def run(key, table):
        rows, state = table.sort_by([("part", "ascending"), ("chunk", "ascending")]).to_pylist(), START
        before, letters = [], []
        for r in rows:
            before.append(state)
            letters.append(r["letters"][state])
            state = r["states"][state]
        return _table(schema, dict(conv=[r["conv"] for r in rows], part=[r["part"] for r in rows], chunk=[r["chunk"] for r in rows], before=before, letters=letters))

    return traced.groupBy("conv").applyInArrow(run, schema)


def _rest(opened: DataFrame, chosen: DataFrame) -> DataFrame:
    """The turns that stay of each fragment."""
    schema = _like(opened, "part int, chunk long, seq long, letter string, role string, text string")

    def run(key, left, right):
        rows = left.sort_by("seq")
        values = list(zip(*(rows.column(c).to_pylist() for c in ("free", "forced", "role", "text"))))
        kept = list(applied(values, right.column("letters")[0].as_py(), right.column("before")[0].as_py()))
        conv, part, chunk = (k.as_py() for k in key)
        n = len(kept)
        columns = dict(zip(("letter", "role", "text"), map(list, zip(*kept)))) if kept else dict(letter=[], role=[], text=[])
        return _table(schema, dict(conv=[conv] * n, part=[part] * n, chunk=[chunk] * n, seq=list(range(n)), **columns))

    keys = ("conv", "part", "chunk")
    return opened.groupBy(*keys).cogroup(chosen.groupBy(*keys)).applyInArrow(run, schema)


def _digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's lines, streamed in order."""
    schema = _like(turns, "digest string")
    ordered = turns.repartition("conv").sortWithinPartitions("conv", "part", "chunk", "seq").select("conv", "role", "text")

    def run(batches):
        current, digest = None, None
        for batch in batches:
            done = []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is None or conv != current:
                    if digest is not None:
                        done.append((current, digest.hash.hexdigest()))
                    current, digest = conv, Digest()
                digest.add(role, text)
            if done:
                yield from _table(schema, dict(conv=[c for c, _ in done], digest=[d for _, d in done])).to_batches()
        if digest is not None:
            yield from _table(schema, dict(conv=[current], digest=[digest.hash.hexdigest()])).to_batches()

    return ordered.mapInArrow(run, schema)


@dataclass
class Repaired:
    turns: DataFrame  #: conversation, part, chunk, seq (their order), letter (K, R or I), role, text
    summary: DataFrame  #: conversation, gaps, blank, duplicate, truncated, illegal, cost, audit, digest


def repair(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", also: DataFrame | None = None
) -> Repaired:
    """The repaired conversations; ``also`` holds ids (column ``conv_col``) that get a row even without turns."""
    column = lambda c: F.col(f"`{c}`")
    rows = _faults(turns, *map(column, (conv_col, turn_col, role_col, text_col)))
    rows = written(rows, "turns")  # read by the counts, by the sample for the ranges and by the sort
    border = ["conv", F.col("turn").asc_nulls_first(), F.left("role", F.lit(16)), F.left("text", F.lit(32))]
    ordered = _codes(rows).repartitionByRange(*border).sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    schema = _sorted_schema(rows.schema["conv"].dataType)
    found = ordered.select("conv", "role", "text", "free", "forced", "initial", "copies").mapInArrow(_sorted_map(schema), schema)
    found = written(found, "repaired")
    opened = found.filter(F.col("kind") == OPEN)
    codes = opened.select("conv", "part", "chunk", "seq", "free", "forced", "initial", "copies")
    behind = written(_behind(_fragments(codes)), "behind")  # a row a fragment
    chosen = written(_chosen(_traced(codes, behind)), "chosen")
    rest = _rest(opened.select("conv", "part", "chunk", "seq", "free", "forced", "role", "text"), chosen)
    kept = ["conv", "part", "chunk", "seq", "letter", "role", "text"]
    all_turns = found.filter(F.col("kind") == TURN).select(*kept).unionByName(rest.select(*kept))

    # One row an id from what each step knows of it.
    pieces = F.array_sort(F.collect_list(F.struct("part", "chunk", "letters")))  # letters of all its fragments: the audit's own size
    audits = chosen.groupBy("conv").agg(F.array_join(F.transform(pieces, lambda p: p["letters"]), "").alias("audit"))
    sources = [
        _counts(rows), found.filter(F.col("kind") == DONE).select("conv", "illegal", "cost", "audit", "digest"),
        behind.filter(F.col("cost").isNotNull()).select("conv", "cost", "illegal"), audits, _digests(rest),
    ]
    if also is not None:
        sources.append(also.select(column(conv_col).alias("conv")).distinct())
    united = sources[0]
    for s in sources[1:]:
        united = united.unionByName(s, allowMissingColumns=True)
    best = {c: F.max(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    summary = united.groupBy(F.col("conv").alias(conv_col)).agg(
        *[(v if c == "gaps" else F.coalesce(v, F.lit(0))).alias(c) for c, v in best.items()], F.count("blank").alias("seen"),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("digest"), F.lit(hashlib.sha256().hexdigest())).alias("digest"),
    )
    gaps = F.when((F.col("seen") == 0) & F.col("gaps").isNull(), 0).otherwise(F.col("gaps"))
    return Repaired(all_turns.withColumnRenamed("conv", conv_col), summary.withColumn("gaps", gaps).drop("seen"))
