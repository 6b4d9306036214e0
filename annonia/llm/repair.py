"""Cheapest repair of broken conversations, by dynamic programming with checkpoints.

A sound conversation has the role initials ``(s?(ua)+)?``. Edits: Keep a row (0), give it the role
user or assistant (Rerole, 3), Delete it (4; required for blank rows and duplicates), Insert a turn
without text (3); a truncated row that stays costs 3 more. Of the cheapest repairs the one whose edits
read least in ASCII is taken.

Equal rows are counted first, so repeats of one row are one item. All items are sorted by conversation and turn
over ranges, so a conversation of any length is spread over tasks, and cut into blocks. A block
gives a small matrix: the least cost from each state before it to each state after it. The
matrices, taken from the last block to the first, give the vector of costs to the end at each block's
end: the checkpoints. From its checkpoint each block computes its own vectors again, keeping one in every
square root of its length and those between them only while it walks there, and walks forward
along tight edits from each of the four states. Chaining the blocks' ends picks one walk for each block.

Input: ``conv_id``, ``turn``, ``role``, ``text``, one row a turn. Null roles and texts count as one space
(so a null text is blank). Rows are taken by turn (null first), then role, then the SHA-256 of the text; equal rows are
turns of their own; rows with a null conv_id form one conversation; an empty table gives no rows; other
columns are ignored. A role is told by its first character; one without any fits nowhere. The edits of a
conversation are one string in the result, one character an edit; the digest reads its rows as a stream."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import isqrt
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .store import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Items of a block.
BLOCK_BITS = 10
FAR = 1 << 60
#: States: nothing yet, after the system turn, after a user, after an assistant. The role to come next, the state it leads to, and whether one may end there.
NEXT_ROLE, NEXT_STATE, ENDS = ("u", "u", "a", "u"), (2, 2, 3, 2), (True, False, False, True)
NAMES = {"u": "user", "a": "assistant"}
#: Faults, and what stands for them in an item's code.
BLANK, DUPLICATE, CUT, SOUND = "b", "d", "t", "-"
_SOLID = r"[^\x20\x09-\x0D]"


# ---- one block: items are two characters, the fault and the role's initial ----


def _inserted(costs: list[int]) -> list[int]:
    """Costs from each state once turns may be inserted there."""
    once = [min(costs[s], INSERT + costs[NEXT_STATE[s]]) for s in range(4)]
    return [min(once[s], INSERT + once[NEXT_STATE[s]]) for s in range(4)]


#: Least costs from each state where no row is left.
END = _inserted([0 if e else FAR for e in ENDS])


def _kept(state: int, initial: str) -> int | None:
    """The state after a row that is kept, if it may be."""
    if initial == "s":
        return 1 if state == 0 else None
    return NEXT_STATE[state] if initial == NEXT_ROLE[state] else None


def _before(item: str, costs: list[int]) -> list[int]:
    """Costs before an item from those after it."""
    fault, initial = item
    if fault in (BLANK, DUPLICATE):
        return [c + DELETE for c in costs]  # inserting before or after it costs the same
    more = TRUNCATED if fault == CUT else 0
    out = []
    for s in range(4):
        best = min(DELETE + costs[s], REROLE + more + costs[NEXT_STATE[s]])
        to = _kept(s, initial)
        out.append(best if to is None else min(best, KEEP + more + costs[to]))
    return _inserted(out)


def matrix(items: list[str]) -> list[int]:
    """Least costs from each state before the items to each state after them, row by row."""
    columns = []
    for end in range(4):
        costs = [0 if s == end else FAR for s in range(4)]
        for item in reversed(items):
            costs = _before(item, costs)
        columns.append(costs)
    return [min(FAR, columns[end][s]) for s in range(4) for end in range(4)]


def _tight(item: str, state: int, cost: int, after: list[int]) -> tuple[str, int]:
    """The least tight edits up to and with an item, and the state after it. D < I < K < R in ASCII."""
    fault, initial = item
    more = TRUNCATED if fault == CUT else 0
    edits = ""
    while True:
        if DELETE + after[state] == cost:
            return edits + "D", state
        # an insertion is tight if the rest is as cheap from where it leads
        to = NEXT_STATE[state]
        if fault not in (BLANK, DUPLICATE) and INSERT + _before(item, after)[to] == cost:
            edits, cost, state = edits + "I", cost - INSERT, to
            continue
        kept = _kept(state, initial)
        if kept is not None and KEEP + more + after[kept] == cost:
            return edits + "K", kept
        return edits + "R", to


def walk(items: list[str], end: list[int], state: int) -> tuple[list[str], list[int], int]:
    """Edits at each item and the state before them, and the last state, given the costs after the items.

    Costs are kept at every ``isqrt(n)``-th item; those between are computed again, stretch by stretch."""
    n = len(items)
    step = max(1, isqrt(n))
    marks = {n: end}
    costs = end
    for i in range(n - 1, -1, -1):
        costs = _before(items[i], costs)
        if i % step == 0:
            marks[i] = costs
    edits, states = [], []
    for a in range(0, n, step):
        b = min(n, a + step)
        stretch = [marks[b]]
        for i in range(b - 1, a - 1, -1):
            stretch.append(_before(items[i], stretch[-1]))
        stretch.reverse()
        for i in range(a, b):
            states.append(state)
            done, state = _tight(items[i], state, stretch[i - a][state], stretch[i - a + 1])
            edits.append(done)
    return edits, states, state


def last_inserts(state: int) -> int:
    """Turns to insert after the last row."""
    return 0 if ENDS[state] else 1 if NEXT_ROLE[state] == "a" else 2


# ---- columns ----


def _order(turn: Column) -> Column:
    return F.struct(turn.isNotNull().alias("known"), F.coalesce(turn, F.lit(0)).alias("turn"))


def _joined(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join on columns of the same names, in which nulls are equal."""
    right = b.withColumnsRenamed({c: f"_{c}" for c in on})
    return a.join(right, reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on)), how).drop(*(f"_{c}" for c in on))


def _plain(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.select(*(rows[c].cast("long").alias(c) for c in ("conv_id", "turn")), *(F.coalesce(rows[c].cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), *more)


def items(rows: DataFrame, times: str | None = None) -> DataFrame:
    """Distinct rows with their number ``n``, fault and initial, and ``at``, a number in the order of the rows.

    The column ``times``, if named, says how often a row counts; 0 keeps its conversation only."""
    plain = _plain(rows, (rows[times] if times else F.lit(1)).cast("long").alias("n"))
    distinct = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumns({"digest": F.sha2("text", 256), "when": _order(F.col("turn"))})
    # the first place of each role and text; the join's keys are unique on both sides, so no text makes it uneven
    first = distinct.where("n > 0").groupBy("conv_id", "role", "digest").agg(F.min("when").alias("when"))
    joined = _joined(distinct, first.withColumn("first", F.lit(True)), ["conv_id", "role", "digest", "when"], "left").drop("when")
    ends = F.regexp_extract("text", rf"({_SOLID})[\x20\x09-\x0D]*\z", 1)
    fault = F.when(~F.rlike("text", F.lit(_SOLID)), BLANK).when(F.col("first").isNull(), DUPLICATE).when(ends.isin(".", "!", "?"), SOUND).otherwise(CUT)
    ordered = joined.withColumns({"fault": fault, "initial": F.substring("role", 1, 1)})
    turn_order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    return written(ordered.repartitionByRange(*turn_order).sortWithinPartitions(*turn_order).drop("first", "digest").withColumn("at", F.monotonically_increasing_id()))


def _mapped(df: DataFrame, schema: str, one) -> DataFrame:
    """A function of a row's values, each of whose results is a row."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 32):  # a row may be a whole block
                out = [r for row in batch.slice(k, 32).to_pylist() for r in one(**row)]
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=kinds)

    kinds = to_arrow_schema(_parse_datatype_string(schema))
    return df.mapInArrow(run, schema)


_ENDS = "conv_id long, block long, first string, last string, illegal long, extra long, costs array<long>"
_CHECKPOINTS = "conv_id long, block long, cost long, illegal long, after array<long>"
_WALKS = "conv_id long, block long, edits array<array<string>>, states array<array<int>>, ends array<int>"
_STARTS = "conv_id long, block long, state int, final boolean"


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _ends(conv_id, block, items):
    codes = [(i["fault"] + (i["initial"] or "-"), i["n"], i["initial"]) for i in items]
    yield conv_id, block, codes[0][2], codes[-1][2], _illegal([c[2] for c in codes]), sum(n - 1 for _, n, _ in codes), matrix([c[0] for c in codes])


def _checkpoints(conv_id, blocks):
    """Costs to the end from the end of each block, and of the whole conversation (a row a block; the first has the totals)."""
    after, rows = END, []
    for b in reversed(blocks):
        rows.append((b["block"], after))
        after = [min(b["costs"][4 * s + t] + after[t] for t in range(4)) for s in range(4)]
    extra = sum(b["extra"] for b in blocks)  # copies of a row beside it: same initials, to be deleted
    illegal = extra + sum(b["illegal"] for b in blocks) + sum(_illegal([x["last"], y["first"]]) for x, y in zip(blocks, blocks[1:]))
    for k, (block, end) in enumerate(reversed(rows)):
        yield conv_id, block, after[0] + DELETE * extra if k == 0 else 0, illegal if k == 0 else 0, end


def _walks(conv_id, block, items, after):
    codes = [i["fault"] + (i["initial"] or "-") for i in items]
    edits, states, ends = zip(*(walk(codes, after, s) for s in range(4)))
    repeats = ["D" * (i["n"] - 1) for i in items]
    yield conv_id, block, [[e + r for e, r in zip(each, repeats)] for each in edits], [list(s) for s in states], list(ends)


def _starts(conv_id, blocks):
    state = 0
    for k, b in enumerate(blocks):
        yield conv_id, b["block"], state, k == len(blocks) - 1
        state = b["ends"][state]


def _by_conversation(df: DataFrame, *columns: str) -> DataFrame:
    """One row a conversation with its blocks in order: a few numbers for each 1,024 rows of it."""
    return df.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", *columns))).alias("blocks"))


_ONE_BLOCK = ["conv_id", "block"]


def repair(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``items``: the conversations (conv_id, faults, illegal, cost, audit), and the edits (at, edits, state before, final) item by item."""
    live = found.where("n > 0").withColumn("block", F.shiftright("at", BLOCK_BITS))
    blocks = written(live.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("at", "fault", "initial", "n"))).alias("items")))
    ends = _mapped(blocks.select("conv_id", "block", "items"), _ENDS, _ends)
    marks = written(_mapped(_by_conversation(ends, "first", "last", "illegal", "extra", "costs"), _CHECKPOINTS, _checkpoints))
    walks = written(_mapped(_joined(blocks, marks, _ONE_BLOCK).select(*_ONE_BLOCK, "items", "after"), _WALKS, _walks))
    starts = _mapped(_by_conversation(walks.select("conv_id", "block", "ends"), "ends"), _STARTS, _starts)
    # of the four walks of a block the one from its true state
    chosen = _joined(walks, starts, _ONE_BLOCK).select(*_ONE_BLOCK, F.col("edits")[F.col("state")].alias("edits"), F.col("states")[F.col("state")].alias("states"), F.col("ends")[F.col("state")].alias("end"), "final")
    inserts = F.when(~F.col("final"), "").otherwise(F.get(F.array(*(F.lit("I" * last_inserts(s)) for s in range(4))), F.col("end")))
    chosen = written(chosen.withColumn("inserts", inserts))
    per_block = chosen.select("conv_id", F.struct("block", F.concat(F.array_join("edits", ""), "inserts").alias("edits")).alias("part"))
    audits = per_block.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["edits"]), "").alias("audit"))
    totals = marks.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    first = F.col("fault").isin(SOUND, CUT)
    count = lambda fault, n: F.sum(F.when(F.col("fault") == fault, n).otherwise(0))
    known = F.when(F.col("n") > 0, F.col("turn"))
    stats = found.groupBy("conv_id").agg(
        F.coalesce(F.max(known) - F.min(known) + 1 - F.count_distinct(known), F.lit(0)).alias("gaps"),
        count(BLANK, F.col("n")).alias("blank"),
        (count(DUPLICATE, F.col("n")) + F.sum(F.when(first & (F.col("n") > 0), F.col("n") - 1).otherwise(0))).alias("duplicate"),
        F.sum(F.when((F.col("fault") == CUT) & (F.col("n") > 0), 1).otherwise(0)).alias("truncated"),
    )
    out = _joined(_joined(stats, totals, ["conv_id"], "left"), audits, ["conv_id"], "left")
    zero = F.lit(0).cast("long")
    conversations = out.select("conv_id", "gaps", "blank", "duplicate", "truncated", F.coalesce("illegal", zero).alias("illegal"), F.coalesce("cost", zero).alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"))
    at = _joined(blocks, chosen, _ONE_BLOCK).select(F.explode(F.arrays_zip(F.col("items.at").alias("at"), "edits", "states")).alias("e"), F.element_at("items.at", -1).alias("last"), "end", "inserts")
    tail = F.col("e.at") == F.col("last")
    edits = at.select("e.at", "e.edits", F.col("e.states").alias("state"), F.when(tail, F.col("inserts")).otherwise("").alias("inserts"), F.col("end"))
    return conversations, edits


def repaired(found: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, at, k, turn (null where inserted), role, text, in the order of ``at`` and ``k``."""
    rows = found.where("n > 0").select("conv_id", "at", "turn", "role", "text").join(edits, "at")
    step = F.struct(F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit("").alias("text"))
    # the state after k inserted turns, and so each turn's role
    role_at = F.array(*(F.lit(NAMES[r]) for r in NEXT_ROLE))
    goes_to = F.array(*map(F.lit, NEXT_STATE))

    def inserted(n: Column, state: Column) -> Column:
        first, second = F.get(role_at, state), F.get(role_at, F.get(goes_to, state))
        turns = F.transform(F.array(first, second), lambda r: step.withField("role", r))
        return F.slice(turns, F.lit(1), n)

    ahead = F.length("edits") - F.length(F.ltrim(F.col("edits"), F.lit("I")))
    own = F.substring(F.ltrim(F.col("edits"), F.lit("I")), F.lit(1), F.lit(1))
    state = F.col("state")
    there = F.when(ahead == 0, state).when(ahead == 1, F.get(goes_to, state)).otherwise(F.get(goes_to, F.get(goes_to, state)))
    row = F.struct("turn", F.when(own == "R", F.get(role_at, there)).otherwise(F.col("role")).alias("role"), "text")
    all_turns = F.concat(inserted(ahead, state), F.when(own == "D", F.array().cast("array<struct<turn:long,role:string,text:string>>")).otherwise(F.array(row)), inserted(F.length("inserts"), F.col("end")))
    return rows.select("conv_id", "at", F.posexplode(all_turns).alias("k", "t")).select("conv_id", "at", "k", "t.*")


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines; a conversation is read as a stream, so none is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if now != (conv,):
                    if now is not None:
                        done.append((now[0], digest.hexdigest()))
                    now, digest = (conv,), hashlib.sha256(line.encode())
                else:
                    digest.update(b"\n" + line.encode())
            yield pa.record_batch([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["conv_id", "repaired_sha256"])
        if now is not None:
            yield pa.record_batch([pa.array([now[0]], pa.int64()), pa.array([digest.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    lines = turns.select("conv_id", "at", "k", F.concat_ws(":", "role", "text").alias("line"))
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "at", "k").select("conv_id", "line").mapInArrow(run, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults planted by a checksum of conversation and turn; ``n`` is 0 for dropped and 2 for repeated rows."""
    plain = _plain(rows)
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    return plain.withColumn("kind", kind).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("n"),
    )


def audited(rows: DataFrame, times: str | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    found = items(rows, times)
    conversations, edits = repair(found)
    made = digests(repaired(found, edits))
    empty = hashlib.sha256(b"").hexdigest()
    return _joined(conversations, made, ["conv_id"], "left").withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(empty)))
