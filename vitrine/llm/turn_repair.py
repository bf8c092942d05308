"""Repair of conversations: the cheapest edits that give a legal order of roles.

A backward pass finds what the rest of a conversation costs from each state of
the role pattern, a forward pass takes the edits that keep to that cost.  The
cost vectors are kept at checkpoints only: between chunks of rows, which go to
different tasks, and within a chunk at every square root of its rows; what lies
between two checkpoints is computed again on the way forward.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import isqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.scratch import stored

CHUNK_BITS = 12
SPACES = " \t\n\x0b\f\r"
# States of the pattern (s?(ua)+)?: nothing yet, behind s, behind u, behind a.
START, SYSTEM, USER, ASSISTANT = range(4)
KINDS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FOLLOWS = (USER, USER, ASSISTANT, USER)  # what an inserted or changed turn leads to
KEPT = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
# What edits cost.
INSERT, REROLE, DELETE, CUT_OFF = 3, 3, 4, 3
FAR = 1 << 40
Costs = tuple[int, int, int, int]


class Row(NamedTuple):
    """What the edits of a turn depend on."""

    place: int
    kind: int  # state its role leads to, 0 for other roles
    doomed: bool  # blank or duplicate
    extra: int  # cost of leaving it as it ends


class Repaired(NamedTuple):
    turns: DataFrame
    conversations: DataFrame


def _closed(costs) -> Costs:
    """Costs with turns inserted first wherever that is cheaper."""
    start, system, user, assistant = costs
    user, assistant = min(user, assistant + INSERT), min(assistant, user + INSERT)
    return min(start, user + INSERT), min(system, user + INSERT), user, assistant


END = _closed((0, FAR, FAR, 0))


def _before(row: Row, costs: Costs) -> Costs:
    """Costs in front of a row from those behind it."""
    if row.doomed:
        return tuple(c + DELETE for c in costs)
    out = []
    for state in range(4):
        best = min(costs[state] + DELETE, costs[FOLLOWS[state]] + REROLE + row.extra)
        if (state, row.kind) in KEPT:
            best = min(best, costs[row.kind] + row.extra)
        out.append(best)
    return _closed(out)


def _through(rows: list[Row], costs: Costs) -> Costs:
    for row in reversed(rows):
        costs = _before(row, costs)
    return costs


def passage(rows: list[Row]) -> list[list[int]]:
    """Least cost from each state in front of the rows to each state behind them."""
    columns = [_through(rows, tuple(0 if s == end else FAR for s in range(4))) for end in range(4)]
    return [[columns[end][begin] for end in range(4)] for begin in range(4)]


def _ahead(table: list[list[int]], costs: Costs) -> Costs:
    return tuple(min(step + c for step, c in zip(steps, costs, strict=True)) for steps in table)


def walk(rows: list[Row], end: Costs, state: int, last: bool) -> tuple[str, int]:
    """The least of the cheapest edit strings from ``state``, and the state it leads to.

    ``last`` says that no row follows, so that the pattern has to be complete.
    """
    step = isqrt(len(rows)) + 1
    blocks = [rows[i : i + step] for i in range(0, len(rows), step)]
    checkpoints = [end]
    for block in reversed(blocks[1:]):
        checkpoints.append(_through(block, checkpoints[-1]))
    edits = []
    for block in blocks:
        costs = [checkpoints.pop()]
        for row in reversed(block):
            costs.append(_before(row, costs[-1]))
        here = costs.pop()
        for row in block:
            behind = costs.pop()
            letter = ""
            while letter in ("", "I"):
                letter, state = _edit(row, here, behind, state)
                edits.append(letter)
            here = behind
    while last and state not in (START, ASSISTANT):
        edits.append("I")
        state = FOLLOWS[state]
    return "".join(edits), state


def _edit(row: Row, here: Costs, behind: Costs, state: int) -> tuple[str, int]:
    """The first letter that keeps to the cost, and the state it leads to."""
    following = FOLLOWS[state]
    if here[state] == behind[state] + DELETE:
        return "D", state
    if here[state] == here[following] + INSERT:
        return "I", following
    if (state, row.kind) in KEPT and here[state] == behind[row.kind] + row.extra:
        return "K", row.kind
    return "R", following


def _parts(table: pa.Table) -> Iterator[tuple[object, pa.Table]]:
    """The rows of each conversation in a chunk, in order."""
    table = table.sort_by("place")
    ids = table.column("conv_id").to_pylist()
    first = 0
    for i in range(1, len(ids) + 1):
        if i == len(ids) or ids[i] != ids[first]:
            yield ids[first], table.slice(first, i - first)
            first = i


def _rows(part: pa.Table) -> list[Row]:
    columns = (part.column(c).to_pylist() for c in ("place", "initial", "fault"))
    return [
        Row(place, KINDS.get(initial, 0), fault in ("blank", "duplicate"), CUT_OFF * (fault == "truncated"))
        for place, initial, fault in zip(*columns, strict=True)
    ]


def _summaries(id_kind: pa.DataType):
    """Of each conversation's rows in a chunk: their border, costs, and the edits if no row lies in another chunk."""
    kind = pa.schema(
        [
            ("conv_id", id_kind), ("chunk", pa.int64()), ("illegal", pa.int64()), ("opens", pa.string()),
            ("closes", pa.string()), ("cost", pa.int64()), ("audit", pa.string()),
            ("passage", pa.list_(pa.list_(pa.int64()))),
        ]
    )

    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        out, left = [], table.num_rows
        for conv, part in _parts(table):
            rows, initials = _rows(part), part.column("initial").to_pylist()
            border = left in (table.num_rows, len(rows))
            left -= len(rows)
            whole = {"cost": _through(rows, END)[START], "audit": walk(rows, END, START, True)[0]}
            out.append(
                {
                    "conv_id": conv, "chunk": chunk, "opens": initials[0], "closes": initials[-1],
                    "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
                    **({"passage": passage(rows)} if border else whole),
                }
            )
        return pa.Table.from_pylist(out, schema=kind)

    return run, kind


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs behind and in front of each part, whose conversation's parts come last to first."""
    conv, costs = None, None
    for batch in batches:
        out = []
        for row in batch.select(["conv_id", "chunk", "passage"]).to_pylist():
            last = costs is None or row["conv_id"] != conv
            end = END if last else costs
            conv, costs = row["conv_id"], _ahead(row["passage"], END if last else costs)
            out.append({"conv_id": conv, "chunk": row["chunk"], "last": last, "behind": end, "front": costs})
        yield pa.RecordBatch.from_pylist(out, schema=_COSTS(batch.schema.field("conv_id").type))


def _COSTS(id_kind: pa.DataType) -> pa.Schema:
    numbers = pa.list_(pa.int64())
    return pa.schema(
        [("conv_id", id_kind), ("chunk", pa.int64()), ("last", pa.bool_()), ("behind", numbers), ("front", numbers)]
    )


def _walks(id_kind: pa.DataType):
    """For each part that was given costs: its edits from every state, and the states they lead to."""
    kind = pa.schema(
        [("conv_id", id_kind), ("chunk", pa.int64()), ("audits", pa.list_(pa.string())), ("exits", pa.list_(pa.int64()))]
    )

    def run(table: pa.Table, wanted: pa.Table) -> pa.Table:
        given = {row["conv_id"]: row for row in wanted.to_pylist()}
        out = []
        for conv, part in _parts(table) if given else ():
            if conv in given:
                rows, row = _rows(part), given[conv]
                found = [walk(rows, tuple(row["behind"]), state, row["last"]) for state in range(4)]
                audits, exits = zip(*found, strict=True)
                out.append({"conv_id": conv, "chunk": row["chunk"], "audits": audits, "exits": exits})
        return pa.Table.from_pylist(out, schema=kind)

    return run, kind


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each part begins in, its edits and their cost; a conversation's parts come first to last."""
    conv, state, closes = None, None, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if state is None or row["conv_id"] != conv:
                conv, state, closes = row["conv_id"], START, None
            leads = row["exits"][state]
            illegal = row["illegal"] + (closes is not None and closes + row["opens"] not in LEGAL)
            rest = 0 if row["last"] else row["behind"][leads]
            out.append(
                {
                    "conv_id": conv, "chunk": row["chunk"], "state": state, "audit": row["audits"][state],
                    "cost": row["front"][state] - rest, "illegal": illegal,
                }
            )
            state, closes = leads, row["closes"]
        yield pa.RecordBatch.from_pylist(out, schema=_CHOSEN(batch.schema.field("conv_id").type))


def _CHOSEN(id_kind: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("conv_id", id_kind), ("chunk", pa.int64()), ("state", pa.int32()), ("audit", pa.string()),
            ("cost", pa.int64()), ("illegal", pa.int64()),
        ]
    )


def _applied(id_kind: pa.DataType):
    """The turns that the edits leave: place, step and role, null for an unchanged one."""
    kind = pa.schema(
        [
            ("conv_id", id_kind), ("place", pa.int64()), ("step", pa.int32()), ("edit", pa.string()),
            ("new_role", pa.string()),
        ]
    )

    def run(table: pa.Table, chosen: pa.Table) -> pa.Table:
        plans = {row["conv_id"]: row for row in chosen.to_pylist()}
        columns = {name: [] for name in kind.names}
        for conv, part in _parts(table):
            rows, state, at = _rows(part), plans[conv]["state"], 0
            for step, letter in enumerate(plans[conv]["audit"]):
                row = rows[min(at, len(rows) - 1)]
                at += letter != "I"
                if letter == "D":
                    continue
                state = row.kind if letter == "K" else FOLLOWS[state]
                for name, value in zip(
                    kind.names, (conv, row.place, step, letter, None if letter == "K" else NAMES[state]), strict=True
                ):
                    columns[name].append(value)
        return pa.Table.from_pydict(columns, schema=kind)

    return run, kind


def repair(turns: DataFrame, chunk_bits: int = CHUNK_BITS) -> Repaired:
    """The cheapest legal form of every conversation in ``turns`` (conv_id, turn, role, text; others are not read).

    A conversation's rows are taken by turn, nulls first, rows of the same turn
    by role and text.  Roles are told by their first letter and have to follow
    (s?(ua)+)?.  Keeping a row costs nothing, giving it the role user or
    assistant 3, deleting it 4, an empty row of either role put in anywhere 3.  Blank rows and
    duplicates (role and text seen earlier) have to go; a row that stays but
    doesn't end in one of .!? costs 3 more.  Of several cheapest ways the one
    whose edits' initials (D, I, K, R) come first in ASCII is taken.

    ``turns`` of the result has conv_id, place, step (together the order),
    edit, role and text of what is left; ``conversations`` has conv_id, gaps
    (turns missing between the first and the last), blank, duplicate,
    truncated, illegal, cost and audit.  Null roles and texts are read as one
    space; null conv_ids are one conversation.  Repeated rows are duplicates of
    each other.  Empty and very long texts are rows like others: only a digest
    of a text and its end are looked at.  An empty table gives empty results.

    Rows are put in order by ranges of even size, so that a conversation of any
    length is cut into chunks of 2 ** ``chunk_bits`` places.  What a chunk costs
    between any two states is a table of 4 x 4; these are joined up from the
    end, which gives the costs at the chunks' borders; every chunk is then
    walked from each state it may begin in, and the walks are linked from the
    start.  One conversation's share in that are two passes over one small
    row a chunk.
    """
    places = _in_order(turns)
    id_type = places.schema["conv_id"].dataType.simpleString()
    id_kind = _arrow(places)
    rows = _faults(places, chunk_bits)
    by_chunk = lambda: rows.select("conv_id", "chunk", "place", "initial", "fault").groupBy("chunk")

    summarise, kind = _summaries(id_kind)
    parts = stored(by_chunk().applyInArrow(summarise, _ddl(kind, id_type)), "parts")
    cut = parts.filter("passage IS NOT NULL")
    last_first = cut.select("conv_id", "chunk", "passage").repartition("conv_id")
    costs = stored(
        last_first.sortWithinPartitions("conv_id", F.col("chunk").desc()).mapInArrow(
            _backward, _ddl(_COSTS(id_kind), id_type)
        ),
        "costs",
    )
    walks, kind = _walks(id_kind)
    walked = by_chunk().cogroup(costs.groupBy("chunk")).applyInArrow(walks, _ddl(kind, id_type))
    same = lambda a, b: a["conv_id"].eqNullSafe(b["conv_id"]) & (a["chunk"] == b["chunk"])
    linked = (
        cut.select("conv_id", "chunk", "illegal", "opens", "closes")
        .join(costs.withColumnRenamed("conv_id", "c"), F.expr("conv_id <=> c") & (cut["chunk"] == costs["chunk"]))
        .drop("c", costs["chunk"])
    )
    first_first = (
        linked.join(walked, same(linked, walked)).drop(walked["conv_id"], walked["chunk"]).repartition("conv_id")
    )
    chosen = first_first.sortWithinPartitions("conv_id", "chunk").mapInArrow(_forward, _ddl(_CHOSEN(id_kind), id_type))
    whole = parts.filter("passage IS NULL").select(
        "conv_id", "chunk", F.lit(START).alias("state"), "audit", "cost", "illegal"
    )
    plans = stored(whole.unionByName(chosen), "plans")

    applied, kind = _applied(id_kind)
    left = by_chunk().cogroup(plans.groupBy("chunk")).applyInArrow(applied, _ddl(kind, id_type))
    own = places.select("place", F.col("role").alias("own_role"), F.col("text").alias("own_text"))
    repaired = left.join(own, "place").select(
        "conv_id", "place", "step", "edit",
        F.coalesce("new_role", "own_role").alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("own_text")).alias("text"),
    )
    return Repaired(repaired, _conversations(rows, plans))


def _in_order(turns: DataFrame) -> DataFrame:
    """The rows with their place in the order of conversation, turn, role and text, stored.

    Equal rows are told apart by where they were read, so that any number of them is dealt out evenly.
    """
    order = ["conv_id", "turn", "role", "text", "_read"]
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("_read"),
    )
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return stored(ranged.drop("_read").withColumn("place", F.monotonically_increasing_id()), "turns")


def _faults(places: DataFrame, chunk_bits: int) -> DataFrame:
    """Each row's place, chunk, initial and first fault, without its text; stored."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    rows = places.select(
        "conv_id", "turn", "role", "place",
        F.sha2("text", 256).alias("digest"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open_end"),
    )
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("new"))
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(F.col("open_end"), "truncated")
    )
    marked = rows.join(firsts, "place", "left").select(
        "conv_id", "turn", "place",
        F.shiftright("place", chunk_bits).alias("chunk"),
        F.substring("role", 1, 1).alias("initial"),
        fault.alias("fault"),
    )
    return stored(marked, "faults")


def _conversations(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Counts from the rows, costs and edits from the plans of a conversation's chunks."""

    def count(fault: str) -> Column:
        return F.count_if(F.coalesce(F.col("fault") == fault, F.lit(False))).alias(fault)

    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = rows.groupBy("conv_id").agg(
        F.coalesce(turns, F.lit(0)).alias("gaps"), count("blank"), count("duplicate"), count("truncated")
    )
    in_order = F.array_sort(F.collect_list(F.struct("chunk", "audit")))
    edits = plans.groupBy(F.col("conv_id").alias("c")).agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(in_order["audit"], "").alias("audit"),
    )
    return counts.join(edits, F.expr("conv_id <=> c")).drop("c")


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its repaired lines ``role:text``, in order and joined by line feeds.

    A digest has to see its conversation in order, so that one task reads it;
    that task sorts on disk and holds a batch of rows at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, kind = None, None, pa.null()
        for batch in batches:
            done, kind = [], batch.schema.field("conv_id").type
            for own, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if digest is None or own != conv:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = own, sha256(line)
                else:
                    digest.update(b"\n" + line)
            yield _pairs(done, kind)
        if digest is not None:
            yield _pairs([(conv, digest.hexdigest())], kind)

    def _pairs(done: list, kind: pa.DataType) -> pa.RecordBatch:
        ids, found = [c for c, _ in done], [d for _, d in done]
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])

    line = F.concat("role", F.lit(":"), "text").cast("binary").alias("line")
    lines = turns.select("conv_id", line, "place", "step").repartition("conv_id")
    id_type = turns.schema["conv_id"].dataType.simpleString()
    return (
        lines.sortWithinPartitions("conv_id", "place", "step")
        .select("conv_id", "line")
        .mapInArrow(run, f"conv_id {id_type}, repaired_sha256 string")
    )


def _arrow(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["conv_id"].dataType)


def _ddl(kind: pa.Schema, id_type: str) -> str:
    """The Spark schema of an Arrow one; conversation ids keep their own type."""
    names = {
        pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.string(): "string",
        pa.list_(pa.int64()): "array<long>", pa.list_(pa.string()): "array<string>",
        pa.list_(pa.list_(pa.int64())): "array<array<long>>",
    }
    return ", ".join(f"{f.name} {id_type if f.name == 'conv_id' else names[f.type]}" for f in kind)
