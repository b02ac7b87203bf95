"""Repair of the turn structure of conversations: cheapest edits by an auction shortest-path algorithm.

A conversation's rows, in order, must become role initials of the form `(s?(ua)+)?`. Edits of a row: Keep (0), Rerole to user
or assistant (2), Delete (3, the only edit of blank and duplicate rows); Insert of an empty user or assistant row (2) is
possible anywhere; a truncated row that is not deleted adds 1. The edits form a lattice whose nodes are (rows done, what
came last: nothing, s, u or a) with integer arc costs.

**Auction.** Every node has a price, zero at first. A path starts at the origin; at its last node, if the price is below
the cheapest arc cost plus price beyond it, the price rises to that and the path contracts by a node; otherwise it is
extended along that arc, until it holds the target. Prices never exceed an arc's cost plus the price behind it, and on
arrival the origin's price is the least cost. An arc is tight where the two are equal: a path from origin to target is cheapest
exactly if all its arcs are tight. Among the tight arcs from which the target is reached over tight arcs, the trace takes
the least letter of D, I, K, R at each node, which gives the least string of edits. Other origins of the same target go on
with the prices reached.

**Long conversations.** Rows are cut into stretches of `STRETCH`. A stretch has 4 x 4 least costs and strings, from what came
before it to what comes last in it; the last stretch closes with the inserts after all rows. These combine like matrices.
Two strings of one stretch and origin never are equal or one the beginning of the other, so stretches can be decided
from the front.

**Spread over tasks.** Rows are sorted globally by (conv_id, turn, role, text) into ranges, so a conversation of any size
is spread over as many tasks as it needs. Each task repairs the conversations that lie inside its range and passes on the
first and last one of the range, and any beyond `PIECE` rows, as pieces of that size. Of those pieces, duplicates are
found by the first place of every (conversation, digest of role and text); each piece gives its 4 x 5 costs; a
conversation's pieces are routed by these few numbers alone; then each piece traces its own stretch.

Nulls and corner cases: null roles and texts count as one space. Rows go by turn, null turns first; rows of one turn by the
first 32 characters of role, then of text, then a hash of both, so equal rows are neighbours. Null conv_ids are one conversation.
Roles other than system, user and assistant must be reroled or deleted; only the first byte of a role decides. Rows where
`present` is false only name their conversation: without any other it has no rows, costs nothing and has empty results.
Very long texts are carried whole. Empty tables give empty tables. Columns other than conv_id, turn, role, text and
`present` are left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored, table_batches

STRETCH = 32
#: Rows and bytes of a conversation that a task holds, to repair it alone or to pass them on as a piece.
PIECE, HELD_BYTES = 8192, 16 << 20

NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The role accepted after each state (s is accepted after nothing, too), and the state it leads to.
ACCEPTS = (("u", AFTER_U), ("u", AFTER_U), ("a", AFTER_A), ("u", AFTER_U))
ROLES = {AFTER_U: b"user", AFTER_A: b"assistant"}
LEGAL = {b"su", b"ua", b"au"}


# -- rows --------------------------------------------------------------------------------------


def sign(role: bytes, text: bytes, fresh: bool) -> tuple[str, str]:
    """A row's fault ('' if none), and its sign: `-` must be deleted; s, u, a or x (any other role), in capitals if
    truncated."""
    solid = text.strip()
    if not solid:
        return "blank", "-"
    if not fresh:
        return "duplicate", "-"
    initial = chr(role[0]) if role[:1] in (b"s", b"u", b"a") else "x"
    if solid[-1:] not in b".!?":
        return "truncated", initial.upper()
    return "", initial


# -- auction -----------------------------------------------------------------------------------


def arcs_of(signs: str, closing: bool) -> tuple[list[list[tuple[int, str, int]]], int]:
    """(cost, letter, next node) of every node 4 * rows done + state, and the number of nodes; with `closing`, rows may be
    inserted after the last one and a last node stands for a finished conversation."""
    n = len(signs)
    out: list[list[tuple[int, str, int]]] = []
    for i in range(n + 1):
        for state in range(4):
            role, after = ACCEPTS[state]
            arcs = []
            if i < n:
                row = signs[i]
                arcs.append((3, "D", 4 * i + 4 + state))
                if row != "-":
                    initial, extra = row.lower(), int(row.isupper())
                    if initial == role:
                        arcs.append((extra, "K", 4 * i + 4 + after))
                    else:
                        arcs.append((2 + extra, "R", 4 * i + 4 + after))
                        if initial == "s" and state == NOTHING:
                            arcs.append((extra, "K", 4 * i + 4 + AFTER_S))
            if i < n or closing:
                arcs.append((2, "I", 4 * i + after))
            if i == n and closing and state in (NOTHING, AFTER_A):
                arcs.append((0, "", 4 * n + 4))
            out.append(arcs)
    if closing:
        out.append([])
    return out, len(out)


def leading(arcs: list[list[tuple[int, str, int]]], target: int, tight=lambda node, arc: True) -> set[int]:
    """Nodes from which `target` is reached over the arcs that `tight` admits."""
    found = {target}
    for low in range(len(arcs) // 4 * 4 - 4, -1, -4):
        layer = range(low, low + 4)
        for _ in layer:  # inserts lead to other nodes of the layer
            found.update(i for i in layer if i not in found and any(a[2] in found and tight(i, a) for a in arcs[i]))
    return found


def auction(arcs: list[list[tuple[int, str, int]]], origin: int, target: int, prices: list[int]) -> None:
    """Raise `prices` until the origin's is its least cost to the target, which all nodes with arcs must reach."""
    path = [origin]
    while path[-1] != target:
        node = path[-1]
        least, onward = min((cost + prices[after], after) for cost, _, after in arcs[node])
        if prices[node] < least:
            prices[node] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(onward)


def cheapest(signs: str, closing: bool, origins: tuple[int, ...], target: int) -> dict[int, tuple[int, str]]:
    """Least cost and least string of the cheapest edits from each state before the rows to node `target`, where there
    is a way."""
    arcs, n = arcs_of(signs, closing)
    alive = leading(arcs, target)
    arcs = [[a for a in own if a[2] in alive] if i in alive else [] for i, own in enumerate(arcs)]
    arcs[target] = []
    prices = [0] * n
    found = {}
    for origin in origins:
        if origin not in alive:
            continue
        auction(arcs, origin, target, prices)
        tight = lambda i, a: prices[i] == a[0] + prices[a[2]]
        ways = leading(arcs, target, tight)
        node, letters = origin, []
        while node != target:
            letter, node = min((a[1], a[2]) for a in arcs[node] if a[2] in ways and tight(node, a))
            letters.append(letter)
        found[origin] = (prices[origin], "".join(letters))
    return found


Table = dict[tuple[int, int], tuple[int, str]]
CLOSED = 4


@lru_cache(maxsize=50_000)
def whole(signs: str) -> tuple[int, str]:
    """Cost and edits of a conversation of one stretch."""
    return cheapest(signs, True, (NOTHING,), 4 * len(signs) + 4)[NOTHING]


@lru_cache(maxsize=5_000)
def stretch(signs: str, closing: bool) -> Table:
    """(state before, state after or CLOSED) -> cost and edits."""
    table = {}
    for exit_ in (CLOSED,) if closing else range(4):
        for entry, best in cheapest(signs, closing, (0, 1, 2, 3), 4 * len(signs) + exit_).items():
            table[entry, exit_] = best
    return table


def route(tables: list[dict[tuple[int, int], tuple]], entry: int, exit_: int) -> list[tuple[int, int]] | None:
    """(state before, state after) in each of several tables in a row on the cheapest way with the least string. A
    table's values are (cost, anything that sorts like the strings)."""
    togo: list[dict[int, int]] = [{exit_: 0}]
    for table in reversed(tables):
        costs: dict[int, int] = {}
        for (a, b), (cost, *_) in table.items():
            if b in togo[-1]:
                costs[a] = min(costs.get(a, cost + togo[-1][b]), cost + togo[-1][b])
        togo.append(costs)
    togo.reverse()
    if entry not in togo[0]:
        return None
    steps = []
    for k, table in enumerate(tables):
        _, after = min(
            (best[1], b)
            for (a, b), best in table.items()
            if a == entry and b in togo[k + 1] and best[0] + togo[k + 1][b] == togo[k][entry]
        )
        steps.append((entry, after))
        entry = after
    return steps


def stretches(signs: str, closing: bool) -> list[Table]:
    cuts = range(0, max(1, len(signs)), STRETCH)
    return [stretch(signs[i : i + STRETCH], closing and i == cuts[-1]) for i in cuts]


def edits(signs: str, entry: int, exit_: int) -> tuple[int, str]:
    """Cost and least string of the cheapest edits of any number of rows between two states; exit CLOSED ends."""
    if len(signs) <= STRETCH and entry == NOTHING and exit_ == CLOSED:
        return whole(signs)
    tables = stretches(signs, exit_ == CLOSED)
    best = [t[step] for t, step in zip(tables, route(tables, entry, exit_), strict=True)]
    return sum(b[0] for b in best), "".join(b[1] for b in best)


def lines(rows: list[tuple[bytes, bytes]], letters: str, state: int) -> list[bytes]:
    """The repaired rows as `role:text`, from the edits and the state before them."""
    out, i = [], 0
    for letter in letters:
        after = ACCEPTS[state][1]
        if letter == "I":
            out.append(ROLES[after] + b":")
            state = after
            continue
        role, text = rows[i]
        i += 1
        if letter == "K":
            out.append(role + b":" + text)
            state = AFTER_S if state == NOTHING and role[:1] == b"s" else after
        elif letter == "R":
            out.append(ROLES[after] + b":" + text)
            state = after
    return out


# -- pieces ------------------------------------------------------------------------------------

FACTS = (
    "rows long, first_turn long, last_turn long, turns long, first_initial binary, last_initial binary, "
    "blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired binary"
)
_FACTS = pa.schema(
    [
        *((c, pa.int64()) for c in ("rows", "first_turn", "last_turn", "turns")),
        *((c, pa.binary()) for c in ("first_initial", "last_initial")),
        *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        ("audit", pa.string()),
        ("repaired", pa.binary()),
    ]
)


def facts(rows: list[tuple], entry: int, exit_: int) -> tuple:
    """`FACTS` of consecutive rows (turn, role, text, fresh) of a conversation, repaired between two states."""
    marks = [sign(role, text, fresh) for _, role, text, fresh in rows]
    faults = [fault for fault, _ in marks]
    cost, letters = edits("".join(s for _, s in marks), entry, exit_)
    initials = [r[1][:1] for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    return (
        len(rows),
        turns[0] if turns else None,
        turns[-1] if turns else None,
        len(set(turns)),
        initials[0] if rows else None,
        initials[-1] if rows else None,
        faults.count("blank"),
        faults.count("duplicate"),
        faults.count("truncated"),
        sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        cost,
        letters,
        b"\n".join(lines([(r[1], r[2]) for r in rows], letters, entry)),
    )


def first_seen(rows: list[tuple[int | None, bytes, bytes]]) -> list[tuple]:
    """The rows with whether their role and text come for the first time."""
    seen: set[tuple[bytes, bytes]] = set()
    out = []
    for turn, role, text in rows:
        out.append((turn, role, text, (role, text) not in seen))
        seen.add((role, text))
    return out


def _sorted_rows(rows: DataFrame, n: int) -> DataFrame:
    """`part, conv_id, turn, role, text, present` in global order, rows of one conversation in neighbouring parts."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    present = F.coalesce("present", F.lit(True)) if "present" in rows.columns else F.lit(True)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"), present.alias("present"))
    # short keys: a sample of them passes through the driver. The last one spreads equal rows.
    order = [
        F.col("conv_id").asc_nulls_first(),
        F.col("turn").asc_nulls_first(),
        F.substring("role", 1, 32),
        F.substring("text", 1, 32),
        F.xxhash64("role", "text"),
        F.col("at"),
    ]
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    binary = (F.col(c).cast("binary").alias(c) for c in ("role", "text"))
    return rows.select(F.spark_partition_id().alias("part"), "conv_id", "turn", *binary, "present")


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations in pieces: `conv_id, whole, part, piece`, and the columns of `FACTS`.

    A conversation is one row with `whole`, or several rows in order of (part, piece). `repaired` holds the repaired rows
    as `role:text`, joined by line ends, `audit` the edits' initials. `summaries` adds the pieces up.
    """
    spark = rows.sparkSession
    n = prepare(spark)
    kind = rows.schema["conv_id"].dataType.simpleString()
    head = f"conv_id {kind}, whole boolean, part int, piece long"
    row = "turn long, role binary, text binary, present boolean"

    def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        done, raw = [], []

        def emit() -> pa.RecordBatch:
            width = len(_FACTS)
            columns = list(zip(*([(*d, None, None, None, None) for d in done] + [(*r[:5], *[None] * width, *r[5:]) for r in raw])))
            batch = pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            done.clear()
            raw.clear()
            return batch

        current, opened, held, size, first, passed = None, False, [], 0, True, False
        part = piece = place = 0

        def hand_on(last: bool) -> None:
            """Pass the held rows on as raw rows of a new piece, or repair them if they are a whole conversation."""
            nonlocal held, size, piece, place
            if passed or first or last:
                for r in held:
                    raw.append((current, False, part, piece, place, *r))
                    place += 1
                piece += 1
            else:
                own = first_seen([r[:3] for r in held if r[3]])
                done.append((current, True, part, piece, None, *facts(own, NOTHING, CLOSED)))
            held, size = [], 0

        waiting = 0
        for batch in batches:
            if schema is None:
                conv = batch.schema.field("conv_id").type
                schema = pa.schema(
                    [("conv_id", conv), ("whole", pa.bool_()), ("part", pa.int32()), ("piece", pa.int64()), ("place", pa.int64()), *_FACTS]
                    + [("turn", pa.int64()), ("role", pa.binary()), ("text", pa.binary()), ("present", pa.bool_())]
                )
            for part, conv_id, *values in table_batches([batch], "part", "conv_id", "turn", "role", "text", "present"):  # noqa: B007
                if opened and current != conv_id:
                    hand_on(False)
                    first = passed = False
                current, opened = conv_id, True
                held.append(tuple(values))
                size += len(values[2])
                waiting += len(values[2])
                if len(held) >= PIECE or size > HELD_BYTES:
                    passed = True
                    hand_on(False)
                if waiting > 1 << 22:
                    yield emit()
                    waiting = 0
        if held:
            hand_on(True)
        if done or raw:
            yield emit()

    parts = stored(
        _sorted_rows(rows, n).mapInArrow(by_part, f"{head}, place long, {FACTS}, {row}"), "conversation-parts"
    )
    finished = parts.where("whole").drop("place", "turn", "role", "text", "present")
    pieces = parts.where(~F.col("whole")).select("conv_id", "part", "piece", "place", "turn", "role", "text", "present")
    return finished.unionByName(_across(pieces, f"{head}, {FACTS}"))


def _piece_rows(table: pa.Table) -> list[tuple]:
    """(turn, role, text, fresh) of a piece in order."""
    columns = (table.column(c).to_pylist() for c in ("place", "turn", "role", "text", "fresh", "present"))
    return [r[1:5] for r in sorted(zip(*columns, strict=True), key=lambda r: r[0]) if r[5]]


def _across(pieces: DataFrame, schema: str) -> DataFrame:
    """The rows of `repair` for conversations that lie in several pieces."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    digest = F.sha2(F.concat(F.length("role").cast("string").cast("binary"), F.lit(b":"), "role", "text"), 256)
    firsts = pieces.where("present").groupBy("conv_id", digest.alias("digest")).agg(F.min(F.struct("part", "place")).alias("at"))
    firsts = firsts.select("at.part", "at.place", F.lit(True).alias("fresh"))
    marked = stored(
        pieces.join(firsts, ["part", "place"], "left").withColumn("fresh", F.coalesce("fresh", F.lit(False))), "conversation-pieces"
    )

    def cost(table: pa.Table) -> pa.Table:
        """A piece's costs, and strings as ranks: the least string that leads to an exit sorts like its rank."""
        signs = "".join(sign(role, text, fresh)[1] for _, role, text, fresh in _piece_rows(table))
        out = []
        for closing in (False, True):
            tables = stretches(signs, closing)
            for entry in range(4):
                ways = []
                for exit_ in (CLOSED,) if closing else range(4):
                    steps = route(tables, entry, exit_)
                    if steps is not None:
                        best = [t[step] for t, step in zip(tables, steps, strict=True)]
                        ways.append(("".join(b[1] for b in best), sum(b[0] for b in best), exit_))
                ways.sort()
                out += [{"entry": entry, "exit": e, "cost": c, "rank": k} for k, (_, c, e) in enumerate(ways)]
        keys = [table.column(c)[:1] for c in ("conv_id", "part", "piece")]
        way = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32())])
        return pa.table([*keys, pa.array([out], pa.list_(way))], names=["conv_id", "part", "piece", "ways"])

    ways = marked.groupBy("part", "piece").applyInArrow(
        cost, f"conv_id {kind}, part int, piece long, ways array<struct<entry:int,exit:int,cost:long,rank:int>>"
    )

    def choose(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("piece", "ascending")])
        own = table.column("ways").to_pylist()
        tables = [
            {(w["entry"], w["exit"]): (w["cost"], w["rank"]) for w in ways if (w["exit"] == CLOSED) == (k == len(own) - 1)}
            for k, ways in enumerate(own)
        ]
        entries, exits = zip(*route(tables, NOTHING, CLOSED), strict=True)
        columns = [table.column("part"), table.column("piece"), pa.array(entries, pa.int32()), pa.array(exits, pa.int32())]
        return pa.table(columns, names=["part", "piece", "entry", "exit"])

    steps = ways.groupBy("conv_id").applyInArrow(choose, "part int, piece long, entry int, exit int")

    def trace(key, rows: pa.Table, step: pa.Table) -> pa.Table:
        entry, exit_ = step.column("entry")[0].as_py(), step.column("exit")[0].as_py()
        values = facts(_piece_rows(rows), entry, exit_)
        head = [rows.column("conv_id")[:1], pa.array([False]), *(rows.column(c)[:1] for c in ("part", "piece"))]
        body = [pa.array([v], f.type) for v, f in zip(values, _FACTS, strict=True)]
        return pa.table(head + body, names=["conv_id", "whole", "part", "piece", *_FACTS.names])

    return marked.groupBy("part", "piece").cogroup(steps.groupBy("part", "piece")).applyInArrow(trace, schema)


def summaries(pieces: DataFrame) -> DataFrame:
    """One row per conversation of `repair`: `conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit` and
    `repaired_sha256`. A conversation in pieces is added up and hashed in order as its pieces pass by; none is held."""
    n = prepare(pieces.sparkSession)
    kind = pieces.schema["conv_id"].dataType.simpleString()
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    whole_ones = pieces.where("whole").select("conv_id", gaps, *counts, "audit", F.sha2("repaired", 256).alias("repaired_sha256"))
    names = ["part", "piece", *_FACTS.names]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, conv = None, None

        def result() -> pa.RecordBatch:
            first, last, turns = current["turns"]
            values = [last - first + 1 - turns if first is not None else 0, *current["sums"]]
            columns = [pa.array([current["id"]], conv), *(pa.array([v], pa.int64()) for v in values)]
            columns += [pa.array(["".join(current["audit"])]), pa.array([current["hash"].hexdigest()])]
            return pa.record_batch(columns, ["conv_id", "gaps", *counts, "audit", "repaired_sha256"])

        for batch in batches:
            conv = batch.schema.field("conv_id").type
            for conv_id, *values in table_batches([batch], "conv_id", *names):
                row = dict(zip(names, values, strict=True))
                if current is None or current["id"] != conv_id:
                    if current is not None:
                        yield result()
                    current = {"id": conv_id, "turns": (None, None, 0), "sums": [0] * 5, "audit": [], "last": None}
                    current |= {"hash": hashlib.sha256(), "lines": False}
                first, last, turns = current["turns"]
                if row["first_turn"] is not None:
                    again = int(last == row["first_turn"])
                    current["turns"] = (row["first_turn"] if first is None else first, row["last_turn"], turns + row["turns"] - again)
                sums = current["sums"] = [a + row[c] for a, c in zip(current["sums"], counts, strict=True)]
                if row["rows"]:
                    sums[3] += current["last"] is not None and current["last"] + row["first_initial"] not in LEGAL
                    current["last"] = row["last_initial"]
                current["audit"].append(row["audit"])
                if row["repaired"]:
                    current["hash"].update(b"\n" + row["repaired"] if current["lines"] else row["repaired"])
                    current["lines"] = True
        if current is not None:
            yield result()

    schema = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    rest = pieces.where(~F.col("whole")).select("conv_id", *names)
    rest = rest.repartition(n, "conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "piece")
    return whole_ones.unionByName(rest.mapInArrow(add_up, f"{schema}, audit string, repaired_sha256 string"))
