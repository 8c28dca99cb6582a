"""Operator 11: conversation structure repair by a generalised LR parse.

The order of roles is a small grammar.  A parse may delete a turn, give it
another role, or insert a turn, each at a cost; the cheapest way to a legal
conversation wins, and of equally cheap ones the least string of edit letters.
All ways are followed at once on a graph-structured stack: a node is a state on
top of another node, equal tops are one node, and each keeps only its least
(cost, letters).  This loses nothing: two ways to one node have consumed the
same turns, and where they cost the same neither string begins the other, so
whatever follows does not change their order.

A conversation may hold any number of turns.  It is cut into pieces of at most
``PIECE`` turns, each piece gives the cheapest way from every node to every
node, and the pieces are put together in order; only the edit letters (a byte a
turn) of one conversation meet in a task, never its texts.  Texts are repaired
and digested in a stream.

Defined results: null role or text is one space; a null conv_id is a
conversation of its own; turns are in order of turn (nulls first), role and
text; roles count by their first character, so any role that does not begin
like a known one must get another role or go; a conversation whose turns all go
is empty; repeated rows are duplicates of the first; an empty table gives an
empty table; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: turns of one piece of a conversation, as a power of two
PIECE_BITS = 12
#: bytes of text gathered before a batch is handed on
FLUSH_BYTES = 8 << 20

#: conversations are empty, or an optional system turn and pairs of user and assistant turns
GRAMMAR = (("talk", ()), ("talk", ("pairs",)), ("talk", ("s", "pairs")),
           ("pairs", ("u", "a")), ("pairs", ("pairs", "u", "a")))
ROLES = {"s": "system", "u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: letters and costs of the edits; a kept or reroled truncated turn costs TRUNCATED more
KEEP, REROLE, DELETE, INSERT = ("K", 0), ("R", 1), ("D", 2), ("I", 5)
TRUNCATED = 5
#: roles that a turn may be given or an inserted turn may have
GIVEN = ("u", "a")
END = "$"


class Tables:
    """States, shifts, gotos and reductions (with their lookaheads) of a grammar."""

    def __init__(self, grammar=GRAMMAR):
        self.rules = [("start", (grammar[0][0],)), *grammar]
        self.names = {left for left, _ in self.rules}
        self.follow = self._follow()
        self.go: list[dict[str, int]] = []
        self.reductions: list[list[tuple[str, int, frozenset]]] = []
        numbers, todo = {}, [self._closed({(0, 0)})]
        while todo:
            items = todo.pop(0)
            if items in numbers:
                continue
            numbers[items] = len(numbers)
            todo += [self._closed(k) for _, k in sorted(self._kernels(items).items())]
        for items in numbers:
            self.go.append({x: numbers[self._closed(k)] for x, k in self._kernels(items).items()})
            self.reductions.append([(left, len(right), frozenset(self.follow[left]))
                                    for r, at in sorted(items) for left, right in [self.rules[r]] if r and at == len(right)])
        self.final = self.go[0][grammar[0][0]]

    def _closed(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            r, at = todo.pop()
            right = self.rules[r][1]
            for k, (left, _) in enumerate(self.rules):
                if at < len(right) and left == right[at] and (k, 0) not in items:
                    items.add((k, 0))
                    todo.append((k, 0))
        return frozenset(items)

    def _kernels(self, items: frozenset) -> dict[str, set]:
        out: dict[str, set] = {}
        for r, at in items:
            right = self.rules[r][1]
            if at < len(right):
                out.setdefault(right[at], set()).add((r, at + 1))
        return out

    def _follow(self) -> dict[str, set]:
        empty: set[str] = set()
        first: dict[str, set] = {n: set() for n in self.names}
        follow: dict[str, set] = {n: set() for n in self.names}
        follow["start"].add(END)
        for _ in range(2 * len(self.rules) + 2):            # each round settles one more step of a chain
            for left, right in self.rules:
                if all(x in empty for x in right):
                    empty.add(left)
                for x in right:
                    first[left] |= first.get(x, {x})
                    if x not in empty:
                        break
                after = set(follow[left])
                for x in reversed(right):
                    if x in self.names:
                        follow[x] |= after
                        after = first[x] | after if x in empty else set(first[x])
                    else:
                        after = {x}
        return follow


class Stacks:
    """The graph-structured stack.  Nodes are shared: one for each state over a
    node.  All nodes that can be reached are numbered in advance, which asks for
    a grammar whose stacks do not grow with the input (left recursion)."""

    def __init__(self, tables: Tables | None = None, most: int = 1000):
        self.tables = tables or Tables()
        self.nodes: list[tuple[int, int]] = []              # state, number of the node below
        self.known: dict[tuple[int, int], int] = {}
        self.symbols = sorted({x for _, right in self.tables.rules for x in right} - self.tables.names)
        self.root = self.node(0, -1)
        self.tops, todo = [], [self.root]
        while todo:
            top = todo.pop(0)
            if top not in self.tops:
                self.tops.append(top)
                if len(self.tops) > most:
                    raise ValueError("the stacks of this grammar grow with its input")
                todo += [y for x in self.symbols for y in self.shifted(top, x)]
        self.ends = [top for top in self.tops if self.accepts(top)]
        self.steps: dict[tuple, dict[int, list]] = {}

    def node(self, state: int, below: int) -> int:
        if (state, below) not in self.known:
            self.known[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.known[state, below]

    def reduced(self, top: int, symbol: str) -> list[int]:
        """``top`` and all it reduces to before ``symbol``."""
        found, todo = [], [top]
        while todo:
            at = todo.pop()
            if at in found:
                continue
            found.append(at)
            for left, size, before in self.tables.reductions[self.nodes[at][0]]:
                if symbol in before:
                    base = at
                    for _ in range(size):
                        base = self.nodes[base][1]
                    todo.append(self.node(self.tables.go[self.nodes[base][0]][left], base))
        return found

    def shifted(self, top: int, symbol: str) -> list[int]:
        go = self.tables.go
        return [self.node(go[self.nodes[x][0]][symbol], x) for x in self.reduced(top, symbol) if symbol in go[self.nodes[x][0]]]

    def accepts(self, top: int) -> bool:
        return self.node(self.tables.final, self.root) in self.reduced(top, END)

    def inserted(self, ways: dict[int, tuple[int, str]]) -> dict[int, tuple[int, str]]:
        """``ways`` and those with turns inserted after them."""
        ways, todo = dict(ways), list(ways)
        while todo:
            top = todo.pop()
            cost, letters = ways[top]
            for symbol in GIVEN:
                for to in self.shifted(top, symbol):
                    if keep_least(ways, to, cost + INSERT[1], letters + INSERT[0]):
                        todo.append(to)
        return ways

    def start(self) -> dict[int, tuple[int, str]]:
        return self.inserted({self.root: (0, "")})

    def step(self, turn: tuple[str, bool, bool]) -> dict[int, list[tuple[int, int, str]]]:
        """For each top: what a turn (initial, must go, truncated) and inserts after it lead to."""
        if turn not in self.steps:
            initial, must_go, truncated = turn
            out = {}
            for top in self.tops:
                ways = {top: DELETE[::-1]}
                if not must_go:
                    extra = TRUNCATED if truncated else 0
                    for (letter, cost), symbols in ((KEEP, [initial] if initial in self.symbols else []), (REROLE, GIVEN)):
                        for symbol in symbols:
                            for to in self.shifted(top, symbol):
                                keep_least(ways, to, cost + extra, letter)
                out[top] = [(to, c, s) for to, (c, s) in self.inserted(ways).items()]
            self.steps[turn] = out
        return self.steps[turn]

    def run(self, ways: dict[int, tuple[int, str]], turns: list[tuple[str, bool, bool]]) -> dict[int, tuple[int, str]]:
        for turn in turns:
            moves, after = self.step(turn), {}
            for top, (cost, letters) in ways.items():
                for to, c, s in moves[top]:
                    keep_least(after, to, cost + c, letters, s)
            ways = after
        return ways

    def best(self, ways: dict[int, tuple[int, str]]) -> tuple[int, str]:
        return min(ways[top] for top in self.ends if top in ways)


def keep_least(ways: dict, to: int, cost: int, letters: str, more: str = "") -> bool:
    """Merges a way into the top ``to``; whether it is the least so far."""
    old = ways.get(to)
    if old is not None and (cost > old[0] or (cost == old[0] and letters + more >= old[1])):
        return False
    ways[to] = (cost, letters + more)
    return True


# --- turns and their faults -------------------------------------------------------------------

def shown(role: Column, text: Column) -> tuple[Column, Column]:
    return F.coalesce(role, F.lit(" ")), F.coalesce(text, F.lit(" "))


def in_order(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` and ``at``, which rises along the
    order of conversations and turns; a written table.  Rows are dealt by ranges
    of the whole order, so a conversation of any length spans many tasks."""
    role, text = shown(F.col("role"), F.col("text"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc()]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order, F.substring("text", 1, 32).asc())
    dealt = dealt.sortWithinPartitions(*order, F.col("text").asc())
    return common.materialize(dealt.withColumn("at", F.monotonically_increasing_id()), "turns")


def with_faults(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``at``, ``initial`` and ``fault`` (the first of blank,
    duplicate, truncated, or none) of each turn.  The first turn of each text is
    found by an aggregate and joined on ``at``, so a text that a third of all
    turns say meets nowhere."""
    spoken = F.rtrim(F.translate("text", "\t\n\u000b\f\r", "     "))
    last = F.substring(spoken, -1, 1)
    told = turns.select("conv_id", "turn", "at", "role", F.substring("role", 1, 1).alias("initial"), (spoken == "").alias("blank"),
                        (~last.isin(".", "!", "?")).alias("truncated"), F.sha2(F.col("text").cast("binary"), 256).alias("said"))
    firsts = told.filter(~F.col("blank")).groupBy("conv_id", "role", "said").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("is_first"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("is_first").isNull(), "duplicate")
             .when(F.col("truncated"), "truncated").otherwise("none"))
    return told.join(firsts, "at", "left").select("conv_id", "turn", "at", "initial", fault.alias("fault"))


# --- cheapest edits ---------------------------------------------------------------------------

WAYS = "array<struct<source:int,target:int,cost:bigint,letters:string>>"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stacks = Stacks()
    for batch in batches:
        out = []
        for piece, is_start, turns in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            initials = [t["initial"] for t in turns]
            classes = [(t["initial"], t["fault"] in ("blank", "duplicate"), t["fault"] == "truncated") for t in turns]
            entries = [(stacks.root, stacks.start())] if is_start else [(top, {top: (0, "")}) for top in stacks.tops]
            ways = [{"source": source, "target": to, "cost": c, "letters": s}
                    for source, begun in entries for to, (c, s) in stacks.run(begun, classes).items()]
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            out.append((piece, initials[0], initials[-1], illegal, ways))
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                                          pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64()), pa.array(columns[4], WAYS_ARROW)],
                                         ["conv_id", "piece", "first", "last", "illegal", "ways"])


WAYS_ARROW = pa.list_(pa.struct([("source", pa.int32()), ("target", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())]))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stacks = Stacks()
    for batch in batches:
        costs, audits, illegal = [], [], []
        for pieces in batch.column(1).to_pylist():
            ways, bad, before = {stacks.root: (0, "")}, 0, None
            for piece in pieces:
                bad += piece["illegal"] + (before is not None and before + piece["first"] not in LEGAL)
                before, after = piece["last"], {}
                for w in piece["ways"]:
                    if w["source"] in ways:
                        cost, letters = ways[w["source"]]
                        keep_least(after, w["target"], cost + w["cost"], letters, w["letters"])
                ways = after
            cost, audit = stacks.best(ways)
            costs.append(cost), audits.append(audit), illegal.append(bad)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(illegal, pa.int64())],
                                         ["conv_id", "cost", "audit", "illegal"])


def cheapest_edits(faults: DataFrame) -> DataFrame:
    """``conv_id``, ``illegal`` (neighbours whose roles may not follow each other),
    ``cost`` and ``audit`` (a letter for each edit, in order) of each conversation."""
    kind = faults.schema["conv_id"].dataType.simpleString()
    cut = faults.groupBy("conv_id", F.shiftright("at", PIECE_BITS).alias("piece")).agg(
        F.sort_array(F.collect_list(F.struct("at", "initial", "fault"))).alias("turns"))
    cut = cut.withColumn("is_start", F.col("piece") == F.min("piece").over(Window.partitionBy("conv_id")))
    pieces = cut.select("conv_id", "piece", "is_start", "turns").mapInArrow(
        _pieces, f"conv_id {kind}, piece long, first string, last string, illegal long, ways {WAYS}")
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("piece", "first", "last", "illegal", "ways"))).alias("pieces"))
    return whole.mapInArrow(_joined, f"conv_id {kind}, cost long, audit string, illegal long")


def edited(faults: DataFrame) -> DataFrame:
    """One row for each conversation of ``faults``: its gaps, faults and cheapest edits."""
    count = lambda name: F.count_if(F.col("fault") == name).alias(name)
    seen = faults.groupBy("conv_id").agg(
        F.expr("coalesce(try_add(try_subtract(cast(max(turn) as bigint), cast(min(turn) as bigint)), 1) - count(distinct turn), 0)").alias("gaps"),
        count("blank"), count("duplicate"), count("truncated"))
    edits = cheapest_edits(faults).withColumnRenamed("conv_id", "own")
    return seen.join(edits, F.col("conv_id").eqNullSafe(F.col("own"))).drop("own")


# --- repaired conversations -------------------------------------------------------------------

def apply_edits(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id``, ``pos`` (from 0), ``role``, ``text``, ``edit``,
    in order within each task.  The edits of a conversation come first and its
    turns after them, as one sorted stream: no conversation is held in memory."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    heads = edits.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    dealt = heads.unionByName(turns.select("conv_id", "at", "role", "text")).repartition("conv_id")
    return dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "at").mapInArrow(
        _repaired, f"conv_id {kind}, pos long, role string, text string, edit string")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, held, conv, letters, before, pos = [], 0, None, iter(()), "", 0
    kind = None

    def put(role, text, letter):
        nonlocal held, before, pos
        out.append((conv, pos, role, text, letter))
        held, before, pos = held + len(text) + 40, role[:1], pos + 1

    def batch_of():
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), pa.array(columns[1], pa.int64()), *[pa.array(c, pa.string()) for c in columns[2:]]],
                                          ["conv_id", "pos", "role", "text", "edit"])

    def given():
        return ROLES["a" if before == "u" else "u"]

    def finish():
        for letter in letters:
            put(given(), "", letter)

    for batch in batches:
        kind = batch.schema.field(0).type
        for own, at, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if at < 0:
                finish()
                conv, letters, before, pos = own, iter(text), "", 0
            else:
                for letter in letters:
                    if letter == INSERT[0]:
                        put(given(), "", letter)
                        continue
                    if letter != DELETE[0]:
                        put(role if letter == KEEP[0] else given(), text, letter)
                    break
            if held > FLUSH_BYTES or len(out) >= 50_000:
                yield batch_of()
                out.clear()
                held = 0
    finish()
    if out:
        yield batch_of()


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256`` of ``role:text`` lines, of rows in the
    order that ``apply_edits`` gives them; a running hash, whatever the length."""
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running = None, None
        for batch in batches:
            convs, sums = [], []
            for own, pos, role, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if pos == 0:
                    if running is not None:
                        convs.append(conv), sums.append(running.hexdigest())
                    conv, running = own, hashlib.sha256()
                running.update(f"{chr(10) if pos else ''}{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(convs, batch.schema.field(0).type), pa.array(sums, pa.string())], ["conv_id", "repaired_sha256"])
            field = batch.schema.field(0).type
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], field), pa.array([running.hexdigest()], pa.string())], ["conv_id", "repaired_sha256"])

    return repaired.select("conv_id", "pos", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults planted by a checksum of their place."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    role, said = shown(F.col("role"), F.col("text"))
    fate = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", role.alias("role"), said.alias("text"), fate.alias("fate")).filter("fate <> 0")
    told = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), told.alias("text"),
                       times.alias("copy")).drop("copy")


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits of each conversation (a written table), and the repaired turns."""
    turns = in_order(rows)
    edits = common.materialize(edited(with_faults(turns)), "edits")
    return edits, apply_edits(turns, edits)
