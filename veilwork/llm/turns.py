"""Repair of conversation structure: generalised LR parsing of role sequences with weighted edits.

A conversation is well formed when its role initials are a sentence of a grammar. The grammar
becomes an SLR automaton; stacks of its states are linked nodes that share what lies below,
and a row extends every live stack by the edits keep, rerole, delete and insert. Stacks that
become equal are merged into the one of the least (cost, audit), the audit being the string
of edit initials so far. Audits are not compared as strings: at each row the live stacks are
ranked by audit, and a rank with the edits of one more row orders the next ones. That holds
since audits up to a row end in that row's edit, so none is the beginning of another.

Rows are dealt by ranges of (conversation, turn, role, text), so a long conversation is cut
over tasks. A task parses the first and the last conversation of its range from every stack
that may have been reached before, and the pieces are joined like rows are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.session import materialize

SPACES = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))
ENDS = ".!?"
#: (s?(ua)+)? over the initials of system, user and assistant. Upper case: what a rule makes.
RULES = (("S", ""), ("S", "H"), ("H", "Hua"), ("H", "ua"), ("H", "sua"))
NAMES = {"u": "user", "a": "assistant"}  # the roles that edits may give
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FINE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3  # a row's first fault

Node = tuple  # (state, node below); the lowest is (0, None)
Move = tuple[Node, int, str]  # (stack it leads to, cost, edits)
BOTTOM: Node = (0, None)


class Automaton:
    """SLR states of a grammar, and the stacks that reading a symbol leads to.

    The grammar may be ambiguous, but no head may become empty next to itself without end.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]):
        rules = list(rules)
        self.rules = [("", rules[0][0]), *rules]
        self.heads = {head for head, _ in rules}
        symbols = {c for _, body in self.rules for c in body}
        self.states = [self._closure({(0, 0)})]
        self.goto: dict[tuple[int, str], int] = {}
        for state, items in enumerate(self.states):  # the list grows meanwhile
            for symbol in sorted(symbols):
                moved = {(r, dot + 1) for r, dot in items if self.rules[r][1][dot : dot + 1] == symbol}
                if moved:
                    new = self._closure(moved)
                    if new not in self.states:
                        self.states.append(new)
                    self.goto[state, symbol] = self.states.index(new)
        self.follow = self._follow()
        self.read = lru_cache(maxsize=1 << 16)(self._read)
        self.accepts = lru_cache(maxsize=1 << 16)(self._accepts)

    def _closure(self, items: set[tuple[int, int]]) -> frozenset:
        todo, found = list(items), set(items)
        while todo:
            r, dot = todo.pop()
            wanted = self.rules[r][1][dot : dot + 1]
            for other, (head, _) in enumerate(self.rules):
                if other and head == wanted and (other, 0) not in found:
                    found.add((other, 0))
                    todo.append((other, 0))
        return frozenset(found)

    def _follow(self) -> dict[str, set[str]]:
        """What may come after each head; "" is the end."""
        empty: set[str] = set()
        first: dict[str, set[str]] = {h: set() for h in self.heads}
        follow: dict[str, set[str]] = {h: set() for h in self.heads} | {"": {""}}
        before = None
        while before != (before := (len(empty), sum(map(len, first.values())), sum(map(len, follow.values())))):
            for head, body in self.rules:
                after, opens, clear = set(follow[head]), set(), True
                for c in reversed(body):
                    if c in self.heads:
                        follow[c] |= after
                        after = after | first[c] if c in empty else set(first[c])
                    else:
                        after = {c}
                for c in body:
                    opens |= first[c] if c in self.heads else {c}
                    if c not in empty:
                        clear = False
                        break
                if head:
                    first[head] |= opens
                    if clear:
                        empty.add(head)
        return follow

    def _reduced(self, top: Node, symbol: str) -> set[Node]:
        """`top` and the stacks of all reductions that the next symbol allows."""
        found, todo = {top}, [top]
        while todo:
            one = todo.pop()
            for r, dot in self.states[one[0]]:
                head, body = self.rules[r]
                if r and dot == len(body) and symbol in self.follow[head]:
                    below = one
                    for _ in body:
                        below = below[1]
                    new = (self.goto[below[0], head], below)
                    if new not in found:
                        found.add(new)
                        todo.append(new)
        return found

    def _settled(self, top: Node) -> Node:
        """The stack after reductions that need no look at the next symbol."""
        while len(items := self.states[top[0]]) == 1:
            ((r, dot),) = items
            head, body = self.rules[r]
            if not r or dot < len(body):
                break
            for _ in body:
                top = top[1]
            top = (self.goto[top[0], head], top)
        return top

    def _read(self, top: Node, symbol: str) -> tuple[Node, ...]:
        """The stacks after `symbol`, several where the grammar leaves it open."""
        ready = self._reduced(top, symbol)
        return tuple(sorted({self._settled((self.goto[x[0], symbol], x)) for x in ready if (x[0], symbol) in self.goto}, key=str))

    def _accepts(self, top: Node) -> bool:
        return any((0, 1) in self.states[x[0]] and x[1] == BOTTOM for x in self._reduced(top, ""))

    def stacks(self, symbols: Iterable[str]) -> list[Node]:
        """All stacks that some sequence leads to; the role grammar has six."""
        found = [BOTTOM]
        for top in found:  # the list grows meanwhile
            found += [x for c in symbols for x in self.read(top, c) if x not in found]
        return found


@lru_cache(maxsize=8)
def automaton(rules: tuple[tuple[str, str], ...] = RULES) -> Automaton:
    return Automaton(rules)


@lru_cache(maxsize=1 << 12)
def inserted(top: Node) -> tuple[Move, ...]:
    """The stacks that inserted rows lead to, no row among them, each by the fewest."""
    best, rows = {top: 0}, [top]
    for one in rows:  # the list grows meanwhile
        for new in (x for c in sorted(NAMES) for x in automaton().read(one, c)):
            if new not in best:
                best[new] = best[one] + 1
                rows.append(new)
    return tuple((x, INSERT * n, "I" * n) for x, n in best.items())


@lru_cache(maxsize=1 << 14)
def moves(top: Node, initial: str, fault: int) -> tuple[Move, ...]:
    """What a row may do to a stack. No insert comes right before a forced delete, since after it is less."""
    if fault in (BLANK, DUPLICATE):
        return ((top, DELETE, "D"),)
    best: dict[Node, tuple[int, str]] = {}
    for node, cost, edits in inserted(top):
        options = [(node, DELETE, "D")]
        more = TRUNCATED * (fault == CUT)
        options += [(x, KEEP + more, "K") for x in automaton().read(node, initial)]
        options += [(x, REROLE + more, "R") for c in sorted(NAMES) for x in automaton().read(node, c)]
        for target, extra, edit in options:
            new = (cost + extra, edits + edit)
            if target not in best or new < best[target]:
                best[target] = new
    return tuple((x, cost, edits) for x, (cost, edits) in best.items())


Heads = dict[Node, tuple[int, int]]  # live stacks with (cost, rank of the audit)
Links = dict[Node, tuple[Node, str]]  # where each came from, by which edits


def extend(heads: Heads, step: Callable[[Node], Iterable[Move]]) -> tuple[Heads, Links]:
    """All stacks after one more row or piece; equal ones are merged by least (cost, audit)."""
    best: dict[Node, tuple[int, int, str, Node]] = {}
    for node, (cost, rank) in heads.items():
        for target, more, edits in step(node):
            new = (cost + more, rank, edits, node)
            if target not in best or new[:3] < best[target][:3]:
                best[target] = new
    order = sorted(best, key=lambda x: best[x][1:3])
    return {x: (best[x][0], i) for i, x in enumerate(order)}, {x: (best[x][3], best[x][2]) for x in order}


def trace(links: list[Links], node: Node) -> list[str]:
    """The edits that led to `node`, one string per step."""
    out = []
    for link in reversed(links):
        node, edits = link[node]
        out.append(edits)
    return out[::-1]


def ended(heads: Heads) -> tuple[int, str, Node]:
    """(cost, last inserts, stack) of the cheapest end."""
    found = []
    for node, (cost, rank) in heads.items():
        found += [(cost + more, rank, edits, node) for x, more, edits in inserted(node) if automaton().accepts(x)]
    cost, _, edits, node = min(found, key=lambda x: x[:3])
    return cost, edits, node


Turn = tuple[str, int, int]  # (role initial, fault, copies)


def parse(rows: list[Turn], entry: Node = BOTTOM) -> tuple[Heads, list[Links], list[int]]:
    """The stacks after all rows. Copies of a row after the first add a delete to every stack alike."""
    heads, links, again = {entry: (0, 0)}, [], []
    for initial, fault, copies in rows:
        heads, link = extend(heads, lambda top: moves(top, initial, fault))
        if copies > 1:
            heads = {x: (cost + DELETE * (copies - 1), rank) for x, (cost, rank) in heads.items()}
        links.append(link)
        again.append(copies - 1)
    return heads, links, again


def audit_of(links: list[Links], again: list[int], node: Node) -> str:
    return "".join(edits + "D" * n for edits, n in zip(trace(links, node), again, strict=True))


def solve(rows: list[Turn]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    if len(rows) <= 32:
        return _solved(tuple(rows))
    return _solution(rows)


def _solution(rows: Iterable[Turn]) -> tuple[int, str]:
    heads, links, again = parse(list(rows))
    cost, last, node = ended(heads)
    return cost, audit_of(links, again, node) + last


_solved = lru_cache(maxsize=1 << 14)(_solution)


def crossing(rows: list[Turn]) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of a piece; stacks are numbered as `stacks` lists them."""
    known = known_stacks()
    out = []
    for i, entry in enumerate(known):
        heads, links, again = parse(rows, entry)
        out += [(i, known.index(x), cost, audit_of(links, again, x)) for x, (cost, _) in heads.items()]
    return out


@lru_cache(maxsize=1)
def known_stacks() -> list[Node]:
    return automaton().stacks("sua")


@dataclass
class Facts:
    """Counts of a run of rows, which add up along a conversation. Rows come by turn, nulls first."""

    gone: int = 0  # rows before the damage that are not there after it
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0  # distinct
    low: int | None = None
    high: int | None = None
    first: str | None = None  # role initials
    last: str | None = None

    def add(self, other: Facts) -> None:
        for name in ("gone", "blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if self.last is not None and other.first is not None and self.last + other.first not in LEGAL:
            self.illegal += 1
        if other.low is not None:
            self.turns -= self.high == other.low
            self.low = other.low if self.low is None else self.low
            self.high = other.high
        self.first = other.first if self.first is None else self.first
        self.last = other.last if other.last is not None else self.last

    @classmethod
    def of(cls, turn: int | None, initial: str, fault: int, later: int, copies: int) -> Facts:
        """`later`: the fault of copies after the first."""
        faults = [(fault, 1), (later, copies - 1)]
        n = {k: sum(m for f, m in faults if f == k) for k in (BLANK, DUPLICATE, CUT)}
        illegal = (copies - 1) * (initial * 2 not in LEGAL)
        return cls(0, n[BLANK], n[DUPLICATE], n[CUT], illegal, int(turn is not None), turn, turn, initial, initial)

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def counted(facts: Facts, cost: int) -> list[int]:
    return [facts.gaps(), facts.blank, facts.duplicate, facts.truncated, facts.illegal, cost]


def repaired_lines(edits: Iterator[str], role: str, text: str, copies: int) -> Iterator[str]:
    """The lines that a row and what is inserted before it leave. `edits` is used up row by row.

    Roles given by edits follow from the stack, so from the lines before: `spell` fills them in.
    """
    for _ in range(copies):
        for edit in edits:
            if edit == "I":
                yield "I"
                continue
            if edit == "K":
                yield "K" + role + ":" + text
            elif edit == "R":
                yield "R:" + text
            break


def spell(lines: Iterable[str]) -> Iterator[str]:
    """Lines `role:text`. An inserted or reroled row is an assistant after a user, else a user."""
    before = ""
    for line in lines:
        if line[0] == "K":
            line = line[1:]
            before = line[:1]
        else:
            before = "a" if before == "u" else "u"
            line = NAMES[before] + (line[1:] or ":")
        yield line


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, copies) after the damage; a dropped row is one of no copies."""
    as_text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv, turn)]
    draw = F.crc32(F.concat_ws(":", *as_text).cast("binary")) % 20
    text_of = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" "))
    role_of = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" "))
    kept = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        role_of.alias("role"), text_of.alias("text"), draw.alias("draw"),
    )
    there = F.col("draw") != 0
    return kept.select(
        "conv",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(F.col("draw") == 4, "user").when(there, F.col("role")).otherwise("").alias("role"),
        F.when(F.col("draw") == 2, F.translate("text", ENDS, ""))
        .when((F.col("draw") == 1) | ~there, "").otherwise(F.col("text")).alias("text"),
        F.when(there, F.when(F.col("draw") == 3, 2).otherwise(1)).otherwise(0).alias("copies"),
    )


def undamaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The same columns with every row as it is; a null role or text is one space."""
    return rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"), F.lit(1).alias("copies"),
    )


def _faulted(rows: DataFrame) -> DataFrame:
    """One row per distinct (conv, turn, role, text) with its copies and the fault of its first copy.

    Equal rows are added up before they move. Where a role and text is first seen is a minimum
    on a fingerprint, joined back by a key that holds the turn, so no key gathers many rows.
    """
    same = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    same = same.withColumn("mark", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    same = materialize(same, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("dated"), "turn")
    seen = same.where("copies > 0").groupBy("conv", "mark").agg(F.min(place)["turn"].alias("turn"))
    seen = seen.select(*[F.col(c).alias(f"_{c}") for c in seen.columns], F.lit(True).alias("opens"))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv", "mark", "turn")]
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    blank = F.length(body) == 0
    cut = ~F.right(body, F.lit(1)).isin(*ENDS)
    fault = F.when(blank, BLANK).when(F.col("opens").isNull(), DUPLICATE).when(cut, CUT).otherwise(FINE)
    later = F.when(blank, BLANK).otherwise(DUPLICATE)
    return same.join(seen, on[0] & on[1] & on[2], "left").select(
        "conv", "turn", "role", "text", "copies", fault.alias("fault"), later.alias("later")
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


FACTS = list(Facts.__dataclass_fields__)
FACT_TYPES = "gone long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first string, last string"


class Run:
    """The rows of one conversation in one task."""

    def __init__(self, conv: object):
        self.conv, self.facts = conv, Facts()
        self.rows: list[Turn] = []
        self.said: list[tuple[str, str, int]] = []

    def add(self, turn: int | None, role: str, text: str, copies: int, fault: int, later: int) -> None:
        if not copies:
            self.facts.add(Facts(gone=1))
            return
        self.facts.add(Facts.of(turn, role[:1], fault, later, copies))
        self.rows.append((role[:1], fault, copies))
        self.said.append((role, text, copies))

    def repaired(self, audit: str) -> str:
        edits = iter(audit)
        lines = [x for row in self.said for x in repaired_lines(edits, *row)]
        return "\n".join(spell(lines + ["I" for _ in edits]))


def _pieces(kind: str) -> tuple[Callable, str]:
    """Parse whole conversations; of a task's first and last one, give the crossing of its piece."""
    schema = (
        f"conv {kind}, whole boolean, {', '.join(c + ' long' for c in COUNTS)}, audit string, repaired string, part int, "
        f"facts struct<{FACT_TYPES.replace(' ', ':').replace(',:', ',')}>, "
        "crossing array<struct<entry:int,exit:int,cost:long,audit:string>>"
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        types = None
        out: list[dict] = []
        size = 0

        def row(run: Run, edge: bool) -> dict:
            if edge:
                keys = ("entry", "exit", "cost", "audit")
                table = [dict(zip(keys, x, strict=True)) for x in crossing(run.rows)]
                facts = {c: getattr(run.facts, c) for c in FACTS}
                return {"conv": run.conv, "whole": False, "part": part, "facts": facts, "crossing": table}
            cost, audit = solve(run.rows)
            counts = dict(zip(COUNTS, counted(run.facts, cost), strict=True))
            return {"conv": run.conv, "whole": True, **counts, "audit": audit, "repaired": run.repaired(audit)}

        def table(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=types)

        held: Run | None = None
        first = True
        for batch in batches:
            if types is None:
                types = _arrow_schema(batch.schema.field(0).type)
            for conv, *rest in _runs(iter([batch])):
                if held is None or held.conv != conv:
                    if held is not None:
                        out.append(row(held, first))
                        size += len(held.rows)
                        first = False
                        if size >= 4096:
                            yield table(out)
                            out, size = [], 0
                    held = Run(conv)
                held.add(*rest)
        if held is not None:
            out.append(row(held, True))
        if out:
            yield table(out)

    return build, schema


def _arrow_schema(kind: pa.DataType) -> pa.Schema:
    facts = pa.struct([(c, pa.string() if c in ("first", "last") else pa.int64()) for c in FACTS])
    cross = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    return pa.schema(
        [("conv", kind), ("whole", pa.bool_()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()),
         ("repaired", pa.string()), ("part", pa.int32()), ("facts", facts), ("crossing", pa.list_(cross))]
    )


def _joined(kind: str) -> tuple[Callable, str]:
    """The pieces of a conversation, in order, as one result."""

    def build(pieces: pa.Table) -> pa.Table:
        rows = sorted(pieces.to_pylist(), key=lambda r: r["part"])
        facts, heads, links = Facts(), {BOTTOM: (0, 0)}, []
        known = known_stacks()
        for piece in rows:
            facts.add(Facts(**piece["facts"]))
            ways: dict[Node, list[Move]] = {}
            for x in piece["crossing"]:
                ways.setdefault(known[x["entry"]], []).append((known[x["exit"]], x["cost"], x["audit"]))
            heads, link = extend(heads, lambda top: ways.get(top, []))
            links.append(link)
        cost, last, node = ended(heads)
        counts = [pa.array([n], pa.int64()) for n in counted(facts, cost)]
        audit = pa.array(["".join(trace(links, node)) + last], pa.string())
        return pa.table([pieces.column("conv").slice(0, 1), *counts, audit], ["conv", *COUNTS, "audit"])

    return build, f"conv {kind}, {', '.join(c + ' long' for c in COUNTS)}, audit string"


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation after the row that holds its audit -> (conv, repaired)."""
    conv, edits, lines = None, None, []

    def table() -> pa.RecordBatch:
        text = "\n".join(spell(lines + ["I" for _ in edits]))
        return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([text], pa.string())], ["conv", "repaired"])

    for batch in batches:
        kind = batch.schema.field(0).type
        for name, audit, role, text, copies in _runs(iter([batch])):
            if audit is not None:
                if edits is not None:
                    yield table()
                conv, edits, lines = name, iter(audit), []
            else:
                lines += repaired_lines(edits, role, text, copies)
    if edits is not None:
        yield table()


def repair_conversations(
    rows: DataFrame,
    damage: Callable = undamaged,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: what is wrong with it, and its cheapest repair.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired), all counts
    long. Rows come by turn, nulls first; rows of one turn by role and text, so that equal rows
    are neighbours. A row's first fault counts: blank text, role and text seen earlier, no `.!?`
    as the last character. audit has the initials of the edits Keep, Rerole, Delete, Insert;
    repaired is the conversation after them, one `role:text` per row. Of repairs that cost the
    same, the least audit is taken. Other columns are left out, whatever their names.

    Null ids are one conversation. A null role or text is one space. A conversation without
    rows after the damage has zeros and empty strings; without any rows there is no result. A
    conversation's audit and its repaired text are a cell each, which Spark bounds at 2 GB;
    the faults and the parse of a longer one than a task are cut over tasks.
    """
    kind = rows.schema[conv_col].dataType.simpleString()
    faulted = materialize(_faulted(damage(rows, conv_col, turn_col, role_col, text_col)), "faulted")
    names = ["conv", "turn", "role", "text", "copies", "fault", "later"]
    build, schema = _pieces(kind)
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "text")]
    parsed = faulted.select(names).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(build, schema)
    parsed = materialize(parsed, "parsed")
    join, cells = _joined(kind)
    edges = parsed.where(~F.col("whole"))
    cut = materialize(edges.groupBy("conv").applyInArrow(join, cells), "cut")

    # Texts of the conversations at the edges of tasks, streamed in order after their audit.
    ids = cut.select(F.col("conv").alias("_conv"))
    said = faulted.where("copies > 0").join(ids, F.col("conv").eqNullSafe(F.col("_conv")), "left_semi")
    said = said.select("conv", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "copies")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("copies", "long"))]
    told = said.unionByName(cut.select("conv", "audit", *nothing)).repartition("conv")
    told = told.sortWithinPartitions(F.asc_nulls_first("conv"), F.asc_nulls_last("audit"), *order[1:])
    told = told.select("conv", "audit", "role", "text", "copies").mapInArrow(_told, f"conv {kind}, repaired string")
    told = told.withColumnRenamed("conv", "_conv")
    whole = cut.join(told, F.col("conv").eqNullSafe(F.col("_conv")))
    columns = [F.col("conv").alias("conv_id"), *COUNTS, "audit", "repaired"]
    return parsed.where("whole").select(*columns).unionByName(whole.select(*columns))
