"""Conversation structure repair: the cheapest edits that give every conversation the form system? (user assistant)+.

The edits of a conversation are found by a dynamic program over its rows, whose states are the roles that came last. An
audit (the initials of the edits) is a linked list that grows at its end, so all states share their prefixes; nodes carry
binary-lifting ancestors and rolling hashes, and two audits of equal cost are compared at the end of their longest common
prefix, which a search over the ancestors finds. What hashes call equal is verified along the links.

The program is a product of matrices (cheapest way from state to state), so a long conversation is worked in pieces, in
any number of tasks, and joined from the pieces' matrices. Rows are ordered by ranges, which split a hot conversation.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import common

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: What edits cost; a truncated row that stays adds ``TRUNCATED``.
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
#: States: nothing yet, or the role that came last. Initials lead from state to state.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Where an inserted or changed row leads, and the inserted rows at the end that complete a conversation.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDING = {START: "", ASSISTANT: "", USER: INSERT, SYSTEM: INSERT + INSERT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Rows and characters of a piece.
PIECE, PIECE_CHARS = 1024, 1 << 22
#: Patterns of so many rows at most are kept with their answers, so many of them in a worker.
SHORT, KEPT = 64, 50_000
_SPACES = " \t\n\x0b\x0c\r"
_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E681


class Audits:
    """Strings that share their prefixes: a node is a prefix, its item what is added to the parent (the root is 0)."""

    def __init__(self):
        self.item, self.up, self.depth, self.hash = [""], [()], [0], [1]

    def push(self, node: int, item: str) -> int:
        ups, step, k = [node], node, 0
        while k < len(self.up[step]):
            step = self.up[step][k]
            ups.append(step)
            k += 1
        code = ord(item) if len(item) == 1 else int.from_bytes(hashlib.blake2b(item.encode(), digest_size=8).digest(), "little")
        self.item.append(item)
        self.up.append(tuple(ups))
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + code + 1) % _PRIME)
        return len(self.item) - 1

    def extended(self, node: int, items: str) -> int:
        for x in items:
            node = self.push(node, x)
        return node

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            left = self.depth[node] - depth
            node = self.up[node][min(left.bit_length() - 1, len(self.up[node]) - 1)]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth are the same string, item by item until they share a node."""
        while a != b:
            if self.item[a] != self.item[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def items(self, node: int) -> list[str]:
        found = []
        while node:
            found.append(self.item[node])
            node = self.up[node][0]
        return found[::-1]

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        if a == b:
            return False
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] == self.hash[y] and self.same(x, y):
            return self.depth[a] < self.depth[b]
        for k in reversed(range(depth.bit_length())):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if self.same(self.up[x][0], self.up[y][0]) and self.item[x] != self.item[y]:
            return self.item[x] < self.item[y]
        return self.items(a) < self.items(b)  # two strings with one hash


@functools.cache
def moves(symbol: str) -> tuple[tuple[int, int, int, str], ...]:
    """From state, to state, cost and edits of a row, with what may be inserted before it.

    ``symbol`` is the initial of the role (``o`` for others), a capital if the row is truncated, or ``x`` if it must go.
    """
    best: dict[tuple[int, int], tuple[int, str]] = {}
    extra = TRUNCATED if symbol.isupper() else 0
    for state in range(4):
        at, label, cost = state, "", 0
        for _ in range(3):
            ways = [(at, COST[DELETE], DELETE)]
            if symbol != "x":
                ways.append((NEXT[at], COST[REROLE] + extra, REROLE))
                if (at, symbol.lower()) in AFTER:
                    ways.append((AFTER[at, symbol.lower()], COST[KEEP] + extra, KEEP))
            for to, more, edit in ways:
                way = (cost + more, label + edit)
                best[state, to] = min(best.get((state, to), way), way)
            at, label, cost = NEXT[at], label + INSERT, cost + COST[INSERT]
    return tuple((a, b, cost, label) for (a, b), (cost, label) in best.items())


def walk(audits: Audits, start: int, pattern: str) -> dict[int, tuple[int, int]]:
    """Cost and audit of the cheapest way from a state through a pattern to every state."""
    states = {start: (0, 0)}
    for symbol in pattern:
        after: dict[int, tuple[int, int]] = {}
        for a, b, cost, label in moves(symbol):
            if a not in states:
                continue
            total = states[a][0] + cost
            if b not in after or total < after[b][0]:
                after[b] = (total, audits.extended(states[a][1], label))
            elif total == after[b][0]:
                node = audits.extended(states[a][1], label)
                if audits.less(node, after[b][1]):
                    after[b] = (total, node)
        states = after
    return states


def finish(audits: Audits, states: dict[int, tuple[int, int]]) -> tuple[int, int]:
    """The best of all states when nothing follows. A piece that ends a conversation may be followed by inserted rows."""
    best = None
    for state, (cost, node) in sorted(states.items()):
        cost, node = cost + COST[INSERT] * len(ENDING[state]), audits.extended(node, ENDING[state])
        if best is None or cost < best[0] or cost == best[0] and audits.less(node, best[1]):
            best = (cost, node)
    return best


def _cheapest(pattern: str) -> tuple[int, str]:
    audits = Audits()
    cost, node = finish(audits, walk(audits, START, pattern))
    return cost, "".join(audits.items(node))


_cheapest_of_short = functools.lru_cache(KEPT)(_cheapest)


def cheapest(pattern: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation, given as its rows' symbols."""
    return _cheapest_of_short(pattern) if len(pattern) <= SHORT else _cheapest(pattern)


def matrix(pattern: str) -> tuple[list[int], list[str]]:
    """Cost (-1 if there is no way) and audit from each state to each state."""
    costs, labels = [-1] * 16, [""] * 16
    for start in range(4):
        audits = Audits()
        for state, (cost, node) in walk(audits, start, pattern).items():
            costs[4 * start + state], labels[4 * start + state] = cost, "".join(audits.items(node))
    return costs, labels


def edited(audit: str, state: int, rows: list[tuple[str, str]]) -> tuple[list[tuple[str, str]], int]:
    """The rows (role, text) after the edits, and the state they lead to."""
    out, at = [], iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(at)
        if edit == DELETE:
            continue
        if edit == KEEP:
            state = AFTER[state, role[:1]]
        else:
            state = NEXT[state]
            role = ROLE[state]
        out.append((role, text))
    return out, state


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows after damage that depends on the crc32 of ``key:turn`` modulo 20, with the same four columns.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user. Nulls of the key and the
    turn count as one space in the crc32, and null roles and texts become one space. Repeated rows are damaged each.
    """
    names = (key, turn, role, text)
    spaced = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced(key), F.lit(":"), spaced(turn))) % 20
    out = rows.select(rows[key].alias("k"), rows[turn].alias("n"), spaced(role).alias("r"), spaced(text).alias("t"), kind.alias("d")).filter("d <> 0")
    out = out.withColumn("r", F.when(F.col("d") == 4, "user").otherwise(F.col("r")))
    out = out.withColumn("t", F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("t", ".!?", "")).otherwise(F.col("t")))
    out = out.withColumn("again", F.explode(F.when(F.col("d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return out.select(*[F.col(c).alias(name) for c, name in zip("knrt", names)])


def _marked(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Equal rows of a conversation once, with their number, and the symbol of the first of them."""
    spaced = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    plain = rows.select(rows[key].alias("k"), rows[turn].cast("long").alias("n"), spaced(role).alias("r"), spaced(text).alias("t"))
    # Where a role and text of a conversation occur first; only those of several turns matter. Nulls come first.
    order = F.struct(F.col("n").isNotNull().alias("known"), "n")
    digest = F.sha2(F.encode("t", "UTF-8"), 256)
    narrow = plain.select("k", "r", digest.alias("h"), order.alias("o")).groupBy("k", "r", "h").agg(F.min("o").alias("lo"), F.max("o").alias("hi"))
    first = common.written(narrow.filter("lo <> hi").select(F.col("k").alias("fk"), F.col("r").alias("fr"), "h", "lo"), "first")
    one = plain.groupBy("k", "n", "r", "t").agg(F.count("*").alias("copies")).withColumn("own", digest)
    same = F.col("k").eqNullSafe(F.col("fk")) & (F.col("r") == F.col("fr")) & (F.col("own") == F.col("h"))
    one = one.join(common.if_small(first), same, "left")
    rest = F.rtrim(F.col("t"), F.lit(_SPACES))
    fault = F.when(rest == "", "blank").when(F.col("lo") < order, "duplicate").when(~F.right(rest, F.lit(1)).isin(".", "!", "?"), "truncated")
    return one.select("k", "n", "r", "t", "copies", fault.alias("fault"))


_COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")
_LEGAL = ("su", "ua", "au")


def _piece_schema(kind: str) -> str:
    counts = ", ".join(f"`{x}` bigint" for x in _COUNTS)
    return (
        f"k {kind}, part int, seq int, whole boolean, {counts}, lo bigint, hi bigint, opens string, closes string, "
        "cost bigint, audit string, sha string, costs array<bigint>, labels array<string>, roles array<string>, texts array<string>"
    )


class Piece:
    """Rows in a row of one conversation."""

    def __init__(self, key):
        self.key, self.count = key, dict.fromkeys(_COUNTS, 0)
        self.rows: list[tuple[str, str]] = []
        self.symbols: list[str] = []
        self.lo = self.hi = self.opens = self.closes = None
        self.chars = 0

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        count, initial = self.count, role[:1]
        count["rows"] += 1
        if fault:
            count[fault] += 1
        if self.rows and self.closes + initial not in _LEGAL:
            count["illegal"] += 1
        if not self.rows:
            self.opens = initial
        self.closes = initial
        if turn is not None:
            count["turns"] += self.hi != turn
            self.lo, self.hi = turn if self.lo is None else self.lo, turn
        symbol = initial if initial in ("s", "u", "a") else "o"
        self.symbols.append("x" if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol)
        self.rows.append((role, text))
        self.chars += len(text)

    @property
    def pattern(self) -> str:
        return "".join(self.symbols)


def joined(lines: list[tuple[str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in lines).encode()


def _scan(kind: pa.DataType, size: int):
    """Over rows in order: whole conversations with their answers, and pieces of those that may go on in other tasks."""
    names = ["k", "part", "seq", "whole", *_COUNTS, "lo", "hi", "opens", "closes", "cost", "audit", "sha", "costs", "labels", "roles", "texts"]
    strings, ints = pa.list_(pa.string()), pa.list_(pa.int64())
    kinds = [kind, pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * (len(_COUNTS) + 2), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), ints, strings, strings, strings]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, out, held = TaskContext.get().partitionId(), 0, [], 0
        run_no, piece, pieces = 0, None, 0

        def row(p: Piece, whole: bool) -> tuple:
            nonlocal seq, held
            seq += 1
            held += p.chars + 100
            cost, audit, sha, costs, labels = None, None, None, None, None
            if whole:
                cost, audit = cheapest(p.pattern)
                sha = hashlib.sha256(joined(edited(audit, START, p.rows)[0])).hexdigest()
            else:
                costs, labels = matrix(p.pattern)
            texts = ([r for r, _ in p.rows], [t for _, t in p.rows]) if not whole else (None, None)
            return (p.key, part, seq, whole, *[p.count[c] for c in _COUNTS], p.lo, p.hi, p.opens, p.closes, cost, audit, sha, costs, labels, *texts)

        def batch() -> pa.RecordBatch:
            nonlocal out, held
            columns = list(zip(*out)) or [()] * len(names)
            out, held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        for given in batches:
            for start in range(0, given.num_rows, common.SLICE):
                for key, turn, role, text, copies, fault in zip(*[c.to_pylist() for c in given.slice(start, common.SLICE).columns]):
                    if piece is None or key != piece.key:
                        if piece is not None:
                            out.append(row(piece, run_no > 1 and pieces == 0))
                        run_no, piece, pieces = run_no + 1, Piece(key), 0
                    for i in range(copies):
                        if len(piece.rows) >= size or piece.chars >= PIECE_CHARS:
                            out.append(row(piece, False))
                            piece, pieces = Piece(key), pieces + 1
                        piece.add(turn, role, text, fault if i == 0 or fault == "blank" else "duplicate")
                    if len(out) >= 1000 or held >= PIECE_CHARS:
                        yield batch()
        if piece is not None:
            out.append(row(piece, False))
        yield batch()

    return run


_TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _link(kind: pa.DataType):
    """Over the pieces of conversations in order: the audit of each piece, and with the last one the totals."""
    names = ["part", "seq", "state", "edits", "k", *_TOTALS]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), kind, *[pa.int64()] * 6, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        audits, states, before = Audits(), {}, {}

        def closed() -> pa.RecordBatch:
            cost, node = finish(audits, states)
            edits = audits.items(node)
            tail = "".join(edits[len(held) :])  # rows inserted at the end
            edits = edits[: len(held)]
            full = "".join(edits) + tail
            edits[-1] += tail
            at = audits.ancestor(node, len(held))
            starts = []
            while at:
                starts.append(before[at])
                at = audits.up[at][0]
            total = {c: sum(x[c] for x in held) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
            known = [x for x in held if x["lo"] is not None]
            for x, y in zip(held, held[1:]):
                total["illegal"] += x["closes"] + y["opens"] not in _LEGAL
                total["turns"] -= x["hi"] is not None and x["hi"] == y["lo"]
            gaps = known[-1]["hi"] - known[0]["lo"] + 1 - total["turns"] if known else 0
            totals = (gaps, *[total[c] for c in _TOTALS[1:5]], cost, full)
            out = [(x["part"], x["seq"], s, e, x["k"], *[None] * len(_TOTALS)) for x, s, e in zip(held, reversed(starts), edits)]
            out[-1] = (*out[-1][:5], *totals)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        for batch in batches:
            for x in batch.to_pylist():
                if held and x["k"] != held[0]["k"]:
                    yield closed()
                    held = []
                if not held:
                    audits, states, before = Audits(), {START: (0, 0)}, {}
                costs, labels = x.pop("costs"), x.pop("labels")
                after: dict[int, tuple[int, int]] = {}
                for a, (cost, node) in states.items():
                    for b in range(4):
                        if costs[4 * a + b] < 0:
                            continue
                        total = cost + costs[4 * a + b]
                        if b in after and total > after[b][0]:
                            continue
                        # All labels end with the edit of a row, so none is the beginning of another one.
                        way = audits.push(node, labels[4 * a + b])
                        before[way] = a
                        if b not in after or total < after[b][0] or audits.less(way, after[b][1]):
                            after[b] = (total, way)
                states = after
                held.append(x)
        if held:
            yield closed()

    return run


def _hash(kind: pa.DataType):
    """Over the repaired pieces in order: one row for each conversation, with the hash of all its lines."""
    names = ["k", *_TOTALS, "sha"]
    kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, some = hashlib.sha256(), False
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                x = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if x["lines"]:
                    digest.update((b"\n" if some else b"") + x["lines"])
                    some = True
                if x["audit"] is not None:  # the last piece
                    out.append((x["k"], *[x[c] for c in _TOTALS], digest.hexdigest()))
                    digest, some = hashlib.sha256(), False
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return run


def _lines(roles: pa.Array, texts: pa.Array, edits: pa.Array, states: pa.Array) -> pa.Array:
    out = []
    for i in range(len(roles)):
        rows = list(zip(roles[i].as_py(), texts[i].as_py()))
        out.append(joined(edited(edits[i].as_py(), states[i].as_py(), rows)[0]))
    return pa.array(out, pa.binary())


def repair(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = PIECE,
) -> DataFrame:
    """One row for each conversation: ``key``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit`` and ``repaired_sha256`` of the ``role:text`` lines after the edits, joined by line breaks.

    Rows are taken by turn (nulls first), then role and a digest of the text; null roles and texts are one space. A row
    counts with its first fault: blank (nothing but ASCII spaces), duplicate (role and text seen earlier in the
    conversation) or truncated (the last other character is none of ``.!?``). ``gaps`` are the turns missing between the
    first and the last one. ``illegal`` are neighbours whose roles don't follow each other; a role is known by its
    initial, and one that begins otherwise must be changed or go. Of the cheapest audits the least in ASCII is taken. Repeated
    rows are duplicates. All rows with a null key are one conversation. An empty table gives an empty one; other columns
    are not read. ``piece`` is the rows that are worked at once.
    """
    found = _marked(rows, key, turn, role, text)
    kind = found.schema["k"].dataType.simpleString()
    arrow = pa.RecordBatch.from_arrays([_empty(found.schema["k"].dataType)], ["k"]).schema.field("k").type
    digest = F.sha2(F.encode("t", "UTF-8"), 256)
    order = (F.asc_nulls_first("k"), F.asc_nulls_first("n"), "r", digest)
    ordered = found.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = common.written(common.map_in_arrow(ordered, _scan(arrow, piece), _piece_schema(kind)), "pieces")
    whole = pieces.filter("whole").select("k", F.when(F.col("lo").isNull(), F.lit(0)).otherwise(F.col("hi") - F.col("lo") + 1 - F.col("turns")).alias("gaps"), *_TOTALS[1:], "sha")

    some = pieces.filter("NOT whole").drop("roles", "texts", "whole", "cost", "audit", "sha", "rows")
    some = some.repartition("k").sortWithinPartitions("k", "part", "seq")
    totals = ", ".join(f"{c} bigint" for c in _TOTALS[:-1]) + ", audit string"
    linked = common.map_in_arrow(some, _link(arrow), f"part int, seq int, state int, edits string, k {kind}, {totals}")
    linked = common.written(linked, "linked")
    texts = pieces.filter("NOT whole").select("part", "seq", "roles", "texts")
    lines = linked.join(texts, ["part", "seq"]).select("k", "part", "seq", *_TOTALS, common.arrow_udf(_lines, "binary")("roles", "texts", "edits", "state").alias("lines"))
    lines = lines.repartition("k").sortWithinPartitions("k", "part", "seq")
    rest = common.map_in_arrow(lines.drop("part", "seq"), _hash(arrow), f"k {kind}, {totals}, sha string")
    return whole.unionAll(rest).select(F.col("k").alias(key), *_TOTALS, F.col("sha").alias("repaired_sha256"))


def _empty(kind) -> pa.Array:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.array([], to_arrow_type(kind))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The damaged conversations with their repair; those without rows after the damage have zeros."""
    rows = common.table(spark, folder, "conversations")
    found = repair(damaged(rows))
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    out = ids.join(found, ids["id"].eqNullSafe(found["conv_id"]), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    empty = hashlib.sha256().hexdigest()
    return out.select(
        F.col("id").alias("conv_id"), *[zero(c) for c in _TOTALS[:-1]], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )


def _sql() -> str:
    """The same rows in SQL: one recursion over the rows of each conversation with the best way to each state."""
    line = lambda role, text="''": f"|| chr(10) || {role} || ':' || {text}"

    def way(state: str, cost: str, edits: str, lines: str = "") -> str:
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edits}', 'o': {state}.o {lines}}} END"

    def best(*ways: str) -> str:
        return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))[1]"

    user, helper = line("'user'"), line("'assistant'")
    before = (
        f"s0 AS p0, s1 AS p1, {best('s2', *[way(s, '3', 'I', user) for s in ('s0', 's1', 's3')])} AS p2, "
        f"{best('s3', way('s2', '3', 'I', helper), *[way(s, '6', 'II', user + helper) for s in ('s0', 's1')])} AS p3"
    )
    gone = lambda p: way(p, "4", "D")
    stay = lambda p, i: f"CASE WHEN NOT must AND i = '{i}' THEN {way(p, 'late', 'K', line('r', 't'))} END"
    change = lambda p, to: f"CASE WHEN NOT must THEN {way(p, '(3 + late)', 'R', line(to, 't'))} END"
    to_user = [f(p, x) for p in ("p0", "p1", "p3") for f, x in ((stay, "u"), (change, "'user'"))]
    after = (
        f"{best(gone('p0'))} AS s0, {best(gone('p1'), stay('p0', 's'))} AS s1, {best(gone('p2'), *to_user)} AS s2, "
        f"""{best(gone('p3'), stay('p2', 'a'), change('p2', "'assistant'"))} AS s3"""
    )
    way_type = "STRUCT(c BIGINT, a VARCHAR, o VARCHAR)"
    none = f"NULL::{way_type}"
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    end = best("s0", "s3", way("s2", "3", "I", helper), way("s1", "6", "II", user + helper))
    return f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT) AS bytes
  FROM conversations),
coded AS (
  SELECT *, xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], bytes), lambda crc, b:
    list_reduce([xor(crc, b), 0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1))))) % 20 AS d
  FROM given),
hurt AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE r END AS r,
    CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(t, '.!?', '') ELSE t END AS t,
    unnest(CASE WHEN d = 3 THEN [0, 1] ELSE [0] END) AS again
  FROM coded WHERE d <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, sha256(t), again) AS n, rtrim(t, {spaces}) AS rest FROM hurt),
marked AS (
  SELECT *, left(r, 1) AS i, rest = '' AS is_blank, rest <> '' AND row_number() OVER (PARTITION BY conv_id, r, t ORDER BY n) > 1 AS is_copy,
    lag(left(r, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(r, 1) AS pair
  FROM placed),
steps AS (
  SELECT *, is_blank OR is_copy AS must, CASE WHEN NOT is_blank AND NOT is_copy AND right(rest, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS late
  FROM marked),
ways AS (
  SELECT conv_id, 0::BIGINT AS n, {{'c': 0, 'a': '', 'o': ''}}::{way_type} AS s0, {none} AS s1, {none} AS s2, {none} AS s3
  FROM steps WHERE n = 1
  UNION ALL
  SELECT conv_id, n, {after} FROM (
    SELECT x.conv_id, x.n, x.r, x.t, x.i, x.must, x.late, {before}
    FROM ways AS w JOIN steps AS x ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.n = w.n + 1) AS q),
totals AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE is_blank) AS blank,
    count(*) FILTER (WHERE is_copy) AS duplicate, count(*) FILTER (WHERE late > 0) AS truncated,
    count(*) FILTER (WHERE pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM steps GROUP BY conv_id),
ended AS (SELECT w.conv_id, {end} AS e FROM ways AS w JOIN totals AS z ON w.conv_id IS NOT DISTINCT FROM z.conv_id AND w.n = z.n)
SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.c, 0)::BIGINT AS cost,
  coalesce(e.a, '') AS audit, sha256(substr(coalesce(e.o, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS g
LEFT JOIN totals AS z ON z.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN ended AS f ON f.conv_id IS NOT DISTINCT FROM g.conv_id"""


SQL = _sql()
