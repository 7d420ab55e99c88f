"""Cheapest repair of conversations by interval parsing.

A conversation is right if its role initials are ``(s?(ua)+)?``. Its automaton has the states
start, after ``s``, after ``u`` and after ``a``; the repair grammar in Chomsky normal form has a
nonterminal ``pq`` for every two of them, the rules ``pq -> pr rq``, and terminal rules for the
edits of a row: keep, rerole, delete. The cell of a span of rows holds, for each nonterminal, the
least (cost, audit) with which the span is read on the way from ``p`` to ``q``; the audit is
the edits' initials. Insertions need no row, so they enter as a closure in front of each row
and at the end.

Cells are combined bottom-up: spans of one row, of two, of four and so on. With one nonterminal
for every two states, *every* cut of a span gives the same cell, so one cut a span is enough. That the least
of a cell may be taken early holds as audits of one span and cost never are prefixes of each
other: both have one letter a row, so the longer one would have more insertions and cost more.

Rows are sorted by conversation and turn over the whole table and cut into parts, whatever the
conversations' sizes. Parts are parsed on their own, the parts of a conversation are combined, and
the audit goes back to them; a part holds no texts, nor more than a logarithm of its spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierbed.llm.storage import fan_out, saved

START, SYSTEM, USER, ASSISTANT = range(4)
READS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ACCEPTED = (START, ASSISTANT)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NAMES = {"u": "user", "a": "assistant"}
# Blank, tab and the line ends that count as no character.
SPACES = " \t\n\x0b\f\r"

Cell = dict[tuple[int, int], tuple[int, str]]


def product(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for (s, q), (more, rest) in right.items():
            if r == s:
                found = (cost + more, audit + rest)
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


def _insertions() -> Cell:
    """Reading nothing: insertions of users and assistants."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    one: Cell = {(p, q): (INSERT, "I") for (p, letter), q in READS.items() if letter in NAMES}
    for _ in range(4):
        more = product(cell, one)
        cell = {k: min(x[k] for x in (cell, more) if k in x) for k in cell.keys() | more.keys()}
    return cell


INSERTIONS = _insertions()


def leaf(initial: str, truncated: bool, deleted: int = 0) -> Cell:
    """The cell of one row, or of ``deleted`` rows that must go."""
    cell: Cell = {(p, p): (DELETE * max(1, deleted), "D" * max(1, deleted)) for p in range(4)}
    if not deleted:
        for (p, letter), q in READS.items():
            ways = [(REROLE + TRUNCATED * truncated, "R")] if letter in NAMES else []
            ways += [(KEEP + TRUNCATED * truncated, "K")] if letter == initial else []
            if ways:
                cell[p, q] = min([*ways, *([cell[p, q]] if (p, q) in cell else [])])
    return product(INSERTIONS, cell)


_LEAVES = {(i, t): leaf(i, t) for i in "sua-" for t in (False, True)}


class Spans:
    """Cells of neighbouring spans, of decreasing lengths; equal lengths are combined at once."""

    def __init__(self) -> None:
        self.cells: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        length = 1
        while self.cells and self.cells[-1][0] == length:
            cell, length = product(self.cells.pop()[1], cell), 2 * length
        self.cells.append((length, cell))

    def whole(self) -> Cell:
        cell: Cell = {(p, p): (0, "") for p in range(4)}
        for _, left in reversed(self.cells):
            cell = product(left, cell)
        return cell


def cheapest(cell: Cell) -> tuple[int, str]:
    """The least repair of a whole conversation with this cell."""
    ends = product(cell, INSERTIONS)
    return min(ends[START, q] for q in ACCEPTED if (START, q) in ends)


def written(cell: Cell) -> str:
    return "\n".join(f"{p}{q} {cost} {audit}" for (p, q), (cost, audit) in cell.items())


def read(text: str) -> Cell:
    parts = (line.split(" ") for line in text.split("\n"))
    return {(int(pq[0]), int(pq[1])): (int(cost), audit) for pq, cost, audit in parts}


COUNTS = ("n_rows", "blank", "duplicate", "truncated", "illegal", "turns")


class _Part:
    """The rows of one conversation in one part."""

    def __init__(self) -> None:
        self.spans = Spans()
        self.n = dict.fromkeys(COUNTS, 0)
        self.first = self.last = None
        self.least = self.most = None

    def add(self, turn: int | None, initial: str, n: int, blank: bool, cut: bool, again: bool) -> None:
        spare = n if blank or again else n - 1
        if spare < n:
            self.spans.add(_LEAVES[initial, cut])
        if spare:
            self.spans.add(leaf(initial, False, spare))
        self.n["n_rows"] += n
        self.n["blank"] += n * blank
        self.n["duplicate"] += 0 if blank else spare
        self.n["truncated"] += cut and spare < n
        self.n["illegal"] += n - 1 + (self.first is not None and self.last + initial not in ("su", "ua", "au"))
        self.first, self.last = self.first or initial, initial
        if turn is not None:
            self.n["turns"] += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn

    def row(self) -> dict:
        return self.n | {
            "first": self.first, "last": self.last, "least": self.least, "most": self.most,
            "cell": written(self.spans.whole()),
        }


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of sorted batches by runs of equal keys; one batch is held at a time."""
    import itertools

    rows = (row for batch in batches for row in batch.to_pylist())
    return itertools.groupby(rows, key=lambda row: tuple(row[k] for k in keys))


def _out(rows: Iterator[dict], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(fields: dict, conv: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "conv": conv, "binary": pa.binary()}
    return pa.schema([(k, kinds[v]) for k, v in fields.items()])


def _ddl(fields: dict, conv: str) -> str:
    return ", ".join(f"`{k}` {conv if v == 'conv' else v}" for k, v in fields.items())


PARSED = {"conv": "conv", "part": "long"} | dict.fromkeys(COUNTS, "long")
PARSED |= {"first": "string", "last": "string", "least": "long", "most": "long", "cell": "string"}
COMBINED = {"conv": "conv", "part": "long", "piece": "string", "before": "long", "odd": "boolean", "head": "boolean"}
COMBINED |= dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), "long")
COMBINED |= {"audit": "string"}
EDITED = {"conv": "conv", "position": "long", "edit": "string", "role": "string", "key": "binary"}
HASHED = {"conv": "conv", "sha256": "string"}


def _conv_type(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType | None, Iterator[pa.RecordBatch]]:
    import itertools

    head = next(batches, None)
    if head is None:
        return None, iter(())
    return head.schema.field("conv").type, itertools.chain([head], batches)


def _mapped(step, fields: dict):
    """``step`` over grouped rows as a function of Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, batches = _conv_type(iter(batches))
        if conv is not None:
            yield from _out(step(batches), _arrow(fields, conv))

    return run


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for (conv, place), rows in _groups(batches, "conv", "part"):
        part = _Part()
        for r in rows:
            part.add(r["turn"], r["initial"], r["n"], r["blank"], r["cut"], r["again"])
        yield {"conv": conv, "part": place} | part.row()


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for (conv,), found in _groups(batches, "conv"):
        parts, spans = [], Spans()
        total = dict.fromkeys(COUNTS, 0)
        least = most = last = None
        for r in found:
            spans.add(read(r.pop("cell")))
            parts.append((r["part"], r["n_rows"]))
            for k in COUNTS:
                total[k] += r[k]
            total["illegal"] += last is not None and last + r["first"] not in ("su", "ua", "au")
            total["turns"] -= r["least"] is not None and r["least"] == most
            last = r["last"]
            least = r["least"] if least is None else least
            most = most if r["most"] is None else r["most"]
        cost, audit = cheapest(spans.whole())
        at = made = 0
        odd = (len(audit) - audit.count("D")) % 2 == 1
        for i, (place, n) in enumerate(parts):
            end = at
            while n:
                n -= audit[end] != "I"
                end += 1
            piece = audit[at:] if i == len(parts) - 1 else audit[at:end]
            row = {"conv": conv, "part": place, "piece": piece, "before": made, "odd": odd, "head": i == 0}
            if i == 0:
                gaps = 0 if least is None else most - least + 1 - total["turns"]
                row |= {"gaps": gaps, "cost": cost, "audit": audit} | {
                    k: total[k] for k in ("blank", "duplicate", "truncated", "illegal")
                }
            yield row
            at, made = end, made + len(piece) - piece.count("D")


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for (conv, _), rows in _groups(batches, "conv", "part"):
        marker = next(rows)  # sorted before the rows
        piece, position, odd = marker["piece"], marker["before"], marker["odd"]
        at = 0

        def made(letter: str, role: str | None, key: bytes | None, position: int, odd: bool, conv) -> dict:
            due = "s" if odd and not position else "ua"[(position - odd) % 2]
            name = role if letter == "K" else NAMES[due]
            return {"conv": conv, "position": position, "edit": letter, "role": name, "key": key}

        for r in rows:
            left = r["n"]
            while left:
                letter = piece[at]
                at += 1
                left -= letter != "I"
                if letter != "D":
                    own = letter != "I"
                    yield made(letter, r["role"] if own else None, r["key"] if own else None, position, odd, conv)
                    position += 1
        for letter in piece[at:]:
            yield made(letter, None, None, position, odd, conv)
            position += 1


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for (conv,), rows in _groups(batches, "conv"):
        digest = hashlib.sha256()
        for i, r in enumerate(rows):
            digest.update(f"{chr(10) if i else ''}{r['role']}:{r['text']}".encode())
        yield {"conv": conv, "sha256": digest.hexdigest()}


class Repair(NamedTuple):
    conversations: DataFrame
    turns: DataFrame


def _key(*names: str) -> Column:
    return F.unhex(F.md5(F.to_json(F.struct(*names), {"ignoreNullFields": "false"})))


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` rows as the repair is tried on: nulls in role and text are one blank, and
    crc32(``conv_id:turn``) % 20 drops, empties, cuts, repeats or reroles some."""
    number = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(number[0], F.lit(":"), number[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .filter("kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "")
            .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def repair_turns(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Repair:
    """The cheapest repair of every conversation in ``rows``.

    ``conversations``: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``, one row
    each. A row's first fault counts: blank, duplicate (role and text of an earlier row), truncated
    (the last character is none of ``.!?``). Keep costs 0, rerole to user or assistant 2, delete 3,
    insertion of an empty user or assistant 2; a truncated row that stays 1 more. Blank and
    duplicate rows must go. ``audit`` has the edits' initials of the cheapest repair, of several
    the least in ASCII. ``gaps`` counts absent turns between the least and the greatest.

    ``turns``: ``conv, position, edit, role, text`` of the repaired conversations' rows, from 0.

    Rows go by turn, nulls first, then by role and the text's digest; equal rows are interchangeable. Null
    roles and texts are one blank. Roles count by their first character; an empty role fits
    nowhere, but can be reroled. A null conversation id is a conversation. Turns must be whole numbers. An
    empty table gives no rows; other columns are ignored. One conversation may hold any share of the rows.
    Texts are compared by 128-bit digests.
    """
    spark, n = rows.sparkSession, fan_out(rows.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    base = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), role.alias("role"), text.alias("text")
    ).withColumn("digest", F.unhex(F.md5("text")))
    conv_type = base.schema["conv"].dataType.simpleString()

    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.left("role", F.lit(1))
    distinct = base.groupBy(
        "conv", "turn", "role", "digest",
        (bare == "").alias("blank"),
        ((bare != "") & ~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    ).agg(F.count("*").alias("n"))
    light = distinct.withColumn("same", _key("conv", "role", "digest"))
    when = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("at"))
    firsts = light.filter("not blank").groupBy("same").agg(F.min(when).alias("earliest"))
    flagged = light.join(firsts, "same", "left").select(
        "conv", "turn", "role", "digest", "n", "blank", "cut",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
        (~F.col("blank") & (when != F.col("earliest"))).alias("again"),
    )

    order = ["conv", "turn", "role", "digest"]
    at = F.monotonically_increasing_id()
    placed = saved(
        flagged.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("at", at)
        .withColumn("part", F.shiftright("at", 33)),
        "repair-rows",
    )

    def dealt(df: DataFrame, by: list[str], *then: str) -> DataFrame:
        return df.repartition(n, *by).sortWithinPartitions(*by, *then)

    cells = dealt(
        placed.select("conv", "part", "at", "turn", "initial", "n", "blank", "cut", "again"), ["conv", "part"], "at"
    ).mapInArrow(_mapped(_parse, PARSED), _ddl(PARSED, conv_type))
    combined = saved(
        dealt(cells, ["conv"], "part").mapInArrow(_mapped(_combine, COMBINED), _ddl(COMBINED, conv_type)),
        "repair-audits",
    )
    conversations = combined.filter("head").drop("part", "piece", "before", "odd", "head")

    marked = combined.select("conv", "part", F.lit(-1).cast("bigint").alias("at"), "piece", "before", "odd")
    own = placed.select("conv", "part", "at", "role", "n", _key("conv", "turn", "role", "digest").alias("key"))
    edits = dealt(own.unionByName(marked, allowMissingColumns=True), ["conv", "part"], "at").mapInArrow(
        _mapped(_edit, EDITED), _ddl(EDITED, conv_type)
    )
    texts = (
        base.select(_key("conv", "turn", "role", "digest").alias("key"), "text")
        .groupBy("key")
        .agg(F.first("text").alias("text"))
    )
    # Insertions have no text and no key, so they stay out of the join.
    inserted = edits.filter("key is null").select("conv", "position", "edit", "role", F.lit("").alias("text"))
    kept = edits.filter("key is not null").join(texts, "key").select("conv", "position", "edit", "role", "text")
    return Repair(conversations, kept.unionByName(inserted))


def repaired_digests(turns: DataFrame) -> DataFrame:
    """``conv, sha256`` of the repaired ``role:text`` rows, joined by line breaks.

    A hash of one text cannot be shared out, so one task reads a conversation; it streams.
    """
    conv_type = turns.schema["conv"].dataType.simpleString()
    sorted_ = turns.repartition(fan_out(turns.sparkSession), "conv").sortWithinPartitions("conv", "position")
    return sorted_.select("conv", "role", "text").mapInArrow(_mapped(_hash, HASHED), _ddl(HASHED, conv_type))
