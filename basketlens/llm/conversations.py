"""Conversation structure repair by weighted interval parsing.

The grammar is in Chomsky normal form.  A nonterminal ``pq`` stands for rows whose edits take a conversation from state
``p`` to state ``q`` of ``(s?(ua)+)?``: 0 nothing yet, 1 a system turn, 2 a user turn that waits for its answer, 3 an answered
one.  ``pr -> pq qr`` are the binary rules; a single row, kept, given a role or deleted, gives the terminal ones; turns inserted
beside it close them.  A cell holds the least (cost, audit) of a nonterminal over a span of rows.

Two audits of one cell with the same cost are never one the beginning of the other (the longer would hold more insertions), so the least of a
span is made of the least of its parts.  Spans of up to ``BLOCK`` rows are parsed bottom-up over all spans and splits.  As the states
make the grammar associative, longer conversations need one split per span: neighbouring spans combine two by two.
"""

from __future__ import annotations

import hashlib
import itertools

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.session import Scratch

by_value(__name__)

BLOCK = 16  # rows parsed over all spans and splits
BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
HEAD = 64  # characters by which rows of one turn and role are ordered, before their digest

DELETE, RENAME, INSERT, CUT = 3, 2, 2, 1  # costs; CUT: a row that ends early and stays
STATES = range(4)
USER_FROM, ANSWER_FROM = (0, 1, 3), (2,)  # states in which a user's or an assistant's turn may come
PAIRS = ["00", "01", "02", "03", "11", "12", "13", "22", "23", "32", "33"]  # nonterminals that derive anything
RULES = [(p + r, p + q, q + r) for p, q, r in itertools.product("0123", repeat=3) if {p + q, q + r, p + r} <= set(PAIRS)]

Cells = dict[str, tuple[int, str]]


def combine(left: Cells, right: Cells, into: Cells | None = None) -> Cells:
    """Least cells of a span from those of its two parts; ``into`` holds what other splits gave."""
    out = {} if into is None else into
    for whole, first, second in RULES:
        if first in left and second in right:
            a, b = left[first], right[second]
            cost = a[0] + b[0]
            if whole not in out or cost < out[whole][0] or cost == out[whole][0] and a[1] + b[1] < out[whole][1]:
                out[whole] = (cost, a[1] + b[1])
    return out


def _inserted() -> Cells:
    """The empty span: nothing, one inserted turn, or two."""
    one = {f"{p}{2 if p in USER_FROM else 3}": (INSERT, "I") for p in STATES}
    cells = {f"{p}{p}": (0, "") for p in STATES}
    for _ in STATES:
        cells = combine(cells, one, dict(cells))
    return cells


EMPTY = _inserted()
KNOWN_SPANS = 20_000  # parsed spans that a task remembers


def row_cells(symbol: str) -> Cells:
    """One row.  ``symbol``: the role's initial if it is s, u or a, else o; a capital if the row ends early; x if it must go."""
    cells = {f"{p}{p}": (DELETE, "D") for p in STATES}
    if symbol != "x":
        role, more = symbol.lower(), CUT * symbol.isupper()
        for froms, to, own in ((USER_FROM, 2, "u"), (ANSWER_FROM, 3, "a")):
            cells |= {f"{p}{to}": (more, "K") if role == own else (more + RENAME, "R") for p in froms}
        if role == "s":
            cells["01"] = (more, "K")
    return combine(combine(EMPTY, cells), EMPTY)


ROWS = {symbol: row_cells(symbol) for symbol in "suaoSUAOx"}


def parse(symbols: str) -> Cells:
    """Cells of a span of at most ``BLOCK`` rows: all spans by length, over all splits."""
    n = len(symbols)
    if not n:
        return EMPTY
    table = {(at, at + 1): ROWS[s] for at, s in enumerate(symbols)}
    for length in range(2, n + 1):
        for start in range(n - length + 1):
            cells: Cells = {}
            for middle in range(start + 1, start + length):
                combine(table[start, middle], table[middle, start + length], cells)
            table[start, start + length] = cells
    return table[0, n]


class Span:
    """Cells of a growing sequence of rows: parsed blocks, neighbours of like length combined as soon as there are two.

    ``known`` remembers blocks by their symbols, as many conversations are alike.
    """

    def __init__(self, known: dict[str, Cells]) -> None:
        self.known, self.open, self.done = known, [], []  # done: (blocks, cells), fewer blocks towards the end

    def _parsed(self) -> Cells:
        symbols = "".join(self.open)
        if symbols not in self.known:
            if len(self.known) >= KNOWN_SPANS:
                self.known.clear()
            self.known[symbols] = parse(symbols)
        return self.known[symbols]

    def add(self, symbol: str) -> None:
        self.open.append(symbol)
        if len(self.open) == BLOCK:
            self.append(1, self._parsed())
            self.open.clear()

    def append(self, blocks: int, cells: Cells) -> None:
        while self.done and self.done[-1][0] <= blocks:
            before, left = self.done.pop()
            blocks, cells = before + blocks, combine(left, cells)
        self.done.append((blocks, cells))

    def cells(self) -> Cells:
        out = self._parsed()
        for _, left in reversed(self.done):
            out = combine(left, out)
        return out


LEGAL = ("su", "ua", "au")
COUNTS = ["blank", "duplicate", "truncated"]


class Run:
    """What is known of consecutive rows of one conversation."""

    def __init__(self, conv, known: dict[str, Cells]) -> None:
        self.conv, self.span = conv, Span(known)
        self.rows = self.illegal = self.turns = 0
        self.count = dict.fromkeys(COUNTS, 0)
        self.first = self.last = self.low = self.high = None

    def add(self, turn, initial: str, symbol: str, fault: str | None, times: int) -> None:
        for at in range(times):
            self.illegal += self.rows > 0 and self.last + initial not in LEGAL
            self.first = initial if not self.rows else self.first
            self.last, self.rows = initial, self.rows + 1
            self.span.add("x" if at else symbol)
            # A second copy of a row is a duplicate, unless it is blank.
            if kind := (fault if not at or fault == "blank" else "duplicate"):
                self.count[kind] += 1
        if times and turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def summary(self) -> dict:
        return {"rows": self.rows, "illegal": self.illegal, "turns": self.turns, "first": self.first, "last": self.last,
                "low": self.low, "high": self.high} | self.count


def joined(a: dict, b: dict) -> dict:
    """Summary of a run that is followed by another of its conversation."""
    if not a["rows"] or not b["rows"]:
        return a if a["rows"] else b
    out = {k: a[k] + b[k] for k in ("rows", "illegal", "turns", *COUNTS)}
    out["illegal"] += a["last"] + b["first"] not in LEGAL
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    out |= {"first": a["first"], "last": b["last"], "low": b["low"] if a["low"] is None else a["low"], "high": a["high"] if b["high"] is None else b["high"]}
    return out


def finished(conv, summary: dict, cells: Cells) -> dict:
    cost, audit = min(cells["00"], cells["03"])
    gaps = 0 if summary["low"] is None else summary["high"] - summary["low"] + 1 - summary["turns"]
    return {"conv_id": conv, "gaps": gaps, "illegal": summary["illegal"], "cost": cost, "audit": audit} | {k: summary[k] for k in COUNTS}


COUNTED = ["gaps", *COUNTS, "illegal", "cost"]
NAMES = ["conv_id", *COUNTED, "audit"]
RESULT = ", ".join(f"{c} long" for c in COUNTED) + ", audit string"
LONGS, TEXTS = ["rows", "illegal", "turns", "low", "high", *COUNTS], ["first", "last"]
PARTIAL = "struct<" + ", ".join([f"{c}: long" for c in LONGS] + [f"{c}: string" for c in TEXTS]) + ">"


def _fields(conv: pa.DataType) -> list:
    """Arrow's form of ``conv_id`` and ``RESULT``."""
    return [("conv_id", conv), *[(c, pa.int64()) for c in COUNTED], ("audit", pa.string())]


def _partial_fields(conv: pa.DataType) -> list:
    partial = pa.struct([(c, pa.int64()) for c in LONGS] + [(c, pa.string()) for c in TEXTS])
    return [*_fields(conv), ("part", pa.int32()), ("border", pa.bool_()), ("partial", partial), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``times``: the rows after damage; ``times`` is 0 for a dropped row, 2 for a repeated one.

    A row's damage follows from the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops it, 1 empties the text, 2 takes its ``.!?``, 3 repeats
    the row, 4 sets the role to user.  Nulls read as one space.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("said", ".!?", "")).otherwise(F.col("said"))
    rows = conversations.select(F.col("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("by"), spaced("text").alias("said"), how.alias("how"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("by")).alias("role"), text.alias("text"),
        F.when(F.col("how") == 0, 0).when(F.col("how") == 3, 2).otherwise(1).alias("times"),
    )


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("head", F.left("text", F.lit(HEAD))).withColumn("digest", F.unhex(F.sha2("text", 256)))


ORDER = ["turn", "role", "head", "digest"]


def repairs(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per ``conv_id``: the faults after damage, and ``cost`` and ``audit`` of the cheapest repair.

    Rows are dealt by ranges of (conversation, order), so a conversation of any length spreads over tasks, each of which reads its rows as a stream;
    what it knows of a conversation that may go on in another task is joined afterwards, two at most per task.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    rows = _ordered(damaged(conversations)).select(
        "conv_id", "times", *ORDER, F.right(F.rtrim("text", F.expr(BLANKS)), F.lit(1)).alias("last_sign"))
    # Copies of a row become one with a count before they meet.
    rows = scratch.write(rows.groupBy("conv_id", *ORDER, "last_sign").agg(F.sum("times").alias("times")), "rows")
    said = (
        rows.where("times > 0").groupBy("conv_id", "role", "digest")
        .agg(F.count("*").alias("turns"), F.min(F.struct("turn")).alias("first")).where("turns > 1")
        .selectExpr("conv_id as of_conv", "role as of_role", "digest as of_digest", "first.turn as first_turn", "true as again")
    )
    said = scratch.write(said, "said")
    rows = rows.join(said, F.expr("conv_id <=> of_conv and role = of_role and digest = of_digest"), "left")
    first = F.col("again").isNull() | F.col("turn").eqNullSafe(F.col("first_turn"))
    fault = (
        F.when(F.col("last_sign") == "", "blank").when(~first, "duplicate").when(~F.col("last_sign").isin(".", "!", "?"), "truncated")
    )
    initial = F.left("role", F.lit(1))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    marked = rows.select("conv_id", *ORDER, "times", initial.alias("initial"), known.alias("known"), fault.alias("fault"))
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("known")).otherwise(F.col("known"))
    dealt = marked.withColumn("symbol", symbol).repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)

    def run(batches):
        part, now, first_run, spans, schema = TaskContext.get().partitionId(), None, True, {}, None

        def emit(r: Run, border: bool) -> dict:
            cells = r.span.cells()
            if not border:
                return finished(r.conv, r.summary(), cells) | {"part": part, "border": False}
            kept = [cells.get(p, (None, None)) for p in PAIRS]
            return {"conv_id": r.conv, "part": part, "border": True, "partial": r.summary(), "costs": [c for c, _ in kept], "audits": [a for _, a in kept]}

        for batch in batches:
            schema, out = pa.schema(_partial_fields(batch.schema.field("conv_id").type)), []
            for conv, turn, initial, symbol, fault, times in zip(*(x.to_pylist() for x in batch.columns)):
                if now is None or conv != now.conv:
                    if now is not None:
                        out.append(emit(now, first_run))
                        first_run = False
                    now = Run(conv, spans)
                now.add(turn, initial, symbol, fault, times)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([emit(now, True)], schema)

    runs = dealt.select("conv_id", "turn", "initial", "symbol", "fault", "times").mapInArrow(
        run, f"conv_id {kind}, {RESULT}, part int, border boolean, partial {PARTIAL}, costs array<long>, audits array<string>")
    runs = scratch.write(runs, "runs")

    def close(table: pa.Table) -> pa.Table:
        summary, span = None, Span({})
        parts = sorted(table.to_pylist(), key=lambda r: r["part"])
        for r in parts:
            summary = r["partial"] if summary is None else joined(summary, r["partial"])
            span.append(1, {p: (c, a) for p, c, a in zip(PAIRS, r["costs"], r["audits"]) if c is not None})
        return pa.Table.from_pylist([finished(parts[0]["conv_id"], summary, span.cells())], pa.schema(_fields(table.schema.field("conv_id").type)))

    # Two rows of a task at most.
    ends = runs.where("border").select("conv_id", "part", "partial", "costs", "audits").groupBy("conv_id").applyInArrow(close, f"conv_id {kind}, {RESULT}")
    return runs.where("not border").select(*NAMES).unionByName(ends)


def repaired_lines(audit: str, rows):
    """``role:text`` of every row that an audit leaves of ``rows`` (role and text, in order), or inserts."""
    state = 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K" and not state and role[:1] == "s":
            state = 1
        else:
            state = 3 if state == 2 else 2
            role = role if letter == "K" else "user" if state == 2 else "assistant"
        yield f"{role}:{text}"


def repair_conversations(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per ``conv_id``: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    Rows are damaged first (see ``damaged``).  They are taken by turn, nulls first; rows of one turn by role, then by
    the first 64 characters of the text and its SHA-256, so that copies lie side by side.  A null ``conv_id`` is one more conversation.  Null roles
    and texts are one space: a role that cannot stay, a blank text.  A conversation of which nothing is left has zeros,
    an empty audit and the hash of the empty string.  Other columns are not read; an empty table gives an empty table.

    The hash of a conversation's text is a stream in the conversation's order, so the last pass has one task for each conversation; it holds the
    audit (a letter per row), not the texts.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    found = scratch.write(repairs(conversations, scratch), "repairs")
    texts = _ordered(damaged(conversations)).where("times > 0").withColumn("copy", F.explode(F.expr("sequence(1, times)")))
    texts = texts.select("conv_id", F.lit(1).alias("kind"), *ORDER, "text")
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.struct(*NAMES[1:]).alias("found"))
    dealt = heads.unionByName(texts, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)

    def run(batches):
        schema = None

        def rows():
            nonlocal schema
            for batch in batches:
                schema = pa.schema([*_fields(batch.schema.field("conv_id").type), ("repaired_sha256", pa.string())])
                for values in zip(*(x.to_pylist() for x in batch.columns)):
                    yield dict(zip(batch.schema.names, values))

        out = []
        for head, follow in _by_conversation(rows()):
            digest, before = hashlib.sha256(), b""
            for line in repaired_lines(head["found"]["audit"], follow):
                digest.update(before + line.encode())
                before = b"\n"
            out.append(head["found"] | {"conv_id": head["conv_id"], "repaired_sha256": digest.hexdigest()})
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return dealt.select("conv_id", "kind", "role", "text", "found").mapInArrow(run, f"conv_id {kind}, {RESULT}, repaired_sha256 string")


def _by_conversation(rows):
    """Each conversation's first row, which has its audit, and a stream of (role, text) of the others."""
    head = next(rows, None)
    while head is not None:
        following: list = []

        def follow():
            for row in rows:
                if not row["kind"]:
                    following.append(row)
                    return
                yield row["role"], row["text"]

        stream = follow()
        yield head, stream
        for _ in stream:  # rows that the audit has deleted last
            pass
        head = following[0] if following else None


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"), Scratch(spark, "repair"))


def _sql() -> str:
    """The same repair as a walk over the rows: a cell per state, written as ten digits of cost and the audit, so that text order is their order."""
    crc = (
        "xor(list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda c: CAST(ord(c) AS BIGINT))), lambda acc, b: "
        "list_reduce(list_prepend(xor(acc, b), CAST(range(8) AS BIGINT[])), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"
    )
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    add = lambda cell, cost, letter: f"lpad(CAST(CAST({cell}[1:10] AS BIGINT) + {cost} AS VARCHAR), 10, '0') || {cell}[11:] || '{letter}'"
    unless = lambda gone, cell: f"CASE WHEN {gone} THEN NULL ELSE {cell} END"
    once = lambda cell: add(cell, INSERT, "I")
    twice = lambda cell: add(cell, 2 * INSERT, "II")
    grown = f"""{{0}}0 AS i0, {{0}}1 AS i1, least({{0}}2, {once('{0}0')}, {once('{0}1')}, {once('{0}3')}) AS i2,
           least({{0}}3, {once('{0}2')}, {twice('{0}0')}, {twice('{0}1')}) AS i3""".replace("{0}", "s")

    def role(froms: tuple, own: str) -> str:
        moves = []
        for p in froms:
            moves.append(unless(f"gone OR initial <> '{own}'", add(f"i{p}", "cut", "K")))
            moves.append(unless("gone", add(f"i{p}", f"(cut + {RENAME})", "R")))
        return ", ".join(moves)

    delete = lambda p: add(f"i{p}", DELETE, "D")
    return rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc.format(key)} % 20 AS how FROM conversations
), rowed AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN how = 1 THEN '' WHEN how = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw WHERE how <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text[1:{HEAD}], sha256(text)) AS pos,
         regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS solid
  FROM rowed
), judged AS (
  SELECT *, role[1:1] AS initial,
         CASE WHEN solid = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate' WHEN solid[-1:] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), numbered AS (
  SELECT conv_id, pos, role, text, initial, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN {CUT} ELSE 0 END AS cut FROM judged
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, repeat('0', 10) AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3 FROM counted
  UNION ALL
  SELECT conv_id, pos, {delete(0)}, least({delete(1)}, {unless("gone OR initial <> 's'", add("i0", "cut", "K"))}),
         least({delete(2)}, {role(USER_FROM, "u")}), least({delete(3)}, {role(ANSWER_FROM, "a")})
  FROM (SELECT n.*, {grown} FROM walk w JOIN numbered n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.pos = w.pos + 1)
), best AS (
  SELECT g.conv_id, least(g.i0, g.i3) AS cell
  FROM (SELECT conv_id, pos, {grown} FROM walk) g JOIN counted c ON c.conv_id IS NOT DISTINCT FROM g.conv_id AND c.n = g.pos
), letters AS (
  SELECT conv_id, unnest(string_split(cell[11:], '')) AS letter, unnest(range(len(cell) - 10)) AS place FROM best WHERE len(cell) > 10
), followed AS (
  SELECT *, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER w AS pos, sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER w AS turns
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
), written AS (
  SELECT f.conv_id, f.place, f.letter, f.turns, n.role, n.text,
         max(CASE WHEN f.turns = 1 AND f.letter = 'K' AND n.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY f.conv_id) AS led
  FROM followed f LEFT JOIN numbered n ON f.letter <> 'I' AND n.conv_id IS NOT DISTINCT FROM f.conv_id AND n.pos = f.pos
  WHERE f.letter <> 'D'
), hashed AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (turns - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                             CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS lines
  FROM written GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(b.cell, '0000000000')[1:10] AS BIGINT) AS cost,
       coalesce(b.cell, '0000000000')[11:] AS audit, sha256(coalesce(h.lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM o.conv_id
"""


OP12_SQL = _sql()
