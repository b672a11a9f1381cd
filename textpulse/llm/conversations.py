"""Conversation structure repair: the cheapest edits, found by divide and conquer over four-state costs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textpulse.llm.common import discard, map_batches, raw, stage, table

BLOCK = 65_536  # rows of a conversation that one task repairs at a time
REMEMBERED = 64  # results of conversations of at most so many rows are kept for equal ones
NEVER = 1 << 60

# The state is what may follow: 0 nothing yet, 1 behind a system message, 2 behind a user's, 3 behind
# an assistant's. A conversation may end in 0 or 3.
FOLLOWS = (2, 2, 3, 2)  # state behind an inserted or a rewritten message
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # by role (system, user, assistant, other): state before and behind
TAILS = ((0, ""), (10, "II"), (5, "I"), (0, ""))  # cheapest end of a conversation in each state
MUST_GO, CUT_OFF = 4, 8  # added to the role's number: the code of a row


def _edits(code: int):
    """[state before][state behind] of a row: (cost, edits) of the cheapest way, ASCII-least among equals."""
    role, gone, extra = code & 3, code & MUST_GO, 5 if code & CUT_OFF else 0
    ways = [[None] * 4 for _ in range(4)]
    for before in range(4):
        state, put = before, ""
        for _ in range(4):
            found = [(2, "D", state)]
            if not gone:
                found.append((1 + extra, "R", FOLLOWS[state]))
                if state in KEPT[role]:
                    found.append((extra, "K", KEPT[role][state]))
            for cost, letter, behind in found:
                way = (5 * len(put) + cost, put + letter)
                if ways[before][behind] is None or way < ways[before][behind]:
                    ways[before][behind] = way
            state, put = FOLLOWS[state], put + "I"
    return tuple(map(tuple, ways))


EDITS = tuple(_edits(code) for code in range(16))

# A forward vector holds for each state the cost of the cheapest edits that lead there and the place of
# these edits, ASCII-least among equals, in the order of the four. No two of the four are equal and none
# begins with another: as many letters other than I are in each, and the last one is not an I.


def meet(vector, ways) -> tuple:
    """The forward vector behind an element (a row, or a block of rows) that offers ``ways``."""
    best = [min(((cost + ways[i][j][0], place, ways[i][j][1]) for i, (cost, place) in enumerate(vector)
                 if cost < NEVER and ways[i][j]), default=None) for j in range(4)]
    places = {found[1:]: k for k, found in enumerate(sorted((b for b in best if b), key=lambda b: b[1:]))}
    return tuple((b[0], places[b[1:]]) if b else (NEVER, 0) for b in best)


def meet_back(costs, ways) -> tuple:
    """Cheapest costs from each state before an element to the end, from those behind it."""
    return tuple(min((way[0] + cost for way, cost in zip(row, costs) if way), default=NEVER) for row in ways)


@lru_cache(1 << 16)
def _row_step(vector, code: int):
    """A step over a row from costs relative to the least one: few vectors occur, so few are computed."""
    found = meet(vector, EDITS[code])
    least = min(cost for cost, _ in found)
    return tuple((cost - least if cost < NEVER else NEVER, place) for cost, place in found), least


@lru_cache(1 << 16)
def _row_step_back(costs, code: int):
    found = meet_back(costs, EDITS[code])
    least = min(found)
    return tuple(cost - least if cost < NEVER else NEVER for cost in found)


def _start(state: int) -> tuple:
    return tuple((0 if s == state else NEVER, 0) for s in range(4))


def over_rows(vector, codes: Sequence[int]) -> tuple:
    total = 0
    for code in codes:
        vector, least = _row_step(vector, code)
        total += least
    return tuple((cost + total if cost < NEVER else NEVER, place) for cost, place in vector)


def over_rows_back(costs, codes: Sequence[int]) -> tuple:
    for code in reversed(codes):
        costs = _row_step_back(costs, code)
    return costs


def over_blocks(vector, blocks: Sequence) -> tuple:
    for ways in blocks:
        vector = meet(vector, ways)
    return vector


def over_blocks_back(costs, blocks: Sequence) -> tuple:
    for ways in reversed(blocks):
        costs = meet_back(costs, ways)
    return costs


def crossings(elements: Sequence, start: int, end: int, forward: Callable, backward: Callable) -> list[int]:
    """States behind each element on the cheapest way from ``start`` to ``end``, audit-least among equals.

    Costs forward to the middle and backward to it meet there: of the states with the least sum the
    one with the least edits before is crossed. Both halves are solved by themselves in turn. Only
    vectors of four numbers are held, besides the result.
    """
    out, waiting = [], [(0, len(elements), start, end)]
    while waiting:
        low, high, first, last = waiting.pop()
        if high - low <= 1:
            out += [last] * (high - low)
            continue
        middle = (low + high) // 2
        ahead = forward(_start(first), elements[low:middle])
        behind = backward(tuple(0 if s == last else NEVER for s in range(4)), elements[middle:high])
        cross = min((cost + behind[s], place, s) for s, (cost, place) in enumerate(ahead) if cost < NEVER)[2]
        waiting += [(middle, high, cross, last), (low, middle, first, cross)]
    return out


def _audit(codes: bytes, start: int, end: int) -> str:
    states = crossings(codes, start, end, over_rows, over_rows_back)
    return "".join(EDITS[code][before][behind][1] for code, before, behind in zip(codes, [start, *states], states))


_short_audit = lru_cache(1 << 16)(_audit)


def audit(codes: bytes, start: int, end: int) -> str:
    """Edits of a run of rows that lead from one state to another."""
    return (_short_audit if len(codes) <= REMEMBERED else _audit)(codes, start, end)


def _block_ways(codes: bytes) -> list[tuple]:
    """(cost, place) for each state before and behind a block, row by row."""
    return [way for start in range(4) for way in over_rows(_start(start), codes)]


_short_ways = lru_cache(1 << 16)(_block_ways)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the damage that crc32 of ``conv_id:turn`` deals them, nulls as one space; copies says how often a row stands."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), blank("role").alias("role"),
                                blank("text").alias("text"), dealt.alias("dealt")).filter("dealt <> 0")
    text = F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("dealt") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(F.col("dealt") == 3, 2).otherwise(1).alias("copies"))


def _in_order(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


ORDER = ("conv_id", "turn", "role", "digest")


def _outlines(rows: DataFrame) -> DataFrame:
    """Rows without their texts, equal ones of a turn as one: what faults they have, and whether the first is a duplicate."""
    role = F.substring("role", 1, 1)
    kind = F.when(role == "s", 0).when(role == "u", 1).when(role == "a", 2).otherwise(3)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    light = rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"), kind.alias("kind"), blank.alias("blank"), whole.alias("whole"), "copies")
    merged = light.groupBy(*ORDER, "kind", "blank", "whole").agg(F.sum("copies").alias("n"))
    seen = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    firsts = (merged.groupBy("conv_id", "role", "digest").agg(F.min(seen).alias("first"))
              .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("first.turn").alias("first")))
    met = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return merged.join(firsts, met).select(*ORDER, "kind", "blank", "whole", "n", (~F.col("turn").eqNullSafe(F.col("first"))).alias("again"))


BLOCKS = ("conv_id long, part int, block long, codes binary, ways array<long>, first int, last int, blank long, duplicate long, "
          "truncated long, illegal long, least long, greatest long, turns long")
LEGAL = {(0, 1), (1, 2), (2, 1)}


class _Block:
    """Rows of one conversation, in order, until there are ``BLOCK`` of them."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.kinds = conv_id, bytearray(), [None, None]
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.greatest = None

    def add(self, turn, kind: int, code: int, n: int) -> None:
        before = self.kinds[1]
        self.illegal += (before is not None and (before, kind) not in LEGAL) + n - 1
        self.kinds = [kind if before is None else self.kinds[0], kind]
        if turn is not None and turn != self.greatest:
            self.turns += 1
            self.least, self.greatest = turn if self.least is None else self.least, turn
        self.codes += bytes([code]) * n

    def row(self, part: int, number: int) -> tuple:
        codes = bytes(self.codes)
        ways = (_short_ways if len(codes) <= REMEMBERED else _block_ways)(codes)
        return (self.conv_id, part, number, codes, [x for way in ways for x in way], *self.kinds, self.blank, self.duplicate,
                self.truncated, self.illegal, self.least, self.greatest, self.turns)


def _blocks(outlines: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` rows of one conversation, numbered in order by part and block.

    Rows are range-partitioned by conversation and turn, so a conversation of any length is dealt to
    many tasks. A block holds a byte a row and the costs of crossing it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out, now = TaskContext.get().partitionId(), 0, [], None
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("codes", pa.binary()), ("ways", pa.list_(pa.int64())),
                            ("first", pa.int32()), ("last", pa.int32()), *((c, pa.int64()) for c in (
                                "blank", "duplicate", "truncated", "illegal", "least", "greatest", "turns"))])
        send = lambda: pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
        for batch in batches:
            for conv_id, turn, kind, blank, whole, n, again in zip(*(c.to_pylist() for c in batch.columns)):
                while n:
                    if now is None or now.conv_id != conv_id or len(now.codes) >= size:
                        if now is not None:
                            out.append(now.row(part, number))
                            number += 1
                        now = _Block(conv_id)
                    # The first of equal rows may be whole; the others are blank like it, or its duplicates.
                    if blank or again:
                        take = min(n, size - len(now.codes))
                        now.add(turn, kind, kind | MUST_GO, take)
                        if blank:
                            now.blank += take
                        else:
                            now.duplicate += take
                    else:
                        take, again = 1, True
                        now.add(turn, kind, kind | (0 if whole else CUT_OFF), 1)
                        now.truncated += not whole
                    n -= take
            if out:
                yield send()
                out = []
        if now is not None:
            out.append(now.row(part, number))
            yield send()

    ranged = outlines.repartitionByRange(*_in_order(*ORDER)).sortWithinPartitions(*_in_order(*ORDER))
    return ranged.select("conv_id", "turn", "kind", "blank", "whole", "n", "again").mapInArrow(run, BLOCKS)


ROUTES = "part int, block long, start int, end int"
TOTALS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, tail string"


def _routed(blocks: DataFrame) -> DataFrame:
    """States before and behind every block, and on a conversation's last block what it comes to as a whole.

    Blocks of a conversation meet in one task by their costs and counts alone, not by their rows.
    """
    def whole(rows: list[dict]) -> Iterator[dict]:
        tables = []
        for row in rows:
            ways = list(zip(row["ways"][::2], row["ways"][1::2]))
            tables.append(tuple(tuple(w if w[0] < NEVER else None for w in ways[4 * i:4 * i + 4]) for i in range(4)))
        ends = over_blocks(_start(0), tables)
        cost, _, tail, end = min((c + TAILS[s][0], place, TAILS[s][1], s) for s, (c, place) in enumerate(ends) if c < NEVER)
        states = crossings(tables, 0, end, over_blocks, over_blocks_back)
        illegal, turns, least, greatest, before = 0, 0, None, None, None
        for row, start, state in zip(rows, [0, *states], states):
            illegal += row["illegal"] + (before is not None and (before, row["first"]) not in LEGAL)
            before = row["last"]
            if row["least"] is not None:
                turns += row["turns"] - (row["least"] == greatest)
                least, greatest = row["least"] if least is None else least, row["greatest"]
            yield {"part": row["part"], "block": row["block"], "start": start, "end": state, "total": None if row is not rows[-1] else {
                "conv_id": row["conv_id"], "gaps": 0 if least is None else greatest - least + 1 - turns,
                **{name: sum(r[name] for r in rows) for name in ("blank", "duplicate", "truncated")}, "illegal": illegal, "cost": cost, "tail": tail}}

    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    total = pa.struct([("conv_id", pa.int64()), ("gaps", pa.int64()), *((c, pa.int64()) for c in counts), ("tail", pa.string())])
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("total", total)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out = [], []
        for batch in batches:
            for row in batch.to_pylist():
                if own and own[-1]["conv_id"] != row["conv_id"]:
                    out += whole(own)
                    own = []
                own.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if own:
            yield pa.RecordBatch.from_pylist(list(whole(own)), schema)

    light = blocks.drop("codes").repartition("conv_id").sortWithinPartitions(*_in_order("conv_id", "part", "block"))
    return light.mapInArrow(run, f"{ROUTES}, total struct<{', '.join(f'{c.split()[0]}: {c.split()[1]}' for c in TOTALS.split(', '))}>")


def plans(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation with a row.

    ``rows`` has conv_id, turn, role, text without nulls in the last two, and copies. Their order in
    a conversation is by turn, nulls first, then role and a digest of the text. Counts, costs and edits
    are as ``repaired`` says.
    """
    blocks = stage(_blocks(_outlines(rows), block))
    routes = stage(_routed(blocks))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        conv_id, part, number, codes, start, end = (c.to_pylist() for c in batch.columns)
        letters = [audit(*own) for own in zip(codes, start, end)]
        return pa.record_batch([*batch.columns[:3], pa.array(letters, pa.string())], ["conv_id", "part", "block", "letters"])

    crossed = blocks.select("conv_id", "part", "block", "codes").join(routes.select("part", "block", "start", "end"), ["part", "block"])
    lettered = map_batches(crossed.select("conv_id", "part", "block", "codes", "start", "end"), run, "conv_id long, part int, block long, letters string")
    whole = lettered.groupBy(F.col("conv_id").alias("c")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "block", "letters"))), lambda b: b["letters"]), "").alias("letters"))
    totals = routes.filter("total IS NOT NULL").select("total.*")
    planned = totals.join(whole, F.col("conv_id").eqNullSafe(F.col("c"))).withColumn("audit", F.concat("letters", "tail")).drop("c", "letters", "tail")
    out = stage(planned)
    discard(blocks)
    discard(routes)
    return out


class Replay:
    """Applies a conversation's edits to its rows, one after the other."""

    def __init__(self, edits: str):
        self.edits, self.at, self.written, self.shift = edits, 0, 0, 0

    def _role(self) -> str:
        return ("user", "assistant")[(self.written - self.shift) % 2]

    def _inserted(self) -> Iterator[tuple[str, bytes, str]]:
        while self.edits[self.at:self.at + 1] == "I":
            yield self._role(), b"", "I"
            self.written, self.at = self.written + 1, self.at + 1

    def row(self, role: str, text: bytes) -> Iterator[tuple[str, bytes, str]]:
        """(role, text, edit) of what stands where a row stood, with what is inserted before it."""
        yield from self._inserted()
        letter = self.edits[self.at]
        self.at += 1
        if letter != "D":
            if letter == "K" and role[:1] == "s":
                self.shift = 1
            yield role if letter == "K" else self._role(), text, letter
            self.written += 1

    def end(self) -> Iterator[tuple[str, bytes, str]]:
        yield from self._inserted()


TOTAL_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _replayed(rows: DataFrame, ids: DataFrame, planned: DataFrame) -> DataFrame:
    """Plans and rows of conversations, sorted so that each plan stands before its rows; texts are moved once."""
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in TOTAL_COLUMNS]
    named = planned.withColumnRenamed("conv_id", "c")
    heads = (ids.join(named, F.col("conv_id").eqNullSafe(F.col("c")), "left")
             .select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), *(F.lit(None).cast(t).alias(n) for n, t in (
                 ("turn", "long"), ("role", "string"), ("digest", "string"), ("text", "binary"), ("copies", "int")))))
    none = [F.lit(None).cast("long").alias(c) for c in TOTAL_COLUMNS]
    bodies = rows.select("conv_id", *none, F.lit(None).cast("string").alias("audit"), "turn", "role", F.md5("text").alias("digest"),
                         raw("text").alias("text"), "copies")
    both = heads.union(bodies).withColumn("body", F.col("audit").isNull())
    return both.repartition("conv_id").sortWithinPartitions(*_in_order("conv_id", "body", "turn", "role", "digest")).drop("turn", "digest", "body")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator]]:
    """Each batch's events: a plan's head, or pieces of the conversation under the last head."""
    replay = head = None
    for batch in batches:
        events = []
        for row in batch.to_pylist():
            if row["audit"] is not None:
                if replay:
                    events.append((head, replay.end(), True))
                head, replay = row, Replay(row["audit"])
            else:
                for _ in range(row["copies"]):
                    events.append((head, replay.row(row["role"], row["text"]), False))
        yield events
    if replay:
        yield [(head, replay.end(), True)]


def repaired(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, position, role, text, edit) of repaired conversations: alternating, whole, in order.

    ``conversations`` has conv_id, turn, role, text, null texts and roles standing for one space, and
    may have copies. A blank row or one with an earlier row's role and text goes; others are kept,
    given another role, or deleted; empty messages are inserted; so that initials read
    ``(s?(ua)+)?``. Costs: 1 for a role, 2 for a deletion, 5 for an insertion, 5 for a kept row whose
    text does not end in ``.``, ``!`` or ``?``. Of the cheapest ways the one with the ASCII-least
    edits is taken. A role that begins with no s, u or a is never kept as it is.

    A null conv_id is an id; null turns come first; repeated rows are duplicates; rows that share a turn
    are ordered by role and text digest; an empty table gives an empty one.
    """
    rows = _given(conversations)
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position, last = 0, None
        for events in _walk(batches):
            out = []
            for head, pieces, _ in events:
                position, last = position if head is last else 0, head
                for role, text, edit in pieces:
                    out.append({"conv_id": head["conv_id"], "position": position, "role": role, "text": text.decode(), "edit": edit})
                    position += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    sorted_rows = _replayed(rows, rows.select("conv_id").distinct(), plans(rows, block))
    return sorted_rows.mapInArrow(run, "conv_id long, position long, role string, text string, edit string")


def _given(conversations: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    copies = F.col("copies").cast("int") if "copies" in conversations.columns else F.lit(1)
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role"), text("text"), copies.alias("copies"))


def digests(conversations: DataFrame, ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conv_id of ``ids``: counts, cost, audit, and sha256 of the repaired ``role:text`` lines.

    A conversation without rows has zeros and the hash of nothing. A hash is a chain, so one task
    streams a conversation's lines in order; it holds one batch and the audit at a time.
    """
    rows = _given(conversations)
    columns = ("conv_id", *TOTAL_COLUMNS, "audit", "repaired_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, gap = hashlib.sha256(), b""
        for events in _walk(batches):
            out = []
            for head, pieces, over in events:
                for role, text, _ in pieces:
                    digest.update(gap + role.encode() + b":" + text)
                    gap = b"\n"
                if over:
                    out.append((*(head[c] for c in columns[:-1]), digest.hexdigest()))
                    digest, gap = hashlib.sha256(), b""
            if out:
                kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], list(columns))

    schema = ", ".join(f"{c} {'string' if c in columns[-2:] else 'long'}" for c in columns)
    return _replayed(rows, ids.select(F.col("conv_id").cast("long")).distinct(), plans(rows, block)).mapInArrow(run, schema)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return digests(damaged(conversations), conversations)


OP11_SQL = r"""
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END) ORDER BY i) AS t
  FROM range(256) AS bytes(i)),
convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
keyed AS (
  SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(v.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations v JOIN convs ON v.conv_id IS NOT DISTINCT FROM convs.conv_id),
dealt AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda x, b: xor(t[(xor(x, b) & 255) + 1], x >> 8)), 4294967295) % 20 AS h FROM keyed, crc_table),
damaged AS (
  SELECT c, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE h WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM dealt WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos, left(role, 1) AS initial,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut FROM damaged),
faulty AS (
  SELECT *, NOT is_blank AND row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 AS is_dup,
    lag(initial) OVER (PARTITION BY c ORDER BY pos) || initial AS pair FROM placed),
counted AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (is_blank) AS blank,
    count(*) FILTER (is_dup) AS duplicate, count(*) FILTER (NOT is_blank AND NOT is_dup AND cut) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faulty GROUP BY c),
inserts(before, put, middle) AS (VALUES
  (0, '', 0), (0, 'I', 2), (0, 'II', 3), (0, 'III', 2), (1, '', 1), (1, 'I', 2), (1, 'II', 3), (1, 'III', 2),
  (2, '', 2), (2, 'I', 3), (2, 'II', 2), (2, 'III', 3), (3, '', 3), (3, 'I', 2), (3, 'II', 3), (3, 'III', 2)),
steps(middle, letter, initial, behind) AS (VALUES
  (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
  (0, 'R', NULL, 2), (1, 'R', NULL, 2), (2, 'R', NULL, 3), (3, 'R', NULL, 2),
  (0, 'D', NULL, 0), (1, 'D', NULL, 1), (2, 'D', NULL, 2), (3, 'D', NULL, 3)),
ways AS (
  SELECT before, behind, initial, letter, put || letter AS edits, 5 * length(put) + CASE letter WHEN 'K' THEN 0 WHEN 'R' THEN 1 ELSE 2 END AS price
  FROM inserts JOIN steps USING (middle)),
walked(c, pos, state, cost, audit) AS (
  SELECT c, 0::BIGINT, 0, 0::BIGINT, '' FROM counted
  UNION ALL
  SELECT c, pos, state, best.cost, best.audit FROM (
    SELECT w.c, w.pos + 1 AS pos, behind AS state,
      min({'cost': w.cost + price + CASE WHEN letter <> 'D' AND cut THEN 5 ELSE 0 END, 'audit': w.audit || edits}) AS best
    FROM walked w JOIN faulty f ON f.c = w.c AND f.pos = w.pos + 1
      JOIN ways ON before = w.state AND (letter = 'D' OR NOT is_blank AND NOT is_dup) AND (letter <> 'K' OR ways.initial = f.initial)
    GROUP BY w.c, w.pos, behind)),
tails(state, price, tail) AS (VALUES (0, 0, ''), (1, 10, 'II'), (2, 5, 'I'), (3, 0, '')),
solved AS (
  SELECT c, min({'cost': cost + price, 'audit': audit || tail}) AS best
  FROM walked JOIN tails USING (state) JOIN counted USING (c) WHERE pos = n GROUP BY c),
letters AS (SELECT c, unnest(string_split(best.audit, '')) AS letter, unnest(range(length(best.audit))) AS i FROM solved WHERE best.audit <> ''),
applied AS (
  SELECT l.c, i, letter, sum((letter <> 'I')::INT) OVER (PARTITION BY l.c ORDER BY i) AS pos,
    sum((letter <> 'D')::INT) OVER (PARTITION BY l.c ORDER BY i) AS place FROM letters l),
lines AS (
  SELECT a.c, i, letter, place, role, text, initial FROM applied a LEFT JOIN faulty f ON f.c = a.c AND f.pos = a.pos AND letter <> 'I' WHERE letter <> 'D'),
led AS (SELECT c, max((place = 1 AND letter = 'K' AND initial = 's')::INT) AS shift FROM lines GROUP BY c),
joined AS (
  SELECT c, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - 1 - shift) % 2 = 0 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS repaired FROM lines JOIN led USING (c) GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM convs LEFT JOIN counted USING (c) LEFT JOIN solved USING (c) LEFT JOIN joined USING (c)
"""
