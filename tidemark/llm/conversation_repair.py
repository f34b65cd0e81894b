"""Conversation structure repair by secondary-sorted streaming.

A repaired conversation's role initials read ``(s?(ua)+)?``. Among all edits that bring one there the
cheapest are taken: Keep a row (0), Rerole it to user or assistant (1), Delete it (2; the only edit for a
blank or duplicate row), Insert an empty row of user or assistant anywhere (5); a truncated row that is not
deleted adds 5. Equal costs go to the ASCII-least string of edit initials.

Stream. Rows are repartitioned by conversation once, and inside a partition sorted by turn. ``mapInPandas``
carries, over Arrow batches, the state of a dynamic program: for each of the four states of the pattern
(nothing yet, after s, after u, after a) the least cost so far and the rank of its edit string among the
four. No edit string is ever compared: strings that end at the same row are never prefixes of each other, so
the order of two longer ones follows from the ranks and the edits of the new row. Only cost differences
matter, so the steps are few and kept in a table. A step leaves a back pointer of one byte for each state.

Giant conversations. Back pointers and rows of the open conversation are held up to ``BLOCK_ROWS`` rows or
``BLOCK_BYTES`` of text; then they are spilled as one row of a table in the shared folder, and the stream
goes on with the four costs alone. A spilled conversation is traced back block by block, last block first,
then replayed block by block to its results, again by sorted streams. Memory follows the block, never the
conversation; only its edit string, one letter a row, is held whole, as the result has it so. One
conversation is one stream: its digest is sequential by definition, so it is not split over tasks.

Order. Rows of a conversation go by turn, nulls first; equal turns by role, then text (bytes). A duplicate
has the role and text of an earlier row in that order, found by a window of the engine over the same
partitioning.

Rows. Null roles and texts are one space, so a null text is blank; a null conv_id is a conversation of its
own. ``present`` false marks a row that only tells that its conversation exists. Extra columns are ignored.
Empty tables give no rows; a conversation without present rows gives zeros, no edits and the digest of an
empty string. Repeated rows are duplicates of the first.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import clash_free, importable, stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
#: States of the pattern (s?(ua)+)?: nothing yet, after s, after u, after a; the next state by initial.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ACCEPTED = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
#: The only state and role that a rerole or insert leads to.
GIVEN = {q: next((n, {"u": "user", "a": "assistant"}[i]) for i, n in NEXT[q].items() if i in "ua") for q in NEXT}
NEVER = 1 << 60
BLOCK_ROWS = 4096
BLOCK_BYTES = 1 << 20
_EDITS = (DELETE, KEEP, REROLE)
_WHITE = r"\x20\x09-\x0D"

COUNTS = ("n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


# -- the dynamic program ---------------------------------------------------------------------------

def _inserted(state: int) -> Iterator[tuple[int, int]]:
    """(number of inserts, state after them) from ``state``; more than two only lead in a circle."""
    for k in range(3):
        yield k, state
        state = GIVEN[state][0]


@functools.lru_cache(maxsize=100_000)
def step(costs: tuple[int, ...], ranks: tuple[int, ...], initial: str, doomed: bool, truncated: bool
         ) -> tuple[int, tuple[int, ...], tuple[int, ...], bytes]:
    """One row: (cost common to all states, the rest of the costs, ranks, back pointers).

    A back pointer holds the state before (2 bits), the number of inserts (2 bits) and the edit (2 bits).
    """
    best: dict[int, tuple] = {}
    for q, cost in enumerate(costs):
        if cost >= NEVER:
            continue
        for k, at in _inserted(q):
            here = cost + k * INSERT_COST
            late = TRUNCATED_COST if truncated else 0
            moves = [(DELETE, at, here + DELETE_COST)]
            if not doomed:
                if initial in NEXT[at]:
                    moves.append((KEEP, NEXT[at][initial], here + late))
                moves.append((REROLE, GIVEN[at][0], here + REROLE_COST + late))
            for edit, to, total in moves:
                candidate = (total, ranks[q], INSERT * k + edit, q | k << 2 | _EDITS.index(edit) << 4)
                if to not in best or candidate < best[to]:
                    best[to] = candidate
    base = min(c[0] for c in best.values())
    order = sorted(best, key=lambda s: best[s][1:3])
    return (base, tuple(best[s][0] - base if s in best else NEVER for s in range(4)),
            tuple(order.index(s) if s in best else 0 for s in range(4)),
            bytes(best[s][3] if s in best else 0 for s in range(4)))


def finish(costs: tuple[int, ...], ranks: tuple[int, ...]) -> tuple[int, int, int]:
    """After the last row: (cost to add, last state, inserts behind it)."""
    ends = [(cost + k * INSERT_COST, ranks[q], k, q) for q, cost in enumerate(costs) if cost < NEVER
            for k, at in _inserted(q) if at in ACCEPTED]
    cost, _, k, q = min(ends)
    return cost, q, k


def trace(moves: bytes, state: int) -> tuple[str, int]:
    """Edits of a block whose last row leads to ``state``, and the state before its first row."""
    out = []
    for at in range(len(moves) - 4, -1, -4):
        move = moves[at + state]
        out.append(INSERT * (move >> 2 & 3) + _EDITS[move >> 4])
        state = move & 3
    return "".join(reversed(out)), state


def replay(edits: str, roles: list[str], texts: list[str], state: int) -> Iterator[tuple[str, str, str, int]]:
    """``(edit, role, text, state after)`` of every row that the edits leave or insert."""
    row = 0
    for edit in edits:
        if edit == INSERT:
            state, role = GIVEN[state]
            yield edit, role, "", state
            continue
        if edit == KEEP:
            state = NEXT[state][roles[row][:1]]
            yield edit, roles[row], texts[row], state
        elif edit == REROLE:
            state, role = GIVEN[state]
            yield edit, role, texts[row], state
        row += 1


# -- the stream ------------------------------------------------------------------------------------

@dataclass
class _Open:
    """The open conversation of a stream."""

    conv: str | None
    costs: tuple[int, ...] = (0, NEVER, NEVER, NEVER)
    ranks: tuple[int, ...] = (0, 0, 0, 0)
    cost: int = 0
    n_rows: int = 0
    turns: int = 0
    first: int | None = None
    last: int | None = None
    faults: list[int] = field(default_factory=lambda: [0, 0, 0])
    illegal: int = 0
    before: str | None = None
    block: int = 0
    size: int = 0
    moves: bytearray = field(default_factory=bytearray)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)

    def add(self, turn: str | None, role: str, text: str, fault: int) -> None:
        if turn is not None:
            now = int(turn)
            if now != self.last:
                self.turns += 1
            self.first = now if self.first is None else self.first
            self.last = now
        self.n_rows += 1
        if fault:
            self.faults[fault - 1] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        base, self.costs, self.ranks, back = step(self.costs, self.ranks, initial, fault in (1, 2), fault == 3)
        self.cost += base
        self.moves += back
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(role) + len(text)

    def full(self, rows: int, size: int) -> bool:
        return len(self.roles) >= rows or self.size >= size

    def spilled(self, last: bool) -> dict:
        """The held block as a row, and an empty block in its place."""
        row = dict.fromkeys(COUNTS, 0) | {
            "conv": self.conv, "block": self.block, "last": last, "state": -1, "inserts": 0, "moves": bytes(self.moves),
            "roles": self.roles, "texts": self.texts}
        if last:
            cost, state, inserts = finish(self.costs, self.ranks)
            gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
            row |= {"state": state, "inserts": inserts, "n_rows": self.n_rows, "gaps": gaps, "blank": self.faults[0],
                    "duplicate": self.faults[1], "truncated": self.faults[2], "illegal": self.illegal, "cost": self.cost + cost}
        self.block, self.size, self.moves, self.roles, self.texts = self.block + 1, 0, bytearray(), [], []
        return row


_BLOCK = ("conv string, block long, last boolean, state int, inserts int, moves binary, roles array<string>, texts array<string>, "
          + ", ".join(f"{c} long" for c in COUNTS))


def _frame(rows: list[dict], like: list[str]) -> pd.DataFrame:
    return pd.DataFrame({name: pd.Series([r[name] for r in rows], dtype=object) for name in like})


def _blocks(rows: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
    """Blocks of sorted rows with back pointers; a conversation's last block has its counts."""
    names = [part.split()[0] for part in _BLOCK.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: _Open | None = None
        out: list[dict] = []
        size = 0
        for batch in batches:
            for conv, present, turn, role, text, fault in zip(*[batch[c].tolist() for c in batch.columns]):
                conv = None if conv is None or conv != conv else conv
                if now is None or now.conv != conv:
                    if now is not None:
                        out.append(now.spilled(True))
                    now = _Open(conv)
                if present:
                    if now.full(block_rows, block_bytes):
                        out.append(now.spilled(False))
                    now.add(None if turn is None or turn != turn else turn, role, text, int(fault))
                    size += len(text)
                if len(out) >= 1000 or size >= 4 * block_bytes:
                    if out:
                        yield _frame(out, names)
                    out, size = [], 0
        if now is not None:
            out.append(now.spilled(True))
        if out:
            yield _frame(out, names)

    return rows.mapInPandas(run, _BLOCK)


def _faults(convs: DataFrame) -> DataFrame:
    """``conv, present, turn, role, text, fault`` (0 none, 1 blank, 2 duplicate, 3 truncated), all rows of a
    conversation in one partition and in order."""
    present = F.coalesce(F.col("present"), F.lit(False)) if "present" in convs.columns else F.lit(True)
    rows = convs.select(
        F.col("conv_id").cast("string").alias("conv"), present.alias("present"), F.col("turn").cast("long").alias("at"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text")).repartition("conv")
    # The partitioning by conversation serves this window too.
    same = Window.partitionBy("conv", "present", "role", "text").orderBy(F.col("at").asc_nulls_first())
    later = F.row_number().over(same) > 1
    blank = ~F.col("text").rlike(f"[^{_WHITE}]")
    ended = F.col("text").rlike(rf"[.!?][{_WHITE}]*+\z")
    fault = F.when(blank, 1).when(F.col("later"), 2).when(~ended, 3).otherwise(0)
    return rows.withColumn("later", later).select("conv", "present", "at", "role", "text", "later", fault.alias("fault")).sortWithinPartitions(
        F.col("conv").asc_nulls_first(), F.col("at").asc_nulls_first(), "role", "text", "later").select(
            "conv", "present", F.col("at").cast("string").alias("turn"), "role", "text", "fault")


def _traced(blocks: DataFrame) -> DataFrame:
    """``conv, block, entry, edits`` of spilled conversations: a stream from the last block back."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = START
        for batch in batches:
            out = []
            for conv, block, last, at, inserts, moves in zip(*[batch[c].tolist() for c in batch.columns]):
                state = at if last else state
                edits, state = trace(moves, state)
                out.append({"conv": conv, "block": block, "entry": state, "edits": edits + INSERT * (inserts if last else 0)})
            yield _frame(out, ["conv", "block", "entry", "edits"])

    back = blocks.select("conv", "block", "last", "state", "inserts", "moves").repartition("conv").sortWithinPartitions(
        F.col("conv").asc_nulls_first(), F.col("block").desc())
    return back.mapInPandas(run, "conv string, block long, entry int, edits string")


def _planned(convs: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
    """Blocks with their rows, their edits and the state before them; each conversation's blocks in one
    partition and in order."""
    blocks = stored(_blocks(_faults(convs), block_rows, block_bytes), "repair-blocks")
    whole = blocks.where("last and block = 0")

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            edits = [trace(m, s)[0] + INSERT * i for m, s, i in zip(batch["moves"], batch["state"], batch["inserts"])]
            yield batch.drop(columns=["moves", "state", "inserts"]).assign(entry=START, edits=edits)

    counts = ", ".join(f"{c} long" for c in COUNTS)
    single = whole.mapInPandas(one, f"conv string, block long, last boolean, roles array<string>, texts array<string>, {counts}, "
                                    "entry int, edits string")
    spilled = blocks.where("not (last and block = 0)")
    if spilled.isEmpty():
        return single
    # (conversation, block) is unique on both sides.
    edits = stored(_traced(spilled), "repair-edits")
    giant = spilled.drop("moves", "state", "inserts").alias("b").join(
        edits.alias("e"), F.col("b.conv").eqNullSafe(F.col("e.conv")) & (F.col("b.block") == F.col("e.block"))).select(
            "b.*", "e.entry", "e.edits")
    return single.unionByName(giant.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "block"))


def summary(convs: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``, one row for each
    conversation: its faults, the edits' initials, and the digest of its repaired ``role:text`` lines."""
    importable(convs.sparkSession)
    kind = convs.schema["conv_id"].dataType.simpleString()
    names = ["conv", *COUNTS[1:], "audit", "repaired_sha256"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest, audit, some = hashlib.sha256(), [], False
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                if row["block"] == 0:
                    digest, audit, some = hashlib.sha256(), [], False
                audit.append(row["edits"])
                for _, role, text, _ in replay(row["edits"], list(row["roles"]), list(row["texts"]), int(row["entry"])):
                    digest.update(("\n" if some else "").encode() + f"{role}:{text}".encode("utf-8"))
                    some = True
                if row["last"]:
                    conv = row["conv"] if isinstance(row["conv"], str) else None
                    out.append(row | {"conv": conv, "audit": "".join(audit) if row["n_rows"] else "",
                                      "repaired_sha256": digest.hexdigest()})
            if out:
                yield _frame(out, names)

    longs = ", ".join(f"{c} long" for c in COUNTS[1:])
    done = _planned(convs, block_rows, block_bytes).mapInPandas(
        run, f"conv string, {longs}, audit string, repaired_sha256 string")
    return done.select(F.col("conv").cast(kind).alias("conv_id"), *COUNTS[1:], "audit", "repaired_sha256")


def repaired(convs: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``conv_id, place, edit, role, text``: the rows of the repaired conversations, numbered from 0."""
    importable(convs.sparkSession)
    kind = convs.schema["conv_id"].dataType.simpleString()
    names = ["conv", "place", "edit", "role", "text"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = 0
        for batch in batches:
            for row in batch.to_dict("records"):
                place = 0 if row["block"] == 0 else place
                conv = row["conv"] if isinstance(row["conv"], str) else None
                out = []
                for edit, role, text, _ in replay(row["edits"], list(row["roles"]), list(row["texts"]), int(row["entry"])):
                    out.append(dict(zip(names, (conv, place, edit, role, text))))
                    place += 1
                if out:
                    yield _frame(out, names)

    done = _planned(convs, block_rows, block_bytes).mapInPandas(
        run, "conv string, place long, edit string, role string, text string")
    return done.select(F.col("conv").cast(kind).alias("conv_id"), *names[1:])


# -- damage ----------------------------------------------------------------------------------------

# What the remainder of crc32("conv_id:turn") by DAMAGE does to a row.
DAMAGE = 20
DROPS, EMPTIES, UNENDS, REPEATS, USERS = range(5)


def damaged(convs: DataFrame) -> DataFrame:
    """Rows with faults planted by their id and turn (nulls: one space); a dropped row is not ``present``."""
    rows = clash_free(convs, "conv_id", "turn", "role", "text")

    def shown(name: str) -> F.Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    by = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % DAMAGE
    rows = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), by.alias("by"))
    text = F.when(F.col("by") == EMPTIES, "").when(F.col("by") == UNENDS, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("by") == REPEATS, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    gone = F.col("by") == DROPS
    return rows.select(
        "conv_id", "turn", F.when(gone, " ").when(F.col("by") == USERS, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone, " ").otherwise(text).alias("text"), (~gone).alias("present"), F.explode(copies).alias("copy")).drop("copy")


def oracle() -> str:
    """The damaged conversations' summary in DuckDB SQL: the dynamic program row by row over all
    conversations, with whole edit strings."""
    white = r"[^\x20\x09-\x0D]"
    crc = ("(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(list_transform(generate_series(1, length(k)), "
           "lambda i: ascii(substr(k, i, 1))::BIGINT), lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))), "
           "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))")
    steps = " UNION ALL ".join(
        f"SELECT {q} AS q, {at} AS st, {k * INSERT_COST} AS paid, '{INSERT * k}' AS ins" for q in NEXT for k, at in _inserted(q))
    given = " ".join(f"WHEN {q} THEN {n}" for q, (n, _) in GIVEN.items())
    kept = " ".join(f"WHEN st = {q} AND ini = '{i}' THEN {n}" for q in NEXT for i, n in NEXT[q].items())
    return f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
marked AS (SELECT *, xor({crc}, 4294967295) % {DAMAGE} AS hit FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = {USERS} THEN 'user' ELSE role END AS role,
         CASE WHEN hit = {EMPTIES} THEN '' WHEN hit = {UNENDS} THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN hit = {REPEATS} THEN [0, 1] ELSE [0] END) AS copy
  FROM marked WHERE hit <> {DROPS}),
placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS ini,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         NOT regexp_matches(text, '{white}') AS blank,
         NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS open
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN blank THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
         WHEN open THEN 3 ELSE 0 END AS fault,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS ini_before FROM placed),
steps AS ({steps}),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
         count(*) FILTER (WHERE fault = 3) AS truncated,
         count(*) FILTER (WHERE ini_before IS NOT NULL AND ini_before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
walk(conv_id, i, q, cost, audit, lines) AS (
  SELECT conv_id, 0::BIGINT, 0, 0, '', ''::VARCHAR FROM counted
  UNION ALL
  SELECT conv_id, i, q, min(cost), arg_min(audit, (cost, audit)), arg_min(lines, (cost, audit)) FROM (
    SELECT w.conv_id, w.i + 1 AS i, m.q, w.cost + s.paid + m.paid AS cost, w.audit || s.ins || m.edit AS audit,
           w.lines || CASE s.ins WHEN '' THEN '' ELSE CASE w.q WHEN {USER} THEN chr(10) || 'assistant:' ELSE chr(10) || 'user:' END END
             || CASE s.ins WHEN 'II' THEN CASE w.q WHEN {USER} THEN chr(10) || 'user:' ELSE chr(10) || 'assistant:' END ELSE '' END
             || CASE m.edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || m.role || ':' || m.text
                ELSE chr(10) || CASE s.st WHEN {USER} THEN 'assistant' ELSE 'user' END || ':' || m.text END AS lines
    FROM walk w JOIN steps s ON s.q = w.q
    JOIN (
      SELECT conv_id, i, role, text, st, unnest(CASE WHEN fault IN (1, 2) THEN [{{'edit': 'D', 'q': st, 'paid': {DELETE_COST}}}] ELSE [
          {{'edit': 'D', 'q': st, 'paid': {DELETE_COST}}},
          {{'edit': 'K', 'q': CASE {kept} END, 'paid': CASE WHEN fault = 3 THEN {TRUNCATED_COST} ELSE 0 END}},
          {{'edit': 'R', 'q': CASE st {given} END, 'paid': {REROLE_COST} + CASE WHEN fault = 3 THEN {TRUNCATED_COST} ELSE 0 END}}] END,
        recursive := true)
      FROM faulty, (SELECT unnest([0, 1, 2, 3]) AS st) p) m
    ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1 AND m.st = s.st
    WHERE m.q IS NOT NULL) c
  GROUP BY conv_id, i, q),
ended AS (
  SELECT w.conv_id, min(w.cost + s.paid) AS cost, arg_min(w.audit || s.ins, (w.cost + s.paid, w.audit || s.ins)) AS audit,
         arg_min(w.lines || CASE s.ins WHEN '' THEN '' WHEN 'I' THEN chr(10) || 'assistant:' ELSE chr(10) || 'user:' || chr(10) || 'assistant:' END,
                 (w.cost + s.paid, w.audit || s.ins)) AS lines
  FROM walk w JOIN steps s ON s.q = w.q JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
  WHERE s.st IN (0, 3) GROUP BY w.conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(e.cost, 0)::BIGINT AS cost,
       coalesce(e.audit, '') AS audit, sha256(coalesce(substr(e.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""
