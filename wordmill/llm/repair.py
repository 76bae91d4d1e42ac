"""Conversation structure repair: Wagner-Fischer alignment with a grammar string.

The roles of a conversation shall read ``(s?(ua)+)?``: an optional system turn,
then user and assistant in turns, or nothing. Edits: Keep (0), Rerole a turn to
user or assistant (2), Delete (3, required for blank and duplicate turns),
Insert a user or assistant turn with empty text (2); a truncated turn that is
not deleted adds 1. Of the cheapest scripts the one whose audit, its initials
in order, is least in ASCII is taken.

1. *Order.* Turns are range-partitioned and sorted by conversation, turn (nulls
   first), role and digest of the text, and numbered in that order, so a long conversation
   lies over many tasks. Only the numbered table holds texts.
2. *Faults* come from groupings that fold in each task: the smallest number of
   each (conversation, role, text digest) is no duplicate. A turn becomes one
   letter (role initial and fault).
3. *Alignment.* The letters of a conversation, one byte a turn as in its audit,
   are aligned with the alternating string. All targets with the same end share
   their suffixes, so one table of Wagner and Fischer over ``(turns left, target
   left)`` serves every feasible length. Ukkonen's band leaves out cells whose
   difference in length alone costs more than the incumbent, a plain repair in
   one walk. Audits are traced back for each length of least cost and compared.
   Conversations of more than ``BLOCK`` turns are aligned block by block: costs
   from each state of the grammar are carried from the last block to the first,
   then audits from the first to the last, so time and memory grow with the
   length, not with its square.
4. *Repaired turns* are the numbered turns joined with their edits by number.

Defined cases: a null conversation id is one conversation; null role or text is
one space; null turns come first; equal rows are all kept and repeat each other
(the first is no duplicate); a role other than system, user and assistant can be
reroled or deleted only; roles count by their first character; an empty table
gives empty results. Texts may be of any length. Columns other than the four are
not read, so they may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wordmill.llm.common import long_rows, quoted, utf8
from wordmill.plans.physical import materialize

BLOCK = 512  # turns aligned in one table
PIECE_BITS = 12  # turns of a piece of the letters, as a power of two
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# A turn's letter: its role initial if it can stand (s, u, a, or o for others),
# the capital if it is truncated; b for blank and d for duplicate.
BLANK, DUPLICATE = b"bd"
ROLE = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired roles end with so far
FAR = 1 << 30


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the test damage of each row by
    ``crc32("conv_id:turn") % 20``: 0 drops it, 1 empties its text, 2 removes
    ``.!?``, 3 repeats it, 4 makes it a user turn. Nulls count as one space."""
    space = F.lit(" ")
    text = lambda name: F.coalesce(quoted(name).cast("string"), space)
    kind = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    rows = turns.select(
        quoted("conv_id"), quoted("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind")
    ).filter("kind <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _name(conv_id: Column) -> Column:
    """A conversation's key, never null."""
    return F.when(conv_id.isNull(), "").otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def numbered(turns: DataFrame) -> DataFrame:
    """``name, at, conv_id, turn, role, text, digest, initial, last`` sorted by
    conversation; ``at`` numbers the rows in order, ``last`` is the last
    character that is no space (null: blank)."""
    space = F.lit(" ")
    rows = turns.select(
        _name(quoted("conv_id")).alias("name"),
        quoted("conv_id").alias("conv_id"),
        quoted("turn").alias("turn"),
        F.coalesce(quoted("role").cast("string"), space).alias("role"),
        F.coalesce(quoted("text").cast("string"), space).alias("text"),
    )
    order = ["name", "turn", "role", "digest"]
    rows = rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    trimmed = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.select(
        "name",
        F.monotonically_increasing_id().alias("at"),
        "conv_id",
        "turn",
        "role",
        "text",
        "digest",
        F.substring("role", 1, 1).alias("initial"),
        F.when(trimmed != "", F.right(trimmed, F.lit(1))).alias("last"),
    )
    return materialize(rows, "repair-turns")


def _letters(rows: DataFrame) -> DataFrame:
    """``name, letters, initials, starts``: the turns of each conversation as
    letters, their role initials, and the number of the first turn of each
    piece with the piece's length."""
    first = rows.groupBy("name", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    letter = (
        F.when(F.col("last").isNull(), chr(BLANK))
        .when(F.col("first").isNull(), chr(DUPLICATE))
        .when(F.col("last").isin(".", "!", "?"), initial)
        .otherwise(F.upper(initial))
    )
    marked = rows.select("name", "at", "initial", "last").join(first, "at", "left")
    marked = marked.select("name", "at", initial.alias("initial"), letter.alias("letter"))
    # Pieces first, so that no array of structs is longer than a piece.
    pieces = marked.groupBy("name", F.shiftright("at", PIECE_BITS).alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("at", "letter", "initial"))).alias("turns")
    )
    text = lambda field: F.array_join(F.transform("turns", lambda t: t[field]), "")
    pieces = pieces.select(
        "name",
        F.struct(
            F.col("turns")[0]["at"].alias("at"),
            text("letter").alias("letters"),
            text("initial").alias("initials"),
        ).alias("p"),
    )
    whole = pieces.groupBy("name").agg(F.array_sort(F.collect_list("p")).alias("pieces"))
    joined = lambda field: F.array_join(F.transform("pieces", lambda p: p[field]), "").cast("binary")
    return whole.select(
        "name",
        joined("letters").alias("letters"),
        joined("initials").alias("initials"),
        F.transform("pieces", lambda p: p["at"]).alias("starts"),
        F.transform("pieces", lambda p: F.length(p["letters"])).alias("lengths"),
    )


class Block:
    """Alignment tables of some turns: ``table[end][i][m]`` is the least cost to
    align the turns from ``i`` on with the last ``m`` characters of an
    alternating string that ends with ``end``, and to go on from there at the
    cost ``after[state]``. In the last block turns may be inserted at the end."""

    def __init__(self, letters: bytes, after: list[int], last: bool):
        self.letters, self.after, self.last = letters, after, last
        n = len(letters)
        limit = max((c for s in range(4) if (c := self._plain(s)) < FAR), default=0) - min(after)
        self.under, self.over = limit // DELETE, limit // INSERT  # Ukkonen's band
        self.width = n + self.over + 1
        self.table = {USER: self._fill(USER), ASSISTANT: self._fill(ASSISTANT)}

    def _plain(self, state: int) -> int:
        """The incumbent: cost of a repair in one walk, without a search."""
        cost = 0
        for letter in self.letters:
            if letter in (BLANK, DUPLICATE):
                cost += DELETE
                continue
            low = chr(letter).lower()
            if state == START and low == "s":
                state = SYSTEM
            else:
                state = ASSISTANT if state == USER else USER
                cost += 0 if low == "ua"[state == ASSISTANT] else REROLE
            cost += TRUNCATED * chr(letter).isupper()
        if self.last and state in (SYSTEM, USER):
            cost, state = cost + INSERT * (1 + (state == SYSTEM)), ASSISTANT
        return min(FAR, cost + self.after[state])

    @staticmethod
    def _wanted(end: int, m: int) -> int:
        """Character of the target with ``m`` characters left."""
        return ord("ua"[(end == ASSISTANT) == (m % 2 == 1)])

    def _fill(self, end: int) -> np.ndarray:
        n, width = len(self.letters), self.width
        table = np.full((n + 1, width), FAR, np.int64)
        ramp = INSERT * np.arange(width)
        table[n, 0] = self.after[end]
        if self.last:
            table[n] = np.minimum(FAR, self.after[end] + ramp)
            table[n, self.over + 1 :] = FAR
        odd = np.array([self._wanted(end, m) for m in (0, 1)])
        wanted = odd[np.arange(width) % 2]
        for i in range(n - 1, -1, -1):
            left = n - i
            a, b = max(0, left - self.under), min(width, left + self.over + 1)
            row = table[i + 1, a:b] + DELETE
            letter = self.letters[i]
            if letter not in (BLANK, DUPLICATE):
                low = ord(chr(letter).lower())
                extra = TRUNCATED * (low != letter)
                c = max(a, 1)
                change = np.where(wanted[c:b] == low, 0, REROLE) + extra
                row[c - a :] = np.minimum(row[c - a :], table[i + 1, c - 1 : b - 1] + change)
            table[i, a:b] = np.minimum(FAR, np.minimum.accumulate(row - ramp[a:b]) + ramp[a:b])
        return table

    def _lengths(self, state: int, i: int) -> Iterator[tuple[int, int, int]]:
        """``cost, end, length`` of every feasible length after ``state``."""
        first = ord("a") if state == USER else ord("u")
        for end, table in self.table.items():
            for m in range(1 if self._wanted(end, 1) == first else 2, self.width, 2):
                yield int(table[i, m]), end, m
        yield min(FAR, DELETE * (len(self.letters) - i) + self.after[state]), state, 0

    def scripts(self, state: int) -> list[tuple[int, int, int, int]]:
        """``cost, turns of the head, end, length`` of the cheapest targets. The
        head is deleted but for its last turn, a system turn that is kept."""
        found = [(cost, 0, end, m) for cost, end, m in self._lengths(state, 0)]
        if state == START:
            for i, letter in enumerate(self.letters):
                if DELETE * i > min(found)[0]:
                    break
                if letter in b"sS":
                    head = DELETE * i + TRUNCATED * (letter == ord("S"))
                    found += [(head + cost, i + 1, end, m) for cost, end, m in self._lengths(SYSTEM, i + 1)]
        least = min(found)[0]
        return [f for f in found if f[0] == least]

    def cost(self, state: int) -> int:
        return min(FAR, self.scripts(state)[0][0])

    def _trace(self, i: int, end: int, m: int) -> str:
        """The least audit from a cell on: at every cell the first letter that
        keeps the cost."""
        n, letters, out = len(self.letters), self.letters, []
        if m == 0:
            return "D" * (n - i)
        table = self.table[end]
        while i < n or m:
            now = table[i, m]
            if i < n and table[i + 1, m] + DELETE == now:
                out.append("D")
                i += 1
            elif m and table[i, m - 1] + INSERT == now and (i < n or self.last):
                out.append("I")
                m -= 1
            else:
                out.append("K" if self._wanted(end, m) == ord(chr(letters[i]).lower()) else "R")
                i, m = i + 1, m - 1
        return "".join(out)

    def best(self, state: int) -> tuple[str, int]:
        """Least audit of the cheapest scripts from ``state``, and the state it
        ends in."""
        found = []
        for _, head, end, m in self.scripts(state):
            found.append(("D" * (head - 1) + "K" * (head > 0) + self._trace(head, end, m), end))
        return min(found)


def align(letters: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of the cheapest repair."""
    places = range(0, max(1, len(letters)), block)
    ends = {places[-1]: [0, FAR, FAR, 0]}  # costs behind each block: complete are START and ASSISTANT
    for at in reversed(places[1:]):
        part = Block(letters[at : at + block], ends[at], at == places[-1])
        ends[at - block] = [part.cost(state) for state in range(4)]
    audit, state, cost = [], START, 0
    for at in places:
        part = Block(letters[at : at + block], ends[at], at == places[-1])
        if at == 0:
            cost = part.cost(START)
        done, state = part.best(state)
        audit.append(done)
    return cost, "".join(audit)


def replay(audit: str) -> tuple[list[int], list[str]]:
    """For every letter of an audit the position of its turn in the repaired
    conversation (-1: deleted) and the role it gets (empty: its own)."""
    length = len(audit) - audit.count("D")
    places, roles, at = [], [], 0
    for letter in audit:
        if letter == "D":
            places.append(-1)
            roles.append("")
            continue
        # From the end the roles are assistant, user, assistant and so on.
        role = "user" if (length - at) % 2 == 0 else "assistant"
        places.append(at)
        roles.append("" if letter == "K" else role)
        at += 1
    return places, roles


RESULT = StructType(
    [StructField(c, LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    + [StructField("audit", StringType())]
)
LEGAL = {b"su", b"ua", b"au"}


@F.arrow_udf(RESULT)
def _aligned(letters: pa.Array, initials: pa.Array) -> pa.Array:
    rows = []
    for turns, roles in zip(letters.to_pylist(), initials.to_pylist()):
        cost, audit = align(turns)
        codes = np.frombuffer(roles, np.uint8)
        pairs = codes[:-1].astype(np.int64) * 256 + codes[1:]
        legal = sum(int((pairs == a * 256 + b).sum()) for a, b in LEGAL)
        rows.append(
            {
                "blank": turns.count(BLANK),
                "duplicate": turns.count(DUPLICATE),
                "truncated": sum(map(turns.count, b"SUAO")),
                "illegal": len(pairs) - legal,
                "cost": cost,
                "audit": audit,
            }
        )
    return pa.array(rows, pa.struct([(c, pa.int64()) for c in RESULT.names[:-1]] + [("audit", pa.string())]))


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for every letter of the audits that is no deletion."""
    for batch in batches:
        for name, audit, starts, lengths in zip(*(c.to_pylist() for c in batch.columns)):
            if not audit:
                continue
            letters = np.frombuffer(audit.encode(), np.uint8)
            numbers = np.concatenate([np.arange(s, s + k) for s, k in zip(starts, lengths)])
            own = letters != ord("I")
            at = np.zeros(len(letters), np.int64)
            at[own] = numbers
            places, roles = replay(audit)
            stays = letters != ord("D")
            kept = np.flatnonzero(stays)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(kept), pa.string()),
                    pa.array(at[kept], mask=~own[kept]),
                    pa.array([audit[i] for i in kept], pa.string()),
                    pa.array([places[i] for i in kept], pa.int64()),
                    pa.array([roles[i] or None for i in kept], pa.string()),
                ],
                ["name", "at", "edit", "position", "new_role"],
            )


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two frames. One row per conversation of ``turns``: ``name`` (its key),
    ``gaps, blank, duplicate, truncated, illegal, cost, audit``. And the repaired
    turns: ``name, position, edit, role, text``."""
    rows = numbered(turns)
    letters = _letters(rows)
    long_rows(letters)
    found = letters.withColumn("r", _aligned("letters", "initials")).select("name", "starts", "lengths", "r.*")
    found = materialize(found, "repair-audits")
    spans = rows.groupBy("name").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps")
    )
    edits = found.select("name", "audit", "starts", "lengths").mapInArrow(
        _edits, "name string, at bigint, edit string, position bigint, new_role string"
    )
    edits = materialize(edits, "repair-edits")
    texts = rows.select("at", F.col("role").alias("old_role"), "text")
    own = edits.filter(F.col("at").isNotNull()).join(texts, "at")
    own = own.select("name", "position", "edit", F.coalesce("new_role", "old_role").alias("role"), "text")
    made = edits.filter(F.col("at").isNull()).select("name", "position", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    audits = found.drop("starts", "lengths").join(spans, "name")
    return audits, own.unionByName(made)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the newline-joined lines of each name, over rows sorted by
    name: one line at a time is held."""
    name, running = None, None
    for batch in batches:
        out = []
        for new, line in zip(*(c.to_pylist() for c in batch.columns)):
            if new != name:
                if running is not None:
                    out.append((name, running.hexdigest()))
                name, running = new, hashlib.sha256(line)
            else:
                running.update(b"\n" + line)
        yield pa.RecordBatch.from_pydict({"name": pa.array([n for n, _ in out], pa.string()), "digest": pa.array([d for _, d in out], pa.string())})
    if running is not None:
        yield pa.RecordBatch.from_pydict({"name": [name], "digest": [running.hexdigest()]})


def line_digests(turns: DataFrame) -> DataFrame:
    """``name, digest`` of the repaired ``role:text`` lines. A digest is serial,
    so a conversation's lines pass through one task, but never are held there."""
    lines = turns.select("name", "position", utf8(F.concat_ws(":", "role", "text")).alias("line"))
    long_rows(lines)
    lines = lines.repartition("name").sortWithinPartitions("name", "position").select("name", "line")
    return lines.mapInArrow(_digests, "name string, digest string")


NOTHING = hashlib.sha256(b"").hexdigest()


def repair_report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``conversations``: the audit of the repair of
    ``turns`` and the digest of the repaired turns; zeros, an empty audit and
    the digest of nothing where ``turns`` has no row."""
    audits, repaired = repair(turns)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = conversations.select(quoted("conv_id").alias("conv_id")).distinct().withColumn("name", _name(F.col("conv_id")))
    full = ids.join(audits, "name", "left").join(line_digests(repaired), "name", "left")
    return full.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.lit(NOTHING)).alias("repaired_sha256"),
    )
