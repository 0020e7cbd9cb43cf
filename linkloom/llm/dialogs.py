"""Conversation structure repair by iterative-deepening A*.

Read in order, the roles of a repaired conversation are an optional system turn and then user and
assistant in turn, ending with the assistant, or nothing at all.  Edits, in ASCII order:

* D deletes a row (4); blank and duplicate rows have to go;
* I inserts an empty turn of the role that is due (3);
* K keeps a row whose role is due (0);
* R gives a row the role that is due (3).

A row that is truncated and not deleted costs 3 more.  The search goes depth first through the
edits in that order and leaves a path whose cost and least rest pass the bound.  What a state (rows
read, role due) is known to need at least goes into a table: first an estimate, then, each time the
state fails, the least that was missing.  A state is not entered again with less than that, and the
bound of the next round is what the table says of the first state.  The first path that is
accepted is the cheapest one, and the least in ASCII order among those that cost the same.

The estimate counts the edits that faults force up to the next ``LANDMARK``-th row, and adds what
the rest costs from there, which a sweep from the end has found.  So a conversation of n rows
takes a time in proportion to n, however many bounds its first rows need.

Rows of a conversation are in the order of turn (nulls first), role and text digest.  Spark sorts
them; a task sees each conversation twice in a row, first as marks of a few bytes a row, which the
search needs, then as texts, which stream by.  No conversation's texts are ever held together.

Null conv_ids are one conversation; null roles and texts read as one space.  Empty texts are blank.
The same row twice is a duplicate.  An empty table has no conversations.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.llm.common import col, table

LANDMARK = 64
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
SOUND, BLANK, DUPLICATE, CUT = range(4)
#: States by what has been read: nothing, the system turn, a user's turn, an assistant's turn.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_DUE = ("user", "user", "assistant", "user")
_AFTER = (2, 2, 3, 2)
_ENDS = (0, 6, 3, 0)  # what the end costs in each state
_LEGAL = {"su", "ua", "au"}
_FAR = 1 << 30


# -- the search --------------------------------------------------------------------------------------


def _moves(state: int, initial: str, fault: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows read, next state) in ASCII order."""
    out = [("D", DELETE, 1, state), ("I", INSERT, 0, _AFTER[state])]
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED if fault == CUT else 0
        if initial in _NEXT[state]:
            out.append(("K", more, 1, _NEXT[state][initial]))
        out.append(("R", REROLE + more, 1, _AFTER[state]))
    return out


_MOVES = {(s, i, f): _moves(s, i, f) for s in range(4) for i in "sua?" for f in range(4)}
_AT_END = [[("I", INSERT, 0, _AFTER[s])] for s in range(4)]


def _estimates(initials: str, faults: bytes) -> array:
    """For each (row, state) a least cost of the rest; exact at landmarks and at the end."""
    n = len(initials)
    least = array("i", bytes(16 * (n + 1)))
    least[4 * n :] = array("i", _ENDS)
    exact, to_landmark, base = list(_ENDS), 0, 0
    for i in range(n - 1, -1, -1):
        here = [min(cost + exact[after] for _, cost, rows, after in _MOVES[s, initials[i], faults[i]] if rows) for s in range(4)]
        for _ in range(2):
            here = [min(here[s], INSERT + here[_AFTER[s]]) for s in range(4)]
        exact = here
        to_landmark += DELETE if faults[i] in (BLANK, DUPLICATE) else TRUNCATED if faults[i] == CUT else 0
        if i % LANDMARK == 0:
            least[4 * i : 4 * i + 4] = array("i", exact)
            to_landmark, base = 0, min(exact)
        else:
            least[4 * i : 4 * i + 4] = array("i", [base + to_landmark] * 4)
    return least


def cheapest_edits(initials: str, faults: bytes) -> tuple[int, str]:
    """Cost and edits of the cheapest repair, the ASCII-least of them if several cost the same.

    ``initials`` has s, u, a or ? for each row, ``faults`` one of the four fault numbers.
    """
    n = len(initials)
    least = _estimates(initials, faults)
    # the first row's estimate is exact too if it is a landmark; deepening starts below it
    least[:4] = array("i", [min(least[:4])] * 4) if n else least[:4]
    while True:
        bound = least[0]
        path: list[str] = []
        stack = [[0, 0, bound, 0, _FAR]]  # rows read, state, cost left, next move, least cost of the moves that failed
        while stack:
            frame = stack[-1]
            row, state, left, move, missing = frame
            if row == n and state in (0, 3):
                return bound - left, "".join(path)
            moves = _MOVES[state, initials[row], faults[row]] if row < n else _AT_END[state]
            if move < len(moves):
                edit, cost, read, after = moves[move]
                frame[3] += 1
                needed = cost + least[4 * (row + read) + after]
                if needed <= left:
                    stack.append([row + read, after, left - cost, 0, _FAR])
                    path.append(edit)
                elif needed < missing:
                    frame[4] = needed
                continue
            at = 4 * row + state
            least[at] = max(least[at], missing)
            stack.pop()
            if stack:
                path.pop()
                parent = stack[-1]
                parent[4] = min(parent[4], _last_cost(parent, initials, faults) + least[at])


def _last_cost(frame: list[int], initials: str, faults: bytes) -> int:
    """The cost of the move that a state took last."""
    row, state, _, move, _ = frame
    return (_MOVES[state, initials[row], faults[row]] if row < len(initials) else _AT_END[state])[move - 1][1]


def repaired_rows(edits: Iterable[str], rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of what the edits make of the rows (role, text)."""
    state = 0
    for edit in edits:
        if edit == "I":
            yield edit, _DUE[state], ""
        else:
            role, text = next(rows)
            if edit == "D":
                continue
            if edit == "K":
                state = _NEXT[state][role[0]]
                yield edit, role, text
                continue
            yield edit, _DUE[state], text
        state = _AFTER[state]


# -- rows and their marks -----------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """The registered query's damage: by crc32 of ``conv_id:turn`` modulo 20 a row goes, or is changed.

    0 drops it, 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    rows = rows.select("conv_id", "turn", "role", "text", (F.crc32(name.cast("binary")) % 20).alias("harm"))
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(F.col("harm") == 4, "user").otherwise(role)
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("harm") == 3, 2).otherwise(1)))
    return rows.filter("harm <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_")).drop("_")


_SPACES = r"[\x20\x09-\x0D]"


def _marked(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, initial, fault): marks of the rows, without the texts."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(rf"[.!?]{_SPACES}*\z")
    initial = F.substring("role", 1, 1)
    marks = rows.select("conv_id", "turn", "role", "digest", F.when(initial.isin("s", "u", "a"), initial).otherwise("?").alias("initial"), blank.alias("blank"), cut.alias("cut"))
    seen = Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    again = F.row_number().over(seen) > 1
    fault = F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(F.col("cut"), CUT).otherwise(SOUND)
    return marks.withColumn("fault", fault).drop("blank", "cut")


def _dealt(rows: DataFrame) -> DataFrame:
    """Marks and texts of each conversation together in one task, the marks first, both in order."""
    spaced = [F.coalesce(col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = rows.select(col("conv_id").cast("long").alias("conv_id"), col("turn").cast("long").alias("turn"), *spaced)
    rows = rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    # of equal rows the one that is no duplicate comes first
    order = ["conv_id", F.col("text").isNotNull(), F.asc_nulls_first("turn"), "role", "digest", F.col("fault") == DUPLICATE]
    both = _marked(rows).unionByName(rows, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "turn", "role", "initial", "fault", "text")


_COLUMNS = ["turn", "role", "initial", "fault", "text"]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, tuple]]:
    for batch in batches:
        yield from zip(batch.column("conv_id").to_pylist(), zip(*(batch.column(c).to_pylist() for c in _COLUMNS)))


def _read_marks(group: Iterator) -> tuple[dict[str, int], str, bytes, tuple[str, str]]:
    """Counts, initials and faults from a conversation's marks, a byte each a row; and its first (role, text)."""
    initials, faults, turns = bytearray(), bytearray(), 0
    low = high = None
    for _, (turn, role, initial, fault, text) in group:
        if text is not None:
            break
        initials += initial.encode()
        faults.append(fault)
        if turn is not None:
            turns += turn != high  # they come in order
            low, high = turn if low is None else low, turn
    read = initials.decode()
    counts = {"gaps": high - low + 1 - turns if turns else 0}
    counts |= {name: faults.count(kind) for name, kind in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT))}
    counts["illegal"] = sum(a + b not in _LEGAL for a, b in zip(read, read[1:]))
    return counts, read, bytes(faults), (role, text)


def _conversations(batches: Iterator[pa.RecordBatch], made: Callable) -> Iterator:
    """``made(conv_id, counts, cost, edits, rows)`` of each conversation; ``rows`` (role, text) stream by."""
    for conv_id, group in groupby(_stream(batches), key=lambda r: r[0]):
        counts, initials, faults, first = _read_marks(group)
        cost, edits = cheapest_edits(initials, faults)

        def rows(first=first, group=group):
            yield first
            for _, (_, role, _, _, text) in group:
                yield role, text

        yield from made(conv_id, counts, cost, edits, rows())


_AUDIT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audits(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text).

    conv_id, gaps (turns missing between the first and the last), blank, duplicate, truncated,
    illegal (neighbouring roles that may not follow each other), cost, audit (the edits) and
    repaired_sha256 (of ``role:text`` of the repaired rows, joined by newlines).
    """

    def digest(conv_id, counts, cost, edits, rows):
        sha, joint = hashlib.sha256(), b""
        for _, role, text in repaired_rows(edits, rows):
            sha.update(joint + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            joint = b"\n"
        yield {"conv_id": conv_id, **counts, "cost": cost, "audit": edits, "repaired_sha256": sha.hexdigest()}

    kinds = [("conv_id", pa.int64()), *[(c, pa.int64()) for c in _AUDIT], ("audit", pa.string()), ("repaired_sha256", pa.string())]
    return _dealt(rows).mapInArrow(lambda batches: _batched(_conversations(batches, digest), pa.schema(kinds)), "conv_id long, " + ", ".join(f"{c} long" for c in _AUDIT) + ", audit string, repaired_sha256 string")


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit) of the repaired conversations; ``place`` counts from 0."""

    def lines(conv_id, counts, cost, edits, rows):
        for place, (edit, role, text) in enumerate(repaired_rows(edits, rows)):
            yield {"conv_id": conv_id, "place": place, "role": role, "text": text, "edit": edit}

    kinds = [("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]
    return _dealt(rows).mapInArrow(lambda batches: _batched(_conversations(batches, lines), pa.schema(kinds)), "conv_id long, place long, role string, text string, edit string")


def _batched(rows: Iterator[dict], schema: pa.Schema, most: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def query(spark, sf_dir: str) -> DataFrame:
    """The audit of every conversation after damage; one of which nothing is left has zeros."""
    rows = table(spark, sf_dir, "conversations")
    every = rows.select(F.col("conv_id").cast("long").alias("_conv")).distinct()
    found = audits(damaged(rows))
    out = every.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    none = {**dict.fromkeys(_AUDIT, F.lit(0)), "audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return out.select(F.col("_conv").alias("conv_id"), *[F.coalesce(c, value).alias(c) for c, value in none.items()])
