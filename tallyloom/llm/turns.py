"""Conversations repaired at least cost, by Viterbi over chunks with rank convergence.

Costs run backwards: per state of the role grammar, the cheapest way to finish. A conversation that lies within one task's
sorted rows is solved there. Pieces of other conversations (those cut by the sort's ranges, and very long ones) are chunks
of bounded size:

1. every chunk starts from a speculative cost vector at its end and keeps the vector at its start;
2. fix-up passes give each chunk the vector of the chunk after it and rerun it, only until the old and the new vector differ
   by a constant: from there on the old run holds, but for that constant. Passes end when no chunk's input changes;
3. the stitched vectors drive the tracing: each chunk knows for each start state where it ends, a walk over the
   chunks gives the real states, and each chunk then names its edits. Constants don't matter for a choice of edits.

Rows that must go (blank, repeated) leave every state as it is, so they take no part in the vectors. The number of passes
is that of the longest row of chunks that never converge; ordinary dialogues converge within a few turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.llm.common import partitions, saved, text_slices
from tallyloom.operators.keyed import join_by_frequency

#: A chunk has so many rows or bytes of text at most. They bound memory only, not results.
CHUNK_ROWS, CHUNK_BYTES = 8192, 8 << 20
_BLANKS = " \t\n\x0b\x0c\r"
#: Costs of the edits, and the neighbours that are in order.
_REROLE, _DELETE, _INSERT, _TRUNCATED = 2, 3, 2, 1
_ORDERLY = {"su", "ua", "au"}

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. The role that comes next leads to _NEXT.
_NEXT = (2, 2, 3, 2)
_KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_ROLE = {2: "user", 3: "assistant"}
_CLASSES = "sua?"
#: The code of a row that must go; others are twice their role's place in _CLASSES, plus 1 if they end without a stop.
_GONE = 99
_SPECULATIVE = (0, 0, 0, 0)


def _closed(costs: list[int]) -> list[int]:
    """With rows put in before: two of them at most are of use."""
    for _ in range(3):
        costs = [min(c, _INSERT + costs[n]) for c, n in zip(costs, _NEXT)]
    return costs


_END = tuple(_closed([0, 1 << 40, 1 << 40, 0]))


def _before(after: tuple, code: int) -> list[int]:
    kind, late = _CLASSES[code >> 1], (code & 1) * _TRUNCATED
    costs = []
    for state in range(4):
        ways = [_DELETE + after[state], _REROLE + late + after[_NEXT[state]]]
        if kind in _KEEP[state]:
            ways.append(late + after[_KEEP[state][kind]])
        costs.append(min(ways))
    return _closed(costs)


@lru_cache(maxsize=1 << 16)
def step(after: tuple, code: int) -> tuple[tuple, int]:
    """The vector before a row, its least entry 0, and what was taken off."""
    costs = _before(after, code)
    least = min(costs)
    return tuple(c - least for c in costs), least


@lru_cache(maxsize=1 << 16)
def edits(after: tuple, code: int, state: int) -> tuple[str, int]:
    """The least of the cheapest edits at a row, rows put in before it included, and the state after it."""
    costs, kind, late, out = _before(after, code), _CLASSES[code >> 1], (code & 1) * _TRUNCATED, ""
    while True:
        if costs[state] == _DELETE + after[state]:
            return out + "D", state
        if costs[state] == _INSERT + costs[_NEXT[state]]:
            out, state = out + "I", _NEXT[state]
            continue
        kept = _KEEP[state].get(kind)
        if kept is not None and costs[state] == late + after[kept]:
            return out + "K", kept
        return out + "R", _NEXT[state]


def backward(codes: bytes, end: tuple) -> tuple[tuple, int]:
    total, vector = 0, end
    for code in reversed(codes):
        vector, off = step(vector, code)
        total += off
    return vector, total


def fix_up(codes: bytes, old: tuple, new: tuple) -> tuple[bool, tuple, int]:
    """Rerun from ``new`` beside ``old`` until they differ by a constant only: (did they, vector or not, gain or total)."""
    gain = 0
    for code in reversed(codes):
        if old == new:
            return True, new, gain
        (old, before), (new, now) = step(old, code), step(new, code)
        gain += now - before
    return old == new, new, gain


def traced(codes: bytes, end: tuple, state: int) -> tuple[list[str], int]:
    """Edits at each of the rows, from ``state``, and the state after them."""
    vectors = [end]
    for code in reversed(codes):
        vectors.append(step(vectors[-1], code)[0])
    out = []
    for k, code in enumerate(codes):
        own, state = edits(vectors[len(codes) - 1 - k], code, state)
        out.append(own)
    return out, state


def closing(state: int) -> tuple[str, int]:
    """Rows put in after the last one."""
    out = ""
    while state in (1, 2):
        out, state = out + "I", _NEXT[state]
    return out, state


class _Piece:
    """Rows of one conversation, in order: what is counted of them, and the codes of those that may stay."""

    def __init__(self):
        self.rows, self.codes, self.bytes = [], bytearray(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.forced = self.turns = 0
        self.first_turn = self.last_turn = self.first = self.last = None

    def add(self, turn: int | None, role: str, text: str, n: int, repeated: bool) -> None:
        """``n`` equal rows; ``repeated``: their role and text were seen earlier."""
        if n == 0:
            return
        bare, initial = text.strip(_BLANKS), role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in _ORDERLY:
            self.illegal += 1
        self.illegal += (n - 1) * (initial * 2 not in _ORDERLY)
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.turns, self.last_turn = self.turns + 1, turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        live = bool(bare) and not repeated
        if not bare:
            self.blank += n
        else:
            self.duplicate += n - live
        if live:
            late = bare[-1] not in ".!?"
            self.truncated += late
            kind = _CLASSES.find(initial) if initial in "sua" and initial else 3
            self.codes.append(kind << 1 | late)
        self.forced += n - live
        self.rows.append((role, text, n, self.codes[-1] if live else _GONE))
        self.bytes += len(text)


def apply_edits(rows: list[tuple], end: tuple, state: int) -> tuple[list[str], list[tuple[str, str]], int]:
    """Audit parts and repaired (role, text) rows of ``rows`` (role, text, n, code) from ``state``; the state after them."""
    found, _ = traced(bytes(r[3] for r in rows if r[3] != _GONE), end, state)
    audit, kept, at = [], [], iter(found)
    for role, text, n, code in rows:
        live = code != _GONE
        if live:
            own = next(at)
            audit.append(own)
            for edit in own:
                if edit == "D":
                    continue
                state = _KEEP[state][role[:1]] if edit == "K" else _NEXT[state]
                kept.append((role if edit == "K" else _ROLE[state], "" if edit == "I" else text))
        audit.append("D" * (n - live))
    return audit, kept, state


def _closing_rows(state: int) -> tuple[str, list[tuple[str, str]]]:
    text, kept = closing(state)[0], []
    for _ in text:
        state = _NEXT[state]
        kept.append((_ROLE[state], ""))
    return text, kept


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): the rows after damage by crc32(conv_id:turn) % 20, ``n`` equal rows each.

    Null values count as one blank in that key, and null roles and texts are one blank. 0 drops a row (``n`` = 0, so that its
    conversation is still known), 1 empties its text, 2 takes stops out, 3 repeats it, 4 makes it the user's.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    hurt = F.when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 0, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").otherwise(hurt).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows by conversation, turn, role and hash of the text, equal ones as one, with ``repeated``: seen at an earlier turn."""
    same = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    spoken = F.concat(*(F.hex(F.xxhash64(F.lit(seed), F.col("conv_id").isNull(), "conv_id", "role", "text")) for seed in (1, 2)))
    keyed = same.withColumn("h", F.xxhash64("text")).withColumn("spoken", F.when(F.col("n") > 0, spoken))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    uttered = rows.where("n > 0").groupBy(spoken.alias("spoken")).agg(F.min(place).alias("earliest"), F.max(place).alias("latest"), F.count("*").alias("n_turns"))
    several = uttered.where("earliest <> latest").drop("latest")
    joined = join_by_frequency(keyed, saved(several, "spoken"), "spoken", "n_turns", F.xxhash64("turn"), how="left")
    repeated = F.coalesce(place != F.col("earliest"), F.lit(False))
    order = ["conv_id", "turn", "role", "h"]
    ready = joined.select(*order, "text", "n", repeated.alias("repeated"))
    return ready.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order, "text").drop("h")


_FIELDS = (
    "kind int, conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, "
    "part int, chunk int, pos long, codes binary, vector string, total long, forced long, turns long, first_turn long, last_turn long, first string, last string, "
    "role string, text string, n long, code int"
)
_DONE, _TURN, _CHUNK, _ROW = range(4)


def _typed(kind: str) -> tuple[str, list[tuple[str, pa.DataType | None]]]:
    schema = _FIELDS.format(id=kind)
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return schema, [(f.split(" ")[0], types.get(f.split(" ")[1]) if not f.startswith("conv_id") else None) for f in schema.split(", ")]


def _batch(rows: list[dict], fields: list, id_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(name) for r in rows], kind or id_type) for name, kind in fields], [name for name, _ in fields])


def _vector(text: str) -> tuple:
    return tuple(map(int, text.split(",")))


def _told(vector: tuple) -> str:
    return ",".join(map(str, vector))


def _solved(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """One pass over the ordered rows: whole conversations solved, chunks of the others with their speculative run."""
    schema, fields = _typed(rows.schema["conv_id"].dataType.simpleString())

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, id_type, out, held = TaskContext.get().partitionId(), None, [], 0
        # chunks have even numbers, and rows put in at the end of a conversation the next odd one
        piece, chunk, conv, open_ = _Piece(), 0, None, True

        def put(goes_on: bool) -> None:
            """The piece as a chunk, or solved if it is a whole conversation."""
            nonlocal held, chunk
            p = piece
            if not goes_on and not open_:
                audit, kept, state = apply_edits(p.rows, _END, 0)
                more, added = _closing_rows(state)
                vector, total = backward(bytes(p.codes), _END)
                digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept + added).encode()).hexdigest()
                gaps = p.last_turn - p.first_turn + 1 - p.turns if p.turns else 0
                out.append({"kind": _DONE, "conv_id": conv, "gaps": gaps, "blank": p.blank, "duplicate": p.duplicate, "truncated": p.truncated, "illegal": p.illegal, "cost": total + vector[0] + _DELETE * p.forced, "audit": "".join(audit) + more, "repaired_sha256": digest})
                out.extend({"kind": _TURN, "conv_id": conv, "part": part, "chunk": -1, "pos": k, "role": r, "text": t} for k, (r, t) in enumerate(kept + added))
            else:
                vector, total = backward(bytes(p.codes), _SPECULATIVE)
                out.append({"kind": _CHUNK, "conv_id": conv, "part": part, "chunk": chunk, "blank": p.blank, "duplicate": p.duplicate, "truncated": p.truncated, "illegal": p.illegal, "codes": bytes(p.codes), "vector": _told(vector), "total": total, "forced": p.forced, "turns": p.turns, "first_turn": p.first_turn, "last_turn": p.last_turn, "first": p.first, "last": p.last})
                out.extend({"kind": _ROW, "conv_id": conv, "part": part, "chunk": chunk, "pos": k, "role": r, "text": t, "n": n, "code": code} for k, (r, t, n, code) in enumerate(p.rows))
                chunk += 2
            held += p.bytes

        began = False
        for batch in text_slices(batches, "text"):
            id_type = batch.schema.field("conv_id").type
            for row in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "repeated"))):
                if began and row[0] != conv:
                    put(False)
                    piece, open_ = _Piece(), False
                elif len(piece.rows) >= chunk_rows or piece.bytes >= CHUNK_BYTES:
                    put(True)
                    piece, open_ = _Piece(), True
                conv, began = row[0], True
                piece.add(*row[1:])
                if len(out) >= 2048 or held >= CHUNK_BYTES:
                    yield _batch(out, fields, id_type)
                    out, held = [], 0
        if began:
            put(True)
            yield _batch(out, fields, id_type)

    return saved(rows.mapInArrow(solve, schema), "solved-turns")


def _converged(chunks: DataFrame) -> DataFrame:
    """Chunks with their true input vector ``given``, but for a constant, and ``ends``, the state after them for each before."""
    state = chunks.where(F.length("codes") > 0).select("conv_id", "part", "chunk", "codes", F.lit(_told(_SPECULATIVE)).alias("given"), "vector", "total")
    after = Window.partitionBy("conv_id").orderBy(F.desc("part"), F.desc("chunk"))
    schema = state.schema

    def rerun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, vectors, totals = [], [], []
            for codes, old, new, vector, total in zip(*(batch[c].to_pylist() for c in ("codes", "given", "next", "vector", "total"))):
                if new != old:
                    same, end, gain = fix_up(codes, _vector(old), _vector(new))
                    vector, total = (vector if same else _told(end)), total + gain
                given.append(new)
                vectors.append(vector)
                totals.append(total)
            yield pa.RecordBatch.from_arrays([batch["conv_id"], batch["part"], batch["chunk"], batch["codes"], pa.array(given, pa.string()), pa.array(vectors, pa.string()), pa.array(totals, pa.int64())], schema.names)

    def ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = ["".join(str(traced(codes, _vector(given), state)[1]) for state in range(4)) for codes, given in zip(batch["codes"].to_pylist(), batch["given"].to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.string())], [*batch.schema.names, "ends"])

    while True:
        linked = saved(state.withColumn("next", F.coalesce(F.lag("vector").over(after), F.lit(_told(_END)))), "linked-chunks")
        if linked.where("next <> given").isEmpty():
            return linked.drop("next").mapInArrow(ending, schema.add("ends", "string"))
        state = linked.mapInArrow(rerun, schema)


def _walked(chunks: DataFrame, stitched: DataFrame) -> DataFrame:
    """Conversations of several pieces: totals (kind 0) and the start state and input vector of each chunk (kind 2).

    Chunks pass by in order, and of each conversation only the state and the last row's turn and role are kept.
    """
    schema, fields = _typed(chunks.schema["conv_id"].dataType.simpleString())
    known = stitched.select(F.col("part").alias("p"), F.col("chunk").alias("c"), "given", F.col("vector").alias("start"), F.col("total").alias("gained"), "ends")
    rows = chunks.drop("codes").join(known, (F.col("part") == F.col("p")) & (F.col("chunk") == F.col("c")), "left")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, own, state = None, None, 0
        last = turn = low = None
        id_type, out = None, []

        def finish() -> None:
            out.append({"kind": _DONE, **own, "gaps": turn - low + 1 - own["turns"] if low is not None else 0})
            out.append({"kind": _CHUNK, "conv_id": conv, "part": own["part"], "chunk": own["chunk"] + 1, "n": state})

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for r in batch.to_pylist():
                if own is None or r["conv_id"] != conv:
                    if own is not None:
                        finish()
                    conv, state, last, turn, low = r["conv_id"], 0, None, None, None
                    own = {"conv_id": conv, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "turns": 0, "started": False}
                for c in ("blank", "duplicate", "truncated", "illegal", "turns"):
                    own[c] += r[c]
                own["cost"] += _DELETE * r["forced"] + (r["gained"] or 0)
                own["part"], own["chunk"] = r["part"], r["chunk"]
                if last is not None and r["first"] is not None and last + r["first"] not in _ORDERLY:
                    own["illegal"] += 1
                last = r["last"] if r["last"] is not None else last
                if r["first_turn"] is not None:
                    own["turns"] -= r["first_turn"] == turn
                    low = r["first_turn"] if low is None else low
                    turn = r["last_turn"]
                out.append({"kind": _CHUNK, "conv_id": conv, "part": r["part"], "chunk": r["chunk"], "n": state, "vector": r["given"] or _told(_END)})
                if r["ends"]:
                    if not own["started"]:
                        own["cost"], own["started"] = own["cost"] + _vector(r["start"])[0], True
                    state = int(r["ends"][state])
                if len(out) >= 1024:
                    yield _batch(out, fields, id_type)
                    out.clear()
        if own is not None:
            finish()
            yield _batch(out, fields, id_type)

    return saved(ordered.mapInArrow(walk, schema), "walked-chunks")


def _applied(rows: DataFrame, walked: DataFrame) -> DataFrame:
    """Repaired rows, and the audit of each chunk, of the conversations in several pieces."""
    schema, fields = _typed(rows.schema["conv_id"].dataType.simpleString())

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        plan = right.to_pylist()[0]
        if plan["vector"] is None:
            audit, kept = _closing_rows(plan["n"])
            parts = [audit]
        else:
            own = sorted(zip(*(left[c].to_pylist() for c in ("pos", "role", "text", "n", "code"))), key=lambda r: r[0])
            parts, kept, _ = apply_edits([r[1:] for r in own], _vector(plan["vector"]), plan["n"])
        place = {"conv_id": plan["conv_id"], "part": plan["part"], "chunk": plan["chunk"]}
        out = [{"kind": _CHUNK, **place, "pos": -1, "audit": "".join(parts)}]
        out += [{"kind": _TURN, **place, "pos": k, "role": r, "text": t} for k, (r, t) in enumerate(kept)]
        return pa.Table.from_batches([_batch(out, fields, right.schema.field("conv_id").type)])

    chunks = walked.where(F.col("kind") == _CHUNK).select("conv_id", "part", "chunk", "n", "vector")
    return saved(rows.select("part", "chunk", "pos", "role", "text", "n", "code").groupBy("part", "chunk").cogroup(chunks.groupBy("part", "chunk")).applyInArrow(apply, schema), "applied-turns")


def _digested(applied: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256). A digest is of one text, so a conversation's rows pass one task, one by one."""
    kind = applied.schema["conv_id"].dataType.simpleString()
    ordered = applied.select("conv_id", "part", "chunk", "pos", "role", "text", "audit").repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk", "pos")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, began, sha, first, audit, id_type = None, False, None, True, [], None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], id_type), pa.array(["".join(audit)]), pa.array([sha.hexdigest()])], ["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for i, pos, role, text, part in zip(*(batch[c].to_pylist() for c in ("conv_id", "pos", "role", "text", "audit"))):
                if not began or i != conv:
                    if began:
                        yield done()
                    conv, began, sha, first, audit = i, True, hashlib.sha256(), True, []
                if pos < 0:
                    audit.append(part)
                    continue
                sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        if began:
            yield done()

    return ordered.mapInArrow(digest, f"conv_id {kind}, audit string, repaired_sha256 string")


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Cheapest edits that bring each conversation's role initials to ``(s?(ua)+)?``, and the repaired rows.

    ``rows`` has conv_id, turn, role, text (no nulls) and n, the number of equal rows (see ``damaged``); 0 only names the
    conversation. Rows stand by turn (nulls first); those of one turn by role and hash of the text, equal ones side by side.
    A null conv_id is a conversation of its own. Blank rows and rows whose role and text were seen earlier are deleted (3);
    others are kept, get another role (2) or are deleted (3), rows are put in (2), and one that ends without a stop costs 1
    if it stays. Of equally cheap edits the least by their initials is taken. A role of another initial, or none, is never
    kept. Without rows: zeros, an empty audit and the digest of the empty text. No table rows: no rows.

    Returns the conversations (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) and
    the repaired rows (conv_id, part, chunk, pos, role, text), which stand in order of part, chunk and pos.
    """
    solved = _solved(_ordered(rows), chunk_rows)
    chunks = solved.where(F.col("kind") == _CHUNK)
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    placed = ["conv_id", "part", "chunk", "pos", "role", "text"]
    walked = _walked(chunks, _converged(chunks))
    applied = _applied(solved.where(F.col("kind") == _ROW), walked)
    texts = _digested(applied).select(F.col("conv_id").alias("of"), "audit", "repaired_sha256")
    totals = walked.where(F.col("kind") == _DONE).drop("audit", "repaired_sha256")
    pieced = totals.join(texts, F.col("conv_id").eqNullSafe(F.col("of")))
    conversations = solved.where(F.col("kind") == _DONE).select("conv_id", *columns).union(pieced.select("conv_id", *columns))
    turn = F.col("kind") == _TURN
    return conversations, solved.where(turn).select(*placed).union(applied.where(turn).select(*placed))
