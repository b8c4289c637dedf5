"""Repaired conversations against a search over all edits, one conversation at a time."""

import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
import xxhash

from tallyloom.llm import turns

BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        of = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{of(conv)}:{of(turn)}".encode()) % 20
        role, text, own = of(role), of(text), out[conv]
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by trying every edit at every state."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, last, put_in):
        ways = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        role = follow[last]
        if put_in < 3:
            cost, audit, kept = best(i, role, put_in + 1)
            ways.append((cost + 2, "I" + audit, (f"{names[role]}:", *kept)))
        if i < len(rows):
            own, text, forced, late = rows[i]
            cost, audit, kept = best(i + 1, last, 0)
            ways.append((cost + 3, "D" + audit, kept))
            if not forced:
                if own[:1] and (own[:1] == role or (own[0] == "s" and last == "")):
                    cost, audit, kept = best(i + 1, own[0], 0)
                    ways.append((cost + late, "K" + audit, (f"{own}:{text}", *kept)))
                cost, audit, kept = best(i + 1, role, 0)
                ways.append((cost + 2 + late, "R" + audit, (f"{names[role]}:{text}", *kept)))
        return min(ways, default=(10**9, "", ()))

    for i in range(len(rows), -1, -1):  # from the end, so that no call goes deep
        for last in follow:
            best(i, last, 0)
    return best(0, "", 0)


def repaired(rows):
    out = {}
    for conv, own in damage(rows).items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), (xxhash.xxh64_intdigest(r[2].encode(), seed=42) + 2**63) % 2**64, r[2].encode()))
        seen, counts, judged = set(), [0, 0, 0], []
        for _, role, text in own:
            bare = text.strip(BLANKS)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            if fault is not None:
                counts[fault] += 1
            seen.add((role, text))
            judged.append((role, text, fault in (0, 1), fault == 2))
        known = {t for t, _, _ in own if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, kept = cheapest(tuple(judged))
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def _frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS n", "2 AS part", "'k' AS kind").repartition(3)


def _check(spark, rows, chunk_rows):
    conversations, kept = turns.repair(turns.damaged(_frame(spark, rows)), chunk_rows)
    got = conversations.collect()
    want = repaired(rows)
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want
    texts = defaultdict(list)
    for r in sorted(kept.collect(), key=lambda r: (r.part, r.chunk, r.pos)):
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    assert {i: hashlib.sha256("\n".join(texts[i]).encode()).hexdigest() for i in want} == {i: w[-1] for i, w in want.items()}


def _random_rows(rng, conv, n):
    roles = rng.choice([["user", "assistant"], ["user", "assistant", "system", "tool"], ["tool", ""], ["user", "assistant", None, "ux"]])
    text = lambda: rng.choice([None, "", " \t", "Fine.", f"Open {rng.randint(0, 9)}", f"Done {rng.randint(0, 99)}!", "É?\r\n", f"no stop {rng.randint(0, 999)}"])
    turn = lambda k: None if rng.random() < 0.05 else k if rng.random() < 0.8 else rng.randint(0, n)
    return [(conv, turn(k), roles[k % len(roles)] if rng.random() < 0.7 else rng.choice(roles), text()) for k in range(n)]


@pytest.mark.parametrize("chunk_rows", [2, turns.CHUNK_ROWS])
def test_against_all_edits(spark, chunk_rows):
    rng = random.Random(chunk_rows)
    rows = [r for k in range(60) for r in _random_rows(rng, rng.choice([None, k, k, 7]), rng.randint(1, 12))]
    _check(spark, rows + rows[:5] + [rows[0]] * 30, chunk_rows)


def test_one_conversation_over_many_tasks(spark):
    """Ordinary turns, then roles that never converge, then copies only."""
    rows = [(5, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(150)]
    rows += [(5, 200 + k, "tool", f"call {k}") for k in range(101)] + [(5, 400 + k, "user", "again.") for k in range(60)]
    rows += [(6, 0, "user", "a."), (4, 0, "system", "s.")]
    _check(spark, rows, 16)


def test_vectors_converge_and_passes_agree():
    rng = random.Random(1)
    for _ in range(300):
        codes = bytes(rng.randrange(8) for _ in range(rng.randint(1, 40)))
        end, total = turns.backward(codes, turns._END)
        guess, guessed = turns.backward(codes, turns._SPECULATIVE)
        same, vector, gain = turns.fix_up(codes, turns._SPECULATIVE, turns._END)
        assert (guess if same else vector) == end and guessed + gain == total


def test_no_conversations(spark):
    conversations, kept = turns.repair(turns.damaged(spark.createDataFrame([], "conv_id long, turn long, role string, text string")))
    assert conversations.isEmpty() and kept.isEmpty()
