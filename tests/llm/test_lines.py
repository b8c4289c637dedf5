"""Line deduplication against brute force on odd rows."""

import random
from collections import defaultdict

import pytest

from tallyloom.llm import line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def _key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def kept_lines(rows, min_chars, documents):
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(_key(line)) >= min_chars:
                held[_key(line)].add(i)
    largest = {k: max(ids, key=lambda i: (i is not None, i)) for k, ids in held.items() if len(ids) >= documents}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [line for line in lines if largest.get(_key(line), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def _order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


@pytest.mark.parametrize("documents", [2, 5])
def test_against_brute_force(spark, documents):
    rng = random.Random(2)
    common = ["É" + "x" * 8, "Two Words é", "\x85　wide blanks", "under_forty", "KK kelvin K", "🙂" * 10]
    dress = lambda line: rng.choice([line, " " + line + "\r", "\t" + line.replace("T", "t"), line.upper() if line.isascii() else line, line[:9]])
    rows = [(rng.choice([None, k, k, k, 7]), "\n".join(dress(rng.choice(common)) for _ in range(rng.randint(1, 6)))) for k in range(40)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "own line only here"), (54, rows[0][1]), (54, rows[0][1]), (55, "\n".join(["Two Words é"] * 3_000 + ["last"])), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS pos", "3 AS h1", "'k' AS key", "4 AS dropped", "5 AS row").repartition(3)
    got = line_dedup.drop_common_lines(docs, 10, documents)
    assert _order((r["row"].doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect()) == _order(kept_lines(rows, 10, documents))
    assert got.where("row.h1 <> 3 OR row.row <> 5").isEmpty()
    assert line_dedup.drop_common_lines(docs.limit(0)).isEmpty()


def test_plan_has_no_python_and_no_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = line_dedup.drop_common_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
