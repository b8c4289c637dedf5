"""Tokenizer alignment against brute force over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyloom.llm import alignment

BYTE_BPE, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    (900_001, None), (900_002, ""), (900_003, " "), (900_004, "   \n  x"), (900_005, "a▁b c"), (900_006, "<s> <|endoftext|> </s>x"), (900_007, "=" * 300 + " " + "é中🙂" * 40),
    (900_008, "a\0b  c　 d  e"), (None, "no id, none"), (None, "no id, none"), (900_009, "the the the the\tthe"), (900_010, "\n\n a  b   c\n d \n\n"), (900_011, "ﬁ é İ ẞ"),
]


def aligned_by_brute_force(texts):
    """(stats without corpus counts, Counter of linked pairs) of each text, from tokens of the whole text."""
    a, b = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in plain)}
    out = []
    for text in texts:
        ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        spelled = [bytes(stand_in[c] for c in a.id_to_token(i)) for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        if not text or any(b"".join(s) != b" " + text.encode() for s in spelled):
            out.append(((0, 0, 0, 0, ""), Counter()))
            continue
        ends = [np.cumsum([len(t) for t in s]).tolist() for s in spelled]
        groups, low, pairs = [], [0, 0], Counter()
        for cut in sorted(set(ends[0]) & set(ends[1])):
            high = [e.index(cut) + 1 for e in ends]
            own = [i[lo:hi] for i, lo, hi in zip(ids, low, high)]
            groups.append("|".join(",".join(map(str, o)) for o in own))
            pairs.update((x, y) for x in own[0] for y in own[1])
            low = high
        out.append(((len(ids[0]), len(ids[1]), len(groups), sum(pairs.values()), hashlib.sha256(";".join(groups).encode()).hexdigest()), pairs))
    return out


def expected(rows):
    found = aligned_by_brute_force([t for _, t in rows])
    documents, links = Counter(), Counter()
    for _, pairs in found:
        documents.update(pairs.keys())
        links.update(pairs)
    most = defaultdict(int)
    for (x, _), n in documents.items():
        most[x] = max(most[x], n)
    out = []
    for (i, _), ((n_a, n_b, n_groups, n_links, digest), pairs) in zip(rows, found):
        best = sum(n for p, n in pairs.items() if documents[p] == most[p[0]])
        out.append((i, n_a, n_b, n_groups, n_links, best, sum(n * documents[p] for p, n in pairs.items()), digest))
    return out, documents, links


def _order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


@pytest.mark.parametrize("block", [40, 3_000, alignment.BLOCK_LINKS])
def test_against_brute_force(spark, sf_dir, block):
    rng = random.Random(5)
    alphabet = "ab the 12\n  .,'-_é中🙂\t <|>▁=İ́"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] if block > 40 else []
    rows += ODD + [(910_000 + k, "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))) for k in range(200)] + [(920_000, "a " * 2_000), (920_000, "a " * 2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "'x' AS id", "2 AS a").repartition(3)
    want, documents, links = expected(rows)
    got = alignment.align_tokenizers(docs, BYTE_BPE, PIECES, block_links=block)
    assert _order(tuple(r) for r in got.collect()) == _order(want)
    pairs = {(r.a, r.b): (r.n_documents, r.n_links) for r in alignment.pair_counts(alignment.align(docs, BYTE_BPE, PIECES, block_links=block)).collect()}
    assert pairs == {p: (n, links[p]) for p, n in documents.items()}


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(none, BYTE_BPE, PIECES).isEmpty()
