"""Two tokenizers aligned by the bytes of their tokens, and how many documents link each pair of ids.

Inverted pair bitmaps: documents are numbered within blocks of bounded size. Per block and linked id pair there is a
compressed bitmap of its documents for each binary digit of the number of links (multiplicity planes). The planes of a
pair are OR-merged and popcounted for its documents in the block; blocks hold different documents, so over blocks these
counts add up. The counts then go back along the postings to the documents.

Both tokenizers cut a text before a single blank between two other characters, whatever stands around. So a text is cut
there, and each distinct piece is encoded, aligned and linked once per worker. No group reaches over such a cut.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm import pieces
from tallyloom.llm.common import per_worker, saved, text_slices

#: A block ends with the document that brings it to so many links or documents. It bounds memory only, not results.
BLOCK_LINKS = 4_000_000
BLOCK_DOCUMENTS = 1 << 16
#: Token ids have 24 bits, places in a block 16.
_ID_BITS, _SLOT_BITS = 24, 16
_WHITE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{180E}\x{200B}\p{Z}]"
#: Texts where a blank has another blank character, or nothing, on one side.
_UNEVEN = f"{_WHITE} | {_WHITE}|^ | $"
_CUT = re.compile(r"(?<=\S) (?=\S)")

_ROWS = "block long, slot int, id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a int, b int, plane int, dense boolean, n_documents int, n_places int, documents binary"
_SCORED = "doc_id {id}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _byte_level() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(other)}


class Aligner:
    """Tokens, groups and links of pieces; a piece begins with the blank before it."""

    def __init__(self, byte_bpe: str, piece_model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        stand_in = _byte_level()
        spelled = {i: bytes(stand_in[c] for c in t) if all(c in stand_in for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        self.bytes_a = pa.array([spelled.get(i, b"") for i in range(max(spelled) + 1)], pa.binary())
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = pa.array([bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)], pa.binary())
        n_a, n_b = len(self.bytes_a), len(names)
        # each id with the sign after it: within a side, after the last of A, after the last of B
        self.signs = pa.array([b"%d%c" % (i, s) for n, s in ((n_a, 44), (n_a, 124), (n_b, 44), (n_b, 59)) for i in range(n)], pa.binary())
        self.sizes = np.cumsum([0, n_a, n_a, n_b])
        self.forget()

    def forget(self) -> None:
        self.codes = pieces.Codes(self._learn)
        self.valid, self.counts = pieces.Grown(bool), pieces.Grown(np.int64)  # n_a, n_b, n_groups, n_links of each piece
        self.links, self.weights, self.spelled = pieces.Ragged(np.uint64), pieces.Ragged(np.int64), pieces.Ragged(np.uint8)

    def _learn(self, new: list[str]) -> None:
        found = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)], self.b.encode([p[1:] for p in new], num_threads=1)
        counts = [np.fromiter(map(len, ids), np.int64, len(ids)) for ids in found]
        flat = [np.fromiter((i for own in ids for i in own), np.int64, int(n.sum())) for ids, n in zip(found, counts)]
        sizes = np.array([len(p.encode()) for p in new])
        joined = "".join(new).encode()
        spelled = [table.take(pa.array(ids)) for table, ids in zip((self.bytes_a, self.bytes_b), flat)]
        lengths = [pc.binary_length(s).to_numpy().astype(np.int64) for s in spelled]
        same = np.ones(len(new), bool)
        ends = np.cumsum(sizes)
        for s, n, own in zip(spelled, lengths, counts):
            data = s.buffers()[2].to_pybytes()[: int(n.sum())] if len(s) else b""
            length = pieces.sums(n, own)
            same &= length == sizes
            if data != joined or not same.all():
                last = np.cumsum(length)
                same &= [data[e - k : e] == joined[f - m : f] for e, k, f, m in zip(last.tolist(), length.tolist(), ends.tolist(), sizes.tolist())]
        # pieces with other bytes have no tokens
        piece = [np.repeat(np.arange(len(new)), n) for n in counts]
        flat = [ids[same[p]] for ids, p in zip(flat, piece)]
        ends = [np.cumsum(n[same[p]]) for n, p in zip(lengths, piece)]
        counts = [np.where(same, n, 0) for n in counts]
        cuts = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(cuts, e) for e in ends]
        per = [np.bincount(g, minlength=len(cuts)) for g in group]
        n_groups = np.bincount(np.searchsorted(np.cumsum(np.where(same, sizes, 0)), cuts), minlength=len(new)) if len(cuts) else np.zeros(len(new), np.int64)
        self._spell(flat, per, group, n_groups)
        self._link(flat, per, n_groups, len(new))
        n_links = pieces.sums(per[0] * per[1], n_groups)
        self.valid.add(same)
        self.counts.add(np.stack([*counts, n_groups, n_links], 1).ravel())

    def _spell(self, flat, per, group, n_groups) -> None:
        """``a1,a2|b1;`` for each group."""
        (a, b), (na, nb), (ga, gb) = flat, per, group
        last_a, last_b = np.cumsum(na) - 1, np.cumsum(nb) - 1
        sign = np.empty(len(a) + len(b), np.int64)
        of_a, of_b = a + self.sizes[0], b + self.sizes[2]
        of_a[last_a] += self.sizes[1]
        of_b[last_b] += self.sizes[3] - self.sizes[2]
        sign[np.arange(len(a)) + (np.cumsum(nb) - nb)[ga]] = of_a
        sign[np.arange(len(b)) + np.cumsum(na)[gb]] = of_b
        text = self.signs.take(pa.array(sign))
        sizes = pc.binary_length(text).to_numpy()
        data = np.frombuffer(text.buffers()[2], np.uint8, int(sizes.sum())) if len(text) else np.zeros(0, np.uint8)
        per_piece = pieces.sums(sizes, pieces.sums(na + nb, n_groups))
        self.spelled.add(data, per_piece)

    def _link(self, flat, per, n_groups, n: int) -> None:
        """Id pairs of each piece with their number of links; in a group with many tokens equal ids are counted first."""
        (a, b), (na, nb) = flat, per
        start_a, start_b = np.cumsum(na) - na, np.cumsum(nb) - nb
        product = na * nb
        wide = np.flatnonzero(product > 4096)
        narrow = product.copy()
        narrow[wide] = 0
        rep = np.repeat(np.arange(len(product)), narrow)
        within = np.arange(len(rep)) - np.repeat(np.cumsum(narrow) - narrow, narrow)
        keys = a[start_a[rep] + within // nb[rep]].astype(np.uint64) << np.uint64(_ID_BITS) | b[start_b[rep] + within % nb[rep]].astype(np.uint64)
        if not len(wide):
            self.links.add(keys, pieces.sums(narrow, n_groups))
            self.weights.add(np.ones(len(keys), np.int64), pieces.sums(narrow, n_groups))
            return
        parts, ends = [(rep, keys, np.ones(len(keys), np.int64))], np.cumsum(n_groups)
        for g in wide.tolist():
            (ia, ca), (ib, cb) = (np.unique(ids[s[g] : s[g] + k[g]], return_counts=True) for ids, s, k in ((a, start_a, na), (b, start_b, nb)))
            own = (ia.astype(np.uint64) << np.uint64(_ID_BITS))[:, None] | ib.astype(np.uint64)
            parts.append((np.full(own.size, g), own.ravel(), (ca[:, None] * cb).ravel()))
        groups, keys, weights = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(groups, kind="stable")
        lengths = np.bincount(np.searchsorted(ends, groups[order], "right"), minlength=n)
        self.links.add(keys[order], lengths)
        self.weights.add(weights[order], lengths)

    def __call__(self, texts: pa.Array):
        """Per text n_a, n_b, n_groups, n_links, digest and links; then the text, pair and weight of every link."""
        if len(self.codes.known) > pieces.KEPT_PIECES:
            self.forget()
        texts = pc.fill_null(texts, "")
        uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(texts, " ")
        if uneven.any():
            cut = pa.array([_CUT.split(t) if u else p for t, u, p in zip(texts.to_pylist(), uneven, cut.to_pylist())], pa.list_(pa.string()))
        codes = self.codes(pc.binary_join_element_wise("", cut.flatten(), " "))
        n_pieces = np.diff(cut.offsets.to_numpy())
        valid = pieces.sums(~self.valid.values[codes], n_pieces) == 0
        valid &= pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
        codes, n_pieces = codes[np.repeat(valid, n_pieces)], np.where(valid, n_pieces, 0)
        counts = np.stack([pieces.sums(c, n_pieces) for c in self.counts.values.reshape(-1, 4)[codes].T], 1)
        spelled, sizes = self.spelled.take(codes)
        data, ends, digests = memoryview(spelled), np.cumsum(pieces.sums(sizes, n_pieces)).tolist(), []
        for first, end, ok in zip([0, *ends], ends, valid.tolist()):
            digests.append(hashlib.sha256(data[first : end - 1]).hexdigest() if ok else "")
        keys, n_keys = self.links.take(codes)
        weights, _ = self.weights.take(codes)
        return counts, digests, np.repeat(np.arange(len(texts)), pieces.sums(n_keys, n_pieces)), keys, weights


def _merged(entries: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (pair, slot) entries in order, and the number of links of each."""
    many = weights > 1
    entry, count = np.unique(entries[~many], return_counts=True)
    if many.any():
        entry = np.concatenate([entry, entries[many]])
        order = np.argsort(entry, kind="stable")
        entry, count = entry[order], np.concatenate([count, weights[many]])[order]
        first = np.flatnonzero(np.diff(entry, prepend=entry[0] ^ np.uint64(1)))
        entry, count = entry[first], np.add.reduceat(count, first)
    return entry, count


def postings(entries: np.ndarray, weights: np.ndarray, block: int, n_slots: int) -> Iterator[dict[str, pa.Array]]:
    """A block's bitmaps: one row per pair and plane. A sparse bitmap is the list of its places (2 bytes each)."""
    entry, count = _merged(entries, weights)
    pair, slot = entry >> np.uint64(_SLOT_BITS), (entry & np.uint64((1 << _SLOT_BITS) - 1)).astype("<u2")
    width, seen = -(-n_slots // 8), None
    first = np.flatnonzero(np.diff(pair, prepend=pair[0] ^ np.uint64(1))) if len(pair) else np.zeros(0, np.int64)
    # popcount of the OR of all planes of a pair: its distinct places
    in_block = dict(pairs=pair[first], n=np.diff(first, append=len(pair)))
    for plane in range(int(count.max()).bit_length() if len(count) else 0):
        chosen = (count >> plane) & 1 == 1
        keys, places = pair[chosen], slot[chosen]
        first = np.flatnonzero(np.diff(keys, prepend=keys[0] ^ np.uint64(1))) if len(keys) else np.zeros(0, np.int64)
        own, n = keys[first], np.diff(first, append=len(keys))
        told = np.zeros(len(own), np.int32)
        new = np.ones(len(own), bool) if seen is None else ~np.isin(own, seen)
        told[new] = in_block["n"][np.searchsorted(in_block["pairs"], own[new])]
        seen = own if seen is None else np.union1d(seen, own)
        dense = n * 2 > width
        listed = np.repeat(~dense, n)
        for wanted in (False, True):
            rows = np.flatnonzero(dense == wanted)
            if not len(rows):
                continue
            if wanted:
                bits = bytearray()
                for low in range(0, len(rows), 256):
                    part = rows[low : low + 256]
                    plain = np.zeros((len(part), width * 8), bool)
                    for k, r in enumerate(part.tolist()):
                        plain[k, places[first[r] : first[r] + n[r]]] = True
                    bits += np.packbits(plain, axis=1).tobytes()
                data, sizes = bytes(bits), np.full(len(rows), width)
            else:
                data, sizes = places[listed].tobytes(), n[rows] * 2
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            of = own[rows]
            yield {
                "block": pa.array(np.full(len(rows), block)), "a": pa.array((of >> np.uint64(_ID_BITS)).astype(np.int32)),
                "b": pa.array((of & np.uint64((1 << _ID_BITS) - 1)).astype(np.int32)), "plane": pa.array(np.full(len(rows), plane, np.int32)),
                "dense": pa.array(np.full(len(rows), wanted)), "n_documents": pa.array(told[rows]), "n_places": pa.array(n[rows].astype(np.int32)),
                "documents": pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(data)]),
            }


def _add_scores(rows: pa.RecordBatch | pa.Table, n_slots: int, best: np.ndarray, high: np.ndarray, low: np.ndarray) -> None:
    """Add each posting's count, times its plane's weight, to the documents in it."""
    dense = rows["dense"].to_numpy(zero_copy_only=False)
    for wanted in (False, True):
        part = rows.filter(pa.array(dense == wanted))
        if not len(part):
            continue
        raw = part["documents"].to_pylist()
        if wanted:
            bits = np.unpackbits(np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1), axis=1)
            of, place = np.nonzero(bits)
        else:
            place = np.frombuffer(b"".join(raw), "<u2")
            of = np.repeat(np.arange(len(raw)), [len(r) // 2 for r in raw])
        times, count, is_best = (part[c].to_numpy(zero_copy_only=False) for c in ("plane", "n", "is_best"))
        times, count = np.left_shift(1, times.astype(np.int64)), count.astype(np.int64)
        # sums of halves stay exact in doubles
        best += np.bincount(place, (times * is_best)[of], n_slots).astype(np.int64)
        for total, half in ((high, count >> 24), (low, count & ((1 << 24) - 1))):
            total += np.bincount(place, (half * times)[of], n_slots).astype(np.int64)


def align(docs: DataFrame, byte_bpe: str, piece_model: str, id_column: str = "doc_id", text_column: str = "text", block_links: int = BLOCK_LINKS) -> DataFrame:
    """Blocks of aligned documents: rows of documents (``slot`` set) and of postings (``plane`` set), written out.

    One pass over the texts makes both. Every row of ``docs`` is a document, repeated or not; other columns are not kept.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = _ROWS.format(id=kind)
    source = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_worker(f"aligner {byte_bpe} {piece_model}", lambda: Aligner(byte_bpe, piece_model))
        part, number = TaskContext.get().partitionId(), 0
        names = [f.split(" ")[0] for f in schema.split(", ")]
        types = None

        def whole(columns: dict[str, pa.Array]) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([columns[c].cast(types[c]) if c in columns else pa.nulls(n, types[c]) for c in names], names)

        entries, weights, held, slot = [], [], 0, 0
        for batch in text_slices(batches, "text", 2 << 20):
            if types is None:
                long, text = pa.int64(), pa.string()
                types = dict(zip(names, [long, pa.int32(), batch.schema.field("id").type, long, long, long, long, text, pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.binary()]))
            counts, digests, of, keys, times = aligner(batch["text"])
            # where blocks end: a block takes documents until it has enough links or documents
            per_doc = np.bincount(of, minlength=len(batch))
            first = 0
            while first < len(batch):
                reach = held + np.cumsum(per_doc[first:])
                n = min(int(np.searchsorted(reach, block_links)) + 1, BLOCK_DOCUMENTS - slot, len(batch) - first)
                last = first + n
                low, high = np.searchsorted(of, [first, last])
                entries.append(keys[low:high] << np.uint64(_SLOT_BITS) | (of[low:high] - first + slot).astype(np.uint64))
                weights.append(times[low:high])
                block = part << 32 | number
                yield whole({
                    "block": pa.array(np.full(n, block)), "slot": pa.array(np.arange(slot, slot + n)), "id": batch["id"].slice(first, n),
                    **{c: pa.array(counts[first:last, k]) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}, "groups_sha256": pa.array(digests[first:last], pa.string()),
                })
                held, slot, first = int(reach[n - 1]), slot + n, last
                if held >= block_links or slot == BLOCK_DOCUMENTS:
                    yield from map(whole, postings(np.concatenate(entries), np.concatenate(weights), block, slot))
                    entries, weights, held, slot, number = [], [], 0, 0, number + 1
        if slot:
            yield from map(whole, postings(np.concatenate(entries), np.concatenate(weights), part << 32 | number, slot))

    return saved(source.mapInArrow(encode, schema), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n_documents, n_links): documents that link the pair, and its links, from the popcounts of the planes."""
    links = F.expr("shiftleft(CAST(n_places AS BIGINT), plane)")
    return aligned.where("plane IS NOT NULL").groupBy("a", "b").agg(F.sum("n_documents").alias("n_documents"), F.sum(links).alias("n_links"))


def align_tokenizers(docs: DataFrame, byte_bpe: str, piece_model: str, id_column: str = "doc_id", text_column: str = "text", block_links: int = BLOCK_LINKS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``.

    A is a byte-level vocabulary of ``tokenizers``, B a ``sentencepiece`` model; both read the text with one blank before it,
    special tokens as plain text. Groups lie between byte offsets where tokens of both end; each A token of a group is
    linked with each B token of it. A pair's count is the number of documents with such a link, a document's ``count_sum``
    adds it over its links, and ``n_best`` are the links whose count is the highest of their A id.
    Null and empty texts, and texts whose tokens don't spell them, have no tokens: zeros and an empty digest. Every row is
    a document, with or without an id, also if it is repeated. No rows: no rows.
    """
    aligned = align(docs, byte_bpe, piece_model, id_column, text_column, block_links)
    kind = docs.schema[id_column].dataType.simpleString()
    counts = pair_counts(aligned).select("a", "b", F.col("n_documents").alias("n"))
    # at most one row per id of A
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    scores = counts.join(F.broadcast(highest), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("is_best"))
    scored = aligned.where("plane IS NOT NULL").select(F.col("block").alias("in_block"), "a", "b", "plane", "dense", "documents").join(scores, ["a", "b"]).drop("a", "b")
    numbers = ["n_a", "n_b", "n_groups", "n_links"]

    def collect(documents: pa.Table, postings_: pa.Table) -> pa.Table:
        n, slot = len(documents), documents["slot"].to_numpy()
        best, high, low = (np.zeros(n, np.int64) for _ in range(3))
        for batch in postings_.to_batches(max_chunksize=4096):
            _add_scores(batch, n, best, high, low)
        out = [documents["id"], *(documents[c] for c in numbers), pa.array(best[slot]), pa.array((high << 24)[slot] + low[slot]), documents["groups_sha256"]]
        return pa.table(out, ["doc_id", *numbers, "n_best", "count_sum", "groups_sha256"])

    rows = aligned.where("slot IS NOT NULL").select("block", "slot", "id", *numbers, "groups_sha256")
    return rows.groupBy("block").cogroup(scored.groupBy("in_block")).applyInArrow(collect, _SCORED.format(id=kind))
