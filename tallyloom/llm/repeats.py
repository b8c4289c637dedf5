"""Removal of repeated byte strings by suffix order, over texts of any number of machines.

A string of ``length`` bytes falls to the bucket of its least ``GRAM``-byte hash, so equal strings meet in one
bucket wherever they stand. Consecutive strings of a document with their least run at the same place form one
segment, of about ``length`` / 2 strings. Segments that are equal as a whole are settled by their hashes; segments of a bucket that
differ go, as text, through threshold-bounded interval expansion:

    the suffix order of the segments gives their Burrows-Wheeler transform; intervals of suffixes with a common prefix
    are extended backwards, breadth first, which meets every common prefix length between neighbours in increasing
    order; it stops at ``length``. Neighbours whose prefix length was not met by then share ``length`` bytes.

A bucket with very many different segments is cut down to single strings, each a bucket of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.common import partitions, stepwise, text_slices

#: Bytes of the runs whose least hash names the bucket.
GRAM = 32
#: Different segments beyond which a bucket is cut into single strings.
WIDE_BUCKET = 20_000
#: Bytes of segments that one expansion takes at once; buckets are never parted by it.
EXPANSION_BYTES = 1 << 18
_BASE, _BASE2, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD)
#: A text is hashed in stretches, so that a place in one has 24 bits.
_STRETCH, _PLACE = 1 << 23, np.uint64((1 << 24) - 1)
_AT = "bucket long, content long, doc_id long, mark long, at long"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def _windows_hash(data: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Polynomial hashes of all runs of ``size`` bytes, built by doubling."""
    out, done, power = None, 0, base
    block, width = data.astype(np.uint64) + np.uint64(1), 1
    while True:
        if size & width:
            if out is None:
                out, done, out_power = block, width, power
            else:
                n = len(data) - (done + width) + 1
                out = out[:n] * power + block[done : done + n]
                done, out_power = done + width, out_power * power
        width *= 2
        if width > size:
            return out
        half = width // 2
        n = len(data) - width + 1
        block = block[:n] * power + block[half : half + n]
        power = power * power


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def segments(data: np.ndarray, length: int, buckets_only: bool = False) -> tuple[np.ndarray, ...]:
    """(bucket, content hash, start, strings) of the segments of one text of at least ``length`` bytes.

    The strings of a segment have their first least run at the same place, so no two of them are equal.
    """
    out, step = [], _STRETCH - length + 1
    with np.errstate(over="ignore"):
        for low in range(0, len(data) - length + 1, step):
            own = data[low : low + _STRETCH]
            runs = _mixed(_windows_hash(own, GRAM, _BASE))
            least = _sliding_min((runs & ~_PLACE) | np.arange(len(runs), dtype=np.uint64), length - GRAM + 1) & _PLACE
            start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
            if buckets_only:
                out.append((runs[least[start].astype(np.int64)],))
                continue
            strings = np.diff(np.concatenate([start, [len(least)]]))
            # first and last string cover the segment between them
            whole = _windows_hash(own, length, _BASE2)
            content = _mixed(_mixed(whole[start]) * _BASE + whole[start + strings - 1] * _BASE2 + strings.astype(np.uint64))
            out.append((runs[least[start].astype(np.int64)], content, start + low, strings))
    return tuple(np.concatenate(c) for c in zip(*out))


def _packed(start: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """Start and number of strings in one long, ordered by start."""
    return (start.astype(np.int64) << 8) | strings


def expand(parts: list[bytes], length: int) -> np.ndarray:
    """Group numbers for each place of the joined parts (a byte after each part ends it): places with the same
    number start equal strings of ``length`` bytes; -1 where no such string is shared."""
    sizes = np.array([len(p) + 1 for p in parts])
    ends = np.cumsum(sizes) - 1
    text = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.int64) + 1
    text[ends] = 0
    n = len(text)
    part = np.repeat(np.arange(len(parts)), sizes)
    end = ends[part]
    place = np.arange(n)
    # suffix order by doubling, of places whose rank is shared so far; ends of parts are different, lowest symbols.
    # It is exact in the first known - 7 bytes, ends included; order beyond ``length`` bytes does not matter
    key = np.zeros(n, np.int64)
    for k in range(7):
        at = place + k
        key = key * 257 + np.where(at < end, text[np.minimum(at, n - 1)], 0)
    order = np.argsort(key)
    key = key[order]
    slots, rank = place, np.empty(n, np.int64)
    ranked, known = order, 7
    while True:
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[ranked] = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        alone = new & np.concatenate([new[1:], [True]])
        slots, ranked = slots[~alone], ranked[~alone]
        if not len(slots) or known - 7 >= length:
            break
        at = ranked + known
        key = rank[ranked] * (n + len(parts) + 1) + np.where(at <= end[ranked], rank[np.minimum(at, n - 1)] + len(parts), part[ranked])
        by = np.argsort(key)
        key, ranked = key[by], ranked[by]
        order[slots] = ranked
        known *= 2
    # Burrows-Wheeler transform: what stands before each suffix; at the start of a part its own lowest symbol
    first = np.zeros(n, bool)
    first[np.concatenate([[0], ends[:-1] + 1])] = True
    before = ~first[order]
    row = np.empty(n, np.int32)
    row[order] = np.arange(n, dtype=np.int32)
    step = row[order - 1]  # row of the suffix that is one byte longer
    back = row[np.minimum(order + 1, n - 1)]  # row of the suffix that is one byte shorter
    lcp_met = np.zeros(n + 1, bool)
    # level 0: intervals of single symbols; each end of a part is a symbol of its own
    symbol = text[order].astype(np.int16)
    starts = np.flatnonzero(np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (symbol[1:] == 0)]))
    low, high = starts, np.concatenate([starts[1:], [n]])
    lcp_met[high] = True
    owner, longer = np.empty(n, np.int32), np.zeros(n, bool)
    for _ in range(1, length):
        if not len(low):
            break
        width = high - low
        number = np.repeat(np.arange(len(low), dtype=np.int32), width)
        rows = np.arange(len(number), dtype=np.int32) + np.repeat((low - (np.cumsum(width) - width)).astype(np.int32), width)
        owner[rows] = number
        # rows of the longer suffixes, in order; their first symbol is what stood before
        longer[step[rows[before[rows]]]] = True
        target = np.flatnonzero(longer)
        if not len(target):
            break
        longer[target] = False
        whose, char = owner[back[target]], symbol[target]
        cut = np.flatnonzero(np.concatenate([[True], (whose[1:] != whose[:-1]) | (char[1:] != char[:-1])]))
        low, high = target[cut], target[np.concatenate([cut[1:] - 1, [len(target) - 1]])] + 1
        fresh = ~lcp_met[high]
        low, high = low[fresh], high[fresh]
        lcp_met[high] = True
    # rows between met boundaries share ``length`` bytes
    group = np.cumsum(np.concatenate([[True], lcp_met[1:n]])) - 1
    shared = np.bincount(group)[group] > 1
    out = np.full(n, -1, np.int64)
    out[order[shared]] = group[shared]
    return out


def find_repeats(docs: DataFrame, length: int = 100, id_column: str = "doc_id", text_column: str = "text", wide_bucket: int = WIDE_BUCKET) -> DataFrame:
    """(doc_id, mark, spans): per text that has any, the byte spans [start, end) covered by strings that also start earlier."""
    if not GRAM < length < 256:
        raise ValueError("length must be above 32 and below 256")
    spark = docs.sparkSession
    texts = _texts(docs, id_column, text_column).where(F.octet_length("text") >= length)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 1 << 20):
            out = []
            for doc_id, mark, text in zip(batch["doc_id"].to_pylist(), batch["mark"].to_pylist(), batch["text"].to_pylist()):
                bucket, content, start, strings = segments(np.frombuffer(text, np.uint8), length)
                out.append((bucket.view(np.int64), content.view(np.int64), np.full(len(start), doc_id), np.full(len(start), mark), _packed(start, strings)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["bucket", "content", "doc_id", "mark", "at"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 1 << 20):
            own = [segments(np.frombuffer(text, np.uint8), length, True)[0] for text in batch["text"].to_pylist()]
            if own:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own).view(np.int64))], ["bucket"])

    rows = texts.mapInArrow(split, _AT)
    many = texts.select("text").mapInArrow(count, "bucket long").groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    met, _ = stepwise(rows.join(many, "bucket", "left_semi"), "met-segments")
    kinds = met.groupBy("bucket", "content").agg(F.min(F.struct("doc_id", "mark", "at")).alias("first"), F.count("*").alias("n"))
    kinds, _ = stepwise(kinds, "segment-kinds")
    strings = F.col("at").bitwiseAND(255)
    begin = F.shiftright(F.col("at"), 8)
    copies = met.join(kinds.where("n > 1").drop("n"), ["bucket", "content"]).where(F.struct("doc_id", "mark", "at") > F.col("first"))
    spans = copies.select("doc_id", "mark", begin.alias("start"), (begin + strings + (length - 1)).alias("stop"))

    # buckets whose segments differ: the first of each kind goes on as text
    mixed = kinds.groupBy("bucket").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted, _ = stepwise(
        kinds.join(mixed, "bucket").select("bucket", "kinds", "first.doc_id", "first.mark", "first.at").select(
            "bucket", "doc_id", "mark", begin.alias("start"), strings.alias("strings"), (F.col("kinds") > wide_bucket).alias("wide")
        ),
        "wanted-segments",
    )
    per_text = wanted.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("bucket", "start", "strings", "wide")).alias("wanted"))
    held = texts.join(per_text, ["doc_id", "mark"]).select("doc_id", "mark", "text", "wanted")

    def cut(wide: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, "text", 1 << 20):
                out = []
                for doc_id, mark_, text, own in zip(*(batch[c].to_pylist() for c in ("doc_id", "mark", "text", "wanted"))):
                    for w in own:
                        if w["wide"] and wide:
                            for at in range(w["start"], w["start"] + w["strings"]):
                                part = text[at : at + length]
                                out.append((int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little", signed=True), int.from_bytes(hashlib.blake2b(part, digest_size=8, salt=b"b").digest(), "little", signed=True), doc_id, mark_, at, None))
                        elif not w["wide"] and not wide:
                            out.append((w["bucket"], 0, doc_id, mark_, w["start"], text[w["start"] : w["start"] + w["strings"] + length - 1]))
                        if len(out) >= 20_000:
                            yield _rows(out)
                            out = []
                if out:
                    yield _rows(out)

        return run

    schema = "bucket long, content long, doc_id long, mark long, start long, part binary"
    single = held.where(F.exists("wanted", lambda w: w["wide"])).mapInArrow(cut(True), schema).drop("part")
    earliest = single.groupBy("bucket", "content").agg(F.min(F.struct("doc_id", "mark", "start")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = single.join(earliest, ["bucket", "content"]).where(F.struct("doc_id", "mark", "start") > F.col("first"))
    spans = spans.unionByName(again.select("doc_id", "mark", "start", (F.col("start") + length).alias("stop")))

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("bucket", "doc_id", "mark", "start", "part"))):
                if size > EXPANSION_BYTES and row[0] != held[-1][0]:
                    yield _repeated(held, length)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield _repeated(held, length)

    parts = held.mapInArrow(cut(False), schema).drop("content")
    sorted_parts = parts.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")
    spans = spans.unionByName(sorted_parts.mapInArrow(grouped, "doc_id long, mark long, start long, stop long"))
    return spans.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["bucket", "content", "doc_id", "mark", "start", "part"])


def _repeated(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Spans of the strings that also start earlier, among the segments of whole buckets."""
    # earliest first, so that the least place of a group is its first; repeated rows of a document have the same places
    rows = sorted({(r[1], r[2], r[3]): r for r in rows}.values(), key=lambda r: (r[1], r[2], r[3]))
    parts = [r[4] for r in rows]
    group = expand(parts, length)
    at = np.flatnonzero(group >= 0)
    by = at[np.argsort(group[at], kind="stable")]
    later = np.sort(by[1:][group[by[1:]] == group[by[:-1]]])
    starts = np.cumsum([0] + [len(p) + 1 for p in parts])
    own = np.searchsorted(starts, later, "right") - 1
    if len(later):
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(later) != 1) | (np.diff(own) != 0)]))
        low, high = later[cut], later[np.concatenate([cut[1:] - 1, [len(later) - 1]])]
        own = own[cut]
    else:
        low = high = later
    base = np.array([r[3] for r in rows])[own] - starts[own] if len(own) else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array([r[1] for r in rows], np.int64)[own]), pa.array(np.array([r[2] for r in rows], np.int64)[own]), pa.array(base + low), pa.array(base + high + length)],
        ["doc_id", "mark", "start", "stop"],
    )


def _texts(docs: DataFrame, id_column: str, text_column: str, *kept) -> DataFrame:
    """(doc_id, mark, text as bytes); the mark tells texts of one id apart. A null id comes before all others."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    ids = F.coalesce(F.col(id_column).cast("long"), F.lit(-(1 << 63)))
    return docs.select(ids.alias("doc_id"), F.xxhash64(text).alias("mark"), text.cast("binary").alias("text"), *kept)


def without_repeats(docs: DataFrame, length: int = 100, id_column: str = "doc_id", text_column: str = "text", wide_bucket: int = WIDE_BUCKET, as_text: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` (its own columns in one struct ``row``), with what is left of their texts.

    Every byte is removed that a string of ``length`` bytes covers which also starts earlier (in a text of smaller id,
    or earlier in the same text; strings overlap, never reach over texts, and are judged on the input). Texts under
    one id that differ are separate, told apart and ordered by a 64-bit hash; rows that repeat id and text are one document and get
    the same result; null ids come first; a null text is empty. Adds n_bytes, n_removed, n_spans (maximal removed runs) and kept
    (bytes; with ``as_text`` a string without the characters of which a removal left a part only).
    """
    found = find_repeats(docs, length, id_column, text_column, wide_bucket)
    rows = _texts(docs, id_column, text_column, F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_column)).alias("row"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            sizes, removed, runs, kept = [], [], [], []
            for text, own in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                left, at, gone, n = [], 0, 0, 0
                for span in own or ():
                    if span["start"] > at or not n:
                        left.append(text[at : span["start"]])
                        n, gone, at = n + 1, gone + span["stop"] - span["start"], span["stop"]
                    elif span["stop"] > at:
                        gone, at = gone + span["stop"] - at, span["stop"]
                left.append(text[at:])
                sizes.append(len(text))
                removed.append(gone)
                runs.append(n)
                left = b"".join(left)
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary())], ["row", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = rows.join(found, ["doc_id", "mark"], "left").select("row", "text", "spans")
    return joined.mapInArrow(strip, rows.select("row").selectExpr("*", "0L AS n_bytes", "0L AS n_removed", "0L AS n_spans", f"CAST('' AS {'STRING' if as_text else 'BINARY'}) AS kept").schema)
