"""Near-duplicate texts by improved consistent weighted sampling over TF-IDF shingles.

A text is its shingles of five words, each of weight count x inverse document frequency, ln(1 + texts / texts with the
shingle). Frequencies are exact: texts are dealt into batches, each asks for the frequencies of the shingles in it, and
the answers (only those above what the batch itself holds) go back to it. Two texts' likeness is the weighted Jaccard
similarity of their shingles. ``BANDS`` x ``ROWS`` consistent samples are drawn from each text: two texts draw
the same sample with a probability equal to their likeness. Texts that agree in all samples of a band are
candidates, and every link is verified on the whole texts.

A band's bucket is not expanded into all pairs: its least text is compared with the others; then only texts that are
still in different groups are compared, until no two texts of a bucket that are in different groups remain uncompared. Pairs
that can't be alike are left out before texts are sent about: weighted Jaccard similarity is at most the ratio of the weights, and two
texts share at most the sum of the lesser weights in each part of the hash range (their outlines).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.common import components, partitions, per_worker, stepwise, tasks_for, text_slices
from tallyloom.operators.keyed import fresh

WORDS, BANDS, ROWS = 5, 12, 3
#: A pair of likeness s is a candidate with probability 1 - (1 - s ** ROWS) ** BANDS: 0.9997 at 0.8.
SAMPLES = BANDS * ROWS
#: Bytes of text whose shingles one part of the frequencies holds, about.
PART_BYTES = 16 << 20
#: Bytes of partners that one text is compared with in one group, about.
BLOCK_BYTES = 8 << 20
#: Parts of the hash range whose weights make a text's outline.
OUTLINE = 256
#: Texts of a bucket in one comparison of outlines, about. A larger bucket is dealt into chunks, and each two chunks meet.
CHUNK = 2_000
#: Stands for a null id: it comes before all others.
NO_ID = -(1 << 63)
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _BASE
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each, kept per worker."""
    kept = per_worker("near_powers", dict)
    if len(kept.get("up", ())) < n:
        size = 1 << max(17, int(n - 1).bit_length())
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                kept[name] = np.multiply.accumulate(steps)
    return kept["up"], kept["down"]


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the runs of five words, in order; one run if there are fewer words, but not none.

    Words are separated by ASCII white space and control characters and compared without case.
    """
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.concatenate([[False], data > 32, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    low, high = edge[0::2], edge[1::2]
    if not len(low):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
        words = _mixed((total[high] - total[low]) * down[low] + (high - low).astype(np.uint64))
        n = min(WORDS, len(words))
        runs = words[: len(words) - n + 1].copy()
        for k in range(1, n):
            runs = runs * _BASE + words[k : len(words) - n + 1 + k]
        return _mixed(runs)


def _weights(text: str, idf: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles in order of hash, and their weights by the inverse document frequency of each."""
    kinds, counts = np.unique(shingles(text), return_counts=True)
    return kinds, counts.astype(np.float32) * np.frombuffer(idf, "<f4")


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity; 1 for two texts without shingles."""
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    both = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    least = np.minimum(a[1][both], b[1][at[both]]).sum(dtype=np.float64)
    most = a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64) - least
    return float(least / most) if most else 1.0


def outline(kinds: np.ndarray, weights: np.ndarray) -> bytes:
    """Sum of the weights in each part of the hash range, rounded up to 16 bits."""
    whole = np.bincount((kinds >> np.uint64(56)).astype(np.int64), weights, OUTLINE)
    with np.errstate(over="ignore"):  # beyond 16 bits: infinite, so that the text meets all others
        half = whole.astype(np.float16)
        return np.where(half < whole, np.nextafter(half, np.float16(np.inf)), half).astype("<f2").tobytes()


def may_be_alike(weight: np.ndarray, outlines: np.ndarray, apart: Callable[[int, slice], np.ndarray], threshold: float, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each text (in order of weight) the heavier ones that may be as alike as ``threshold``, the ``most`` closest by outline.

    ``apart(i, others)`` tells which of a slice of the others are to be looked at.
    """
    last = np.searchsorted(weight, weight / max(threshold - 1e-6, 1e-12), "right")
    for i in range(len(weight) - 1):
        others = slice(i + 1, int(last[i]))
        at = i + 1 + np.flatnonzero(apart(i, others))
        if len(at):
            # likeness = shared / (both - shared), so it is at least the threshold if and only if shared / both >= threshold / (1 + threshold)
            shared = np.minimum(outlines[at], outlines[i]).sum(axis=1, dtype=np.float32)
            both = weight[at] + weight[i]
            near = shared >= (threshold / (1 + threshold) * (1 - 1e-4)) * both
            at, part = at[near], shared[near] / np.maximum(both[near], 1e-30)
            if len(at) > most:
                at = at[np.argsort(-part, kind="stable")[:most]]
            if len(at):
                yield i, at


def _draws() -> tuple[np.ndarray, ...]:
    """Tables of the method's random numbers, looked up by 16 bits of a shingle's hash under each sample's multiplier."""
    rng = np.random.Generator(np.random.PCG64(20))
    r = rng.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
    beta = rng.random(1 << 16).astype(np.float32)
    log_c = np.log(rng.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
    odd = rng.integers(0, 1 << 63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, np.float32(1) / r, beta, r, log_c - r + r * beta


def bands(kinds: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One hash per band of the consistent samples of a text that has shingles."""
    odd, over_r, beta, r, shift = per_worker("near_draws", _draws)
    log_weight = np.log(weights)
    chosen, level = np.empty(SAMPLES, np.uint64), np.empty(SAMPLES, np.float32)
    each = max(1, min(SAMPLES, (1 << 15) // len(kinds)))
    with np.errstate(over="ignore"):
        for k in range(0, SAMPLES, each):
            at = ((kinds[None, :] * odd[k : k + each, None]) >> np.uint64(48)).astype(np.int32)
            t = np.floor(log_weight * over_r[at] + beta[at])
            best = np.argmin(shift[at] - r[at] * t, axis=1)  # equal values: the least hash
            chosen[k : k + each], level[k : k + each] = kinds[best], t[np.arange(len(best)), best]
        drawn = _mixed(chosen + level.astype(np.int64).view(np.uint64) * _MIX).reshape(BANDS, ROWS)
        out = np.arange(BANDS, dtype=np.uint64)
        for k in range(ROWS):
            out = _mixed(out * _BASE + drawn[:, k])
    return out.view(np.int64)


def _packed(rising: np.ndarray) -> bytes:
    """Rising hashes as steps, their bytes by significance: the high ones are zeros, which the shuffle's codec takes out."""
    return np.diff(rising, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T)
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _asked(texts: list[str], copies: list[int]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Different shingles of each text with their counts, and those of all of them in order of hash with the number of rows that have them."""
    own = [np.unique(shingles(t), return_counts=True) for t in texts]
    every = np.concatenate([*(o[0] for o in own), np.zeros(0, np.uint64)])
    kinds, at = np.unique(every, return_inverse=True)
    held = np.bincount(at, np.repeat(np.array(copies, np.float64), [len(o[0]) for o in own]), len(kinds)).astype(np.int64)
    return own, kinds, held


def with_frequencies(texts: DataFrame, n: int, parts: int) -> tuple[DataFrame, Callable[[], None]]:
    """A written table (and what deletes it) of (own, doc, mark, idf, weight, bands, outline) per text: the inverse document frequency of each
    of its shingles in order of hash (floats), the sum of their weights, its bands and its outline.

    ``texts``: batch, own, doc, mark, copies, text; ``n`` rows in all. A part holds the frequencies of a range of hashes.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _by_batch(batches):
            _, kinds, held = _asked(table["text"].to_pylist(), table["copies"].to_pylist())
            part = ((kinds >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(kinds) else np.zeros(0, np.int64)
            pieces = list(zip(cut.tolist(), [*cut[1:].tolist(), len(kinds)]))
            blobs = ([_packed(kinds[low:high]) for low, high in pieces], [held[low:high].tobytes() for low, high in pieces])
            yield pa.RecordBatch.from_arrays([pa.array(part[cut].astype(np.int64)), pa.array([number] * len(cut), pa.int64()), *(pa.array(b, pa.binary()) for b in blobs)], _ASKED)

    def answer(group: pa.Table) -> pa.Table:
        kinds = [_unpacked(b) for b in group["kinds"].to_pylist()]
        held = [np.frombuffer(b, "<i8") for b in group["rows"].to_pylist()]
        found, at = np.unique(np.concatenate(kinds), return_inverse=True)
        total = np.bincount(at, np.concatenate(held), len(found)).astype(np.int64)  # exact below 2^53
        out, low = [], 0
        for number, k, h in zip(group["batch"].to_pylist(), kinds, held):
            all_rows = total[at[low : low + len(k)]]
            more = all_rows > h
            low += len(k)
            if more.any():
                out.append((number, _packed(k[more]), all_rows[more].tobytes()))
        return pa.table([pa.array([o[c] for o in out], t) for c, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["batch", "kinds", "rows"])

    def use(own: pa.Table, answers: pa.Table) -> pa.Table:
        idf, total, drawn, outlines = [], [], [], []
        each, kinds, held = _asked(own["text"].to_pylist(), own["copies"].to_pylist())
        for k, rows in zip(answers["kinds"].to_pylist(), answers["rows"].to_pylist()):
            held[np.searchsorted(kinds, _unpacked(k))] = np.frombuffer(rows, "<i8")
        for mine, counts in each:
            value = np.log1p(n / held[np.searchsorted(kinds, mine)]).astype("<f4")
            weights = counts.astype(np.float32) * value
            idf.append(value.tobytes())
            total.append(float(weights.sum(dtype=np.float64)))
            drawn.append(bands(mine, weights) if len(mine) else _WORDLESS)
            outlines.append(outline(mine, weights))
        columns = [own["own"], own["doc"], own["mark"], pa.array(idf, pa.binary()), pa.array(total, pa.float64()), pa.array(drawn, pa.list_(pa.int64())), pa.array(outlines, pa.binary())]
        return pa.table(columns, ["own", "doc", "mark", "idf", "weight", "bands", "outline"])

    # written on the way, so that the shuffle of the questions has gone before texts are dealt to their answers
    answers, answers_read = stepwise(texts.mapInArrow(ask, "part long, batch long, kinds binary, rows binary").groupBy("part").applyInArrow(answer, "batch long, kinds binary, rows binary"), "near-answers")
    weighed = stepwise(texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(use, "own binary, doc long, mark long, idf binary, weight double, bands array<long>, outline binary"), "near-weighed")
    answers_read()
    return weighed


_ASKED = ["part", "batch", "kinds", "rows"]
#: The band of all texts without words.
_WORDLESS = [0]


def _by_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of one number that stand together in an Arrow batch."""
    for batch in batches:
        numbers = batch["batch"].to_numpy(zero_copy_only=False)
        cut = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for low, high in zip(cut, cut[1:]):
            if high > low:
                yield int(numbers[low]), batch.slice(low, high - low)


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the number of their batch: neighbours of 4 MB together, or one text."""
    base = TaskContext.get().partitionId() << 33
    for k, batch in enumerate(_merged(batches)):
        yield pa.RecordBatch.from_arrays([pa.array([base + k] * len(batch), pa.int64()), *batch.columns], ["batch", *batch.schema.names])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of 4 MB of text and more put together, larger ones cut."""
    held, size = [], 0
    for batch in text_slices(batches, "text"):
        held.append(batch)
        size += batch["text"].nbytes
        if size >= 4 << 20:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def digest(text_column: str) -> Column:
    """Tells texts of one id apart; a null text is empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")))


def one_of_each_class(docs: DataFrame, threshold: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, that stand for the classes: one row of each class.

    It is that of least id; of texts of that id in the class, that of least digest; of rows that repeat id and text, one.
    """
    least = _members(docs, threshold, id_column, text_column).groupBy("group").agg(F.min(F.struct("doc", "own")).alias("least"))
    doc, own, kept, kept_own = (fresh(c, docs) for c in ("_doc", "_own", "_kept", "_kept_own"))
    chosen = least.select(F.col("least.doc").alias(kept), F.col("least.own").alias(kept_own))
    named = docs.withColumn(doc, F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID))).withColumn(own, digest(text_column))
    stays = named.join(chosen, (F.col(doc) == F.col(kept)) & (F.col(own) == F.col(kept_own)), "left_semi")
    return stays.dropDuplicates([doc, own]).select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicate_classes(docs: DataFrame, threshold: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ``class_id`` (the least id of its class), ``representative`` (true for rows that stand for it).

    Classes are the connected groups of verified links of weighted Jaccard similarity >= ``threshold``. All null, empty and
    wordless texts form one class. Texts of fewer than
    five words are one shingle. A null id comes before all others; repeated rows get equal results, and rows that repeat an id with
    another text are texts of their own.
    """
    own = lambda c: F.when(c != NO_ID, c)
    known = _members(docs, threshold, id_column, text_column)
    return known.select(own(F.col("doc")).alias(id_column), own(F.col("group.doc")).alias("class_id"), (F.struct("doc", "mark") == F.col("group")).alias("representative"))


def _meetings(placed: DataFrame, threshold: float, at_once: int) -> DataFrame:
    """(u, v, size of v, turn): texts of a bucket in different groups that may be alike; of each text the closest ``at_once``, turns 1
    and up, and one of a later turn if there are more.

    Each two chunks of a bucket come to one task, sorted, so that no task holds more than two chunks of outlines at a time.
    """
    chunks = (F.floor(F.col("n") / CHUNK) + 1).cast("int")
    own = placed.select("bucket", "node.*", F.col("group.doc").alias("group_doc"), F.col("group.mark").alias("group_mark"), "weight", "size", "outline", chunks.alias("chunks"), F.pmod(F.xxhash64("node"), chunks).cast("int").alias("chunk"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    met = met.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")}).drop("other")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_meeting(batches):
            order = np.argsort(group["weight"].to_numpy(), kind="stable")
            doc, mark, group_doc, group_mark, weight, size, chunk = (group[c].to_numpy()[order] for c in ("doc", "mark", "group_doc", "group_mark", "weight", "size", "chunk"))
            outlines = np.frombuffer(b"".join(group["outline"].to_pylist()), "<f2").reshape(-1, OUTLINE)[order].astype(np.float32)
            within = group["low"][0].as_py() == group["high"][0].as_py()

            def apart(i: int, others: slice) -> np.ndarray:
                found = (group_doc[others] != group_doc[i]) | (group_mark[others] != group_mark[i])
                return found if within else found & (chunk[others] != chunk[i])

            found = list(may_be_alike(weight, outlines, apart, threshold, at_once + 1))
            if not found:
                continue
            a, b = np.repeat([i for i, _ in found], [len(at) for _, at in found]), np.concatenate([at for _, at in found])
            turn = np.concatenate([np.arange(1, len(at) + 1) for _, at in found])
            first = (doc[a] < doc[b]) | ((doc[a] == doc[b]) & (mark[a] < mark[b]))
            u, v = np.where(first, a, b), np.where(first, b, a)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[u], mark[u], doc[v], mark[v], size[v], turn)], ["u_doc", "u_mark", "v_doc", "v_mark", "size", "turn"])

    keys = ["bucket", "low", "high"]
    pairs = met.repartition(partitions(placed.sparkSession), *keys).sortWithinPartitions(*keys).mapInArrow(meet, "u_doc long, u_mark long, v_doc long, v_mark long, size long, turn long")
    side = lambda c: F.struct(F.col(f"{c}_doc").alias("doc"), F.col(f"{c}_mark").alias("mark")).alias(c)
    return pairs.select(side("u"), side("v"), "size", "turn")


def _by_meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one bucket and pair of chunks, which stand together but may go over several Arrow batches."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        keys = [rows[c].to_numpy() for c in ("bucket", "low", "high")]
        cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        cut = [0, *cut.tolist()]
        for low, high in zip(cut, cut[1:]):
            yield rows.slice(low, high - low)
        held = rows.slice(cut[-1]) if len(rows) else None
    if held is not None:
        yield held


def _members(docs: DataFrame, threshold: float, id_column: str, text_column: str) -> DataFrame:
    """(doc, mark, own, group) per input row: its id, the hash and digest of its text, and the node that stands for its class."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc", F.xxhash64("text").alias("mark"), digest("text").alias("own"), "text")
    # a text is known by the least id that has it and a hash; copies stay out of what follows
    whole = rows.groupBy("own").agg(F.min("doc").alias("doc"), F.first("mark").alias("mark"), F.count("*").alias("copies"), F.first("text").alias("text"))
    texts, texts_read = stepwise(whole.select("own", "doc", "mark", "copies", "text").mapInArrow(_dealt, "batch long, own binary, doc long, mark long, copies long, text string"), "near-texts")
    n, size = texts.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(partitions(spark), size // PART_BYTES)
    weighed, _ = with_frequencies(texts, n, parts)
    node = F.struct("doc", "mark").alias("node")
    members = weighed.select(node, "weight", (F.octet_length("idf") * 3).cast("long").alias("size"), F.posexplode("bands").alias("band", "bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct("node", "weight", "size")).alias("first")).where("n > 1").drop("n")
    members, members_read = stepwise(members.join(shared, "bucket"), "near-members")
    # exchanges have as many parts as the session says, but few rows are left here: a task reads several parts
    few = tasks_for(spark, members.count())

    def fit(a: str, b: str) -> Column:
        """Likeness is at most the ratio of the weights; other pairs need no look."""
        return F.least(a, b) >= (threshold - 1e-6) * F.greatest(a, b)

    def verified(pairs: DataFrame, tasks: int) -> DataFrame:
        """Those of the pairs (u, v, size of v) that are alike. Only texts in pairs are sent about: that of ``v`` once per
        pair, that of ``u`` once per block of partners, of some ``BLOCK_BYTES`` each."""
        needed = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
        needed = needed.select(F.col("node.doc").alias("doc"), F.col("node.mark").alias("mark"))
        held = needed.join(texts.select("doc", "mark", "text"), ["doc", "mark"]).join(weighed.select("doc", "mark", "idf"), ["doc", "mark"]).select(node, "text", "idf").coalesce(tasks)
        loads = pairs.groupBy("u").agg((F.floor(F.sum("size") / BLOCK_BYTES) + 1).cast("int").alias("blocks"))
        right = pairs.join(loads, "u").select("u", "v", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int").alias("block")).coalesce(tasks)
        right = right.join(held.withColumnRenamed("node", "v"), "v").coalesce(tasks)
        left = loads.select("u", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(held.withColumnRenamed("node", "u"), "u")
        left = left.select(*(F.col(c).alias(f"own_{c}") for c in ("u", "block", "text", "idf"))).coalesce(tasks)

        def compare(one: pa.Table, partners: pa.Table) -> pa.Table:
            if not len(partners):  # a block that no partner fell into
                return partners.select(["u", "v"])
            own = _weights(one["own_text"][0].as_py(), one["own_idf"][0].as_py())
            keep = [likeness(own, _weights(t.as_py(), i.as_py())) >= threshold for t, i in zip(partners["text"], partners["idf"])]
            return partners.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

        return left.groupBy("own_u", "own_block").cogroup(right.groupBy("u", "block")).applyInArrow(compare, pairs.select("u", "v").schema).coalesce(tasks)

    def placed_by(groups: DataFrame, bands_: tuple[int, ...], outlines: DataFrame | None = None) -> tuple[DataFrame, Callable[[], None]]:
        """Members of the buckets that hold several groups, with their own group, that of the bucket's first text, and the bucket's size."""
        placed = members.where(F.col("band").isin(*bands_)).join(groups, "node", "left").select("bucket", "node", "weight", "size", "first", F.coalesce("group", "node").alias("group")).coalesce(few)
        several = placed.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.min(F.when(F.col("node") == F.col("first.node"), F.col("group"))).alias("main"), F.count("*").alias("n")).where("low <> high").select("bucket", "main", "n")
        found = placed.join(several, "bucket").coalesce(few)
        return stepwise(found if outlines is None else found.join(outlines, "node").coalesce(few), "near-placed")

    # what was compared grows by a table each round
    compared = weighed.select(node).select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)
    groups = weighed.select(node).limit(0).select("node", F.col("node").alias("group"))
    groups_read = lambda: None  # noqa: E731  nothing is written yet

    def look(pairs: DataFrame, most: int) -> bool:
        """Compare pairs, of at most so many rows, that were not compared before; are there new links?"""
        nonlocal compared, groups, groups_read
        pairs, _ = stepwise(pairs.groupBy("u", "v").agg(F.first("size").alias("size")).join(compared, ["u", "v"], "left_anti").coalesce(tasks_for(spark, most)), "near-pairs")
        n_pairs, n_bytes = pairs.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        if not n_pairs:
            return False
        compared = compared.union(pairs.select("u", "v"))
        found, found_read = stepwise(verified(pairs, tasks_for(spark, n_pairs, n_bytes)), "near-links")
        if found.isEmpty():
            return False
        # the groups so far stand for all earlier links
        linked = groups.select(F.col("node").alias("u"), F.col("group").alias("v")).union(found)
        after, after_read = stepwise(components(linked, "u", "v").withColumnRenamed("root", "group").coalesce(few), "near-groups")
        groups_read()
        found_read()
        groups, groups_read = after, after_read
        return True

    # the least text of each bucket against the others: a few bands first, so that later ones find most texts in one group
    for bands_ in ((0,), (1, 2), tuple(range(3, BANDS))):
        placed, placed_read = placed_by(groups, bands_)
        look(placed.where("group <> main").where(fit("weight", "first.weight")).select(F.col("first.node").alias("u"), F.col("node").alias("v"), "size"), placed.count())
        placed_read()
    # then each text against those of other groups that may be like it, the closest of them in the first round
    at_once, placed = 1, None
    while True:
        if placed is None:
            placed, placed_read = placed_by(groups, tuple(range(BANDS)), weighed.select(node, "outline"))
        met, met_read = stepwise(_meetings(placed, threshold, at_once), "near-met")
        linked = look(met.where(F.col("turn") <= at_once).select("u", "v", "size"), met.count())
        left_out = not met.where(F.col("turn") > at_once).isEmpty()
        met_read()
        if not linked and not left_out:
            break
        if linked:
            placed_read()
            placed = None
        at_once *= 4
    placed_read()
    texts_read()
    members_read()
    found = weighed.select("own", node).join(groups, "node", "left").select("own", F.coalesce("group", "node").alias("group"))
    return rows.select("doc", "mark", "own").join(found, "own")
