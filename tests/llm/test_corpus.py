"""Corpus operators against brute force, exact round trips and held-out labels, on small tables and odd rows."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyloom.llm import common, near, order_fingerprint, packing, queries, repeats, site_quality, token_files, toxicity, url_rules, warc, winnowing
from tallyloom.sources import scratch_path

BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [(900_001, None), (900_002, ""), (900_003, "   \n"), (900_004, "One."), (900_005, "x's a..,, B, c.\nÉ" * 3), (900_006, "é" * 300), (None, "no id here at all, none")]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    return docs + ODD + [(900_007, docs[3][1]), (900_008, docs[0][1][:300] + docs[1][1][100:400])]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With columns whose names are used inside."""
    return spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS row", "'n' AS n", "2 AS bucket", "3 AS node").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_matches_sql(name, spark, sf_dir, duck):
    assert compare.differences(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", ["op3_url_rules", "op4_winnowing", "op6_order_fingerprints"])
def test_native_plans_have_no_python(name, spark, sf_dir):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def _digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("block", [64, 1000, warc.BLOCK])
def test_warc_rejects_records_inside_payloads(spark, block):
    fake = warc.record(77, "http://x", b"payload" * 10, None).decode()
    bad = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5000\r\n\r\nzzz"
    rows = [(1, "same"), (2, "same"), (3, None), (4, ""), (5, fake * 20), (6, bad * 50), (7, "x" * 3000 + fake + "é" * 2000), (8, "same"), (9, fake + bad)]
    pages = spark.createDataFrame([(i, f"http://h/\n{i}", h) for i, h in rows], "page_id long, url string, html string").repartition(3)
    path = scratch_path(spark, "w")
    warc.write_archives(pages, path)
    found = warc.page_payloads(warc.read_archives(spark, path, block)).collect()
    largest = defaultdict(int)
    for i, h in rows:
        largest[_digest(h)] = max(largest[_digest(h)], i)
    expected = {(i, len((h or "").encode()), _digest(h), "response" if largest[_digest(h)] == i else "revisit", None if largest[_digest(h)] == i else largest[_digest(h)]) for i, h in rows}
    assert {tuple(r) for r in found} == expected and len(found) == len(rows)


@pytest.mark.parametrize("block", [1000, 1 << 17, warc.BLOCK])
def test_warc_reads_headers_of_any_length(spark, block):
    """Urls of several hundred KB in the middle of an archive, and what follows them."""
    urls = [f"http://h/{i}?" + "u" * n for i, n in enumerate((1, 65_000, 65_536, 700_000, 5, 300_000, 2))]
    pages = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "w")
    warc.write_archives(pages, path)
    found = warc.read_archives(spark, path, block).collect()
    assert sorted((r.page_id, r.url, r.own_digest) for r in found) == [(i, u, _digest(f"page {i}")) for i, u in enumerate(urls)]


def test_warc_of_no_pages(spark):
    path = scratch_path(spark, "w")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.page_payloads(warc.read_archives(spark, path)).count() == 0


def test_toxicity_on_held_out_labels(spark, mid_dir):
    scored = queries.op2_toxicity(spark, mid_dir)
    labels = spark.read.parquet(f"{mid_dir}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    # few labels here: 37 toxic ones to learn from (20,598 labels, of which 2,162 toxic, gave 99% of them and no other)
    assert sum(r.toxic == r.predicted for r in rows) >= 0.9 * len(rows)
    assert not any(r.predicted for r in rows if not r.toxic)


def _places(text):
    """Places of the 4- to 6-grams, hashed one by one."""
    data, found = b" " + text.lower().encode() + b" ", set()
    for size in (4, 5, 6):
        for k in range(len(data) - size + 1):
            h = 0
            for c in data[k : k + size]:
                h = (h * 0x9E3779B1 + c) % 2**32
            found.add(((h ^ (h >> 15)) * 0x85EBCA6B % 2**32) >> 12)
    return found


def test_toxicity_fit_against_brute_force(spark):
    """Places, ratios and the regression's loss, which is near that of ten times as many plain steps."""
    rng = random.Random(4)
    words = ["vile", "kind", "tree", "house", "Straße", "rude", "blue"]
    rows = [(k, " ".join(rng.choices(words, [5 if k % 3 else 1, 1, 1, 1, 1, 4 if k % 3 else 1, 1], k=rng.randint(0, 6)))) for k in range(60)]
    labels = [(k, int(k % 3 > 0)) for k in range(60)] + [(99, 1), (None, 0), (3, None)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    own = [_places(t) for _, t in rows]
    assert all(set(toxicity.places_of(toxicity._lowered(t), np.zeros(toxicity.SLOTS, np.int32)).tolist()) == p for (_, t), p in zip(rows, own))
    y = np.array([k % 3 > 0 for k in range(60)], float)
    slots = sorted(set().union(*own))
    x = np.array([[s in p for s in slots] for p in own], float)
    n1, n0 = y.sum(), (1 - y).sum()
    ratio = np.log((x[y == 1].sum(0) + 1) / (n1 + 2)) - np.log((x[y == 0].sum(0) + 1) / (n0 + 2))
    scaled, ridge = x * ratio, 1.0 / 60

    def loss(coefficient, bias):
        margin = scaled @ coefficient + bias
        return np.mean(np.log1p(np.exp(-margin * (2 * y - 1)))) + ridge / 2 * coefficient @ coefficient

    coefficient, bias, step = np.zeros(len(slots)), float(np.log(n1 / n0)), 2.0 / ((scaled**2).sum(1).mean() + 1)
    for _ in range(4_000):
        error = (1 / (1 + np.exp(-(scaled @ coefficient + bias))) - y) / len(y)
        coefficient, bias = coefficient - step * (scaled.T @ error + ridge * coefficient), bias - step * error.sum()
    told = np.divide(model.weights[slots], ratio, out=np.zeros(len(slots)), where=ratio != 0)
    assert loss(coefficient, bias) <= loss(told, model.bias) + 1e-9 and loss(told, model.bias) < 1.02 * loss(coefficient, bias)
    assert np.count_nonzero(np.delete(model.weights, slots)) == 0


def test_held_out_is_never_null(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(50).union(spark.createDataFrame([(None, "no id", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    rows = queries.op2_toxicity(spark, str(tmp_path)).collect()
    assert len(rows) == 51 and all(r.held_out is not None and (r.doc_id is not None or not r.held_out) for r in rows)


def test_toxicity_of_odd_rows_and_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, none)
    scored = toxicity.score(docs, model)
    assert scored.count() == docs.count() and scored.where("score <> 0.5 OR row.node <> 3").isEmpty()
    assert toxicity.score(empty, model).isEmpty()


def test_url_rules_of_odd_urls(spark):
    rules = spark.createDataFrame([("b.com/", "block"), ("a.b.com/x", "allow"), ("com/xyz", "block"), (None, "block"), ("nothing", "block"), ("b.com/", "block")], "rule string, verdict string")
    urls = [(1, "http://A.B.com/xyz?q#f"), (2, "http://b.com"), (3, None), (4, ""), (5, "no scheme"), (6, "http://zb.com/"), (7, "x://b.com/://c"), (7, "x://b.com/://c"), (8, "http://c.com/xyz1")]
    got = sorted(tuple(r) for r in url_rules.apply_rules(spark.createDataFrame(urls, "page_id long, url string"), rules).collect() if r.page_id not in (3, 4, 5))
    assert got == [
        (1, "a.b.com", "/xyz", "a.b.com/x", "allow"), (2, "b.com", "", None, "allow"), (6, "zb.com", "/", None, "allow"),
        (7, "b.com", "/://c", "b.com/", "block"), (7, "b.com", "/://c", "b.com/", "block"), (8, "c.com", "/xyz1", "com/xyz", "block"),
    ]


def test_winnowing_of_odd_rows(spark):
    words = "A b c d e f g h i j k l".split()
    items = spark.createDataFrame([(1, " ".join(words)), (2, "Short one"), (3, None), (4, "!!"), (None, "q"), (10, "short-ONE")], "item_id long, text string")
    texts = [(1, "x a B c d, e f g h i j y"), (2, "a b c d e f g h i"), (3, None), (None, "the SHORT one, short one"), (5, "short; one short")]
    rows = spark.createDataFrame(texts, "doc_id long, text string").withColumn("words", F.lit(1))
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in winnowing.find_contamination(rows, items).collect()}
    assert got == {1: (12, 10, ["1"], True), 2: (9, 0, [], False), 3: (0, 0, [], False), None: (5, 4, ["10", "2"], True), 5: (3, 2, ["10", "2"], True)}
    assert winnowing.clean_documents(rows, items).count() == 2
    assert winnowing.find_contamination(rows.limit(0), items).isEmpty() and winnowing.find_contamination(rows, items.limit(0)).where("contaminated").isEmpty()


def _ids(texts):
    encoder = Tokenizer.from_file(BPE)
    return [np.array([*e.ids, 1], "<u4") for e in encoder.encode_batch([t or "" for _, t in texts], add_special_tokens=False)]


def test_packing_is_whole_and_gapless(docs, texts, empty):
    rows = packing.pack_documents(docs, BPE, 512).collect()
    tokens = defaultdict(list)
    for (i, _), ids in zip(texts, _ids(texts)):
        tokens[i].append(ids)
    sequences, covered = defaultdict(list), defaultdict(int)
    for r in rows:
        assert any(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.start == 512 * r.piece for ids in tokens[r.doc_id])
        sequences[r.sequence_id].append((r.offset, r.length))
        covered[r.doc_id] += r.length
    assert covered == {i: sum(map(len, own)) for i, own in tokens.items()}
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512
    assert packing.pack_documents(empty, BPE, 512).isEmpty()


@pytest.mark.parametrize("seed", range(30))
def test_dominance_and_best_fit_against_the_optimum(seed):
    """Fixed sets never cost a sequence: reduction and then the optimum of the rest is the optimum of all."""
    rng = random.Random(seed)
    sizes = [rng.randint(1, 20) for _ in range(9)]

    def optimum(items):
        best = [len(items)]

        def place(k, bins):
            if len(bins) >= best[0]:
                return
            if k == len(items):
                best[0] = len(bins)
                return
            for b in range(len(bins)):
                if bins[b] + items[k] <= 20 and bins[b] not in bins[:b]:
                    place(k + 1, [*bins[:b], bins[b] + items[k], *bins[b + 1 :]])
            place(k + 1, [*bins, items[k]])

        place(0, [])
        return best[0]

    counts = {s: sizes.count(s) for s in sizes}
    fixed, left = packing.reduce_by_dominance(counts, 20)
    rest = sorted((s for s, n in left.items() for _ in range(n)), reverse=True)
    assert sum(times for times, _ in fixed) + optimum(rest) == optimum(sorted(sizes, reverse=True))
    placed = defaultdict(int)
    for times, pattern in packing.plan(counts, 20):
        assert sum(s * n for s, n in pattern) <= 20
        for s, n in pattern:
            placed[s] += times * n
    assert dict(placed) == counts


def test_order_fingerprints(docs, texts, empty):
    rows = order_fingerprint.compare_with_next(docs.where("doc_id IS NOT NULL")).collect()
    ordered = sorted((i, t or "") for i, t in texts if i is not None)
    own = {r.doc_id: r for r in rows}
    prints = {}
    for k, (i, t) in enumerate(ordered):
        following, half = ordered[(k + 1) % len(ordered)], len(t) // 2
        edited = t[: len(t) - half] + following[1][:half]
        assert own[i].n_chars == len(t) and own[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(t, own[i].fingerprint) == own[i].fingerprint
        a, b = (set(own[j].fingerprint.split(".")) - {""} for j in (i, following[0]))
        either = {e[:2] for e in a | b}
        assert own[i].near_next == pytest.approx(len(a & b) / len(either) if either else 1.0)
    assert order_fingerprint.compare_with_next(empty).isEmpty()


def test_order_fingerprint_follows_order_and_repeats(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(reversed(words))), (3, "a b c " * 50), (4, "a b c " * 51)]
    tuples = order_fingerprint.with_tuples(spark.createDataFrame(rows, "id long, text string"), "text", "tuples")
    got = {r.id: r.tuples for r in tuples.collect()}
    assert len(got[3]) > 30 and not set(got[1]) & set(got[2])
    assert len(set(got[3]) & set(got[4])) > 0.7 * len(got[3])


def _tuples(text):
    """One after another, by the definition: for each bin the two least pairs from it on, in a circle."""

    def hashed(*values, seed=42):
        for v in values:
            seed = xxhash.xxh64(v if isinstance(v, bytes) else v.to_bytes(8, "little", signed=True), seed=seed).intdigest()
        return seed

    signed = lambda h: h - (1 << 64) if h >> 63 else h
    words = [signed(hashed(w.encode())) for w in re.split("[ \t\r\n]+", text or "") if w]
    kmers = [hashed(*words[i : i + 3]) >> 27 for i in range(len(words) - 2)] if len(words) > 2 else [hashed(" ".join(map(str, words)).encode()) >> 27] * bool(words)
    seen, pairs = Counter(), []
    for place, k in enumerate(kmers):
        pairs.append((hashed(k, seen[k].to_bytes(4, "little")) >> 27, place))
        seen[k] += 1
    pairs.sort()
    out = []
    for b in range(64) if pairs else ():
        start = next((i for i, (h, _) in enumerate(pairs) if h >> 31 >= b), 0)
        two = sorted({pairs[start], pairs[(start + 1) % len(pairs)]}, key=lambda p: p[1])
        out.append(f"{b << 32 | hashed(*(h for h, _ in two)) & 0xFFFFFFFF:010X}")
    return out


def test_order_fingerprints_against_brute_force(spark, texts):
    given = [*texts, (1_000_001, "a b c " * 70), (1_000_002, "one two"), (1_000_003, "x y z"), (1_000_004, "x y z u"), (None, None)]
    rows = spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "1 AS _words", "2 AS _pairs", "3 AS _least")
    got = order_fingerprint.with_tuples(rows, "text", "tuples").collect()
    assert len(got) == len(given) and all(r.tuples == _tuples(r.text) and (r._words, r._pairs, r._least) == (1, 2, 3) for r in got)
    near = order_fingerprint.compare_with_next(rows.where("doc_id IS NOT NULL")).collect()
    own = {i: t or "" for i, t in given if i is not None}
    ids = sorted(own)
    for r in near:
        text, after = own[r.doc_id], own[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        half = len(text) // 2
        a, b = _tuples(text), _tuples(text[: len(text) - half] + after[:half])
        assert r.edited_fingerprint == ".".join(b) and r.near_edited == pytest.approx(len(set(a) & set(b)) / max(len(a), len(b), 1) if a or b else 1.0)


def test_order_counts_in_short_texts_as_in_long_ones(spark):
    """Texts with their halves swapped."""
    means = {}
    for n in (20, 30, 60, 200, 1000):
        rows = []
        for k in range(60):
            words = [f"v{k}n{n}w{j}" for j in range(n)]
            rows.append((" ".join(words), " ".join(words[n // 2 :] + words[: n // 2])))
        both = order_fingerprint.with_tuples(order_fingerprint.with_tuples(spark.createDataFrame(rows, "a string, b string"), "a", "one"), "b", "two")
        means[n] = both.agg(F.avg(order_fingerprint.likeness(F.col("one"), F.col("two")))).first()[0]
    assert 0.4 < means[1000] < 0.6 and all(means[n] <= means[1000] + 0.05 for n in means) and means[20] > 0.15


def _kept(texts, length):
    seen, out = set(), {}
    for i, t in sorted(texts, key=lambda r: (r[0] is not None, r[0])):
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(data[p : p + length])
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[: len(data)]).sum())
        out[i] = (len(data), int(gone.sum()), runs, bytes(b for b, g in zip(data, gone) if not g))
    return out


@pytest.mark.parametrize("wide", [repeats.WIDE_BUCKET, 5])
def test_repeats_against_brute_force(spark, docs, texts, wide):
    rng = random.Random(1)
    noise = lambda: "".join(rng.choice("xyz ") for _ in range(80))
    more = [(910_000 + k, noise() + texts[2][1][:150] + noise()) for k in range(40)]
    given = docs.select("doc_id", "text").union(spark.createDataFrame([*more, more[0]], "doc_id long, text string"))
    rows = repeats.without_repeats(given, 100, wide_bucket=wide).collect()
    assert {r["row"].doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows} == _kept([*texts, *more], 100)
    assert len(rows) == len(texts) + 41
    assert repeats.without_repeats(given.limit(0), 100).isEmpty()


def test_repeats_of_many_texts_without_id(spark):
    """Texts whose hashes agree in 23 bits keep their own spans; each has a passage twice, at places of its own."""
    sha = lambda c: F.sha2(F.concat(F.col("id").cast("string"), F.lit(c)), 256)
    twice = F.concat(sha("a"), sha("b"))
    made = spark.range(20_000).select(F.concat(sha("c"), F.expr("substring(sha2(concat(id, 'd'), 256), 1, CAST(id % 60 AS INT))"), twice, sha("e"), twice).alias("text"))
    made = made.withColumn("low", F.xxhash64("text").bitwiseAND((1 << 23) - 1))
    twins = made.groupBy("low").agg(F.collect_list("text").alias("own")).where("size(own) > 1 AND length(own[0]) <> length(own[1])")
    texts = [t for r in twins.collect() for t in r.own]
    assert len(texts) > 10
    rows = repeats.without_repeats(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string"), 100).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows) == sorted(_kept([(None, t)], 100)[None] for t in texts)


def test_near_duplicate_classes_against_all_pairs(docs, texts, empty):
    got = {r.doc_id: r.class_id for r in near.near_duplicate_classes(docs).collect()}
    runs = [Counter(near.shingles(t).tolist()) for _, t in texts]
    having = Counter(k for own in runs for k in own)
    weighted = [{k: c * np.log1p(len(texts) / having[k]) for k, c in own.items()} for own in runs]

    def likeness(a, b):
        least = sum(min(w, b[k]) for k, w in a.items() if k in b)
        most = sum(a.values()) + sum(b.values()) - least
        return least / most if most else 1.0

    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if group[i] != group[j] and likeness(weighted[i], weighted[j]) >= 0.8:
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for g, (i, _) in zip(group, texts):
        least[g] = min(least.get(g, i), i, key=lambda x: (x is not None, x))
    assert got == {i: least[g] for g, (i, _) in zip(group, texts)}
    assert near.near_duplicate_classes(empty).isEmpty()


def test_unrelated_texts_do_not_change_a_likeness(spark):
    """By exact frequencies the pair has 5 ln 6 / (5 ln 6 + ln 11) = 0.789; a shingle in the last one's place of 20 bits would make it 0.833."""
    words = [f"w{i}" for i in range(10)]
    place = (near.shingles(" ".join(words[5:])) >> np.uint64(44))[0]
    found = np.flatnonzero(near.shingles(" ".join(f"q{i}" for i in range(12_000_000))) >> np.uint64(44) == place)
    strange = " ".join(f"q{i}" for i in range(found[0], found[0] + 5))
    texts = [" ".join(words), " ".join(words[:9]), strange, *(f"a{k} b c d e" for k in range(7))]
    got = {r.doc_id: r.class_id for r in near.near_duplicate_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: i for i in range(10)}


def test_texts_that_may_be_alike():
    """Outlines leave out no pair of that likeness, and leave out most pairs that have less, of equal weight as well."""
    rng = np.random.default_rng(3)
    stem = [f"s{i}" for i in range(400)]
    rows = []
    for k in range(60):
        words, share = list(stem), rng.choice([0.005, 0.02, 0.1])
        for i in np.flatnonzero(rng.random(len(words)) < share):
            words[i] = f"t{k}x{i}"
        kinds, counts = np.unique(near.shingles(" ".join(words)), return_counts=True)
        rows.append((kinds, counts.astype(np.float32) * (1 + kinds % np.uint64(7)).astype(np.float32)))
    rows.sort(key=lambda r: r[1].sum(dtype=np.float64))
    weight = np.array([w.sum(dtype=np.float64) for _, w in rows])
    outlines = np.array([np.frombuffer(near.outline(*r), "<f2") for r in rows]).astype(np.float32)
    every = lambda i, others: np.ones(len(weight[others]), bool)
    found = {(i, j) for i, at in near.may_be_alike(weight, outlines, every, 0.8, 60) for j in at.tolist()}
    pairs = [(i, j) for i in range(60) for j in range(i + 1, 60)]
    alike = {p for p in pairs if near.likeness(rows[p[0]], rows[p[1]]) >= 0.8}
    assert len(alike) > 100 and alike <= found and len(found - alike) < 0.2 * (len(pairs) - len(alike))
    closest = {i: at.tolist() for i, at in near.may_be_alike(weight, outlines, every, 0.8, 1)}
    assert all(len(at) == 1 for at in closest.values()) and closest.keys() == {i for i, _ in found}


def test_buckets_of_several_chunks(spark, monkeypatch):
    """Texts in a chain, each like the next only, and copies of another chain: the classes are the same in chunks of two texts."""
    texts = []
    for name, steps in (("a", 12), ("b", 5)):
        words = [f"{name}{i}" for i in range(120)]
        for k in range(steps):
            texts.append(" ".join(words))
            words[8 * k : 8 * k + 2] = [f"{name}{k}new", f"{name}{k}newer"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes = lambda: {r.doc_id: r.class_id for r in near.near_duplicate_classes(rows, 0.7).collect()}
    whole = classes()
    assert set(whole.values()) == {0, 12}
    monkeypatch.setattr(near, "CHUNK", 2)
    assert classes() == whole


def test_components_take_tasks_by_their_edges(spark):
    """With 64 parts an exchange, a graph of a few edges doesn't take 64 tasks for each of its exchanges (4,373 in all before, 1,075 now)."""
    edges = [(0, k) for k in range(5, 60)] + [(k, k + 1) for k in range(100, 110)] + [(201, 200), (200, 201), (300, 300)]
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    jobs, tracker = "components of few edges", spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(jobs, jobs)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").coalesce(8).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == {k: 0 for k in (0, *range(5, 60))} | {k: 100 for k in range(100, 111)} | {200: 200, 201: 200}
    stages = {k for job in tracker.getJobIdsForGroup(jobs) for k in tracker.getJobInfo(job).stageIds}
    tasks = sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)
    assert tasks < 2_000, tasks


def test_site_quality_on_held_out_labels(spark, mid_dir, docs, empty):
    every, labels = spark.read.parquet(f"{mid_dir}/documents.parquet"), spark.read.parquet(f"{mid_dir}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    judged = site_quality.site_quality(every, labels.where(~held), F.col("source"), F.col("lang"))
    rows = judged.join(labels.where(held), "doc_id").select("quality", "keep").collect()
    assert sum(bool(r.quality) == r.keep for r in rows) >= 0.95 * len(rows)
    none = labels.limit(0)
    odd = site_quality.site_quality(docs, none, F.lit(None), F.col("n"))
    assert odd.count() == docs.count() and odd.where("abs(score - 0.5) > 1e-9").isEmpty()
    assert site_quality.site_quality(empty, labels, F.col("n"), F.col("n")).isEmpty()


def test_sparse_sites_stay_near_their_parents(spark):
    rows = [(i, "plain words here", "big" if i < 400 else "small") for i in range(402)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0) if i < 400 else 0) for i in range(402)], "doc_id long, quality int")
    priors = {r.host: r.host_prior for r in site_quality.site_quality(docs, labels, F.col("host"), F.lit("s")).collect()}
    assert abs(priors["big"] - 0.75) < 0.01 and priors["small"] > 0.2


def test_token_files_round_trip(spark, docs, texts, empty):
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, path, BPE, frame_ids=700)
    rows = token_files.read_token_files(spark, path).collect()
    start, expected = 0, []
    for k, ids in sorted(enumerate(_ids(texts)), key=lambda r: (texts[r[0]][0] is not None, texts[r[0]][0])):
        expected.append((texts[k][0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == sorted((s, i, n, c) for i, s, n, c in expected)
    few = token_files.read_token_files(spark, path, only=[5, 900_006]).collect()
    assert {(r.doc_id, r.ids_crc32) for r in few} == {(i, c) for i, _, _, c in expected if i in (5, 900_006)}
    token_files.write_token_files(empty, path + "-none", BPE)
    assert token_files.read_token_files(spark, path + "-none").isEmpty()


def test_reader_decompresses_only_what_is_asked_and_checks_it(tmp_path):
    file = tmp_path / "t"
    ids = [np.arange(k, k + 1000, dtype="<u4").tobytes() for k in range(20)]
    with file.open("wb") as sink:
        token_files._written(sink, [(list(range(20)), ids)], 500, 3)

    class Source:
        def __init__(self, data):
            self.data, self.place = data, 0

        def size(self):
            return len(self.data)

        def seek(self, at):
            self.place = at

        def read(self, n):
            return self.data[self.place : self.place + n]

    opened = token_files.TokenFile(Source(file.read_bytes()))
    assert b"".join(opened.document(7)) == ids[7] and opened.decompressed == 2
    broken = bytearray(file.read_bytes())
    broken[10] ^= 255
    with pytest.raises(Exception):
        b"".join(token_files.TokenFile(Source(bytes(broken))).document(0))


def test_pipeline_stages(spark, sf_dir):
    """Each stage does to its input what its operator says, and the last packs all that is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == columns and 0 < after.count() <= docs.count()
        if name == "near_duplicates":
            assert near.near_duplicate_classes(after).groupBy("class_id").count().where("count > 1").isEmpty()
        if name == "repeated_strings":
            whole = _kept([(r.doc_id, r.text) for r in docs.collect()], 100)
            assert {r.doc_id: r.text for r in after.collect()} == {i: v[3].decode("utf-8", "ignore") for i, v in whole.items()}
        if name == "decontamination":
            left = winnowing.find_contamination(after, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
            assert left.where("contaminated").isEmpty() and after.count() == left.count()
        docs = after
    packed = corpus_pipeline.pack(spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_pipeline_keeps_one_text_of_each_class_whatever_the_ids(spark):
    """Null ids and an id with two texts; a copy of a kept text with a larger id goes."""
    line = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    given = [*((None, line(k)) for k in range(6)), (7, line(10)), (7, line(11)), (7, line(11)), (8, line(11)), (3, line(11)), (9, line(0)), (5, None)]
    rows = spark.createDataFrame(given, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    after = corpus_pipeline.drop_near_duplicates(spark, rows.repartition(3), "")
    expected = {*((None, line(k)) for k in range(6)), (7, line(10)), (3, line(11)), (5, None)}
    got = [(r.doc_id, r.text) for r in after.collect()]
    assert after.columns == rows.columns and set(got) == expected and len(got) == len(expected)
    odd = corpus_pipeline.drop_near_duplicates(spark, rows.selectExpr("*", "99 AS _doc", "98 AS _own", "97 AS _kept", "96 AS _kept_own"), "")
    assert odd.where("_doc <> 99 OR _own <> 98 OR _kept <> 97 OR _kept_own <> 96").isEmpty() and odd.count() == len(expected)


def test_registered_queries():
    import __spark_entry__ as driver

    numbers = {n.split("_")[0] for n in driver.queries() if n.startswith("op")}
    assert {f"op{n}" for n in range(1, 14)} <= numbers and "pipeline" in driver.queries()
