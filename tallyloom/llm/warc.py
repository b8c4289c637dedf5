"""WARC archives: writing with revisit records, and reading in blocks with boundary-chain verification.

A record names its own length, so a true record leads to its successor. Archives are read in blocks by many tasks, and a
block may start within a payload that holds the text of other records. So every place that looks like a record is a
candidate with an offset of its successor; candidates of a block are followed to the first one beyond it, and pointer
jumping from the start of each file, over the blocks, tells which are reached. Only records on the chain from the start are real.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm.common import partitions, saved

#: Bytes of a block, and of what is read at once beyond it while a header goes on; a header may have any length.
BLOCK, AHEAD = 4 << 20, 1 << 16
_MAGIC = b"WARC/1.0\r\n"
_NO_SUCCESSOR = -1


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; a revisit has no payload of its own, but names the response with the same one, and its digest."""
    own = b"" if refers_to is not None else payload
    lines = [
        b"WARC/1.0",
        b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: <urn:page:%s>" % (b"" if page_id is None else b"%d" % page_id),
        b"WARC-Target-URI: " + re.sub(r"[\r\n]", " ", url or "").encode("utf-8", "surrogatepass"),
        b"WARC-Payload-Digest: sha1:" + _digest(payload).encode(),
    ]
    if refers_to is not None:
        lines += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: <urn:page:%d>" % refers_to]
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(own), b"", b""]) + own + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", smallest: int = 0) -> DataFrame:
    """Write a record per page, one archive per input partition; the manifest (file, bytes) is returned and kept.

    A null payload is empty. Of pages with equal payloads of at least ``smallest`` bytes the one with the largest id is the
    response and the others revisit it; pages without an id are always responses, and of rows that repeat that id too each is one.
    A task writes under its own name and renames, so that a task that runs again replaces the file.
    """
    uri, spark = path.rstrip("/"), pages.sparkSession
    payload = F.coalesce(F.col(payload_column).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).cast("long").alias("id"), F.col(url_column).cast("string").alias("url"), payload.alias("payload"))
    digests = rows.where(F.octet_length("payload") >= smallest).where("id is not null").select("id", F.unhex(F.sha1("payload")).alias("digest"), F.octet_length("payload").alias("size"))
    largest = digests.groupBy("digest", "size").agg(F.max("id").alias("refers_to"), F.min("id").alias("least")).where("least < refers_to").drop("least")
    # saved, so that Spark knows how many revisits there are before it joins them with the payloads
    revisits = saved(digests.join(largest, ["digest", "size"]).where("id < refers_to").select("id", F.col("digest").alias("own"), "refers_to").distinct(), "revisits")
    marked = rows.join(revisits, (rows["id"] == revisits["id"]) & (F.unhex(F.sha1("payload")) == revisits["own"]), "left").select(rows["id"], "url", "payload", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, written = TaskContext.get(), 0
        store, base = _store(uri)
        store.create_dir(base, recursive=True)
        name = f"part-{context.partitionId():06d}.warc"
        trial = f"{base}/.{name}.{context.taskAttemptId()}"
        with store.open_output_stream(trial) as sink:
            for batch in batches:
                for row in zip(*(batch[c].to_pylist() for c in ("id", "url", "payload", "refers_to"))):
                    out = record(*row)
                    sink.write(out)
                    written += len(out)
        store.move(trial, f"{base}/{name}")
        yield pa.RecordBatch.from_pylist([{"file": name, "bytes": written}])

    marked.mapInArrow(write, "file string, bytes long").write.parquet(f"{uri}/manifest")
    return spark.read.parquet(f"{uri}/manifest")


class _Held:
    """The bytes of a file from ``start`` on: those of a block, and as many beyond it as were asked for."""

    def __init__(self, source, size: int, start: int, stop: int) -> None:
        self.source, self.size, self.start, self.data = source, size, start, bytearray()
        self._read(min(size, stop + AHEAD) - start)

    def _read(self, n: int) -> bool:
        self.source.seek(self.start + len(self.data))
        part = self.source.read(max(0, min(n, self.size - self.start - len(self.data))))
        self.data += part
        return bool(part)

    def line_end(self, at: int) -> int:
        """Place of the first line end from ``at`` on, read on for it as far as needed; -1 if the file has none."""
        while (end := self.data.find(b"\r\n", at)) < 0:
            at = max(at, len(self.data) - 1)
            if not self._read(max(AHEAD, len(self.data))):
                break
        return end


def _header(held: _Held, at: int) -> tuple[dict[str, str], int] | None:
    """Fields and first byte after the header of the record at ``at``; None if it isn't one."""
    if not held.data.startswith(_MAGIC, at):
        return None
    fields, at = {}, at + len(_MAGIC)
    while (end := held.line_end(at)) > at:
        name, colon, value = bytes(held.data[at:end]).partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        at = end + 2
    return (fields, at + 2) if end == at and re.fullmatch(r"\d{1,18}", fields.get("content-length", "")) else None


def read_archives(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """The real records of all archives in ``path``: file, offset, type, page_id, url, payload_digest, refers_to, own_bytes, own_digest.

    ``own_bytes`` and ``own_digest`` are of the bytes that the record itself holds. What follows a broken or cut-off record in a file is
    not reached and not returned. Empty archives have no records.
    """
    uri = path.rstrip("/")
    sizes = spark.read.parquet(f"{uri}/manifest").where("bytes > 0").select(F.regexp_extract("file", r"(\d+)", 1).cast("long").alias("file_no"), "file", "bytes")
    blocks = sizes.select("file_no", "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / block))).alias("k"))
    blocks = saved(blocks.select("file_no", "file", "bytes", (F.col("k") * block).alias("start")), "warc-blocks")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(uri)
        for batch in batches:
            for file_no, file, size, start in zip(*(batch[c].to_pylist() for c in ("file_no", "file", "bytes", "start"))):
                stop = min(size, start + block)
                with store.open_input_file(f"{base}/{file}") as source:
                    held = _Held(source, size, start, stop)
                    following: dict[int, int] = {}
                    last = stop - start - 1 + len(_MAGIC)
                    at = held.data.find(_MAGIC, 0, last)
                    while at >= 0:
                        if found := _header(held, at):
                            after = start + found[1] + int(found[0]["content-length"]) + 4
                            following[start + at] = after if after <= size else _NO_SUCCESSOR
                        at = held.data.find(_MAGIC, at + 1, last)
                # last first: the first place beyond the block that a candidate leads to
                for offset in sorted(following, reverse=True):
                    after = following[offset]
                    if offset < after < stop:
                        following[offset] = following.get(after, _NO_SUCCESSOR)
                if following:
                    yield pa.RecordBatch.from_arrays([pa.array([file_no] * len(following)), pa.array(following.keys(), pa.int64()), pa.array(following.values(), pa.int64())], ["file_no", "offset", "beyond"])

    tasks = max(1, min(partitions(spark), blocks.count()))
    found = saved(blocks.repartition(tasks).mapInArrow(candidates, "file_no long, offset long, beyond long"), "warc-candidates")
    # pointer jumping over the places at which chains enter a block
    entries = found.select("file_no", F.col("beyond").alias("offset")).union(sizes.select("file_no", F.lit(0).cast("long").alias("offset"))).distinct()
    jump = saved(found.join(entries, ["file_no", "offset"], "left_semi"), "warc-jump")
    reached = saved(jump.where("offset = 0").select("file_no", "offset"), "warc-reached")
    while True:
        ahead = reached.join(jump, ["file_no", "offset"]).select("file_no", F.col("beyond").alias("offset"))
        more = saved(ahead.union(reached).distinct().join(found.select("file_no", "offset"), ["file_no", "offset"], "left_semi"), "warc-reached")
        if more.count() == reached.count():
            break
        reached = more
        twice = jump.select("file_no", F.col("offset").alias("beyond"), F.col("beyond").alias("next"))
        jump = saved(jump.join(twice, ["file_no", "beyond"], "left").select("file_no", "offset", F.coalesce("next", F.lit(_NO_SUCCESSOR).cast("long")).alias("beyond")), "warc-jump")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(uri)
        for batch in batches:
            for file, size, start, offset in zip(*(batch[c].to_pylist() for c in ("file", "bytes", "start", "offset"))):
                stop = min(size, start + block)
                out = []
                with store.open_input_file(f"{base}/{file}") as source:
                    held = _Held(source, size, start, stop)
                    while offset < stop:
                        parsed = _header(held, offset - start)
                        if not parsed:
                            break
                        fields, body = parsed
                        length = int(fields["content-length"])
                        if start + body + length + 4 > size:
                            break
                        digest, left = hashlib.sha1(held.data[body : body + length]), body + length - len(held.data)
                        if left > 0:  # the payload goes on beyond what is held
                            source.seek(start + len(held.data))
                            while left > 0:
                                part = source.read(min(left, 1 << 20))
                                digest.update(part)
                                left -= len(part)
                        ids = [re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(f, "")) for f in ("warc-record-id", "warc-refers-to")]
                        out.append((file, offset, fields.get("warc-type"), ids[0] and int(ids[0][1]), fields.get("warc-target-uri"), fields.get("warc-payload-digest", "").removeprefix("sha1:"), ids[1] and int(ids[1][1]), length, base64.b32encode(digest.digest()).decode()))
                        offset = start + body + length + 4
                if out:
                    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["file", "offset", "type", "page_id", "url", "payload_digest", "refers_to", "own_bytes", "own_digest"])

    entered = reached.withColumn("start", F.floor(F.col("offset") / block) * block).groupBy("file_no", "start").agg(F.min("offset").alias("offset"))
    entered = blocks.join(entered, ["file_no", "start"]).select("file", "bytes", "start", "offset")
    return entered.repartition(tasks).mapInArrow(records, "file string, offset long, type string, page_id long, url string, payload_digest string, refers_to long, own_bytes long, own_digest string")


def page_payloads(records: DataFrame) -> DataFrame:
    """Per record of a page: payload size and digest of the full payload; a revisit's size is that of its response."""
    kept = saved(records, "warc-records")
    responses = kept.where("type = 'response'").select(F.col("page_id").alias("refers_to"), F.col("own_bytes").alias("full_bytes"), F.col("own_digest").alias("full_digest")).distinct()
    both = kept.join(responses, (kept["refers_to"] == responses["refers_to"]) & (kept["payload_digest"] == responses["full_digest"]), "left")
    revisit = F.col("type") == "revisit"
    return both.select(
        "page_id",
        F.when(revisit, F.col("full_bytes")).otherwise(F.col("own_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("full_digest")).otherwise(F.col("own_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, kept["refers_to"]).alias("refers_to"),
    )
