"""Token files: independent zstandard frames, a trailing seek table, a checksum per frame.

File layout (the seekable zstandard format, so that plain zstandard tools read it as well)::

    frame*            ids as little-endian unsigned 32-bit integers; each frame is decompressed alone
    skippable frame   directory: document ids (int64), null flags (uint8), token counts (int64)
    skippable frame   seek table: per frame compressed size, size, checksum; then count, flags, magic

Frames are cut at ``frame_ids`` ids, wherever documents end. A reader takes footer, seek table and directory and
then decompresses only the frames in which the wanted documents lie.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm.bpe import word_encoder
from tallyloom.llm.common import partitions, text_slices

END_ID = 1
# Fixed values of the seekable format.
_DIRECTORY_MAGIC, _SEEK_MAGIC, _FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_CHECKSUMS = 0x80


def _written(sink, encoded: Iterable[tuple[list, list[bytes]]], frame_ids: int, level: int) -> tuple[int, int]:
    """Write one file; documents and ids in it. Only one frame and the directory are in memory."""
    pack = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
    table, held, ids, counts = [], bytearray(), [], []
    size = frame_ids * 4

    def put(raw: bytes) -> None:
        frame = pack.compress(raw)
        sink.write(frame)
        table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    for doc_ids, tokens in encoded:
        ids += doc_ids
        counts += [len(t) // 4 for t in tokens]
        for t in tokens:
            held += t
            while len(held) >= size:
                put(bytes(held[:size]))
                del held[:size]
    if held:
        put(bytes(held))
    known = np.array([i if i is not None else 0 for i in ids], "<i8").tobytes()
    nulls = np.array([i is None for i in ids], "u1").tobytes()
    directory = known + nulls + np.array(counts, "<i8").tobytes()
    sink.write(struct.pack("<II", _DIRECTORY_MAGIC, len(directory)) + directory)
    entries = b"".join(struct.pack("<III", *row) for row in table)
    sink.write(struct.pack("<II", _SEEK_MAGIC, len(entries) + 9) + entries + struct.pack("<IBI", len(table), _CHECKSUMS, _FOOTER_MAGIC))
    return len(ids), sum(counts)


class TokenFile:
    """One file opened for reading by document position."""

    def __init__(self, source):
        self.source, end = source, source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != _FOOTER_MAGIC or not flags & _CHECKSUMS:
            raise ValueError("not a token file, or one without checksums")
        seek = end - 9 - 12 * n - 8
        self.frames = np.frombuffer(self._at(seek + 8, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.first = np.concatenate([[0], np.cumsum(self.frames[:, 1] // 4)])
        magic, size = struct.unpack("<II", self._at(int(self.at[-1]), 8))
        body = self._at(int(self.at[-1]) + 8, size)
        docs = size // 17
        self.ids = np.frombuffer(body, "<i8", docs)
        self.nulls = np.frombuffer(body, "u1", docs, 8 * docs).astype(bool)
        self.counts = np.frombuffer(body, "<i8", docs, 9 * docs)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.decompressed, self._last = 0, (-1, b"")

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.at[k]), int(self.frames[k, 0])))
            if len(raw) != self.frames[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k, 2]:
                raise ValueError(f"frame {k} doesn't match its checksum")
            self._last = (k, raw)
            self.decompressed += 1
        return self._last[1]

    def document(self, i: int) -> Iterator[bytes]:
        """The ids of document ``i`` in parts, one for each frame that it reaches into."""
        low, high = int(self.starts[i]), int(self.starts[i + 1])
        k = int(np.searchsorted(self.first, low, "right")) - 1
        while low < high:
            stop = min(high, int(self.first[k + 1]))
            yield self._frame(k)[4 * (low - int(self.first[k])) : 4 * (stop - int(self.first[k]))]
            low, k = stop, k + 1


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", frame_ids: int = 1 << 18, level: int = 3) -> DataFrame:
    """Encode whole texts, append the end id to each and write one file per range of document ids.

    Files and documents in them are in ascending order of id (nulls first; rows of one id by text). A null text
    has the end id only. A file is written under a task's own name and then renamed, so a task that runs again
    replaces it with the same bytes. ``path`` is a folder that all executors reach, as a URI or a plain path.
    Returns the manifest (part, file, n_docs, n_ids), which is also kept in ``path``/manifest. No rows: no files.
    """
    uri = path.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        encode, end = word_encoder(tokenizer), struct.pack("<I", END_ID)
        slices = text_slices(batches, "text")
        first = next(slices, None)
        if first is None:
            return

        def encoded():
            batch = first
            while batch is not None:
                yield batch["id"].to_pylist(), [t + end for t in encode(batch["text"])]
                batch = next(slices, None)

        store, base = pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)
        store.create_dir(base, recursive=True)
        name = f"part-{part:06d}.tokens.zst"
        trial = f"{base}/.{name}.{context.taskAttemptId()}"
        with store.open_output_stream(trial) as sink:
            n_docs, n_ids = _written(sink, encoded(), frame_ids, level)
        store.move(trial, f"{base}/{name}")
        yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "n_docs": n_docs, "n_ids": n_ids}])

    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(partitions(spark), "id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(write, "part long, file string, n_docs long, n_ids long").write.parquet(f"{uri}/manifest")
    return spark.read.parquet(f"{uri}/manifest")


def read_token_files(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file) per document of the files; ``start`` counts the ids of all before it.

    With ``only``, a stated list of ids, no frame without one of these documents is decompressed.
    Each file is read by one task, frame by frame; every frame that is read is checked.
    """
    uri = path.rstrip("/")
    wanted = None if only is None else np.array(sorted(only), "i8")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['file']}") as source:
                    tokens = TokenFile(source)
                    chosen = np.arange(len(tokens.ids)) if wanted is None else np.flatnonzero(np.isin(tokens.ids, wanted) & ~tokens.nulls)
                    for low in range(0, len(chosen), 4096):
                        out = []
                        for i in chosen[low : low + 4096]:
                            crc = 0
                            for part in tokens.document(i):
                                crc = zlib.crc32(part, crc)
                            out.append((None if tokens.nulls[i] else int(tokens.ids[i]), row["before"] + int(tokens.starts[i]), int(tokens.counts[i]), crc, row["file"]))
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["doc_id", "start", "n_tokens", "ids_crc32", "file"])

    # one row per file: the number of files is that of the write's partitions
    files, before = [], 0
    for row in spark.read.parquet(f"{uri}/manifest").orderBy("part").toLocalIterator():
        files.append((row["file"], before))
        before += row["n_ids"]
    listed = spark.createDataFrame(files, "file string, before long")
    return listed.repartition(max(1, len(files))).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, file string")
