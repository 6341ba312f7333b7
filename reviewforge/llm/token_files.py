"""Operator 9: token-id files with fixed-width bit packing and random access.

File layout (little endian)::

    magic  "TOKPACK1"                                      8 bytes
    width, block, n_tokens, n_docs, n_blocks               5 x uint64
    doc_id int64 x n_docs, null mark uint8 x n_docs, end uint64 x n_docs
    byte offset of each block, and of the end              uint64 x (n_blocks + 1)
    blocks: ``block`` ids of ``width`` bits each, the last block shorter

``width`` is the fewest bits that hold the largest id of the vocabulary.
``end`` is a document's last id plus one, counted within the file. Offsets are
stored, so any range of ids is read with one seek and unpacked by numpy.

Writing range-partitions the documents by id, sorts each partition and writes
files of at most ``file_tokens`` ids (a longer document has a file of its own).
Files are written by pyarrow, so any file system it knows works, under names
that no other attempt of a task uses; the manifest, a Parquet table that Spark
commits, lists the files of the attempts that count. A lost executor leaves at
most a stray file that nothing reads.

Defined results: a null or empty text is the end id alone; a null id comes
first; rows with the same id follow each other by text; an empty table has an
empty manifest. Only the two named columns are read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import BYTE_PRETOKEN, Memo, blanks, byte_chars, library, pattern, unassigned, vocabulary
from .common import python_ready, sole, work_path

MAGIC = b"TOKPACK1"
PIECES, PRETOKENS = 1_000_000, 200_000
#: Marks that often end a word; after a letter each is a pre-token by itself.
MARKS = frozenset(".,;:!?")


# -- packing ---------------------------------------------------------------------------------


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as ``width`` bits each, lowest bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    """The first ``count`` ids of a packed block, as uint32."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: count * width].reshape(count, width)
    full = np.zeros((count, 32), np.uint8)
    full[:, :width] = bits
    return np.packbits(full, axis=1, bitorder="little").reshape(-1).view("<u4").astype(np.uint32)


def to_file(docs: list[tuple[int | None, np.ndarray]], width: int, block: int) -> bytes:
    """The bytes of one file."""
    ids = np.concatenate([x for _, x in docs]) if docs else np.zeros(0, np.uint32)
    blocks = [pack(ids[i : i + block], width) for i in range(0, len(ids), block)]
    head = MAGIC + struct.pack("<5Q", width, block, len(ids), len(docs), len(blocks))
    head += np.array([d or 0 for d, _ in docs], "<i8").tobytes() + np.array([d is None for d, _ in docs], np.uint8).tobytes()
    head += np.cumsum([len(x) for _, x in docs], dtype="<u8").tobytes()
    first = len(head) + 8 * (len(blocks) + 1)
    offsets = first + np.cumsum([0, *map(len, blocks)], dtype="<u8")
    return head + offsets.astype("<u8").tobytes() + b"".join(blocks)


class TokenFile:
    """Random access to a written file: ``ids(start, stop)`` reads only the blocks that it needs."""

    def __init__(self, path: str):
        system, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        self.file = system.open_input_file(name)
        head = self.file.read_at(48, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.width, self.block, self.n_tokens, self.n_docs, self.n_blocks = struct.unpack("<5Q", head[8:])
        n = self.n_docs
        rest = self.file.read_at(n * 17 + 8 * (self.n_blocks + 1), 48)
        null = np.frombuffer(rest, np.uint8, n, 8 * n)
        self.doc_ids = [None if gone else int(d) for d, gone in zip(np.frombuffer(rest, "<i8", n), null)]
        self.ends = np.frombuffer(rest, "<u8", n, 9 * n).astype(np.int64)
        self.offsets = np.frombuffer(rest, "<u8", self.n_blocks + 1, 17 * n).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        stop = min(stop, self.n_tokens)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        data = self.file.read_at(int(self.offsets[last + 1] - self.offsets[first]), int(self.offsets[first]))
        out = []
        for k in range(first, last + 1):
            at = int(self.offsets[k] - self.offsets[first])
            count = min(self.block, self.n_tokens - k * self.block)
            out.append(unpack(data[at : at + int(self.offsets[k + 1] - self.offsets[k])], self.width, count))
        return np.concatenate(out)[start - first * self.block : stop - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start within the file, ids), a run of documents at a time."""
        starts = np.concatenate([[0], self.ends[:-1]]) if self.n_docs else self.ends
        run = 0
        while run < self.n_docs:
            stop = run + 1
            while stop < self.n_docs and self.ends[stop] - starts[run] <= 1 << 20:
                stop += 1
            ids = self.ids(int(starts[run]), int(self.ends[stop - 1]))
            for k in range(run, stop):
                yield self.doc_ids[k], int(starts[k]), ids[starts[k] - starts[run] : self.ends[k] - starts[run]]
            run = stop

    def close(self) -> None:
        self.file.close()


# -- encoding --------------------------------------------------------------------------------


class Encoder:
    """Whole texts to ids by the tokenizers library.

    The library's model encodes each distinct pre-token once and the ids are
    kept in a bounded memo, since text repeats its words; texts with special
    strings or runs of white space go to the library whole.
    """

    def __init__(self, path: str):
        self.lib = library(path)
        self.find = pattern(BYTE_PRETOKEN).findall
        self.blank = blanks()
        self.special = list(vocabulary(path)["added"])
        self.model = self.lib.model
        self.chars = dict(enumerate(byte_chars()))
        self.space = self.chars[0x20]
        self.pretokens = Memo(self.of_pretoken, PRETOKENS)
        self.pieces = Memo(self.of_piece, PIECES)

    def whole(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of_pretoken(self, word: str) -> bytes:
        mapped = word.encode().decode("latin-1").translate(self.chars)
        ids = [t.id for t in self.model.tokenize(mapped)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def of_piece(self, piece: str) -> bytes | None:
        """Ids of a space and ``piece``; None if a cut at that space is not certain (see operator 1)."""
        if not piece or piece[0] in self.blank or piece[-1] in self.blank:
            return None
        if piece.isalpha():  # a space and letters are one pre-token
            if piece.isascii():  # each is the character of its byte
                ids = [t.id for t in self.model.tokenize(self.space + piece)]
                return struct.pack(f"<{len(ids)}I", *ids)
            return self.of_pretoken(" " + piece)
        if piece[-1] in MARKS and piece[:-1].isalpha():
            return self.pieces[piece[:-1]] + self.pretokens[piece[-1]]
        return self.of_plain(" " + piece)

    def of_plain(self, text: str) -> bytes:
        return self.whole(text) if unassigned(text) else b"".join(map(self.pretokens.__getitem__, self.find(text)))

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        head, *rest = text.split(" ")
        data = None
        if head and head[-1] not in self.blank and not any(s in text for s in self.special):
            try:
                data = self.of_plain(head) + b"".join(map(self.pieces.__getitem__, rest))
            except TypeError:  # a piece is None
                data = None
        return np.frombuffer(self.whole(text) if data is None else data, "<u4")


def encoder(path: str) -> Encoder:
    """One per Python worker process, so that its memo serves all tasks."""
    return sole(Encoder, path)


# -- writing and reading ----------------------------------------------------------------------

#: Files that a task reads back, on average; without a number, the names' few bytes would make them all one task.
FILES_PER_TASK = 4
MANIFEST = "part int, file string, first long, n_docs long, n_tokens long"


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, block: int = 4096, file_tokens: int = 1 << 21, doc_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write ``docs`` in ascending id order under ``path`` and return the manifest.

    The manifest has a row per file: its partition, name, first id within the
    partition, documents and ids.
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    model = vocabulary(tokenizer)
    width = max([end_id, *model["vocab"].values(), *model["added"].values()]).bit_length()
    spark = docs.sparkSession
    python_ready(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode = TaskContext.get().partitionId(), encoder(tokenizer)
        system, folder = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        attempt, held, size, first, made = uuid.uuid4().hex, [], 0, 0, 0
        end = np.array([end_id], np.uint32)

        def flush():
            nonlocal held, size, first, made
            name = f"part-{part:06d}-{made:06d}-{attempt}.tok"
            with system.open_output_stream(f"{folder}/data/{name}") as f:
                f.write(to_file(held, width, block))
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [name], "first": pa.array([first], pa.int64()), "n_docs": pa.array([len(held)], pa.int64()), "n_tokens": pa.array([size], pa.int64())})
            first, made, held, size = first + size, made + 1, [], 0
            return row

        system.create_dir(f"{folder}/data", recursive=True)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.concatenate([encode(text), end])
                if held and size + len(ids) > file_tokens:
                    yield flush()
                held.append((doc, ids))
                size += len(ids)
        if held:
            yield flush()

    ranged = docs.select(docs[doc_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).repartitionByRange("doc_id")
    ranged.sortWithinPartitions("doc_id", "text").mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files that the manifest lists.

    ``start`` counts the ids of all documents before, over all files. The
    partitions' totals, one row each, are summed up in order and joined to the
    files, which are dealt over as many tasks as their number asks for.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    totals = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    tasks = max(1, -(-manifest.count() // FILES_PER_TASK))
    files = manifest.join(before, "part").select("file", (F.col("before") + F.col("first")).alias("start")).repartition(tasks, "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenFile(f"{path}/data/{name}")
                rows = [(doc, start + at, len(ids), zlib.crc32(ids.tobytes())) for doc, at, ids in file.documents()]
                file.close()
                cols = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` to new files in the shared folder and read them back."""
    path = work_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, tokenizer)
    return read_token_files(docs.sparkSession, path)
