"""Token ids in Arrow stream files of equal-length sequences, as a Spark data source.

Method: a file is an Arrow stream whose batches hold the columns `ids` and `mask`, lists of a fixed size. All
batches but the last have one size, so the n-th sequence lies at a known byte: `TokenFile` maps a file into memory
and gives any sequence and its mask as views of it, without a copy or a scan. Ids take the smallest unsigned type that holds
the vocabulary. Documents follow each other without a gap; only the last sequence of a file is filled up, with
mask false. Beside each file, an Arrow stream of (doc_id, start, n_tokens) says where each document lies.

`spark.dataSource.register(TokenFiles)` makes it a format: rows (doc_id, ids) are written in the order of the partitions
and of the rows in them. A task writes files of its own name and reports them; the commit writes one manifest (a row
per file, with the ids before it), and readers see only what it lists, so tasks can be lost, repeated or
doubled. Reading gives documents (doc_id, start, n_tokens, ids, ids_crc32: those that the schema asks for) or, with the option view="sequences",
sequences (file, sequence, ids, mask).

`write_documents` brings documents into ascending order of doc_id by a range partitioning with the text's hash and the row's
place as further keys, so that a doc_id on many rows does not fill one task. Texts are encoded as their parts between
spaces and line ends, which the tokenizer drops, each part once while the cache holds it. A task keeps one batch of ids in memory.

The folder is any that pyarrow reaches from all machines (a mounted path, hdfs, s3, gs).

Defined cases: a null text is an empty one and has the end id only; a null doc_id comes first; rows of one doc_id are ordered by the
hash of their text, then by place; repeated rows are written as often as they occur; an empty table gives a manifest without
files; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from obslake.llm.common import Cache, documents, portions
from obslake.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: ids in a sequence, sequences in a batch, ids after which a file ends with its document
SEQUENCE, BATCH, FILE_IDS = 2048, 128, 16_000_000
MANIFEST = "_manifest.json"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids array<int>"
SEQUENCES = "file string, sequence long, ids array<int>, mask array<boolean>"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """One file: its sizes, the place of its batches, and the ids before it in all files."""

    name: str
    part: int
    ids: int
    documents: int
    sequences: int
    first_byte: int
    batch_bytes: int
    length: int
    batch: int
    start: int = 0


@dataclass
class Task(WriterCommitMessage):
    files: list[Written]


def manifest(path: str) -> list[Written]:
    """The files of a folder in their order; none if nothing was committed."""
    system, folder = located(path)
    if system.get_file_info(f"{folder}/{MANIFEST}").type == fs.FileType.NotFound:
        return []
    with system.open_input_stream(f"{folder}/{MANIFEST}") as source:
        return [Written(**row) for row in json.loads(source.read())]


class _FileWriter:
    """Writes the files of one task, one batch of ids in memory at a time."""

    def __init__(self, path: str, prefix: str, part: int, length: int, batch: int, file_ids: int, width: int):
        self.system, self.folder = located(path)
        self.prefix, self.part, self.length, self.batch, self.file_ids = prefix, part, length, batch, file_ids
        self.ids = np.zeros(length * batch, f"<u{width}")
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(self.ids.dtype), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.places = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.files: list[Written] = []
        self.open = False

    def _begin(self) -> None:
        self.name = f"{self.prefix}-{self.part:06d}-{len(self.files):04d}.arrow"
        self.sink = self.system.open_output_stream(f"{self.folder}/{self.name}")
        self.out = ipc.new_stream(self.sink, self.schema)
        self.docs_sink = self.system.open_output_stream(f"{self.folder}/{self.name}.docs")
        self.docs = ipc.new_stream(self.docs_sink, self.places)
        self.first = self.schema.serialize().size  # the stream begins with it, at its first batch
        self.stride, self.total, self.held, self.count, self.rows = 0, 0, 0, 0, []
        self.open = True

    def _flush(self) -> None:
        """Writes the ids held, filled up to whole sequences."""
        sequences = -(-self.held // self.length)
        size = sequences * self.length
        self.ids[self.held : size] = 0
        mask = np.arange(size) < self.held
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(values), self.length) for values in (self.ids[:size], mask)]
        before = self.sink.tell() or self.first
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.stride = self.stride or self.sink.tell() - before
        self.held = 0

    def _flush_docs(self) -> None:
        columns = [pa.array(column, pa.int64()) for column in zip(*self.rows, strict=True)]
        self.docs.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.places))
        self.rows = []

    def add(self, doc_id: int | None, code: bytes) -> None:
        if not self.open:
            self._begin()
        ids = np.frombuffer(code, self.ids.dtype)
        self.rows.append((doc_id, self.total, len(ids)))
        self.total += len(ids)
        self.count += 1
        at = 0
        while at < len(ids):
            some = ids[at : at + len(self.ids) - self.held]
            self.ids[self.held : self.held + len(some)] = some
            self.held += len(some)
            at += len(some)
            if self.held == len(self.ids):
                self._flush()
        if len(self.rows) == 10_000:
            self._flush_docs()
        if self.total >= self.file_ids:
            self.end()

    def end(self) -> None:
        if not self.open:
            return
        if self.held:
            self._flush()
        if self.rows:
            self._flush_docs()
        for stream in (self.out, self.sink, self.docs, self.docs_sink):
            stream.close()
        sizes = self.total, self.count, -(-self.total // self.length), self.first, self.stride
        self.files.append(Written(self.name, self.part, *sizes, self.length, self.batch))
        self.open = False


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.sizes = [int(options.get(name, value)) for name, value in (("length", SEQUENCE), ("batch", BATCH), ("file_ids", FILE_IDS), ("width", 4))]
        self.overwrite = overwrite
        self.prefix = f"part-{uuid.uuid4().hex[:12]}"
        system, folder = located(self.path)
        system.create_dir(folder, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Task:
        from pyspark import TaskContext

        out = _FileWriter(self.path, f"{self.prefix}-{uuid.uuid4().hex[:8]}", TaskContext.get().partitionId(), *self.sizes)
        for batch in iterator:
            for doc_id, code in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                out.add(doc_id, code.as_buffer())
        out.end()
        return Task(out.files)

    def commit(self, messages: list[Task | None]) -> None:
        """Lists the files in one manifest, moved into place when it is complete."""
        kept = [] if self.overwrite else manifest(self.path)
        start = kept[-1].start + kept[-1].ids if kept else 0
        for file in sorted((file for task in messages if task for file in task.files), key=lambda file: (file.part, file.name)):
            kept.append(replace(file, start=start))
            start += file.ids
        system, folder = located(self.path)
        fresh = f"{folder}/_{self.prefix}.json"
        with system.open_output_stream(fresh) as sink:
            sink.write(json.dumps([asdict(file) for file in kept]).encode())
        system.move(fresh, f"{folder}/{MANIFEST}")
        self._clear({file.name for file in kept})

    def abort(self, messages: list[Task | None]) -> None:
        self._clear(set())

    def _clear(self, kept: set[str]) -> None:
        """Removes what lost attempts of this job left behind."""
        system, folder = located(self.path)
        for info in system.get_file_info(fs.FileSelector(folder)):
            if info.base_name.startswith(self.prefix) and info.base_name.removesuffix(".docs") not in kept:
                system.delete_file(info.path)


class TokenFile:
    """Sequences of a file by number, as views of its bytes."""

    def __init__(self, path: str, file: Written):
        self.file = file
        system, folder = located(path)
        name = f"{folder}/{file.name}"
        self.source = pa.memory_map(name) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(name)
        self.schema = ipc.open_stream(self.source).schema
        self._kept: tuple[int, pa.RecordBatch | None] = (-1, None)

    def __len__(self) -> int:
        return self.file.sequences

    def _batch(self, number: int) -> pa.RecordBatch:
        if self._kept[0] != number:
            self.source.seek(self.file.first_byte + number * self.file.batch_bytes)
            self._kept = (number, ipc.read_record_batch(ipc.read_message(self.source), self.schema))
        return self._kept[1]

    def __getitem__(self, sequence: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view) and mask of a sequence."""
        if not 0 <= sequence < len(self):
            raise IndexError(sequence)
        batch = self._batch(sequence // self.file.batch)
        at = sequence % self.file.batch * self.file.length
        ids = batch.column("ids").values.to_numpy(zero_copy_only=True)[at : at + self.file.length]
        return ids, batch.column("mask").values.slice(at, self.file.length)

    def between(self, start: int, end: int) -> np.ndarray:
        """The ids at places start to end of the file: a view, or a copy where they cross a batch."""
        size, parts = self.file.length * self.file.batch, []
        while start < end:
            ids = self._batch(start // size).column("ids").values.to_numpy(zero_copy_only=True)
            upto = min(end, (start // size + 1) * size)
            parts.append(ids[start % size : start % size + upto - start])
            start = upto
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, "<u4")


@dataclass
class _FilePartition(InputPartition):
    file: Written


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.columns = options["path"], schema.names
        self.sequences = options.get("view") == "sequences"

    def partitions(self) -> list[_FilePartition]:
        return [_FilePartition(file) for file in manifest(self.path)] or [_FilePartition(None)]

    def read(self, partition: _FilePartition) -> Iterator[pa.RecordBatch]:
        if partition.file is None:
            return iter(())
        return self._sequences(partition.file) if self.sequences else self._documents(partition.file)

    def _batch(self, columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[name]() for name in self.columns], self.columns)

    def _sequences(self, file: Written) -> Iterator[pa.RecordBatch]:
        source = TokenFile(self.path, file)
        for number in range(0, file.sequences, file.batch):
            batch = source._batch(number // file.batch)
            rows = batch.num_rows
            yield self._batch({
                "file": lambda rows=rows: pa.array([file.name] * rows),
                "sequence": lambda number=number, rows=rows: pa.array(range(number, number + rows), pa.int64()),
                "ids": lambda batch=batch: batch.column("ids").cast(pa.list_(pa.int32(), file.length)).cast(pa.list_(pa.int32())),
                "mask": lambda batch=batch: batch.column("mask").cast(pa.list_(pa.bool_())),
            })

    def _documents(self, file: Written) -> Iterator[pa.RecordBatch]:
        source = TokenFile(self.path, file)
        system, folder = located(self.path)
        with system.open_input_stream(f"{folder}/{file.name}.docs") as stream:
            for whole in ipc.open_stream(stream):
                for batch in (whole.slice(at, 1000) for at in range(0, whole.num_rows, 1000)):
                    starts, sizes = (batch.column(name).to_numpy() for name in ("start", "n_tokens"))
                    spans = list(zip(starts.tolist(), (starts + sizes).tolist(), strict=True))
                    yield self._batch({
                        "doc_id": lambda batch=batch: batch.column("doc_id"),
                        "start": lambda starts=starts: pa.array(starts + file.start),
                        "n_tokens": lambda sizes=sizes: pa.array(sizes),
                        "ids": lambda spans=spans: pa.array([source.between(*span).astype(np.int32) for span in spans], pa.list_(pa.int32())),
                        "ids_crc32": lambda spans=spans: pa.array((zlib.crc32(source.between(*span).astype("<u4")) for span in spans), pa.int64()),
                    })


class TokenFiles(DataSource):
    """The format `token_files`."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return SEQUENCES if self.options.get("view") == "sequences" else DOCUMENTS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), overwrite)


#: letters whose lower case is one letter and that no normal form changes (so without U+0130)
_LETTERS = re.compile(r"[a-zA-ZÀ-ÖØ-öø-įı-ɏ]+")
_MARKS = ".,;:!?"
#: a byte that no UTF-8 text holds, for the end of a word
_WORD_END = b"\xff"


class Encoder:
    """Ids of texts as bytes of unsigned numbers of `width`.

    The vocabulary's pre-tokeniser drops white space and joins nothing across it, so a text's ids are those of its
    parts between spaces and line ends, each encoded once while the cache holds it. A part of letters is one
    pre-token, and a mark after letters is another one. Ids of this vocabulary are its merge order, so words are
    merged by rank, which is quicker; the tokenizer encodes all other parts.
    """

    def __init__(self, path: str, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = id_width(self.tokenizer.get_vocab_size())
        byte_of = {chr(mark): code for code, mark in enumerate(byte_marks())}
        ranks = {_WORD_END: self.tokenizer.get_vocab_size()}
        for token, rank in self.tokenizer.get_vocab(with_added_tokens=False).items():
            text, end = (token.removesuffix("</w>"), _WORD_END) if token.endswith("</w>") else (token, b"")
            if byte_of.keys() >= set(text):
                ranks[bytes(map(byte_of.__getitem__, text)) + end] = rank
        self.code = {2: "H", 4: "I"}[self.width]
        self.word = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.parts = Cache(self._part, limit)
        self.marks = {mark: self._ids(mark) for mark in _MARKS}

    def _ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        if part.isascii() and part.isalpha() or _LETTERS.fullmatch(part):
            return array(self.code, self.word(part.lower().encode() + _WORD_END)).tobytes()
        if part[-1:] in self.marks and _LETTERS.fullmatch(part, 0, len(part) - 1):
            return self.parts[part[:-1]] + self.marks[part[-1]]
        return self._ids(part)

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        end = end_id.to_bytes(self.width, "little")
        return [b"".join([*map(self.parts.__getitem__, text.replace("\n", " ").split(" ")), end]) for text in texts]


def byte_marks() -> list[int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [code if code in shown else next(hidden) for code in range(256)]


_ENCODERS = Cache(Encoder, 4)


def id_width(size: int) -> int:
    return 2 if size <= 1 << 16 else 4


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def encoded(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id and ids (bytes of unsigned little-endian numbers) in the order of the rows."""
    path = path or tokenizer_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS[path]
        for batch in portions(batches, 1_000_000):
            codes = encoder.encode([text or "" for text in batch.column("text").to_pylist()], end_id)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(codes, pa.binary())], ["doc_id", "ids"])

    return documents(docs).mapInArrow(encode, "doc_id long, ids binary")


def write_documents(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, **sizes: int) -> None:
    """Writes all documents in ascending order of doc_id; sizes: length, batch, file_ids."""
    spark, path = docs.sparkSession, path or tokenizer_path()
    spark.dataSource.register(TokenFiles)
    rows = documents(docs).withColumns({"__hash": F.xxhash64("text"), "__place": F.monotonically_increasing_id()})
    order = ["doc_id", "__hash", "__place"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    from tokenizers import Tokenizer

    width = id_width(Tokenizer.from_file(path).get_vocab_size())
    out = encoded(rows, path, end_id).write.format("token_files").mode("overwrite").options(width=width, **sizes)
    out.save(folder)


def read_documents(spark, folder: str, schema: str = DOCUMENTS) -> DataFrame:
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").schema(schema).load(folder)


def read_sequences(spark, folder: str) -> DataFrame:
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").option("view", "sequences").load(folder)


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from files that were written for it."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_documents(docs, folder)
    return read_documents(docs.sparkSession, folder, "doc_id long, start long, n_tokens long, ids_crc32 long")
