"""Operator 12: token ids in binary files with Elias-Fano document boundaries.

Documents are dealt by ranges of doc_id and encoded by the tokenizers library in
the task that writes them.  A file holds the ids of consecutive documents in one
array without gaps (16 bits an id where the vocabulary allows), and behind it two
Elias-Fano codes: where each document starts, and the ids of the documents.  So
document k is found by two selects, and a file's index takes some bits a document.

    file:    id array | starts code | doc_id code | FOOTER
    starts:  0, length of the first document, ..., length of all (one more than documents)
    doc_ids: each less the first; documents without id come first and are only counted

A manifest row a file says which documents come before it; it is a written
table, and so are the files: they are written under another name and moved into
place, so a task that runs twice leaves one file.  A file ends at ``FILE_IDS``
ids or ``FILE_DOCS`` documents; ids are written as they come, so a task holds a
batch of documents and the lengths of one file.

Defined results: null text is empty (an end id alone); documents are in order of
doc_id, those with a null doc_id first, those that share one by a hash of their
text; special strings in a text count as the library counts them; an empty table
has no files; other columns are not read, so their names cannot clash.  Texts of
any length are encoded whole; doc_id must be an integer.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from voltframe.operators import series
from voltframe.session import scratch_path

from . import common, eliasfano
from .bpe import Known, byte_symbols, read_model

MAGIC = b"EFTOKEN1"
#: ids, documents, documents without id, first doc_id, bytes an id, sizes of the two codes
FOOTER = struct.Struct("<QQQqIQQ8s")
FILE_IDS, FILE_DOCS = 1 << 26, 1 << 20
#: ids read at once, and bytes of output gathered before a batch is handed on
READ_IDS, FLUSH_BYTES = 1 << 21, 8 << 20
#: fresh words and units that a worker remembers (and as many older ones)
UNIT_MEMORY = 1 << 18


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Any folder that Spark names: a plain path, file:/..., or another store's address."""
    path = re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


# --- encoding ---------------------------------------------------------------------------------

#: fixed value: the library's byte-level pattern, for texts of ASCII and the letters of Latin-1 and Latin Extended
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
LATIN = re.compile(rf"[\x00-\x7f{LETTERS}]*").fullmatch
WORDS = re.compile(rf" ?[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\t-\r 0-9{LETTERS}]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+").findall


class Encoder:
    """The library's ids of whole texts.  A text of plain letters is cut into the
    words of the byte-level pattern; words recur, and only a new one goes to the
    library's model.  Of other texts, the pattern never joins a character other
    than white space with a space behind it, and a space before such a character
    begins a word with it: cut before such spaces, a text gives the same ids unit
    by unit, and a new unit of another script goes to the library as it is."""

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # Spark has a worker for each core
        self.lib = Tokenizer.from_str(raw.decode())
        self.lib.no_truncation()
        self.lib.no_padding()
        self.model = self.lib.model
        self.symbols = dict(enumerate(byte_symbols()))
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.type = np.dtype("<u2" if self.lib.get_vocab_size() <= 1 << 16 else "<u4")
        self.units, self.words = Known(self.unit, UNIT_MEMORY), Known(self.word, UNIT_MEMORY)

    def plain(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def word(self, word: str) -> bytes:
        symbols = word.encode().decode("latin-1").translate(self.symbols)
        ids = [t.id for t in self.model.tokenize(symbols)]
        return struct.pack(f"<{len(ids)}{self.type.char}", *ids)

    def part(self, text: str) -> bytes:
        """Ids of a part of a text that no word crosses."""
        return b"".join(map(self.words.__getitem__, WORDS(text))) if LATIN(text) else self.plain(text)

    def unit(self, piece: str) -> bytes | None:
        """None for a piece that a white space begins or ends, which the library
        may join with what stands beside it."""
        return None if not piece or piece[0].isspace() or piece[-1].isspace() else self.part(" " + piece)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.plain(text)
        if LATIN(text):
            return self.part(text)
        pieces = text.split(" ")
        found = list(map(self.units.__getitem__, pieces[1:]))
        if pieces[0] and not pieces[0][-1].isspace() and None not in found:
            return b"".join([self.part(pieces[0]), *found])
        out, unit = [], pieces[0]
        for piece in pieces[1:]:
            if unit and not unit[-1].isspace() and piece and not piece[0].isspace():
                out.append(self.part(unit))
                unit = " " + piece
            else:
                unit += " " + piece
        return b"".join([*out, self.part(unit)])


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(raw: bytes) -> Encoder:
    if raw not in _ENCODERS:
        _ENCODERS[raw] = Encoder(raw)
    return _ENCODERS[raw]


# --- files ------------------------------------------------------------------------------------

class FileWriter:
    """One file of consecutive documents; ``close`` moves it into place."""

    def __init__(self, folder: str, name: str, attempt: int, type_: np.dtype):
        self.fs, base = filesystem(folder)
        self.path, self.draft = f"{base}/{name}", f"{base}/_draft-{attempt}-{name}"
        self.fs.create_dir(base, recursive=True)
        self.out = self.fs.open_output_stream(self.draft)
        self.type, self.starts, self.doc_ids, self.n_nulls = type_, [0], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.starts.append(self.starts[-1] + len(ids) // self.type.itemsize)
        if doc_id is None:
            self.n_nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def full(self, file_ids: int) -> bool:
        return self.starts[-1] >= file_ids or len(self.starts) > FILE_DOCS

    def close(self) -> tuple[int, int]:
        first = self.doc_ids[0] if self.doc_ids else 0
        starts = eliasfano.encode(np.array(self.starts, np.uint64))
        names = eliasfano.encode(np.array(self.doc_ids, np.int64).astype(np.uint64) - np.int64(first).astype(np.uint64))
        n_docs = len(self.starts) - 1
        self.out.write(starts + names + FOOTER.pack(self.starts[-1], n_docs, self.n_nulls, first, self.type.itemsize, len(starts), len(names), MAGIC))
        self.out.close()
        self.fs.move(self.draft, self.path)
        return n_docs, self.starts[-1]


class TokenFile:
    """Random access to the documents of one file."""

    def __init__(self, path: str):
        fs, path = filesystem(path)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        self.n_ids, self.n_docs, self.n_nulls, self.first, width, n_starts, n_names, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.type = np.dtype(f"<u{width}")
        codes = self.file.read_at(n_starts + n_names, size - FOOTER.size - n_starts - n_names)
        self.starts, self.names = eliasfano.Sequence(codes[:n_starts]), eliasfano.Sequence(codes[n_starts:])

    def ids(self, start: int, stop: int) -> np.ndarray:
        width = self.type.itemsize
        return np.frombuffer(self.file.read_at((stop - start) * width, start * width), self.type)

    def document(self, k: int) -> np.ndarray:
        """Ids of document ``k`` of the file."""
        start, stop = self.starts[[k, k + 1]].astype(np.int64)
        return self.ids(int(start), int(stop))

    def doc_ids(self, first: int, stop: int) -> list[int | None]:
        nulls = min(max(self.n_nulls - first, 0), stop - first)
        named = self.names[np.arange(first + nulls - self.n_nulls, stop - self.n_nulls)]
        return [None] * nulls + (named + np.int64(self.first).astype(np.uint64)).astype(np.int64).tolist()

    def runs(self, read_ids: int = READ_IDS) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """doc_ids, starts (one more) and ids of runs of documents of up to ``read_ids`` ids, or of one longer document."""
        first, some = 0, 1 << 14
        while first < self.n_docs:
            starts = self.starts[np.arange(first, min(first + some, self.n_docs) + 1)].astype(np.int64)
            stop = max(1, int(np.searchsorted(starts, starts[0] + read_ids, side="right")) - 1)
            starts = starts[:stop + 1]
            yield self.doc_ids(first, first + stop), starts, self.ids(int(starts[0]), int(starts[-1]))
            first += stop


# --- Spark jobs -------------------------------------------------------------------------------

def write_tokens(docs: DataFrame, model_path: str, end_id: int, folder: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the files, and gives the manifest: ``file``, ``part``, ``nth``,
    ``n_docs``, ``n_ids``, and ``docs_before`` and ``ids_before`` it."""
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        raise TypeError("doc_id must be an integer")
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, f"token-files-{uuid.uuid4().hex[:12]}")
    shipped = spark.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task = encoder(shipped.value), TaskContext.get()
        part, end, file, nth = task.partitionId(), np.array([end_id], encoder(shipped.value).type).tobytes(), None, 0

        def done():
            return pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "part": part, "nth": nth, **dict(zip(("n_docs", "n_ids"), file.close()))}], MANIFEST)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if file is None:
                    name = f"part-{part:06d}-{nth:04d}.tokens"
                    file = FileWriter(folder, name, task.taskAttemptId(), enc.type)
                file.add(doc_id, enc.encode(text.as_py() or "") + end)
                if file.full(file_ids):
                    yield done()
                    file, nth = None, nth + 1
        if file is not None:
            yield done()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select("doc_id", "text").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    written = common.materialize(dealt.mapInArrow(run, "file string, part int, nth int, n_docs long, n_ids long"), "token-files")
    sums = series.prefix_sums(written, ["n_docs", "n_ids"], "nth", block=F.col("part"))
    return sums.select("file", "part", "nth", "n_docs", "n_ids", (F.col("n_docs_cum") - F.col("n_docs")).alias("docs_before"),
                       (F.col("n_ids_cum") - F.col("n_ids")).alias("ids_before"))


MANIFEST = pa.schema([("file", pa.string()), ("part", pa.int32()), ("nth", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def read_tokens(manifest: DataFrame, read_ids: int = READ_IDS, flush_bytes: int = FLUSH_BYTES) -> DataFrame:
    """``doc_id``, ``place`` (documents before it), ``start`` (ids before it) and
    ``ids`` (binary, little-endian unsigned 32-bit integers) of each document, from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, docs_before, ids_before in zip(*(c.to_pylist() for c in batch.columns)):
                place = docs_before
                for doc_ids, starts, ids in TokenFile(path).runs(read_ids):
                    cuts = np.r_[0, np.flatnonzero(np.diff((starts[1:] - starts[0]) * 4 // flush_bytes)) + 1, len(doc_ids)]
                    for a, b in zip(cuts, cuts[1:]):
                        if a < b:
                            packed = [ids[starts[k] - starts[0]:starts[k + 1] - starts[0]].astype("<u4").tobytes() for k in range(a, b)]
                            yield pa.RecordBatch.from_arrays([pa.array(doc_ids[a:b], pa.int64()), pa.array(range(place + a, place + b), pa.int64()),
                                                              pa.array(starts[a:b] + ids_before), pa.array(packed, pa.binary())], ["doc_id", "place", "start", "ids"])
                    place += len(doc_ids)

    files = common.materialize(manifest.select("file", "docs_before", "ids_before"), "manifest")
    tasks = min(max(files.count(), 1), 100_000)
    return files.repartition(tasks, "file").mapInArrow(run, "doc_id long, place long, start long, ids binary")
