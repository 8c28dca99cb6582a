"""Operator 10: BPE encoding and decoding.

Each word is a doubly linked list of symbols; a priority queue holds the
possible merges by (rank, position), and an entry whose symbols have changed
since it was queued is skipped.  Decoding joins vocabulary strings.

The model file (a vocabulary of fixed size) is read once on the driver and
broadcast; its size is checked.  Work is one map over documents, without a
shuffle: a lost executor only repeats its own tasks.

Defined results: null text counts as empty text; empty text has no ids and
decodes to the empty string; repeated rows give repeated results; null ids
pass through; other columns are not read, so their names cannot clash; texts
and words of any length are encoded whole (a word of n symbols takes
O(n log n)).
"""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: largest model file that is broadcast
MAX_MODEL_BYTES = 64 << 20
#: runs and words that a worker remembers, and the longest of them
RUN_MEMORY, WORD_MEMORY, KEY_LENGTH = 1 << 17, 1 << 19, 48
#: bytes of output gathered before a batch is handed on
FLUSH_BYTES = 8 << 20


#: stands where a symbol has been merged away
DEAD = (1 << 32) - 1


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: visible Latin-1 characters stand for
    themselves, the other bytes for the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, free = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in out:
            out[b], free = chr(free), free + 1
    return [out[b] for b in range(256)]


#: marks of several combining classes, beside which every other mark is tried
TRIED_BESIDE = "\u0305\u0323\u0334\u094d\u3099\u05b0\u0301"


def other_marks(normalised: Callable[[str], str]) -> set[str]:
    """Combining marks that the library's tables order otherwise than this Python's."""
    marks = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] == "M"]
    return {m for m in marks for o in TRIED_BESIDE for t in (f"a{o}{m}", f"a{m}{o}") if lower(unicodedata.normalize("NFC", t)) != normalised(t)}


def newer_characters(others: set[str]) -> Callable[[str], bool]:
    """Whether a text has code points that this Python's Unicode tables don't know,
    or one of ``others``, of which they know something else than the library's."""
    unknown = [c for c in map(chr, range(0x10000)) if unicodedata.category(c) == "Cn" or c in others]
    suspect = re.compile("[" + "".join(unknown) + "\U00010000-\U0010ffff]").search
    return lambda text: bool(suspect(text)) and any(c in others or unicodedata.category(c) == "Cn" for c in set(text))


class Known(dict):
    """Results that a worker remembers: ``most`` fresh ones, and as many of the
    generation before, from which a result that is asked for again comes back."""

    def __init__(self, find: Callable, most: int):
        self.find, self.most, self.old = find, most, {}

    def __missing__(self, key):
        out = self.old.get(key)
        if out is None:
            out = self.find(key)
        if len(key) <= KEY_LENGTH:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = out
        return out


class BpeModel:
    """A BPE with byte symbols and a word-end suffix, as read from a tokenizer file."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for name, i in [*vocab.items(), *special.items()]:
            self.names[i] = name
        self.names = np.array(self.names, object)
        self.merges: dict[int, tuple[int, int]] = {}        # left id * 2^32 + right id: rank, new id
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault(vocab[a] << 32 | vocab[b], (rank, vocab[a + b]))
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.final = [vocab[s + self.suffix] for s in symbols]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")).findall
        self.special = {k: np.uint32(v).astype("<u4").tobytes() for k, v in special.items()}
        by_length = sorted(special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")").split if special else lambda t: [t]
        self.known, self.word_ids = Known(self.packed, RUN_MEMORY), Known(self.merge, WORD_MEMORY)
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(raw.decode())
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self.newer = newer_characters(other_marks(self.lib.normalizer.normalize_str))

    def newer_words(self, part: str) -> list[str]:
        """Words of a text with characters of which the two Unicode tables differ, by
        the library's own normaliser and splitter."""
        lib = self.lib
        found = lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(part))
        return [bytes(self.byte_of[c] for c in w).decode() for w, _ in found]

    def merge(self, word: str) -> bytes:
        """Ids of one word: always the merge of lowest rank, leftmost first.  A queue
        entry is rank * 2^32 + position; it is stale if the pair that now stands at
        the position has another rank (each pair has a rank of its own)."""
        raw = word.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        n, merges = len(ids), self.merges.get
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        queue = [m[0] << 32 | at for at, (a, b) in enumerate(zip(ids, ids[1:])) if (m := merges(a << 32 | b))]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            at = entry & 0xFFFFFFFF
            nxt = after[at]
            if nxt < 0 or (m := merges(ids[at] << 32 | ids[nxt])) is None or m[0] != entry >> 32:
                continue                                    # stale
            new, far = m[1], after[nxt]
            ids[at], ids[nxt], after[at], after[nxt] = new, DEAD, far, -1
            if far >= 0:
                before[far] = at
                if m := merges(new << 32 | ids[far]):
                    heapq.heappush(queue, m[0] << 32 | at)
            if (back := before[at]) >= 0 and (m := merges(ids[back] << 32 | new)):
                heapq.heappush(queue, m[0] << 32 | back)
        return struct.pack(f"<{n - ids.count(DEAD)}I", *[i for i in ids if i != DEAD])

    def packed(self, run: bytes) -> bytes:
        """Ids of a run without ASCII white space.  No word spans white space, which
        neither composes with its neighbours nor changes their case, so each run
        is normalised and cut by itself."""
        if run.isalpha():                                   # ASCII letters only
            return self.word_ids[run.decode().lower()]
        text = run.decode()
        if run.isascii():
            words = self.words(text.lower())
        elif self.newer(text):
            words = self.newer_words(text)
        else:
            words = self.words(lower(unicodedata.normalize("NFC", text)))
        return b"".join(map(self.word_ids.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        known = self.known.__getitem__
        if not any(s in text for s in self.special):
            return b"".join(map(known, text.encode().split()))
        out = []
        for k, part in enumerate(self.cut(text)):
            out += [self.special[part]] if k % 2 else map(known, part.encode().split())
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """Vocabulary strings, joined by a space as where a file names no decoder."""
        return " ".join(self.names[ids].tolist())


def lower(text: str) -> str:
    """Lower case of each character by itself (no rule for a final sigma)."""
    return text.lower() if "Σ" not in text else "".join(map(str.lower, text))


#: one model a worker process
_MODELS: dict[bytes, BpeModel] = {}


def read_model(path: str) -> bytes:
    size = os.path.getsize(path)
    if size > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has {size} bytes; up to {MAX_MODEL_BYTES} are broadcast")
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (binary: little-endian unsigned 32-bit integers) and
    ``decoded`` (string) for each row of ``docs``."""
    shipped = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    ident = docs.schema[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = shipped.value
        if raw not in _MODELS:
            _MODELS[raw] = BpeModel(raw)
        model = _MODELS[raw]
        for batch in batches:
            start, ids, decoded, held = 0, [], [], 0
            for k, text in enumerate(batch.column(1)):
                ids.append(packed := model.encode(text.as_py() or ""))
                decoded.append(model.decode(np.frombuffer(packed, "<u4")))
                held += len(packed) + len(decoded[-1])
                if held > FLUSH_BYTES or k + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, k + 1 - start), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], ["id", "ids", "decoded"])
                    start, ids, decoded, held = k + 1, [], [], 0

    rows = docs.select(id_col, text_col).mapInArrow(run, f"id {ident.dataType.simpleString()}, ids binary, decoded string")
    return rows.withColumnRenamed("id", id_col)
