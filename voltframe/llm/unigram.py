"""Operator 4: token counts of a unigram tokenizer, without the tokens.

An Aho-Corasick automaton lists every vocabulary piece that ends at a character,
longest first; dynamic programming carries, for each character, the best score
and the number of pieces on the best way there.  Tie rule of the tokenizer: a
way replaces another only if its score is greater, and longer pieces are tried
first, so of equal scores the longest last piece wins.  A character that is no
piece costs ``UNKNOWN_PENALTY`` below the least score; it counts as its UTF-8
bytes where the vocabulary has byte pieces, else a run of such characters as one.

Text is prepared as the vocabulary's file asks: a space in front (if the text is
not empty) and spaces as U+2581.  Where no piece has that sign after another
character and all scores are whole numbers, sums are exact, the best way passes
through every word start, and each word is counted once and remembered;
otherwise the whole text is one sequence.

Scale: one map over whole texts; the vocabulary (fixed size, checked) is
broadcast; memory grows with the longest word or text.

Defined results: null and empty texts have 0 tokens and score 0; repeated rows
count alike; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import Known

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
MAX_PIECES = 2_000_000
MEMORY = 1 << 19
NORMAL, BYTE = "normal", "byte"


def read_pieces(model_file: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) of a sentencepiece file; controls and the unknown piece are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(sp.id_to_piece(i), sp.get_score(i), BYTE if sp.is_byte(i) else NORMAL) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]


class Counter:
    """Counts and best scores under a unigram vocabulary."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        if len(pieces) > MAX_PIECES:
            raise ValueError(f"{len(pieces)} pieces; up to {MAX_PIECES} are broadcast")
        self.find = ahocorasick.Automaton()
        normal = [(p, float(s)) for p, s, kind in pieces if kind == NORMAL]
        self.unknown = min((s for _, s in normal), default=0.0) - UNKNOWN_PENALTY
        self.bytes = sum(kind == BYTE for _, _, kind in pieces) == 256
        for piece, score in normal:
            self.find.add_word(piece, (len(piece), score))
        self.find.make_automaton()
        self.by_word = all(SPACE not in p.lstrip(SPACE) for p, _ in normal) and all(s == int(s) for _, s in normal)
        # a character of no piece that counts as its bytes also ends a word
        self.breaks = "\n" if self.bytes and not any("\n" in p for p, _ in normal) else ""
        self.words = re.compile(f"[{SPACE}{self.breaks}]+[^{SPACE}{self.breaks}]*").findall
        self.known = Known(self.sequence, MEMORY)

    def sequence(self, text: str) -> tuple[int, float]:
        """Pieces on the best way through one sequence, and its score."""
        n = len(text)
        ending = [[] for _ in range(n + 1)]
        for last, piece in self.find.iter(text):
            ending[last + 1].append(piece)
        best, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            top, single = None, False
            for size, score in ending[end]:             # longest first
                way = best[end - size] + score
                if top is None or way > top:
                    top, count[end] = way, count[end - size] + 1
                single = size == 1
            if not single:
                way = best[end - 1] + self.unknown
                if top is None or way > top:
                    top, unknown[end] = way, True
                    count[end] = count[end - 1] + (len(text[end - 1].encode()) if self.bytes else not unknown[end - 1])
            best[end] = top
        return count[n], best[n]

    def count(self, text: str) -> tuple[int, float]:
        """Tokens of a whole text, and the score of its best segmentation."""
        if not text:
            return 0, 0.0
        text = SPACE + text.replace(" ", SPACE)
        if not self.by_word:
            return self.sequence(text)
        tokens, total = 0, 0.0
        for n, score in map(self.known.__getitem__, self.words(text)):
            tokens += n
            total += score
        return tokens, total


_COUNTERS: dict[int, Counter] = {}


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float, str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_tokens`` and ``best_score`` for each row."""
    shipped = docs.sparkSession.sparkContext.broadcast(pieces)
    key = hash(tuple(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _COUNTERS:
            _COUNTERS[key] = Counter(shipped.value)
        counter = _COUNTERS[key]
        for batch in batches:
            found = [counter.count(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], ["id", "n_tokens", "best_score"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_tokens long, best_score double")
    return out.withColumnRenamed("id", id_col)
