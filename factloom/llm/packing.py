"""Sequence packing by minimum bin slack.

Texts are tokenised, an end id is added, and documents are cut into full windows of ``capacity``
ids and one remainder. Remainders are packed where they are read: a task keeps a bounded block of
them, and for each window a bitset subset-sum dynamic program over the histogram of remaining
lengths finds the multiset that fills it closest to capacity, with the counts found by
backtracking; the largest remaining piece is always part of it, and a multiset is used again for
as long as the counts last. Where slack is left, a remaining piece is cut to fill it. What is left
at a task's end goes to sequences whose lengths are powers of two, which need no padding. So
nothing is shuffled, a task's memory does not grow with its input, and no sequence is padded.

Rows: one per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
Defined cases: null and empty texts give the end id alone; a null doc_id is kept; repeated rows are
packed each for itself; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import CACHES, column, map_arrow, prepare, slices, table, words_of

CAPACITY = 4096
END_ID = 2
#: Remainders held by a task before windows are filled from them.
BLOCK = 2048
#: Words whose ids a task remembers; then it starts anew.
REMEMBERED = 600_000
TOKEN_SLICE = 8_000_000
#: Words encoded in one call, and the mark of a word's last token in the vocabulary.
TOGETHER = 256
WORD_END = "</w>"
#: Words of letters that stay single letters when they are normalised and lowered. Others, as U+0130, may end in a
#: combining mark, which the tokenizer would join with the punctuation after it, so they are encoded as they stand.
PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u0152\u0153]+").fullmatch


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of whole texts, found word by word.

    The vocabulary drops white space and never joins across it, so a text's ids are those of its
    words in a row; each different word of a slice is encoded once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.dtype(np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32)
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.marks = {m: self.bytes_of(self.tokenizer.encode(m, add_special_tokens=False).ids) for m in ".,"}

    def bytes_of(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, as bytes of ``kind``. Plain words are encoded many at a time, as each gives one word end."""
        out = {}
        plain, rest = [w for w in words if PLAIN(w)], [w for w in words if not PLAIN(w)]
        for lo in range(0, len(plain), TOGETHER):
            part = plain[lo : lo + TOGETHER]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, dtype=self.kind)
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(part):  # a tokenizer that marks word ends in another way
                rest += part
                continue
            data, at = ids.tobytes(), 0
            for w, end in zip(part, (self.kind.itemsize * ends).tolist(), strict=True):
                out[w] = data[at:end]
                at = end
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            out[w] = self.bytes_of(e.ids)
        return out

    def ids(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, as ``kind``, and each text's offsets into them."""
        flat, offsets = words_of(text)
        if not len(flat):
            return np.zeros(0, self.kind), np.zeros(len(text) + 1, np.int64)
        coded = flat.dictionary_encode()
        # A-Z are lowered here already (fewer different words), but where a special token may stand
        words = pc.if_else(pc.match_substring(coded.dictionary, "<|"), coded.dictionary, pc.ascii_lower(coded.dictionary)).to_pylist()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        # a full stop or comma after a plain word is a token of its own: the word is looked up without it
        stems = [w[:-1] if w[-1] in ".," and PLAIN(w[:-1]) else w for w in words]
        got = list(map(known.get, stems))
        known.update(self.encode(list({s for s, g in zip(stems, got, strict=True) if g is None})))
        found = [g or known[s] for s, g in zip(stems, got, strict=True)]
        found = [g if len(s) == len(w) else g + self.marks[w[-1]] for s, g, w in zip(stems, found, words, strict=True)]
        store = np.frombuffer(b"".join(found), dtype=self.kind)
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.kind.itemsize
        begin = np.cumsum(size) - size
        at = np.asarray(coded.indices)
        size, begin = size[at], begin[at]
        ends = np.cumsum(size)
        ids = store[np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]))]
        return ids, np.concatenate([[0], ends])[offsets]


@cache
def coder(path: str) -> WordTokenizer:
    """One tokenizer per Python worker: what it remembers serves later tasks too."""
    return WordTokenizer(path)


CACHES["packing"] = coder.cache_clear


def fill_window(counts: dict[int, int], capacity: int) -> tuple[dict[int, int], int]:
    """The multiset of lengths (with counts) closest to capacity that holds the largest length, and its slack."""
    seed = max(counts)
    target = capacity - seed
    used = {seed: 1}
    if not target:
        return used, 0
    mask = (1 << (target + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= target), reverse=True):
        left, part = counts[length] - (length == seed), 1
        while left > 0 and length * part <= target:
            part = min(part, left)
            steps.append((length, part, reach))
            reach |= (reach << (length * part)) & mask
            left -= part
            part *= 2
        if reach >> target & 1:
            break
    total = reach.bit_length() - 1
    slack = target - total
    for length, part, before in reversed(steps):
        if not before >> total & 1:
            total -= length * part
            used[length] = used.get(length, 0) + part
    return used, slack


class Packer:
    """Packs pieces (anything with a length) into sequences; ``emit(piece, start, length, sequence, offset)``."""

    def __init__(self, emit: Callable, capacity: int = CAPACITY, block: int = BLOCK, first_sequence: int = 0):
        self.emit, self.capacity, self.block, self.sequence = emit, capacity, block, first_sequence
        self.by_length: dict[int, list] = defaultdict(list)
        self.held = self.total = 0

    def add(self, piece, length: int) -> None:
        start = 0
        while length - start >= self.capacity:
            self.emit(piece, start, self.capacity, self.sequence, 0)
            self.sequence += 1
            start += self.capacity
        self._hold(piece, start, length - start)
        if self.held >= self.block:
            self._fill()

    def _hold(self, piece, start: int, length: int) -> None:
        if length:
            self.by_length[length].append((piece, start))
            self.held += 1
            self.total += length

    def _take(self, length: int) -> tuple:
        pieces = self.by_length[length]
        got = pieces.pop()
        if not pieces:
            del self.by_length[length]
        self.held -= 1
        self.total -= length
        return got

    def _fill(self) -> None:
        while self.total >= self.capacity:
            counts = {k: len(v) for k, v in self.by_length.items()}
            used, slack = fill_window(counts, self.capacity)
            times = 1 if slack else min(counts[k] // n for k, n in used.items())
            for _ in range(times):
                offset = 0
                for length, n in used.items():
                    for _ in range(n):
                        piece, start = self._take(length)
                        self.emit(piece, start, length, self.sequence, offset)
                        offset += length
                if slack:  # every piece that is left is longer than the slack
                    length = max(self.by_length)
                    piece, start = self._take(length)
                    self.emit(piece, start, slack, self.sequence, offset)
                    self._hold(piece, start + slack, length - slack)
                self.sequence += 1

    def finish(self) -> None:
        """The rest, cut into sequences whose lengths are the powers of two in its sum."""
        self._fill()
        rest = [(p, s, length) for length in sorted(self.by_length, reverse=True) for p, s in self.by_length[length]]
        room = offset = 0
        total = self.total
        for piece, start, length in rest:
            while length:
                if not room:
                    room, offset = 1 << (total.bit_length() - 1), 0
                    total -= room
                part = min(room, length)
                self.emit(piece, start, part, self.sequence, offset)
                start, length, room, offset = start + part, length - part, room - part, offset + part
                if not room:
                    self.sequence += 1
        self.by_length.clear()
        self.held = self.total = 0


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece. ``tokenizer``: a tokenizers file that drops white space, read on the executors."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = coder(tokenizer or tokenizer_file())
        rows: list[tuple] = []

        def emit(piece, start, length, sequence, offset):
            doc_id, ids = piece
            rows.append((doc_id, start, length, zlib.crc32(ids[start : start + length].astype("<u4").tobytes()), len(ids), sequence, offset))

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            arrays = [pa.array(cols[0], type=id_type), *(pa.array(c, type=pa.int64()) for c in cols[1:])]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        packer = Packer(emit, capacity, first_sequence=TaskContext.get().partitionId() << 40)
        for b in slices(batches, "text", TOKEN_SLICE):
            id_type = column(b, "doc_id").type
            ids, offsets = tokens.ids(column(b, "text"))
            for k, doc_id in enumerate(column(b, "doc_id").to_pylist()):
                own = np.append(ids[offsets[k] : offsets[k + 1]], tokens.kind.type(end_id))
                packer.add((doc_id, own), len(own))
            if len(rows) > 5000:
                yield out()
        packer.finish()
        if rows:
            yield out()

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_arrow(src, run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long", keeps="packing")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(prepare(spark), sf_dir, "documents"))
