"""Cost-balanced packing of tokenised documents into fixed-length training sequences.

The cost of a piece of ``n`` tokens is ``linear * n + quadratic * n * n``: the second term stands
for attention.  Every document is cut into full sequences and a rest; the rests of a block of
documents are taken in descending order, each into the sequence of the lowest cost so far that
still has room.  What fits nowhere is cut to fill the remaining gaps, so every sequence of a block
is full, and what is left over moves on to the next block.  The last rest of a partition is laid
out in sequences whose lengths are powers of two, which need no padding.

Blocks are packed where their documents are read: nothing is shuffled, memory is bounded by
``block_tokens`` and a recomputed task yields the same sequences.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import batch, id_and_text, strings

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_ARROW = pa.schema(
    [(n, pa.int64()) for n in re.findall(r"(\w+) long", SCHEMA)] + [("input_ids", pa.binary())]
)
# Fixed value: the word pattern of byte-level vocabularies.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Code points below this one are split into words alike by both libraries; a test tries them all.
PLAIN_BELOW = 0x500
_OTHER = re.compile(f"[^\\0-{chr(PLAIN_BELOW - 1)}]")


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    ``tokenizers`` defines the ids, that of a special token's string included.  For texts of common
    scripts without such a string ``tiktoken`` computes the same ids, with the vocabulary and the
    word pattern of the same file, several times faster.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.slow = Tokenizer.from_file(path)
        # The alphabet of a byte-level vocabulary: printable bytes stand for themselves.
        bytes_of = {c: ord(c) for c in ByteLevel.alphabet() if ord(c) < 256}
        others = sorted(set(ByteLevel.alphabet()) - set(bytes_of))
        bytes_of |= zip(others, sorted(set(range(256)) - set(bytes_of.values())), strict=True)
        special = {t.content for t in self.slow.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, sorted(special))) or r"(?!)")
        ranks = {
            bytes(bytes_of[c] for c in piece): i
            for piece, i in self.slow.get_vocab(with_added_tokens=False).items()
            if piece not in special
        }
        self.fast = tiktoken.Encoding(
            "words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        plain = text.isascii() or not _OTHER.search(text)
        if plain and not self.special.search(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.slow.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.fromiter(ids, "<u4", len(ids)).tobytes()


def assign(lengths: np.ndarray, n: int, size: int, linear: float, quadratic: float) -> list:
    """Sequence of each length: descending, to the lowest cost among those with room; -1 if none."""
    free = np.full(n, size, np.int64)
    cost = np.zeros(n)
    where = np.full(len(lengths), -1, np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        at = int(np.argmin(np.where(free >= length, cost, np.inf))) if n else 0
        if n and free[at] >= length:
            where[i] = at
            free[at] -= length
            cost[at] += linear * length + quadratic * length * length
    return where.tolist()


class _Packer:
    """Lays pieces (doc, start, ids, doc_tokens) into sequences and yields finished rows."""

    def __init__(self, size: int, linear: float, quadratic: float, first_id: int, keep_ids: bool):
        self.size, self.linear, self.quadratic = size, linear, quadratic
        self.next_id, self.keep_ids = first_id, keep_ids
        self.rests: list[tuple] = []
        self.held = 0
        self.rows: list[list] = [[] for _ in _ARROW]

    def _place(self, piece: tuple, sequence: int, offset: int) -> None:
        doc, start, ids, total = piece
        row = (doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset)
        for column, value in zip(self.rows, (*row, ids if self.keep_ids else None), strict=True):
            column.append(value)

    def add(self, doc: int | None, ids: bytes) -> None:
        total, step = len(ids) // 4, self.size * 4
        full = total // self.size
        for k in range(full):
            piece = (doc, k * self.size, ids[k * step : (k + 1) * step], total)
            self._place(piece, self.next_id, 0)
            self.next_id += 1
        if total > full * self.size:
            self.rests.append((doc, full * self.size, ids[full * step :], total))
            self.held += total - full * self.size

    def pack(self) -> None:
        """Fill whole sequences with the rests held; keep what is left over."""
        n, size = self.held // self.size, self.size
        lengths = np.array([len(p[2]) // 4 for p in self.rests], np.int64)
        where = assign(lengths, n, size, self.linear, self.quadratic)
        filled, loose = [0] * n, []
        for piece, at in zip(self.rests, where, strict=True):
            if at < 0:
                loose.append(piece)
                continue
            self._place(piece, self.next_id + at, filled[at])
            filled[at] += len(piece[2]) // 4
        gaps = sorted((k for k in range(n) if filled[k] < size), key=lambda k: filled[k])
        loose.reverse()
        for k in gaps:
            while filled[k] < size:
                doc, start, ids, total = loose.pop()
                room = (size - filled[k]) * 4
                if len(ids) > room:
                    loose.append((doc, start + room // 4, ids[room:], total))
                    ids = ids[:room]
                self._place((doc, start, ids, total), self.next_id + k, filled[k])
                filled[k] += len(ids) // 4
        self.next_id += n
        self.rests, self.held = loose[::-1], self.held - n * size

    def finish(self) -> None:
        """Lay the last rest out in sequences of the powers of two that add up to its length."""
        self.pack()
        loose = self.rests[::-1]
        for bit in reversed(range(self.held.bit_length())):
            if not self.held >> bit & 1:
                continue
            offset = 0
            while offset < 1 << bit:
                doc, start, ids, total = loose.pop()
                room = ((1 << bit) - offset) * 4
                if len(ids) > room:
                    loose.append((doc, start + room // 4, ids[room:], total))
                    ids = ids[:room]
                self._place((doc, start, ids, total), self.next_id, offset)
                offset += len(ids) // 4
            self.next_id += 1
        self.rests, self.held = [], 0

    def take(self) -> pa.RecordBatch:
        out, self.rows = batch(_ARROW, self.rows), [[] for _ in _ARROW]
        return out if self.keep_ids else out.select(_ARROW.names[:-1])


def pack_documents(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    seq_len: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
    block_tokens: int = 1 << 20,
    include_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document, with its place in a sequence of ``seq_len`` tokens.

    A document is its token ids (no special tokens; their strings count as ordinary text) and
    ``end_id``.  ``start`` counts the document's ids before the piece, ``ids_crc32`` is the CRC-32
    of the piece's ids as little-endian unsigned 32-bit integers; ``include_ids`` adds those bytes
    as ``input_ids``.  Every id lies in exactly one piece and every sequence is gapless.

    A null or empty text is the single ``end_id``; a null id is kept as null.  Rows with equal ids
    or texts are packed each on their own.  A text longer than a sequence fills whole sequences
    first.  An empty table yields no rows.  Ties in length keep the order of reading.  Other
    columns are ignored, whatever their names.
    """
    if seq_len < 1 or seq_len & (seq_len - 1):
        raise ValueError("seq_len must be a power of two")
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        first = TaskContext.get().partitionId() << 36
        packer = _Packer(seq_len, linear, quadratic, first, include_ids)
        for rows in batches:
            for doc, text in zip(rows[0].to_pylist(), strings(rows[1]), strict=True):
                packer.add(doc, encoder.encode(text) + tail)
                if packer.held >= block_tokens:
                    packer.pack()
                if len(packer.rows[0]) >= 8192:
                    yield packer.take()
        packer.finish()
        yield packer.take()

    schema = SCHEMA + (", input_ids binary" if include_ids else "")
    return id_and_text(df, id_col, text_col).mapInArrow(run, schema)
