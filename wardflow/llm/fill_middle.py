"""Fill-in-the-middle texts, assembled by a secondary sort.

A document is cut into units (runs of letters, or single other characters).  Chunks of units leave
the first step as pieces keyed by the document and by their place in the output; one shuffle by
document sorts them by that place within partitions, and the output streams through an incremental
digest, piece by piece.  The text is then restored from that stream alone: the marks met on the way
tell which section a piece belongs to.  Restored pieces are sorted once more, by section, within
the partitions they are already in, and stream through a second digest.  No output text is ever
whole in memory, and the texts cross the network once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch, id_and_text, partitions, strings

#: Marks of the sections, and the shares of forms in percent.
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
FORMED, SUFFIX_FIRST = 90, 20
#: Units of a piece.
CHUNK = 4096
#: Places of a section; restored pieces are keyed by section times this, plus their number.
_SECTION = 1 << 40

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("place", pa.int64()),
        ("piece", pa.string()),
        ("copies", pa.int32()),
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("digest", pa.string()),
    ]
)
_PIECES_DDL = (
    "doc_id long, text_key long, place long, piece string, copies int, n long, form string, "
    "prefix_chars long, middle_chars long, digest string"
)
_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("output_sha256", pa.string()),
        ("restored_sha256", pa.string()),
    ]
)
_RESULT_DDL = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    "output_sha256 string, restored_sha256 string"
)


def unit_starts(text: str) -> np.ndarray:
    """Where the units of a text start, in code points."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = (points | 32) - np.uint32(97) < 26
    joined = letter.copy()
    joined[1:] &= letter[:-1]
    joined[:1] = False
    return np.flatnonzero(~joined)


def draws(doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits that a document's id decides; a null id counts as empty."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4)]


@dataclass
class Plan:
    """How one text is cut: ``bounds`` are the ends of prefix and middle in units."""

    form: str
    starts: np.ndarray
    bounds: tuple[int, int] | None = None
    chars: tuple[int, int] | None = None

    def sections(self) -> list[tuple[str | None, int, int]]:
        """Mark, first unit and end unit of each part of the output, in its order."""
        n = len(self.starts)
        if self.bounds is None:
            return [(None, 0, n)]
        a, b = self.bounds
        prefix, middle, suffix = (PREFIX, 0, a), (MIDDLE, a, b), (SUFFIX, b, n)
        return [suffix, prefix, middle] if self.form == "spm" else [prefix, suffix, middle]


def plan_text(doc_id: int | None, text: str) -> Plan:
    starts = unit_starts(text)
    h1, h2, h3, h4 = draws(doc_id)
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= FORMED:
        return Plan("plain", starts)
    n = len(starts)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    ends = [int(starts[u]) if u < n else len(text) for u in (a, b)]
    return Plan("spm" if h4 % 100 < SUFFIX_FIRST else "psm", starts, (a, b), (ends[0], ends[1] - ends[0]))


def output_pieces(text: str, plan: Plan, chunk: int) -> Iterator[str]:
    """Marks and chunks of units, in the order of the output."""
    n = len(plan.starts)
    for mark, first, end in plan.sections():
        if mark:
            yield mark
        for at in range(first, end, chunk):
            stop = min(at + chunk, end)
            yield text[int(plan.starts[at]) : int(plan.starts[stop]) if stop < n else len(text)]


def transformed(doc_id: int | None, text: str) -> tuple[str, str]:
    """Form and whole output of one text, for callers that hold it anyway."""
    plan = plan_text(doc_id, text)
    return plan.form, "".join(output_pieces(text, plan, CHUNK))


def _empty(schema: pa.Schema) -> list[list]:
    return [[] for _ in schema]


def _add(columns: list[list], *values) -> None:
    for column, value in zip(columns, values, strict=True):
        column.append(value)


def _emit(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            # Rows repeated within a batch travel once, with their number.
            counted: dict[tuple, int] = {}
            for key in zip(rows[0].to_pylist(), strings(rows[1]), strict=True):
                counted[key] = counted.get(key, 0) + 1
            out = _empty(_PIECES)
            for (doc, text), copies in counted.items():
                digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()
                key = int.from_bytes(digest[:8], "big", signed=True)
                plan = plan_text(doc, text)
                n, chars = len(plan.starts), plan.chars or (None, None)
                _add(out, doc, key, 0, None, copies, n, plan.form, *chars, None)
                for place, piece in enumerate(output_pieces(text, plan, chunk), 1):
                    _add(out, doc, key, place, piece, *[None] * 6)
            yield batch(_PIECES, out)

    return run


@dataclass
class _Open:
    """The document that a stream of sorted pieces is in."""

    header: list = field(default_factory=list)
    place: int = -1
    digest: object = None
    section: int = 0
    number: int = 0


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(key, place, piece, header, again)`` of each row; ``again`` marks a copy of the last row."""
    last = None
    for rows in batches:
        columns = [rows[i].to_pylist() for i in range(len(_PIECES))]
        for doc, key, place, piece, *header in zip(*columns, strict=True):
            at = (doc, key, place)
            yield (doc, key), place, piece, header, at == last
            last = at


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each output, and its pieces keyed by their place in the restored text."""
    order = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
    out, held, size = _empty(_PIECES), None, 0
    state = _Open()

    def close() -> None:
        if held is not None:
            _add(out, *held, 0, None, *state.header[:-1], state.digest.hexdigest())

    for key, place, piece, header, again in _documents(batches):
        if place == 0:
            if again:  # the same row once more: its pieces follow as copies and are skipped
                state.header[0] += header[0]
                continue
            close()
            held, state = key, _Open(header, digest=hashlib.sha256())
        elif not again:
            state.digest.update(piece.encode("utf-8", "surrogatepass"))
            if state.header[2] != "plain" and piece in order:
                state.section = order[piece]
            else:
                _add(out, *key, 1 + state.section * _SECTION + state.number, piece, *[None] * 6)
                state.number += 1
                size += len(piece)
        if size > 1 << 22 or len(out[0]) > 8192:
            yield batch(_PIECES, out)
            out, size = _empty(_PIECES), 0
    close()
    yield batch(_PIECES, out)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document and copy: digests of the output and of the restored text."""
    out, held, state = _empty(_RESULT), None, _Open()

    def close() -> None:
        if held is not None:
            copies, n, form, prefix, middle, digest = state.header
            for _ in range(copies):
                _add(out, held[0], n, form, prefix, middle, digest, state.digest.hexdigest())

    for key, place, piece, header, _ in _documents(batches):
        if place == 0:
            close()
            held, state = key, _Open(header, digest=hashlib.sha256())
            if len(out[0]) > 8192:
                yield batch(_RESULT, out)
                out = _empty(_RESULT)
        else:
            state.digest.update(piece.encode("utf-8", "surrogatepass"))
    close()
    yield batch(_RESULT, out)


def fill_in_middle(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """Form, cuts and digests of the fill-in-the-middle output of every document.

    Columns: ``doc_id``, ``n`` (units), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (code points; null if plain), ``output_sha256`` and ``restored_sha256``.

    A null text is empty; an empty text, and one that contains a mark, is plain.  A null id draws as
    an empty one.  Rows of one id are told apart by 64 bits of a digest of their text; rows equal in
    both are assembled once and each gets its row.  An empty table yields no rows; other columns are
    ignored.  A task holds one piece at a time of the texts it assembles.
    """
    pieces = id_and_text(df, id_col, text_col).mapInArrow(_emit(chunk), _PIECES_DDL)
    order = ("doc_id", "text_key", "place")
    pieces = pieces.repartition(partitions(df.sparkSession), *order[:2]).sortWithinPartitions(*order)
    restored = pieces.mapInArrow(_assemble, _PIECES_DDL).sortWithinPartitions(*order)
    return restored.mapInArrow(_restore, _RESULT_DDL)


def fill_in_middle_texts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``form`` and the whole ``output`` of every document, without a shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("form", pa.string()), ("output", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            docs = rows[0].to_pylist()
            made = [transformed(d, t) for d, t in zip(docs, strings(rows[1]), strict=True)]
            yield batch(schema, (docs, [f for f, _ in made], [o for _, o in made]))

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, form string, output string")
