"""Removal of repeated byte strings by threshold-bounded interval expansion.

Within a block of text, suffixes are sorted by their first ``depth`` bytes, which gives the
Burrows-Wheeler transform as far as it matters.  From the interval of all suffixes, breadth-first
backward extension yields the boundaries between suffixes whose common prefix is 0, then 1, and so
on; it stops at ``depth``.  Suffixes with no boundary between them share ``depth`` bytes.

Blocks are made so that equal strings meet.  Every string of ``depth`` bytes has a minimizer, its
least hashed substring of ``WORD`` bytes, which depends on nothing else.  One pass tells which
minimizers occur in more than one document.  For those only, the stretch of text whose strings
have that minimizer goes to the block of the minimizer.  A stretch that a task has met in an
earlier document is marked there and not sent on, so a passage that very many documents hold
reaches its block once per task.  Documents with equal texts are told apart from repeats first.

Arrays of numbers travel as packed binary columns; text is shuffled twice, by document.  Documents
of one home (a hash of the id) are packed together for the first of these shuffles.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import U64, batch, from_planes, mix64, partitions, planes

#: Bytes of the substrings that minimizers are chosen among, for long enough strings.
WORD = 20
#: Longest part of a text that is hashed at once; parts overlap.
PART = 1 << 22
#: Bytes of stretches a task holds before it sends them, and of text in one sorted block.
FLUSH, BLOCK = 16 << 20, 1 << 19
#: Words whose least hash parts a group that is larger than a block, level by level.
SPLIT_WORDS = (8, 6, 10)
#: Bytes of stretches that a task remembers so as not to send them again.
REMEMBERED = 64 << 20
_MULTIPLIER = U64(0x9E3779B97F4A7C15)


def minimizers(text: bytes, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings of ``depth`` bytes with one minimizer: hash, first start, last start.

    Of equal hashes in a string the rightmost is its minimizer, so runs depend on content alone.
    """
    found = []
    for at in range(0, max(len(text) - depth + 1, 0), PART):
        found.append(_part_minimizers(text[at : at + PART + depth - 1], depth, at))
    if not found:
        return (np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _word_hashes(text: bytes, word: int, seed: int = 1) -> np.ndarray:
    """Hash of every substring of ``word`` bytes."""
    hashes = mix64(np.frombuffer(text, np.uint8).astype(U64) + U64(seed))
    span = 1
    while span < word:
        step = min(span, word - span)
        right = hashes[step:]
        hashes = hashes[: len(right)] * _MULTIPLIER + (right ^ (right >> U64(29)))
        span += step
    return mix64(hashes)


def _part_minimizers(text: bytes, depth: int, base: int):
    word = min(WORD, (depth + 1) // 2)
    window = depth - word + 1
    hashes = _word_hashes(text, word)
    n = len(hashes)
    # High bits of the hash, then the distance from the end: least means rightmost of the least.
    best = (hashes & ~U64((1 << 23) - 1)) | np.arange(n - 1, -1, -1, dtype=U64)
    reach = 1
    while 2 * reach <= window:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if window > reach:
        best = np.minimum(best[: reach - window], best[window - reach :])
    first = np.flatnonzero(np.append(True, best[1:] != best[:-1]))
    last = np.append(first[1:] - 1, len(best) - 1)
    where = n - 1 - (best[first] & U64((1 << 23) - 1)).astype(np.int64)
    return hashes[where], first + base, last + base


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix positions in order of their first ``depth`` bytes, by doubling; text ends with 0."""
    n = len(text)
    padded = np.append(text, np.zeros(8, np.uint8))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n]
    key, span = np.ascontiguousarray(eight).view(">u8").ravel().astype(U64), 8
    if depth < 8:
        key, span = key >> U64(8 * (8 - depth)), depth
    while True:
        order = np.argsort(key)
        if span >= depth:
            return order
        ordered = key[order]
        rank = np.empty(n, U64)
        rank[order] = np.cumsum(np.append(True, ordered[1:] != ordered[:-1]))
        step = min(span, depth - span)
        after = np.zeros(n, U64)
        after[: n - step] = rank[step:]
        key, span = rank << U64(32) | after, span + step


def boundaries(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each place in ``order``, whether its common prefix with the one before is below ``depth``.

    Level ``l`` extends the intervals found at level ``l - 1`` by one byte to the left and meets
    every boundary with a common prefix of exactly ``l`` that is not known yet.
    """
    n = len(text)
    bwt = text[order - 1]
    by_byte = np.argsort(bwt, kind="stable")
    to_front = np.empty(n, np.int64)
    to_front[by_byte] = np.arange(n)
    same = bwt[by_byte][1:] == bwt[by_byte][:-1]
    following, previous = np.full(n, n), np.full(n, -1)
    following[by_byte[:-1][same]] = by_byte[1:][same]
    previous[by_byte[1:][same]] = by_byte[:-1][same]
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    low, high = np.zeros(1, np.int64), np.full(1, n - 1)
    for _ in range(depth):
        sizes = high - low + 1
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(low - ends + sizes, sizes)
        # The last and the first place of each byte in an interval map to the extended interval.
        high = np.sort(to_front[at[following[at] > np.repeat(high, sizes)]])
        low = np.sort(to_front[at[previous[at] < np.repeat(low, sizes)]])
        new = ~known[high + 1]
        low, high = low[new], high[new]
        if not len(low):
            break
        known[high + 1] = True
    return known[:n]


def shared_starts(strings: list[bytes], docs: np.ndarray, depth: int) -> list[np.ndarray]:
    """Per string, the starts of ``depth`` bytes that also occur in a string of a smaller doc."""
    lengths = np.array([len(s) for s in strings])
    # Bytes move up by one: 0 ends the block, 255 (no byte of UTF-8 reaches it) parts the strings.
    text = np.frombuffer(b"\xfe".join(strings) + b"\xfe\xff", np.uint8) + np.uint8(1)
    order = sorted_suffixes(text, depth)
    group = np.empty(len(text), np.int64)
    group[order] = np.cumsum(boundaries(text, order, depth)) - 1
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    counts = np.maximum(lengths - depth + 1, 0)
    owner = np.repeat(np.arange(len(strings)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    group = group[begins[owner] + offset]
    least = np.full(int(group.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, docs[owner])
    hit = least[group] < docs[owner]
    cuts = np.cumsum(np.bincount(owner[hit], minlength=len(strings)))[:-1]
    return np.split(offset[hit], cuts)


def _content_runs(strings: list[bytes], depth: int, level: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of strings of ``depth`` bytes with one key: string, first start, last start and key.

    Like the minimizer, the key depends on the ``depth`` bytes alone: it is the least hash of their
    words, with a seed and a word length of its level, and on the last level their own hash.
    """
    word = min(SPLIT_WORDS[level], depth) if level < len(SPLIT_WORDS) else depth
    done = 0
    while done < len(strings):
        size, end = 0, done
        while end < len(strings) and (end == done or size < BLOCK):
            size += len(strings[end])
            end += 1
        part = strings[done:end]
        lengths = np.array([len(x) for x in part])
        best = _word_hashes(b"".join(part), word, 1000 * (level + 1))
        width, reach = depth - word + 1, 1
        while 2 * reach <= width:
            best = np.minimum(best[:-reach], best[reach:])
            reach *= 2
        if width > reach:
            best = np.minimum(best[: reach - width], best[width - reach :])
        counts = np.maximum(lengths - depth + 1, 0)
        owner = np.repeat(np.arange(len(part)), counts)
        start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        key = best[np.repeat(np.cumsum(lengths) - lengths, counts) + start]
        new = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))[: len(key)]
        first = np.flatnonzero(new)
        last = np.append(first[1:] - 1, len(key) - 1)[: len(first)]
        yield owner[first] + done, start[first], start[last], key[first]
        done = end


def bounded_starts(strings: list[bytes], docs: np.ndarray, depth: int, level: int = 0) -> list[np.ndarray]:
    """As :func:`shared_starts`, in blocks of about ``BLOCK`` bytes however large the group is.

    A larger group is parted by the content of its strings of ``depth`` bytes, so equal ones stay
    together; parts that are still too large are parted again.  Runs of equal bytes count once, for
    the smallest document that has them: for all others they are shared.  A share of the keys at a
    time is looked at, which bounds the memory, too.
    """
    total = sum(map(len, strings)) + len(strings)
    if total <= 2 * BLOCK or level > len(SPLIT_WORDS):
        return shared_starts(strings, docs, depth)
    found: list[list[np.ndarray]] = [[] for _ in strings]
    for turn in range(turns := -(-total // (8 * BLOCK))):
        # By key: bytes of a run -> the places (string, start) that have it.
        parts: dict[int, dict[bytes, list[tuple[int, int]]]] = {}
        for owner, first, last, key in _content_runs(strings, depth, level):
            own = np.flatnonzero(key % U64(turns) == turn)
            for i, a, b, k in zip(*(x[own].tolist() for x in (owner, first, last, key)), strict=True):
                parts.setdefault(k, {}).setdefault(strings[i][a : b + depth], []).append((i, a))
        pieces: list[bytes] = []
        places: list[list[tuple[int, int]]] = []
        held = 0

        def search() -> None:
            least = np.array([min(docs[i] for i, _ in p) for p in places], np.int64)
            finder = bounded_starts(pieces, least, depth, level + 1)
            for piece, low, starts, where in zip(pieces, least, finder, places, strict=True):
                whole = np.arange(len(piece) - depth + 1)
                for i, a in where:
                    here = whole if docs[i] > low else starts
                    if len(here):
                        found[i].append(here + a)

        for runs in parts.values():
            for piece, where in runs.items():
                if len(runs) > 1 or len(where) > 1:
                    pieces.append(piece)
                    places.append(where)
                    held += len(piece) + 1
            if held >= BLOCK:
                search()
                pieces, places, held = [], [], 0
        if pieces:
            search()
    none = np.zeros(0, np.int64)
    return [np.unique(np.concatenate(f)) if f else none for f in found]


def runs_of(starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by strings of ``depth`` bytes at ascending ``starts``."""
    if not len(starts):
        return starts, starts
    breaks = np.flatnonzero(starts[1:] > starts[:-1] + depth)
    return starts[np.append(0, breaks + 1)], starts[np.append(breaks, len(starts) - 1)] + depth


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as maximal runs; touching ones are one."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    breaks = np.flatnonzero(begins[1:] > ends[:-1])
    return begins[np.append(0, breaks + 1)], ends[np.append(breaks, len(ends) - 1)]


# --- packing of numbers -----------------------------------------------------------------------

_PACKED = ("a", "b", "c", "d", "e", "f")
_ARROW = pa.schema(
    [("part", pa.int32()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("text", pa.binary())]
    + [(n, pa.binary()) for n in _PACKED]
)
_SCHEMA = "part int, kind int, doc_id long, text binary, " + ", ".join(f"{n} binary" for n in _PACKED)


def _four(hashes: np.ndarray) -> bytes:
    """The upper half of hashes.  A block's number stands for some of the rest; two minimizers of a
    block that are taken for one only make the block compare more."""
    return (hashes >> U64(32)).astype("<u4").tobytes()


def _from_four(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4")


def _packed_marks(marks: np.ndarray) -> list[bytes]:
    """Marks (doc, tag, start, end): each document once, with its count; starts and lengths."""
    marks = marks[np.lexsort((marks[:, 2], marks[:, 1], marks[:, 0]))]
    new = np.any(marks[1:, :2] != marks[:-1, :2], axis=1)
    first = np.flatnonzero(np.append(True, new))
    counts = np.diff(np.append(first, len(marks)))
    columns = (marks[first, 0], marks[first, 1], counts, marks[:, 2], marks[:, 3] - marks[:, 2])
    return [planes(c, k) for c, k in zip(columns, _MARKS, strict=True)]


_MARKS = ("<i8", "<u4", "<u4", "<u4", "<u4")


def _from_marks(row: dict) -> np.ndarray:
    doc, tag, counts, start, length = (
        from_planes(row[n], k).astype(np.int64) for n, k in zip("abcde", _MARKS, strict=True)
    )
    return np.stack([np.repeat(doc, counts), np.repeat(tag, counts), start, start + length], axis=1)


class _Rows:
    """Output rows of packed columns."""

    def __init__(self):
        self.columns: list[list] = [[] for _ in _ARROW]

    def add(self, part: int, kind: int, *packed: bytes) -> None:
        row = (part, kind, None, None, *packed, *[None] * (len(_PACKED) - len(packed)))
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)

    def take(self) -> pa.RecordBatch:
        out, self.columns = batch(_ARROW, self.columns), [[] for _ in _ARROW]
        return out


def _sliced(values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Value and extent of every run of equal values."""
    if len(values):
        starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        for a, b in zip(starts, np.append(starts[1:], len(values)), strict=True):
            yield int(values[a]), slice(int(a), int(b))


def _add_by_doc(rows: _Rows, kind: int, part, docs, homes, hashes) -> None:
    """One row per part: its documents, their homes and hash counts, and the hashes by document."""
    order = np.lexsort((hashes, docs, part))
    part, docs, homes, hashes = part[order], docs[order], homes[order], hashes[order]
    for p, at in _sliced(part):
        d = docs[at]
        first = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
        counts = np.diff(np.append(first, len(d)))
        rows.add(
            p, kind, planes(d[first], "<i8"), planes(homes[at][first], "<u4"),
            planes(counts, "<u4"), _four(hashes[at]),
        )


# --- the passes -------------------------------------------------------------------------------


def _list_minimizers(depth: int, blocks: int):
    """Minimizers of each document to their blocks; of one met twice here, documents are told at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            least: dict[bytes, tuple[int, int]] = {}
            for home, doc, text in zip(*[rows[i].to_pylist() for i in range(3)], strict=True):
                if len(text) >= depth and (text not in least or doc < least[text][0]):
                    least[text] = (doc, home)
            found = [np.unique(minimizers(t, depth)[0]) for t in least]
            if not found:
                continue
            n = [len(h) for h in found]
            hashes = np.concatenate(found)
            docs = np.repeat(np.array([d for d, _ in least.values()], np.int64), n)
            homes = np.repeat(np.array([h for _, h in least.values()], np.int64), n)
            order = np.argsort(hashes, kind="stable")
            hashes, docs, homes = hashes[order], docs[order], homes[order]
            fresh = np.append(True, hashes[1:] != hashes[:-1])
            single = fresh & np.append(fresh[1:], True)
            out = _Rows()
            block = (hashes % U64(blocks)).astype(np.int64)
            _add_by_doc(out, 0, block[single], docs[single], homes[single], hashes[single])
            witness = fresh & ~single
            by_block = np.argsort(block[witness], kind="stable")
            seen, seen_block = hashes[witness][by_block], block[witness][by_block]
            for p, at in _sliced(seen_block):
                out.add(p, 1, b"", b"", b"", _four(seen[at]))
            told = _Rows()
            _add_by_doc(told, 2, homes[~single], docs[~single], homes[~single], hashes[~single])
            # These only pass through a block; any block will do.
            told.columns[4 + 4] = [str(p).encode() for p in told.columns[0]]
            told.columns[0] = [p % blocks for p in told.columns[0]]
            yield out.take()
            yield told.take()

    return run


def _pack_texts():
    """Documents of each home together, compressed: ids, lengths and texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shrink = zstandard.ZstdCompressor(level=3)
        for rows in batches:
            homes = rows[0].to_numpy()
            docs, texts = rows[1].to_numpy(), rows[2].to_pylist()
            order = np.argsort(homes, kind="stable")
            out = _Rows()
            for home, at in _sliced(homes[order]):
                own = order[at]
                lengths = np.array([len(texts[i]) for i in own])
                text = shrink.compress(b"".join([texts[i] for i in own]))
                out.add(home, 2, planes(docs[own], "<i8"), planes(lengths, "<u4"), text)
            yield out.take()

    return run


def _unpacked_texts(row: dict) -> Iterator[tuple[int, bytes]]:
    text, begin = zstandard.ZstdDecompressor().decompress(row["c"]), 0
    docs, lengths = from_planes(row["a"], "<i8"), from_planes(row["b"], "<u4")
    for doc, length in zip(docs.tolist(), lengths.tolist(), strict=True):
        yield doc, text[begin : begin + length]
        begin += length


def _tell_shared():
    """Of each block's minimizers, those of several documents, back to the documents' homes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows()
        docs, homes, hashes, seen = [], [], [], []
        for rows in batches:
            for row in rows.select(["kind", *_PACKED[:5]]).to_pylist():
                if row["kind"] == 2:
                    out.add(int(row["e"]), 0, row["a"], row["b"], row["c"], row["d"])
                elif row["kind"] == 1:
                    seen.append(_from_four(row["d"]))
                else:
                    n = from_planes(row["c"], "<u4")
                    docs.append(np.repeat(from_planes(row["a"], "<i8"), n))
                    homes.append(np.repeat(from_planes(row["b"], "<u4"), n))
                    hashes.append(_from_four(row["d"]))
            if len(out.columns[0]) >= 1024:
                yield out.take()
        if hashes:
            h, d = np.concatenate(hashes), np.concatenate(docs)
            place = np.concatenate(homes).astype(np.int64)
            order = np.lexsort((d, h))
            h, d, place = h[order], d[order], place[order]
            fresh = np.append(True, h[1:] != h[:-1])
            number = np.cumsum(fresh) - 1
            other = np.append(False, ~fresh[1:] & (d[1:] != d[:-1]))
            several = np.bincount(number, weights=other) > 0
            if seen:
                several |= np.isin(h[fresh], np.concatenate(seen))
            keep = several[number]
            _add_by_doc(out, 0, place[keep], d[keep], place[keep], h[keep].astype(U64) << U64(32))
        yield out.take()

    return run


def _cut_stretches(depth: int, blocks: int):
    """Stretches around shared minimizers to their blocks; those met in an earlier document, marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, copies = [], [], set()
        ready = False
        first_in: dict[bytes, int] = {}
        home, held, remembered = 0, 0, 0
        send: list[tuple] = []  # (hash, number of the document, start, stretch)
        sources: list[tuple[int, int]] = []  # documents of what is held: (doc, tag)
        marks: list[np.ndarray] = []
        shrink = zstandard.ZstdCompressor(level=3)

        def flush() -> pa.RecordBatch:
            out = _Rows()
            if send:
                h = np.array([s[0] for s in send], U64)
                block = (h % U64(blocks)).astype(np.int64)
                order = np.argsort(block, kind="stable")
                for p, at in _sliced(block[order]):
                    own = [send[i] for i in order[at]]
                    used, number = np.unique([s[1] for s in own], return_inverse=True)
                    table = np.array([sources[i] for i in used], np.int64)
                    out.add(
                        p, 0,
                        planes(table[:, 0], "<i8") + planes(table[:, 1], "<u4"),
                        _four(h[order[at]]),
                        planes(np.diff(number, prepend=0), "<u4"),
                        planes(np.array([s[2] for s in own]), "<u4"),
                        planes(np.array([len(s[3]) for s in own]), "<u4") + np.uint32(home).tobytes(),
                        shrink.compress(b"".join([s[3] for s in own])),
                    )
            if marks:
                # These only pass through a block; any block will do.
                out.add(home % blocks, 1, *_packed_marks(np.concatenate(marks)), str(home).encode())
            for kept in (send, sources, marks):
                kept.clear()
            return out.take()

        for rows in batches:
            for row in rows.to_pylist():
                home = row["part"]
                if row["kind"] == 0:
                    ids.append(np.repeat(from_planes(row["a"], "<i8"), from_planes(row["c"], "<u4")))
                    hashes.append(_from_four(row["d"]))
                    continue
                if row["kind"] == 1:
                    copies.add((row["doc_id"], row["text"]))
                    continue
                if not ready:
                    ready = True
                    ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
                    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint32)
                    order = np.argsort(ids, kind="stable")
                    ids, hashes = ids[order], hashes[order]
                for doc, text in _unpacked_texts(row):
                    a, b = np.searchsorted(ids, doc), np.searchsorted(ids, doc, side="right")
                    if a == b:
                        continue
                    tag = zlib.crc32(text)
                    if copies and (doc, tag.to_bytes(4, "big")) in copies:
                        continue
                    found, first, last = minimizers(text, depth)
                    at = np.flatnonzero(np.isin((found >> U64(32)).astype(np.uint32), hashes[a:b]))
                    if not len(at):
                        continue
                    begins, ends = first[at], last[at] + depth
                    known = []
                    sources.append((doc, tag))
                    for h, s, e in zip(found[at].tolist(), begins.tolist(), ends.tolist(), strict=True):
                        stretch = text[s:e]
                        before = first_in.get(stretch)
                        if before is not None and before < doc:
                            known.append(True)
                            continue
                        known.append(False)
                        if remembered >= REMEMBERED:  # what is forgotten is sent once more
                            first_in.clear()
                            remembered = 0
                        first_in[stretch] = doc
                        remembered += len(stretch) + 100
                        send.append((h, len(sources) - 1, s, stretch))
                        held += len(stretch) + 40
                    if any(known):
                        mine = np.array(known)
                        runs = merged(begins[mine], ends[mine])
                        marks.append(np.stack([np.full(len(runs[0]), doc), np.full(len(runs[0]), tag), *runs], axis=1))
                        held += 32 * len(runs[0])
                    if held >= FLUSH:
                        held = 0
                        yield flush()
        yield flush()

    return run


def _find_repeats(depth: int):
    """Within each block, the bytes of stretches that an earlier document has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows()
        # By minimizer: stretch -> where it occurs, as (doc, tag, position, home).
        found: dict[int, dict[bytes, list[tuple]]] = {}
        marks: list[tuple] = []
        doc_of = itemgetter(0)

        def flush() -> None:
            if not marks:
                return
            m = np.array(marks, np.int64)
            m = m[np.argsort(m[:, 0], kind="stable")]
            for home, at in _sliced(m[:, 0]):
                out.add(home, 0, *_packed_marks(m[at, 1:]))
            marks.clear()

        grow = zstandard.ZstdDecompressor()
        for rows in batches:
            for row in rows.select(["kind", *_PACKED]).to_pylist():
                if row["kind"] == 1:
                    out.add(int(row["f"]), 0, *[row[n] for n in "abcde"])
                    continue
                home = int.from_bytes(row["e"][-4:], "little")
                lengths = from_planes(row["e"][:-4], "<u4")
                count = len(row["a"]) // 12
                docs = from_planes(row["a"][: 8 * count], "<i8").tolist()
                tags = from_planes(row["a"][8 * count :], "<u4").tolist()
                numbers = np.cumsum(from_planes(row["c"], "<u4"), dtype=np.uint32).tolist()
                columns = (_from_four(row["b"]).tolist(), numbers, from_planes(row["d"], "<u4").tolist())
                text, begin = grow.decompress(row["f"]), 0
                for h, k, at, end in zip(*columns, np.cumsum(lengths).tolist(), strict=True):
                    of = found.get(h)
                    if of is None:
                        of = found[h] = {}
                    stretch = text[begin:end]
                    place = (docs[k], tags[k], at, home)
                    if stretch in of:
                        of[stretch].append(place)
                    else:
                        of[stretch] = [place]
                    begin = end
            if len(out.columns[0]) >= 1024:
                yield out.take()

        strings: list[bytes] = []
        holders: list[list[tuple]] = []
        least: list[int] = []
        size = 0

        def search() -> None:
            smallest = np.array(least, np.int64)
            for starts, places, low in zip(bounded_starts(strings, smallest, depth), holders, least, strict=True):
                if not len(starts):
                    continue
                begins, ends = runs_of(starts, depth)
                for doc, tag, at, home in places:
                    if doc == low:
                        runs = zip(begins.tolist(), ends.tolist(), strict=True)
                        marks.extend((home, doc, tag, at + b, at + e) for b, e in runs)

        for stretches in found.values():
            several = len(stretches) > 1
            for stretch, places in stretches.items():
                low = places[0][0]
                if len(places) > 1:
                    low = min(map(doc_of, places))
                    for doc, tag, at, home in places:
                        if doc > low:  # the whole stretch stands in an earlier document
                            marks.append((home, doc, tag, at, at + len(stretch)))
                if several:
                    strings.append(stretch)
                    holders.append(places)
                    least.append(low)
                    size += len(stretch) + 1
            if size >= BLOCK:
                search()
                strings, holders, least, size = [], [], [], 0
            if len(marks) >= 1 << 18:
                flush()
                yield out.take()
        if strings:
            search()
        flush()
        yield out.take()

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _remove(depth: int, row_type: pa.DataType, text_at: int, whole_characters: bool):
    """Spans of each text and what is left of it."""
    schema = pa.schema([("row", row_type), ("spans", _SPANS), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        copies: set = set()
        ready = False
        marks = np.zeros((0, 4), np.int64)
        for rows in batches:
            kinds = rows["kind"].to_numpy()
            for row in rows.select(["kind", "doc_id", "text", *_PACKED]).filter(pa.array(kinds < 2)).to_pylist():
                if row["kind"] == 0:
                    parts.append(_from_marks(row))
                else:
                    copies.add((row["doc_id"], row["text"]))
            texts = rows.filter(pa.array(kinds == 2))
            if not texts.num_rows:
                continue
            if not ready:
                ready = True
                if parts:
                    marks = np.concatenate(parts)
                    marks = marks[np.argsort(marks[:, 0], kind="stable")]
                    parts = []
            spans, kept = [], []
            values = texts["row"].field(text_at).cast(pa.binary()).to_pylist()
            for doc, text in zip(texts["doc_id"].to_pylist(), values, strict=True):
                text = text or b""
                begins, ends = _spans_of(doc, text, marks, copies, depth)
                if whole_characters and begins:
                    begins, ends = _to_characters(text, begins, ends)
                spans.append([{"start": b, "end": e} for b, e in zip(begins, ends, strict=True)])
                if begins:
                    stops, starts = [*begins, len(text)], [0, *ends]
                    text = b"".join(text[a:b] for a, b in zip(starts, stops, strict=True))
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [texts["row"], pa.array(spans, _SPANS), pa.array(kept, pa.binary())], schema=schema
            )

    return run


def _spans_of(doc, text: bytes, marks: np.ndarray, copies: set, depth: int) -> tuple[list, list]:
    if doc is None or len(text) < depth:
        return [], []
    tag = zlib.crc32(text)
    if copies and (doc, tag.to_bytes(4, "big")) in copies:
        return [0], [len(text)]
    a, b = np.searchsorted(marks[:, 0], doc), np.searchsorted(marks[:, 0], doc, side="right")
    own = marks[a:b]
    own = own[own[:, 1] == tag]
    if not len(own):
        return [], []
    begins, ends = merged(own[:, 2], own[:, 3])
    return begins.tolist(), ends.tolist()


def _to_characters(text: bytes, begins: list, ends: list) -> tuple[list, list]:
    """Spans shrunk to whole characters of UTF-8; what then is empty is left out."""
    out = []
    for b, e in zip(begins, ends, strict=True):
        while b < e and text[b] & 0xC0 == 0x80:
            b += 1
        while b < e < len(text) and text[e] & 0xC0 == 0x80:
            e -= 1
        if b < e:
            out.append((b, e))
    return [b for b, _ in out], [e for _, e in out]


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_bytes: int = 50,
    whole_characters: bool = False,
) -> DataFrame:
    """All rows and columns of ``df`` (as struct ``row``), with ``spans`` and ``kept``.

    ``spans`` are the maximal runs of bytes (UTF-8, ``start`` and ``end``) covered by a string of
    ``min_bytes`` bytes that also starts in a document with a smaller id; ``kept`` is the rest of
    the text as bytes.  Matches never cross documents and are judged on the input.  With
    ``whole_characters`` spans are shrunk until no character is cut in two.

    A null text is empty.  Texts shorter than ``min_bytes`` are left alone.  Rows with a null id
    neither lose nor take anything.  Rows of equal ids do not take from each other, whether their
    texts are equal or not.  An empty table yields no rows; other columns travel in ``row``.
    """
    spark = df.sparkSession
    n = partitions(spark)
    names = df.columns
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    rows = flat.select(
        F.col(f"c{names.index(id_col)}").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"c{names.index(text_col)}").cast("string"), F.lit("")).cast("binary").alias("text"),
        F.struct(*flat.columns).alias("row"),
    )
    # Rows without an id have no home of their own and are dealt by their text.
    home = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    rows = rows.withColumn("part", F.pmod(home, F.lit(n)).cast("int"))
    docs = rows.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= min_bytes))
    docs = docs.select("part", "doc_id", "text")

    # Copies: rows whose whole text a smaller id has.  Only digests and ids are shuffled.
    digests = docs.select(
        "part", "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.crc32("text").alias("tag")
    )
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = digests.join(first.filter("n > 1"), "digest").filter("doc_id > first")
    tag = F.unhex(F.lpad(F.hex("tag"), 8, "0"))

    def packed(frame: DataFrame, kind: int) -> DataFrame:
        empty = [F.lit(None).cast("binary").alias(c) for c in _PACKED]
        return frame.select("part", F.lit(kind).alias("kind"), "doc_id", "text", *empty)

    copy_rows = packed(copies.select("part", "doc_id", tag.alias("text")), 1)
    listed = docs.select("part", "doc_id", "text").mapInArrow(_list_minimizers(min_bytes, n), _SCHEMA)
    shared = listed.repartitionById(n, F.col("part")).mapInArrow(_tell_shared(), _SCHEMA)
    at_home = (
        shared.unionByName(copy_rows)
        .unionByName(docs.mapInArrow(_pack_texts(), _SCHEMA))
        .repartitionById(n, F.col("part"))
        .sortWithinPartitions("kind")
    )
    stretches = at_home.mapInArrow(_cut_stretches(min_bytes, n), _SCHEMA)
    marked = stretches.repartitionById(n, F.col("part")).mapInArrow(_find_repeats(min_bytes), _SCHEMA)

    no_row = F.lit(None).cast(rows.schema["row"].dataType).alias("row")
    texts = rows.select(
        "part", F.lit(2).alias("kind"), "doc_id", F.lit(None).cast("binary").alias("text"),
        *[F.lit(None).cast("binary").alias(c) for c in _PACKED], "row",
    )
    final = (
        marked.select("*", no_row)
        .unionByName(copy_rows.select("*", no_row))
        .unionByName(texts)
        .repartitionById(n, F.col("part"))
        .sortWithinPartitions("kind")
    )
    row_type = to_arrow_type(rows.schema["row"].dataType)
    ddl = f"row {rows.schema['row'].dataType.simpleString()}, spans array<struct<start:bigint,end:bigint>>, kept binary"
    out = final.mapInArrow(_remove(min_bytes, row_type, names.index(text_col), whole_characters), ddl)
    renamed = F.struct(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
    doc_id = F.col(f"row.c{names.index(id_col)}").cast("long").alias("doc_id")
    return out.select(renamed.alias("row"), doc_id, "spans", "kept")
