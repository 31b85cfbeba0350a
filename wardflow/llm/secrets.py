"""Secret scans: base patterns, and guess-cost dynamic programming over values in credential context.

The base patterns find assignments, access keys and long hexadecimal runs whatever they hold.  The
method then takes every value that stands where a credential would (after a word such as
``password`` and a separator, or as the password of a URL) and asks how many guesses the cheapest
way to build it takes: dynamic programming cuts the value into words, dates, repeats of what
precedes, keyboard walks and brute-force spans, so that the sum of their costs in bits is least.
Values of a high least cost are spans of kind ``guess``; ``password: summer2019`` is not one.

The words are the letter pieces of public vocabularies, by rank: they are a list of a fixed size
that does not change with the documents, so a secret that thousands of documents copy does not
become a common word.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import accumulate
from math import comb, log2

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, id_and_text, strings

#: Kinds of spans, in the order in which those of one start are listed.
KINDS = ("assign", "access", "hex", "guess")
#: Least cost of a secret in bits; letters alone, as words of any language are, need more.
MIN_BITS, MIN_LETTER_BITS = 40.0, 80.0
#: Longest repeated unit; walks and repeats shorter than this many characters are not worth a name.
MAX_UNIT, MIN_RUN = 16, 3

# The base patterns and the least lengths that their contract states.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, as those of [0-9a-f]+
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

#: Words before a credential.  A letter before them makes another word, but for camel case.
CONTEXT_WORDS = (
    "password passwd passphrase passcode pwd secret token credential credentials "
    "api_key api-key apikey access_key access-key accesskey private_key private-key privatekey "
    "authorization bearer"
).split()
_CAMEL = "|".join(re.escape(w[0].upper() + w[1:]) for w in CONTEXT_WORDS)
_ANY_CASE = "|".join(re.escape(w) for w in CONTEXT_WORDS)
CONTEXT = re.compile(
    rf"""(?:(?<![A-Za-z])(?i:{_ANY_CASE})|(?<=[a-z])(?:{_CAMEL}))(?![A-Za-z])["']?[\x20\t]{{0,8}}"""
    r"""(?:=>|:=|[:=]|(?i:is)(?=[\x20\t]))[\x20\t]*(?i:(?:bearer|basic)[\x20\t]+)?"""
    r"""(?:"([^"\r\n]+)"|'([^'\r\n]+)'|["']?([^\s"'<>,;]+))""",
    re.ASCII,
)
URL = re.compile(r"://[^\s/:@]*:([^\s/@]+)@")
_HINTS = ("pass", "pwd", "secret", "token", "credential", "key", "authorization", "bearer")

_PLAIN = {ord("@"): "a", ord("$"): "s"} | {ord(c): p for c, p in zip("013457", "oleast", strict=True)}
_ROWS = ("`1234567890-=", "\tqwertyuiop[]\\", "\tasdfghjkl;'", "\tzxcvbnm,./")
_UNSHIFTED = {ord(s): p for s, p in zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./", strict=True)}
_PLACE = {key: (r, c) for r, row in enumerate(_ROWS) for c, key in enumerate(row) if key != "\t"}
_DATES = [
    (re.compile(r"(?:19|20)\d\d"), log2(200)),
    (re.compile(r"(?:19|20)?\d\d([-/._ ]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])"), log2(366 * 200) + 2),
    (re.compile(r"(?:0?[1-9]|[12]\d|3[01])([-/._ ]?)(?:0?[1-9]|1[0-2])\1(?:19|20)?\d\d"), log2(366 * 200) + 2),
    (re.compile(r"(?:0?[1-9]|1[0-2])([-/._ ]?)(?:0?[1-9]|[12]\d|3[01])\1(?:19|20)?\d\d"), log2(366 * 200) + 2),
]
#: Bits to say of which of the five kinds a segment is.
KIND_BITS = log2(5)


def load_words(paths: list[str]) -> dict[str, int]:
    """Letter pieces of rank files (a base64 token and its rank a line), with their best rank."""
    words: dict[str, int] = {}
    for path in paths:
        with open(path, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                try:
                    word = base64.b64decode(token).decode().strip().lower()
                except UnicodeDecodeError:
                    continue
                if len(word) >= 3 and word.isalpha():
                    words[word] = min(int(rank) + 1, words.get(word, 1 << 30))
    return words


def _lowered(value: str) -> str:
    """Lower case, character by character, so that positions stay."""
    return "".join(low if len(low := c.lower()) == 1 else c for c in value)


class GuessCost:
    """Least cost in bits of building a value from parts that a guesser would try."""

    def __init__(self, words: dict[str, int]):
        self.automaton = ahocorasick.Automaton()
        for word, rank in words.items():
            self.automaton.add_word(word, (len(word), log2(rank)))
        if words:
            self.automaton.make_automaton()
        self.has_words = bool(words)

    @staticmethod
    def _case_bits(part: str) -> float:
        upper = sum(c.isupper() for c in part)
        if not upper:
            return 0.0
        if upper == len(part) or (upper == 1 and part[0].isupper()):
            return 1.0
        few = min(upper, len(part) - upper)
        return log2(sum(comb(len(part), i) for i in range(1, few + 1)) + 1)

    def _words(self, value: str) -> Iterator[tuple[int, int, float]]:
        if not self.has_words:
            return
        low = _lowered(value)
        plain = low.translate(_PLAIN)
        for text in [low] if low == plain else [low, plain]:
            for last, (length, bits) in self.automaton.iter(text):
                start, end = last + 1 - length, last + 1
                changed = sum(a != b for a, b in zip(low[start:end], text[start:end], strict=True))
                yield start, end, bits + changed + self._case_bits(value[start:end])

    @staticmethod
    def _dates(value: str) -> Iterator[tuple[int, int, float]]:
        for pattern, bits in _DATES:
            for start, c in enumerate(value):
                if "0" <= c <= "9" and (found := pattern.match(value, start)):
                    yield start, found.end(), bits

    @staticmethod
    def _repeats(value: str) -> Iterator[tuple[int, int, float]]:
        """Copies of the unit before them; the first unit is paid for by other parts."""
        for unit in range(1, min(MAX_UNIT, len(value) - 1) + 1):
            run = 0
            for at in range(unit, len(value)):
                run = run + 1 if value[at] == value[at - unit] else 0
                if run >= max(unit, MIN_RUN - 1):
                    yield at + 1 - run, at + 1, log2(MAX_UNIT) + log2(run)

    @staticmethod
    def _walks(value: str) -> Iterator[tuple[int, int, float]]:
        """Runs of neighbouring keys: from the start of the run and from its last turn."""
        keys = _lowered(value).translate(_UNSHIFTED)
        shifts = [0, *accumulate(a != b for a, b in zip(value, keys, strict=True))]
        begin = straight = turns = 0
        step = None
        for at in range(1, len(value)):
            a, b = _PLACE.get(keys[at - 1]), _PLACE.get(keys[at])
            move = (b[0] - a[0], b[1] - a[1]) if a and b else None
            # Rows are set off by half a key: up and right, or down and left, touch too.
            if move not in ((0, 1), (0, -1), (1, 0), (-1, 0), (1, -1), (-1, 1)):
                begin = straight = at
                step, turns = None, 0
                continue
            if step is not None and move != step:
                turns += 1
                straight = at - 1
            step = move
            for start, bends in {(begin, turns), (straight, 0)}:
                length = at + 1 - start
                if length >= MIN_RUN:
                    bits = log2(47) + (bends + 1) * (log2(6) + log2(length))
                    yield start, at + 1, bits + shifts[at + 1] - shifts[start]

    def parts(self, value: str) -> Iterator[tuple[int, int, float]]:
        """Segments ``(start, end, bits)`` that have a cheaper description than their characters."""
        yield from self._words(value)
        yield from self._dates(value)
        yield from self._repeats(value)
        yield from self._walks(value)

    @staticmethod
    def character_bits(value: str) -> float:
        """Cost of a character by brute force, over the classes that the value uses."""
        size = 0
        for least, most, n in (("0", "9", 10), ("a", "z", 26), ("A", "Z", 26)):
            size += n * any(least <= c <= most for c in value)
        size += 33 * any(c < "\x80" and not c.isalnum() for c in value)
        size += 128 * any(c >= "\x80" for c in value)
        return log2(max(size, 2))

    def bits(self, value: str) -> float:
        """The least cost over all segmentations; two states per end: closed, or in brute force."""
        ends: dict[int, list[tuple[int, float]]] = {}
        for start, end, bits in self.parts(value):
            ends.setdefault(end, []).append((start, bits + KIND_BITS))
        each = self.character_bits(value)
        closed, brute = [0.0], [float("inf")]
        for end in range(1, len(value) + 1):
            least = float("inf")
            for start, bits in ends.get(end, ()):
                least = min(least, bits + min(closed[start], brute[start]))
            brute.append(each + min(brute[-1], closed[-1] + KIND_BITS))
            closed.append(least)
        return min(closed[-1], brute[-1])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the base patterns as ``(kind, start, end)``, per kind from left to right."""
    low = text.lower()
    found = []
    if any(w in low for w in ("passw", "secret", "token", "key")):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append(("assign", m.start(), m.end()))
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def context_values(text: str) -> list[tuple[int, int]]:
    """Where values in credential context stand: disjoint, from left to right."""
    low = text.lower()
    found = []
    if any(w in low for w in _HINTS):
        for m in CONTEXT.finditer(text):
            start, end = m.span(m.lastindex)
            while end > start and m.lastindex == 3 and text[end - 1] in ".)]}":
                end -= 1  # the end of a sentence or of brackets around it
            found.append((start, end))
    if "://" in text:
        found += [m.span(1) for m in URL.finditer(text)]
    kept: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if start < end and (not kept or start >= kept[-1][1]):
            kept.append((start, end))
    return kept


def is_secret(value: str, bits: float, min_bits: float, min_letter_bits: float) -> bool:
    letters = value.isalpha() and value[1:] == value[1:].lower()
    return bits >= (min_letter_bits if letters else min_bits)


def find_spans(
    text: str, cost: GuessCost, min_bits: float = MIN_BITS, min_letter_bits: float = MIN_LETTER_BITS
) -> list[tuple[str, int, int, float | None]]:
    """All spans by start, then kind; those of kind ``guess`` have their cost in bits."""
    spans = [(*s, None) for s in base_spans(text)]
    for start, end in context_values(text):
        value = text[start:end]
        bits = cost.bits(value)
        if is_secret(value, bits, min_bits, min_letter_bits):
            spans.append(("guess", start, end, bits))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


_SPAN = "struct<kind:string,start:bigint,end:bigint,bits:double,value:string>"
_SPAN_ARROW = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("bits", pa.float64()),
            ("value", pa.string()),
        ]
    )
)


def scan_secrets(
    df: DataFrame,
    word_paths: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    min_bits: float = MIN_BITS,
    min_letter_bits: float = MIN_LETTER_BITS,
) -> DataFrame:
    """``doc_id`` and ``spans`` of every row: kind, start and end (code points), bits and value.

    Spans are ordered by start, then by the order of ``KINDS``; those of different kinds may
    overlap, those of one kind do not.  ``bits`` is null but for ``guess``.  A value in quotes runs
    to the closing quote, another to white space, a quote, ``<``, ``>``, a comma or a semicolon.

    A null or empty text has no spans; null ids are kept; equal ids or texts are scanned each on
    their own; an empty table yields no rows; other columns are ignored.  Time is in proportion to
    the length of texts and of values, however long.  Nothing is shuffled.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("spans", _SPAN_ARROW)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = GuessCost(load_words(word_paths))
        for rows in batches:
            found = [
                [
                    {"kind": k, "start": s, "end": e, "bits": b, "value": text[s:e]}
                    for k, s, e, b in find_spans(text, cost, min_bits, min_letter_bits)
                ]
                for text in strings(rows[1])
            ]
            yield batch(schema, (rows[0].to_pylist(), found))

    return id_and_text(df, id_col, text_col).mapInArrow(run, f"doc_id long, spans array<{_SPAN}>")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def digest_spans(found: DataFrame) -> DataFrame:
    """The counts and digests that the query returns, of a result of :func:`scan_secrets`."""
    def of(kind: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(span_list(base).cast("binary"), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
        F.size(of("guess")).cast("long").alias("n_guess"),
        F.array_max(F.transform(of("guess"), lambda s: s["bits"])).alias("max_bits"),
    )
