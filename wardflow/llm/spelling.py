"""Spelling variants: words one edit apart, found with asymmetric q-chunks.

A word is cut into two disjoint chunks that cover it.  One insertion, deletion or replacement hits
one of them; the other chunk is a gram of the changed word, at its own place or, behind the edit,
at one place further.  So each word contributes its two chunks under its own length, and under the
lengths of shorter words the grams that a chunk can meet within shift one; rows of one key meet in
a task, which checks whole words with a hash table of the places that may differ instead of
comparing all with all.

A key that too many words share is cut again: its words agree outside an interval, the interval is
halved, and one edit leaves one half alone.  That goes on, for those words only, until a group is
small or its interval is one character, which bounds it.  Every pair is found in exactly one group.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import batch, dealt, groups, id_and_text, partitions, strings

#: Code points of the shortest word, and occurrences of the rarest.
MIN_LENGTH, MIN_COUNT = 7, 2
#: A form occurs at least this many times as often as its variant.
RATIO = 10
#: One run in so many loses a character before it counts.
EVERY = 31
#: Rows of a key that one task takes as a group; larger ones are cut again.
GROUP_ROWS = 20_000
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 200_000

def altered(tag: int, run: bytes, every: int = EVERY) -> bytes:
    """``run`` (Latin-1), or what is left of it if its checksum has it lose a character.

    ``tag`` is the checksum of the document's id and a colon, which the run continues.
    """
    if not every:
        return run
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), tag)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    every: int = EVERY,
) -> DataFrame:
    """``word`` and ``n``, its occurrences in all documents; null texts and null ids count as empty."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    # A run that is long enough after losing a character is long enough before.
    long_runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % min_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def flushed() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in total]
            return batch(schema, (words, total.values()))

        for rows in batches:
            for doc, text in zip(rows[0].to_pylist(), strings(rows[1]), strict=True):
                tag = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                # Letters up to U+00FF are single bytes in Latin-1; all else becomes "?".
                found = Counter(long_runs.findall(text.encode("latin-1", "replace").lower()))
                for word, n in found.items():
                    word = altered(tag, word, every)
                    if len(word) >= min_length:
                        total[word] = total.get(word, 0) + n
            if len(total) >= COUNTED_WORDS:
                yield flushed()
                total = {}
        yield flushed()

    counted = id_and_text(df, id_col, text_col).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _keyed(rows: DataFrame, lo, hi) -> DataFrame:
    """The key of what a word keeps outside ``[lo, hi)`` of the chunk word, which has ``size``."""
    rows = rows.withColumn("lo", lo).withColumn("hi", hi)
    # A gram behind the edit is ``shift`` further.
    rest = F.substr("word", F.col("hi") + F.col("shift") + 1)
    kept = F.substr("word", F.lit(1), F.col("lo"))
    return rows.withColumn("key", F.xxhash64("size", "lo", "hi", kept, rest))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row twice: one half of its interval kept, then the other."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    parts = F.array(F.struct(middle.alias("a"), F.col("hi").alias("b")), F.struct(F.col("lo").alias("a"), middle.alias("b")))
    rows = rows.withColumn("part", F.explode(parts))
    return _keyed(rows, F.col("part.a"), F.col("part.b")).select("key", "size", "lo", "hi", "shift", "word", "n")


_NEAR = pa.schema(
    [("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]
)


def _better(a: tuple[int, str] | None, b: tuple[int, str]) -> tuple[int, str]:
    """The larger number, and of equal ones the smaller word."""
    return b if a is None or (-b[0], b[1]) < (-a[0], a[1]) else a


class Group:
    """Words that agree outside the interval ``[lo, hi)`` of words of length ``size``."""

    def __init__(self, size: int, lo: int, hi: int, chunks: dict[str, int], grams: dict[str, int]):
        self.size, self.lo, self.hi, self.chunks, self.grams = size, lo, hi, chunks, grams
        self.count: dict[str, int] = {}
        self.best: dict[str, tuple[int, str]] = {}

    def _note(self, word: str, n: int, other: tuple[int, str]) -> None:
        self.count[word] = self.count.get(word, 0) + n
        self.best[word] = _better(self.best.get(word), other)

    def replaced(self) -> None:
        """Words alike but for the character at one place are all near each other."""
        for at in range(self.lo, self.hi):
            alike: dict[str, list[str]] = {}
            for word in self.chunks:
                alike.setdefault(word[:at] + word[at + 1 :], []).append(word)
            for words in alike.values():
                if len(words) > 1:
                    # The best two suffice: the best of all others is one of them.
                    first, second = sorted((-self.chunks[w], w) for w in words)[:2]
                    for word in words:
                        n, best = second if word == first[1] else first
                        self._note(word, len(words) - 1, (-n, best))

    def inserted(self) -> None:
        """Longer words that lose one character; of a run of equal characters, the last."""
        ends = self.hi + (self.hi == self.size)
        for gram, n in self.grams.items():
            for at in range(self.lo, ends):
                if at + 1 == len(gram) or gram[at] != gram[at + 1]:
                    short = gram[:at] + gram[at + 1 :]
                    short_n = self.chunks.get(short)
                    if short_n is not None:
                        self._note(gram, 1, (short_n, short))
                        self._note(short, 1, (n, gram))

    def near(self) -> Iterator[tuple[str, int, int, str]]:
        if len(self.chunks) > 1:
            self.replaced()
        if self.chunks and self.grams:
            self.inserted()
        for word, count in self.count.items():
            yield word, count, *self.best[word]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for rows in groups(batches, 4):
        if rows.num_rows < 2:
            continue
        size, lo, hi = (rows[i][0].as_py() for i in (1, 2, 3))
        sides: tuple[dict, dict] = ({}, {})
        for shift, word, n in zip(*(rows[i].to_pylist() for i in (4, 5, 6)), strict=True):
            sides[shift][word] = n
        out += Group(size, lo, hi, *sides).near()
        if len(out) >= 8192:
            yield batch(_NEAR, zip(*out, strict=True))
            out = []
    if out:
        yield batch(_NEAR, zip(*out, strict=True))


def near_words(words: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``word``, ``n_near``, ``best`` and ``best_n`` of every word that has a near one.

    ``words`` has distinct ``word`` of two code points at least and ``n``; ``best`` is the near word
    of largest ``n`` (ties: smallest).
    """
    n = partitions(words.sparkSession)
    length = F.length("word")
    # As a chunk word under its own length, and as a gram word under the length of shorter ones.
    roles = F.array(
        F.struct(length.alias("size"), F.lit(0).alias("shift")),
        F.struct((length - 1).alias("size"), F.lit(1).alias("shift")),
    )
    rows = words.withColumn("role", F.explode(roles)).select("word", "n", "role.size", "role.shift")
    rows = _halves(rows.withColumn("lo", F.lit(0)).withColumn("hi", F.col("size")))
    group = ["key", "size", "lo", "hi"]
    found = []
    while True:
        rows = materialise(rows, "word-keys")
        # Only groups that can be cut again and are too large; one row each, so few.
        large = rows.filter(F.col("hi") - F.col("lo") > 1).groupBy(*group).count()
        large = materialise(large.filter(F.col("count") > group_rows).select(*group), "large-keys")
        small = rows.join(large, group, "left_anti")
        small = dealt(small, n, *group).sortWithinPartitions(*group)
        found.append(small.select(*rows.columns).mapInArrow(_verify, "word string, near long, best_n long, best string"))
        if large.isEmpty():
            break
        rows = _halves(rows.join(large, group, "left_semi"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    least = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return (
        every.groupBy("word")
        .agg(F.sum("near").alias("n_near"), least.alias("least"))
        .select("word", "n_near", F.col("least.best").alias("best"), (-F.col("least.m")).alias("best_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: where the links ``word`` to ``form`` end, by doubling their reach.

    Links have no cycle, as a form occurs more often than its word.
    """
    reach = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = reach.join(further.hint("merge"), "root", "left")
        joined = joined.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        reach = materialise(joined, "roots")
        if reach.filter("moved").isEmpty():
            return reach.select("word", "root")


def spelling_variants(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    every: int = EVERY,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of the documents.

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with only A-Z lowered; one run in ``every``
    (by a checksum of document and run; 0 switches that off) loses a character first.  Two words are
    near if one inserted, deleted or replaced character parts them; ``form`` is the near word of
    largest ``n`` (ties: smallest in code-point order) if it occurs ``ratio`` times as often, and
    ``root`` is where forms lead.

    Null and empty texts have no words; a null id counts as empty in the checksum; equal ids and
    texts count each time; an empty table yields no rows; other columns are ignored.
    """
    if min_length < 2 or ratio < 2:
        raise ValueError("words need two characters, and forms must occur more often than variants")
    counted = count_words(df, id_col, text_col, min_length, min_count, every)
    words = materialise(counted, "words")
    found = near_words(words, group_rows)
    is_form = F.col("best_n") >= ratio * F.col("n")
    joined = words.join(found.hint("merge"), "word", "left").select(
        "word",
        F.when(is_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    joined = materialise(joined, "word-forms")
    ends = roots(joined.filter("form is not null"))
    return joined.join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
