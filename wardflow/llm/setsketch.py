"""Near-duplicate detection with SetSketch registers.

A document is its set of word shingles.  Register ``i`` of its sketch is ``floor(1 - log_b x)`` of
the least of exponential values that a hash gives its shingles: exponentially spaced, truncated
minima.  Sketches merge by the larger register, and two registers agree with about the Jaccard
similarity of the sets.  Bands of registers are hash keys: sets that share a band are candidates.
The joint likelihood of the two sketches, given the known set sizes, then tells whether a pair can
reach the threshold at all, and full sets decide.

Equal sets are one class throughout, however many documents have them.  No pair is written out:
a task that looks at a bucket, or at a group of candidates, returns a spanning forest of what it
found.  Large buckets and groups are cut into chunks, and each two chunks meet in one task.

A group of candidates beyond one chunk is looked at twice.  First each member meets one other, the
smallest that the likelihood gave it, so that a text moves about twice however large the group is.
The largest class that these true links make need not be compared within itself: then only the
members outside of it meet each other and the class, and a group that is one class is done.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import U64, batch, groups, id_and_text, mix64, partitions, strings
from .components import connected_components

BASE, RATE, LIMIT = 1.001, 20.0, 65_534
#: A pair at similarity 0.8 shares no band of 5 equal registers with a chance of 1.2e-7.
BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
#: Standard deviations below the threshold at which the likelihood rules a pair out.
MARGIN = 6.0
#: Members of a bucket, and documents of a candidate group, that one task compares.
BUCKET_CHUNK, GROUP_CHUNK = 2048, 512
MEMO_WORDS = 300_000

_rng = np.random.default_rng(20_240_801)
_FACTOR = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * U64(2) + U64(1)
_SHIFT = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * U64(2)


def words_of(text: str) -> list[bytes]:
    """Words between space, tab and line breaks, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], size: int) -> set:
    """Distinct runs of ``size`` words; the whole sequence if shorter; nothing without words."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(size)], strict=False))


class Sketcher:
    """Hashes of shingle sets and their registers."""

    def __init__(self, size: int):
        self.size = size
        self.memo: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 40:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = value
        return value

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct 64-bit shingle hashes."""
        if not words:
            return np.zeros(0, U64)
        get, new = self.memo.get, self._hash
        each = np.fromiter((get(w) or new(w) for w in words), U64, len(words))
        n = max(1, len(each) - self.size + 1)
        total = np.full(n, len(words) if len(words) < self.size else self.size, U64)
        for i in range(min(self.size, len(each))):
            total = mix64(total * U64(0x9E3779B97F4A7C15) + each[i : i + n])
        return np.unique(total)

    @staticmethod
    def registers(hashes: np.ndarray) -> np.ndarray:
        least = np.full(REGISTERS, np.iinfo(np.uint64).max, U64)
        for at in range(0, len(hashes), 512):
            values = hashes[at : at + 512, None] * _FACTOR + _SHIFT
            np.minimum(least, values.min(axis=0), out=least)
        values = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
        return np.clip(np.floor(1.0 - np.log(values) / np.log(BASE)), 0, LIMIT + 1).astype("<u2")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different for equal registers of different bands."""
    bands = registers.reshape(BANDS, ROWS).astype(U64)
    key = np.arange(BANDS, dtype=U64)
    for i in range(ROWS):
        key = mix64(key * U64(0x9E3779B97F4A7C15) + bands[:, i] + U64(1))
    return key.view(np.int64)


def _likely(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability that one register is larger, and its derivative, for a share ``x``."""
    step = (BASE - 1) / BASE
    inside = np.maximum(1 - x * step, 1e-12)
    return np.maximum(-np.log(inside) / np.log(BASE), 1e-12), step / (np.log(BASE) * inside)


def reaches(
    one: np.ndarray, n_one: int, many: np.ndarray, n_many: np.ndarray, least: float
) -> np.ndarray:
    """Whether the most likely similarity of ``one`` with each of ``many`` is at least ``least``.

    The joint log-likelihood of the numbers of larger, smaller and equal registers is concave in
    the similarity, so the sign of its slope at ``least`` answers without a search.
    """
    larger = (one > many).sum(axis=1)
    smaller = (one < many).sum(axis=1)
    equal = REGISTERS - larger - smaller
    u = n_one / (n_one + n_many)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    at = np.minimum(least, most)
    p, dp = _likely(u - v * at)
    q, dq = _likely(v - u * at)
    slope = -v * larger * dp / p - u * smaller * dq / q
    slope += equal * (v * dp + u * dq) / np.maximum(1 - p - q, 1e-12)
    return (slope >= 0) | (equal == REGISTERS)


def sketch_documents(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_key`` (of the whole set; null if empty), ``registers``, ``bands``."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_shingles", pa.int64()),
            ("set_key", pa.binary()),
            ("registers", pa.binary()),
            ("bands", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(words)
        for rows in batches:
            out: list[list] = [[] for _ in schema]
            for doc, text in zip(rows[0].to_pylist(), strings(rows[1]), strict=True):
                found = words_of(text)
                hashes = sketcher.hashes(found)
                row = (doc, len(shingle_set(found, words)), None, None, None)
                if len(hashes):
                    registers = sketcher.registers(hashes)
                    key = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
                    row = (*row[:2], key, registers.tobytes(), band_keys(registers))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield batch(schema, out)

    return id_and_text(df, id_col, text_col).mapInArrow(
        run,
        "doc_id long, n_shingles long, set_key binary, registers binary, bands array<long>",
    )


def _chunked(rows: DataFrame, key: str, n: str, member: str, chunk: int) -> DataFrame:
    """Rows copied to every pair of chunks of their group that they take part in: ``low``, ``high``.

    A group of up to ``chunk`` members is one chunk and is not copied.  Members keep ``chunk_no``.
    """
    chunks = F.ceil(F.col(n) / chunk).cast("int")
    return (
        rows.withColumn("chunks", F.greatest(chunks, F.lit(1)))
        .withColumn("chunk_no", F.pmod(F.xxhash64(member), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("low", F.least("chunk_no", "other").cast("int"))
        .withColumn("high", F.greatest("chunk_no", "other").cast("int"))
        .drop("other", "chunks")
    )


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _grow(n: int, near) -> list[tuple[int, int]]:
    """A spanning forest of the graph in which ``near(i, others)`` tells the neighbours of ``i``.

    Each member is compared once, with all that no earlier member has reached.
    """
    left, edges = np.arange(n), []
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            i = front.pop()
            hit = near(i, left)
            found = left[hit]
            edges += [(i, int(j)) for j in found]
            front += found.tolist()
            left = left[~hit]
    return edges


def _distinct_buckets(keys: DataFrame) -> DataFrame:
    """``key`` and ``n`` of the buckets of several members; of those with the same members, one.

    Buckets count as the same if their number, least and largest member and two 64-bit digests of
    all members agree: an order-free xor, and the sums of both halves of a hash of another seed.
    For two members that is exact.  A member may be in a bucket more than once, which the sums tell.
    """
    other = F.xxhash64(F.lit(1), "rep")
    digests = {
        "first": F.min("rep"),
        "last": F.max("rep"),
        "mixed": F.bit_xor(F.xxhash64("rep")),
        "upper": F.sum(F.shiftright(other, 32)),
        "lower": F.sum(other.bitwiseAND(F.lit(0xFFFFFFFF))),
    }
    return (
        keys.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), *[v.alias(k) for k, v in digests.items()])
        .filter("n > 1")
        .groupBy("n", *digests)
        .agg(F.min("key").alias("key"))
        .select("key", "n")
    )


def _candidate_edges(classes: DataFrame, least: float, ratio: float) -> DataFrame:
    """Spanning forests, per bucket, of pairs that share a band and may reach the threshold."""
    n = partitions(classes.sparkSession)
    keys = classes.select("rep", F.explode("bands").alias("key"))
    buckets = _distinct_buckets(keys)
    rows = _chunked(keys.join(buckets.hint("merge"), "key"), "key", "n", "rep", BUCKET_CHUNK)
    sketches = classes.select("rep", "registers", "n_shingles")
    rows = rows.join(sketches.hint("merge"), "rep")
    rows = (
        rows.select("key", "low", "high", "rep", "registers", "n_shingles")
        .repartition(n, "key", "low", "high")
        .sortWithinPartitions("key", "low", "high", "rep")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, 3):
            ids = rows[3].to_numpy()
            sketches = np.frombuffer(b"".join(rows[4].to_pylist()), "<u2").reshape(len(ids), -1)
            sizes = rows[5].to_numpy().astype(np.float64)

            def near(i, others, sketches=sketches, sizes=sizes):
                fits = np.minimum(sizes[i], sizes[others]) >= ratio * np.maximum(sizes[i], sizes[others])
                hit = np.zeros(len(others), bool)
                at = others[fits]
                hit[fits] = reaches(sketches[i], sizes[i], sketches[at], sizes[at], least)
                return hit

            edges = _grow(len(ids), near)
            if edges:
                yield batch(_LINKS, ids[np.array(edges).T])

    return rows.mapInArrow(run, "a long, b long")


def _members(candidates: DataFrame, edges: DataFrame) -> DataFrame:
    """Members of candidate groups: ``rep``, ``component`` and its size ``n``, and their first look.

    ``hub`` is the smallest member that an edge leads to, if smaller than ``rep``; ``n_leaves`` is
    the number of members with that hub, ``n_own`` of those whose hub is ``rep``.
    """
    sizes = candidates.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    ends = edges.select(F.greatest("a", "b").alias("rep"), F.least("a", "b").alias("hub"))
    hubs = ends.groupBy("rep").agg(F.min("hub").alias("hub"))
    fan = hubs.groupBy("hub").agg(F.count(F.lit(1)).alias("n_leaves"))
    own = fan.select(F.col("hub").alias("rep"), F.col("n_leaves").alias("n_own"))
    return (
        candidates.withColumnRenamed("vertex", "rep")
        .join(sizes, "component")
        .join(hubs.join(fan, "hub"), "rep", "left")
        .join(own, "rep", "left")
    )


def _chunks(n: str) -> Column:
    return F.ceil(F.col(n) / GROUP_CHUNK).cast("int")


def _dealt(member: str, chunks: Column) -> Column:
    return F.pmod(F.xxhash64(member), F.greatest(chunks, F.lit(1))).cast("int")


def _first_links(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """True links between members and their hubs, for groups of more than a chunk.

    The leaves of a hub are dealt to chunks of their own; only the hub's text goes to each of them.
    """
    n = partitions(texts.sparkSession)
    large = texts.filter(F.col("n") > GROUP_CHUNK)
    leaves = large.filter("hub is not null").select(
        "hub", _dealt("rep", _chunks("n_leaves")).alias("chunk"), F.lit(1).alias("leaf"), "rep", "text"
    )
    heads = large.filter("n_own is not null").select(
        F.col("rep").alias("hub"),
        F.explode(F.sequence(F.lit(0), _chunks("n_own") - 1)).alias("chunk"),
        F.lit(0).alias("leaf"),
        "rep",
        "text",
    )
    rows = (
        leaves.unionByName(heads)
        .repartition(n, "hub", "chunk")
        .sortWithinPartitions("hub", "chunk", "leaf", "rep")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, 2):
            heads, found = [], []
            columns = rows[2].to_pylist(), rows[3].to_pylist(), strings(rows[4])
            for leaf, rep, text in zip(*columns, strict=True):
                mine = shingle_set(words_of(text), words)
                if not leaf:
                    heads.append(mine)
                    continue
                both = ((len(mine & head), len(mine) + len(head)) for head in heads)
                if any(100 * same >= percent * (total - same) for same, total in both):
                    found.append(rep)
            if found:
                yield batch(_LINKS, ([rows[0][0].as_py()] * len(found), found))

    return rows.mapInArrow(run, "a long, b long")


def _open_members(members: DataFrame, first: DataFrame) -> DataFrame:
    """Members of large groups that the first look left open, with ``n_main``, ``n_rest`` and ``main``.

    Groups of one class are done.  If the largest class of one exceeds a chunk it is ``main``, with
    the smaller label if two are as large; all others are the rest.
    """
    of_class = connected_components(first).select(F.col("vertex").alias("rep"), F.col("component").alias("class"))
    looked = (
        members.filter(F.col("n") > GROUP_CHUNK)
        .select("component", "rep")
        .join(of_class, "rep", "left")
        .select("component", "rep", F.coalesce("class", "rep").alias("class"))
    )
    classes = looked.groupBy("component", "class").agg(F.count(F.lit(1)).alias("n_class"))
    top = F.min(F.struct((-F.col("n_class")).alias("less"), F.col("class")))
    groups_left = (
        classes.groupBy("component")
        .agg(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("classes"), top.alias("top"))
        .filter("classes > 1")
        .select("component", "n", F.when(-F.col("top.less") > GROUP_CHUNK, F.col("top")).alias("top"))
    )
    n_main = F.coalesce(-F.col("top.less"), F.lit(0))
    return looked.join(groups_left, "component").select(
        "component",
        "rep",
        n_main.alias("n_main"),
        (F.col("n") - n_main).alias("n_rest"),
        F.coalesce(F.col("class") == F.col("top.class"), F.lit(False)).alias("main"),
    )


def _met_in_chunks(rows: DataFrame) -> DataFrame:
    """Members copied to every two chunks in which they are compared: ``low`` and ``high``.

    Chunks of the main class meet those of the rest, chunks of the rest meet all but themselves;
    a group of one chunk meets itself.
    """
    m, r = _chunks("n_main"), _chunks("n_rest")
    own = F.when(F.col("main"), _dealt("rep", m)).otherwise(m + _dealt("rep", r))
    other = F.explode(F.sequence(F.when(F.col("main"), m).otherwise(F.lit(0)), m + r - 1))
    return (
        rows.select("*", own.alias("own"), (m + r).alias("chunks"), other.alias("other"))
        .filter("own <> other or chunks = 1")
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
    )


def _verified_links(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Spanning forests of the true links within candidate groups, from full sets of shingles.

    ``texts`` has the columns of :func:`_open_members` and ``text``; small groups are all rest.
    """
    n = partitions(texts.sparkSession)
    rows = (
        _met_in_chunks(texts)
        .select("component", "low", "high", "rep", "text")
        .repartition(n, "component", "low", "high")
        .sortWithinPartitions("component", "low", "high", "rep")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, 3):
            ids = rows[3].to_numpy()
            number: dict[tuple, int] = {}
            sets = [
                np.fromiter((number.setdefault(s, len(number)) for s in found), np.int64, len(found))
                for found in (shingle_set(words_of(t), words) for t in strings(rows[4]))
            ]
            sizes = np.array([len(s) for s in sets])
            flat = np.concatenate(sets)
            ends = np.concatenate([[0], np.cumsum(sizes)])

            def near(i, others, sets=sets, sizes=sizes, flat=flat, ends=ends, total=len(number)):
                mask = np.zeros(total, np.int64)
                mask[sets[i]] = 1
                if 4 * len(others) > len(sizes):
                    both = np.add.reduceat(mask[flat], ends[:-1])[others]
                else:
                    both = np.array([mask[sets[j]].sum() for j in others])
                return 100 * both >= percent * (sizes[i] + sizes[others] - both)

            edges = _grow(len(ids), near)
            if edges:
                yield batch(_LINKS, ids[np.array(edges).T])

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Documents are linked if ``100 * |A & B| >= percent * |A | B|`` for their sets of ``words``-word
    shingles; ``component_id`` is the smallest id that links lead to, and that document is kept.

    A text of fewer words is one shingle; a null, empty or blank text has an empty set and is
    linked with nothing.  Rows with equal ids are one document as far as links go, and each has its
    row.  Rows with a null id join their group but never name it; a group of null ids only has a
    null component and is kept.  An empty table yields no rows; other columns are ignored.
    """
    sketched = materialise(sketch_documents(df, id_col, text_col, words), "sketches")
    classes = (
        sketched.filter("set_key is not null and doc_id is not null")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("rep"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("registers").alias("registers"),
            F.first("bands").alias("bands"),
        )
    )
    classes = materialise(classes, "sketch-classes")
    share = percent / 100
    least = share - MARGIN * (share * (1 - share) / REGISTERS) ** 0.5
    edges = materialise(_candidate_edges(classes, max(least, 0.0), share), "sketch-edges")
    members = materialise(_members(connected_components(edges), edges), "sketch-members")
    # Nothing here has a bound on its size, so nothing is broadcast, however few rows there are.
    texts = id_and_text(df, id_col, text_col).withColumnRenamed("doc_id", "rep")
    texts = materialise(texts.join(members.hint("merge"), "rep"), "sketch-texts")
    first = materialise(_first_links(texts, words, percent), "sketch-links")
    small = texts.filter(F.col("n") <= GROUP_CHUNK).select(
        "component", "rep", F.lit(0).cast("long").alias("n_main"), F.col("n").alias("n_rest"), F.lit(False).alias("main"), "text"
    )
    large = texts.filter(F.col("n") > GROUP_CHUNK).select("rep", "text")
    large = large.join(_open_members(members, first).hint("merge"), "rep")
    met = _verified_links(small.unionByName(large), words, percent)
    links = connected_components(first.unionByName(met))
    of_class = classes.join(links, classes["rep"] == links["vertex"], "left").select(
        "set_key", "rep", F.coalesce("component", "rep").alias("component")
    )
    # Rows of one set may be a large share of all: AQE splits them, the other side has one row.
    joined = sketched.select("doc_id", "n_shingles", "set_key").join(of_class.hint("merge"), "set_key", "left")
    component = F.coalesce("component", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )
