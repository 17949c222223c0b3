"""Shared pieces of the training-data operators: shared-folder tables, text hashing, connected components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than these (fixed values of the contracts).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

MASK = (1 << 64) - 1


# --- tables in the shared folder -------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or an own one where it is unset."""
    context = spark.sparkContext
    found = context._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    named = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="weirgate-")
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


#: Whether Spark deletes a statement's shuffle files when the statement has ended.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back, which cuts its lineage.

    Nothing reads the write's shuffle files afterwards, so they go with its end; until then lost ones are made again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(RELEASE)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def only(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, whatever else the table has."""
    return docs.select(*(docs[n] for n in names))


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# --- vectorised hashing of words and shingles ------------------------------------------------

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, MASK, 256, dtype=np.uint64, endpoint=True)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_MIX = [int(x) | 1 for x in _rng.integers(1, MASK, 64, dtype=np.uint64)]
_CHUNK = 1 << 19
_powers: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, _CHUNK + 1)
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in (_BASE, _BASE_INV)]
    return _powers


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 byte offsets; null counts as empty."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the n + 1 word offsets of the texts."""
    inside = _IS_WORD[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash for each word: a polynomial of random byte values, scrambled with the length."""
    table = _LOWER if lower else _BYTE
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + _CHUNK, "right")))
        s, e = starts[at:to] - base, ends[at:to] - base
        power, inverse = _power_tables(int(e[-1]) + 1)
        total = np.zeros(int(e[-1]) + 1, np.uint64)
        np.cumsum(table[data[base : base + int(e[-1])]] * power[: int(e[-1])], out=total[1:])
        out[at:to] = mix64((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(_MIX[63]))
        at = to
    return out


def hashed_words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a string column, and the n + 1 word offsets of its rows."""
    data, offsets = text_buffer(column)
    starts, ends, at = word_spans(data, offsets)
    return word_hashes(data, starts, ends, lower), at


def slices(column: pa.Array, most: int = 1 << 22) -> list[pa.Array]:
    """The column in stretches of at most so many bytes, or one row."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_string())
    offsets, out, a = text_buffer(column)[1], [], 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        out.append(column.slice(a, b - a))
        a = b
    return out


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Each text's sorted distinct k-word shingle hashes; with fewer words, the whole sequence as one."""
    return [s for part in slices(column) for s in _shingle_sets(part, k)]


def _shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    h, at = hashed_words(column)
    rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k):
        rolled += h[j : len(h) - k + 1 + j] * np.uint64(_MIX[j])
    rolled = mix64(rolled)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            whole = sum(int(x) * _MIX[j + 32] for j, x in enumerate(h[a:b])) + int(b - a) * _MIX[31]
            out.append(mix64(np.array([whole & MASK], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


# --- connected components ---------------------------------------------------------------------


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest reachable id of every node that has an edge.

    edges: two long columns a and b; direction, repeats and self-loops do not matter. Returns (node, component).
    Alternates the large-star and small-star rewrites until the edge set is a set of stars. Each round is written to the
    shared folder; minima are summed before the shuffle and joined as a table of their own, so that a hub's edges can be
    split over tasks.
    """
    spark = edges.sparkSession
    a, b = F.col("a"), F.col("b")
    nodes = edges.select(a.alias("node")).union(edges.select(b.alias("node")))
    cur = materialize(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), name)
    nodes = materialize(nodes.where("node is not null").distinct(), f"{name}-nodes")

    def star(df: DataFrame, large: bool) -> DataFrame:
        # large: neighbours on both sides of a node, those above it move to the least; small: those below it move.
        near = df.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            near = near.union(df.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = materialize(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-min")
        joined = near.join(least, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return materialize(out.where("a != b").distinct(), name)

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    was = mark(cur)
    while was[0]:
        cur = star(star(cur, True), False)
        now = mark(cur)
        if now == was:
            break
        was = now
    stars = cur.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    return nodes.join(stars, "node", "left").select("node", F.coalesce("least", "node").alias("component"))
