"""Embedding near-dedup with randomised-rotation binary codes.

A vector is normalised and rotated by a random orthogonal matrix; its code is the signs of the result, stored with the
inner product <code, vector>. For a query q, <code, q> / <code, vector> estimates <vector, q> without bias, and its error
exceeds SIGMA * sqrt((1 - c^2) / c^2) / sqrt(dim - 1), c = <code, vector>, with a probability that falls as
exp(-SIGMA^2 / 2). Pairs whose upper bound reaches the threshold are computed again exactly, in double precision; no pair
is linked by its estimate.

Which pairs are estimated at all: leaders, a bounded sample of the vectors thinned to be unlike one another, split the
space. Each vector is at home with its nearest leader and visits every leader whose cosine is at most MARGIN below the
nearest one's, so a pair is met once in each direction, at one's home when the other visits. A pair of cosine s differs
in its leaders' cosines by about sqrt(2 - 2 * s) / sqrt(dim) times a normal variable, which MARGIN exceeds severalfold
(short vectors have a wider margin, see margin());
recall is measured against brute force in the tests. Vectors that are equal in every component are one with a count, and
homes and visits of a leader are dealt in blocks of BLOCK, so that a frequent vector or a crowded leader is no single
task's. Only counts and one row for each vector and block leave a block, never its pairs.

Each length is routed and compared by itself, with leaders, a rotation and components of its own, one after another.

Defined results: vectors of different lengths don't link; vectors that are null, zero, or that hold null or non-finite
components link with nothing; repeated rows of an id count as vectors of their own and share the id's row values; an empty table gives
an empty table; other columns, labels among them, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialize, only

#: Vectors that leaders are chosen from, and the most leaders; vectors for each leader while fewer suffice.
SAMPLE, LEADERS, PER_LEADER = 16384, 4096, 200
#: Leaders are less alike than this.
APART = 0.7
#: How far below the nearest leader's cosine a visited leader's may be.
MARGIN = 0.16
#: Standard deviations of the estimate's error that the bound allows.
SIGMA = 4.0
#: Homes and visits in a block.
BLOCK = 1024


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, correction factors <code, vector>, and the rotated vectors."""
    rotated = unit @ turn.T
    signs = rotated >= 0
    factor = np.abs(rotated).sum(1) / np.sqrt(unit.shape[1])
    return np.packbits(signs, axis=1), factor, rotated


def bound(codes: np.ndarray, factor: np.ndarray, rotated: np.ndarray, sigma: float = SIGMA) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of <vector, query> for all codes and rotated queries, and the half-width of their confidence."""
    dim = rotated.shape[1]
    signs = (np.unpackbits(codes, axis=1)[:, :dim].astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
    estimate = (signs @ rotated.T.astype(np.float32)) / factor[:, None].astype(np.float32)
    spread = sigma * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2) / np.sqrt(max(dim - 1, 1))
    return estimate, spread[:, None]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of doubles; rows that can't be vectors of this length become NaN."""
    out = np.full((len(column), dim), np.nan)
    for i, v in enumerate(column.to_pylist()):
        if v is not None and len(v) == dim and None not in v:
            out[i] = v
    return out


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row's components, in four bytes each where that keeps them all, else in eight."""
    with np.errstate(all="ignore"):
        short = x.astype(np.float32)
    whole = (short == x).all(1)
    return [(short if ok else x)[i].tobytes() for i, ok in enumerate(whole)]


def _unpacked(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(rows), dim))
    for size, kind in ((4, np.float32), (8, np.float64)):
        own = [i for i, r in enumerate(rows) if len(r) == size * dim]
        if own:
            out[own] = np.frombuffer(b"".join(rows[i] for i in own), kind).reshape(len(own), dim)
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        n = np.sqrt((x * x).sum(1))
    return np.where(np.isfinite(n) & (n > 0), n, np.nan)


def margin(dim: int, threshold: float) -> float:
    """MARGIN, or four of the standard deviations above where vectors are short, up to where no pair can differ more."""
    apart = np.sqrt(max(2 - 2 * threshold, 0))
    return float(max(MARGIN, min(2 * apart, 4 * apart / np.sqrt(dim))))


def _homes(leaders, turn, threshold: float):
    """(leader, home, id, times, code, factor, vector) rows: one at home, others where the vector visits."""

    def run(batches):
        lead, matrix = leaders.value, turn.value
        dim = matrix.shape[0]
        room = margin(dim, threshold)
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])  # so that no square overflows; exact
            norm = _norms(x)
            ok = np.flatnonzero(np.isfinite(norm))
            if not len(ok):
                continue
            unit = x[ok] / norm[ok, None]
            codes, factor, _ = encode(unit, matrix)
            near = unit @ lead.T
            best = near.argmax(1)
            rows, where = np.nonzero(near >= near.max(1, keepdims=True) - room)
            home = where == best[rows]
            ids, times = (batch.column(i).to_numpy() for i in (0, 2))
            packed = _packed(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(where.astype(np.int32)), pa.array(home), pa.array(ids[ok][rows]), pa.array(times[ok][rows]), pa.array([codes[r].tobytes() for r in rows], pa.binary()), pa.array(factor[rows]), pa.array([packed[ok[r]] for r in rows], pa.binary())],
                ["leader", "home", "id", "times", "code", "factor", "vector"],
            )

    return run


def _block(turn, threshold: float):
    """For each visitor of a block of homes, how many vectors it links with there; and a forest over the links."""

    def run(table: pa.Table) -> pa.Table:
        matrix = turn.value
        table = table.combine_chunks()
        home = table.column("left").to_numpy() == 1
        ids, times, factor = (table.column(c).to_numpy() for c in ("id", "times", "factor"))
        x = _unpacked(table.column("vector").to_pylist(), matrix.shape[0])
        codes = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
        unit = x / _norms(x)[:, None]
        h, v = np.flatnonzero(home), np.flatnonzero(~home)
        out = []
        for a in range(0, len(v), 512):
            q = v[a : a + 512]
            estimate, spread = bound(codes[h], factor[h], unit[q] @ matrix.T)
            i, j = np.nonzero(estimate + spread >= threshold)
            hit = ((unit[h[i]] * unit[q[j]]).sum(1) >= threshold) & (ids[h[i]] != ids[q[j]])
            i, j = i[hit], j[hit]
            links = np.bincount(j, weights=times[h[i]], minlength=len(q)).astype(np.int64)
            own, to = _forest(ids[h[i]], ids[q[j]])
            out.append((ids[q[links > 0]], links[links > 0], ids[q[links > 0]]))
            out.append((own, np.zeros(len(own), np.int64), to))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("id", "links", "to"), columns)))

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id of the pairs with the least id of its component among them, where that is another."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, label = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def choose_leaders(sample: np.ndarray, many: int) -> np.ndarray:
    """Up to many unit vectors of the sample, none of them as alike as APART to an earlier one."""
    chosen = np.zeros((0, sample.shape[1]))
    for a in range(0, len(sample), 256):
        for v in sample[a : a + 256]:
            if len(chosen) >= many:
                return chosen
            if not len(chosen) or (chosen @ v).max() < APART:
                chosen = np.vstack([chosen, v])
    return chosen


def _of_length(fine: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(vec_id, n_links, component_id) for finite, non-zero vectors of one length."""
    context = fine.sparkSession.sparkContext
    # Equal vectors are one, known by its least id.
    grouped = fine.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("times"))
    grouped = materialize(grouped.select("id", "embedding", "times"), "vectors")
    total = grouped.count()
    many = int(min(LEADERS, max(1, total // PER_LEADER)))
    sample = grouped.orderBy(F.xxhash64("id"), "id").limit(int(min(SAMPLE, 4 * many))).select("embedding").toPandas()["embedding"]
    sample = np.array([np.asarray(v, float) for v in sample])
    leaders = context.broadcast(choose_leaders(sample / _norms(sample)[:, None], many))
    turn = context.broadcast(rotation(dim))
    met = grouped.mapInArrow(_homes(leaders, turn, threshold), "leader int, home boolean, id long, times long, code binary, factor double, vector binary")
    met = materialize(met, "vector-homes")
    crowd = met.groupBy("leader").agg(F.count(F.when(F.col("home"), 1)).alias("homes"), F.count("*").alias("visits"))
    blocks = lambda c: F.greatest(F.ceil(F.col(c) / BLOCK), F.lit(1)).cast("int")
    met = met.join(F.broadcast(crowd), "leader")  # at most LEADERS rows
    met = met.withColumn("hb", blocks("homes")).withColumn("vb", blocks("visits"))
    own = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    carry = ["id", "times", "code", "factor", "vector"]
    homes = met.where("home").select("leader", own("hb").alias("x"), F.explode(F.sequence(F.lit(0), F.col("vb") - 1)).alias("y"), F.lit(1).alias("left"), *carry)
    visits = met.select("leader", F.explode(F.sequence(F.lit(0), F.col("hb") - 1)).alias("x"), own("vb").alias("y"), F.lit(0).alias("left"), *carry)
    found = homes.union(visits).groupBy("leader", "x", "y").applyInArrow(_block(turn, threshold), "id long, links long, to long")
    found = materialize(found, "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")), "vector-components")
    # Back to all rows: a vector's copies are its links too.
    known = grouped.join(links, "id", "left").join(comps.withColumnRenamed("node", "id"), "id", "left")
    known = known.select("embedding", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return fine.join(known, "embedding").select("vec_id", "n_links", "component_id")


def dedup(embeddings: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of embeddings (vec_id, embedding)."""
    rows = only(embeddings, "vec_id", "embedding").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    finite = ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.coalesce(finite & F.exists("embedding", lambda v: v != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    sizes = rows.where(usable).groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").collect()  # a row for each length
    out = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for r in sizes:
        out = out.union(_of_length(rows.where(usable & (F.size("embedding") == r.n)), r.n, threshold))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
