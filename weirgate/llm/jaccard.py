"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact sorted-array intersection.

Documents become sets of hashed word shingles; equal sets are one from the start and are known by a 64-bit key. With n
shingles, two sets of similarity t or more have at most d = n - ceil(t * n) shingles of either outside the other.

1. Which sets can have a partner at all: of its first r * d + 1 shingles by hash (r = LOOK), a set with a partner must
   share all but d, or fewer where a smaller partner is looked at less, with some other set. Shingles travel as 32-bit arrays, one row for each partition and shard; only
   sets that pass are looked at further, and only their texts are moved.
2. Tiles: two sets of similarity t share one of their first d + 1 shingles in any order common to all, so a tile is one
   such shingle and one band of set sizes. The order puts shingles that repeat inside a partition last (the most frequent
   ORDER_SHINGLES, a fixed bound; which ones they are changes the work and never the result), so a passage that many
   documents share forms no tile by itself.
3. Each tile is joined in two rounds, neither of which makes all pairs of a group: every member is paired with the
   tile's most central one, and the links among these pairs give classes; then only tiles that still hold several
   classes are compared, in blocks of BLOCK members by BLOCK members, and there only members of different classes.
Checking a pair means: |A & B| <= min(|A| - |bits(A) - bits(B)|, |B| - |bits(B) - bits(A)|) over hashed bitmaps decides
which pairs are worth the exact intersection of the sorted shingle arrays. The result (components over all links of at
least t) is exact up to collisions of 64-bit hashes.

Defined results: null or empty text has an empty set and links with nothing; ties and repeated rows are copies of one
another, and each row of a repeated id stands for itself; rows without an id get a component only through others; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialize, mix64, only, shingle_sets

#: How many times the shingles that may lie outside a partner are looked at.
LOOK = 3
#: Frequent shingles that the order puts last (8 bytes each on every executor).
ORDER_SHINGLES = 1 << 17
#: How often a shingle must repeat in a partition to be reported.
REPEATS = 2
#: First shingles in a shard (28 bytes each in the task that forms its tiles).
SHARD_TOKENS = 1_000_000
#: Members of a tile that one task compares with as many others.
BLOCK = 512
#: Members of blocks, with their bitmaps, in a task of the second round.
SHARD_ROWS = 1 << 16
#: Pairs of a block that are looked at together.
PAIRS = 1 << 18
#: Bits of a signature.
BITS = 4096


def _prefix(n: np.ndarray | int, t: Fraction):
    """How many shingles of a set of n must be looked at: n - ceil(t * n) + 1."""
    return n + (-n * t.numerator) // t.denominator + 1


def _bitmap(shingles: np.ndarray) -> bytes:
    bits = np.zeros(BITS, bool)
    bits[(shingles >> np.uint64(20)) % np.uint64(BITS)] = True
    return np.packbits(bits).tobytes()


def _set_key(shingles: np.ndarray) -> int:
    """A 64-bit key that stands for a set."""
    total = mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix64(np.array([total]))[0].view(np.int64))


def _long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def _arrays(row: dict, **kinds) -> list[np.ndarray]:
    return [np.frombuffer(row[name], kind) for name, kind in kinds.items()]


def _scan(k: int):
    """(doc_id, n, key, text_hash) of documents."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(1), k)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_set_key(s) for s in sets], pa.int64()), batch.column(2)], ["doc_id", "n", "key", "text_hash"])

    return run


def _looked_at(n: int, t: Fraction) -> int:
    return min(n, LOOK * (int(_prefix(n, t)) - 1) + 1)


def _must_share(n: np.ndarray, t: Fraction) -> np.ndarray:
    """How many of the shingles looked at a set of n has in common with those looked at of any partner, at least.

    Let a partner have c shingles, and the two sets o in common. Where the partner is looked at whole or no less far up
    the order, all but n - o are common; else all but c - o of the partner's, with o >= t * (n + c) / (1 + t). The second
    is linear in c but for rounding, which its floor allows for, so the least and the largest c bound it; and as each
    side looks at more than may lie outside the other, one is common anyway.
    """
    outside, s = _prefix(n, t) - 1, float(t)
    bounds = [LOOK * ((1 - s) * c - 1) + 1 - (c - s * n) / (1 + s) for c in (s * n, n / s)]
    lower = np.floor(np.minimum(*bounds) - 1e-6).astype(np.int64)
    return np.maximum(np.minimum(np.minimum(n, LOOK * outside + 1) - outside, lower), 1)


def _looks(k: int, t: Fraction, shards: int):
    """One row for each shard: the first shingles of the partition's different sets, by set."""

    def run(batches):
        seen, tokens, keys, n = set(), [], [], []
        for batch in batches:
            for s in shingle_sets(batch.column(1), k):
                key = _set_key(s)
                if len(s) and key not in seen:
                    seen.add(key)
                    tokens.append(s[: _looked_at(len(s), t)])
                    keys.append(key)
                    n.append(len(s))
        if not keys:
            return
        counts = np.array([len(x) for x in tokens])
        token, of = np.concatenate(tokens), np.repeat(np.arange(len(keys)), counts)
        keys, sizes = np.array(keys, np.int64), np.array(n, np.int64)
        mixed = mix64(token)
        shard, short = (mixed % np.uint64(shards)).astype(np.int64), (mixed >> np.uint64(32)).astype(np.uint32)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        for j in range(shards):
            pick = order[bounds[j] : bounds[j + 1]]
            if len(pick):
                own, times = np.unique(of[pick], return_counts=True)
                values = (short[pick], keys[own], times.astype(np.int32), sizes[own])
                yield pa.RecordBatch.from_arrays([pa.array([j], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in values)], ["shard", "token", "key", "times", "n"])

    return run


def _shares(shards: int):
    """One row for each shard of keys: how many of a set's shingles here another set has too (or one with the same 32 bits)."""

    def run(batches):
        tokens, keys, sizes = [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                token, key, times, n = _arrays(row, token=np.uint32, key=np.int64, times=np.int32, n=np.int64)
                tokens.append(token)
                keys.append(np.repeat(key, times))
                sizes.append(np.repeat(n.astype(np.int32), times))
        if not tokens:
            return
        token, key, n = np.concatenate(tokens), np.concatenate(keys), np.concatenate(sizes)
        order = np.lexsort((key, token))
        token, key, n = token[order], key[order], n[order]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        token, key, n = token[fresh], key[fresh], n[fresh]
        same = token[1:] == token[:-1]
        shared = np.zeros(len(token), bool)
        shared[1:] |= same
        shared[:-1] |= same
        key, at, shares = np.unique(key[shared], return_index=True, return_counts=True)
        n = n[shared][at]
        to = (key.view(np.uint64) % np.uint64(shards)).astype(np.int32)
        order = np.argsort(to, kind="stable")
        bounds = np.searchsorted(to[order], np.arange(shards + 1))
        for j in range(shards):
            pick = order[bounds[j] : bounds[j + 1]]
            if len(pick):
                values = (key[pick], shares[pick].astype(np.int32), n[pick])
                yield pa.RecordBatch.from_arrays([pa.array([j], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in values)], ["shard", "key", "shares", "n"])

    return run


def _passing(t: Fraction):
    """Keys of the sets that may have a partner."""

    def run(batches):
        rows = [_arrays(row, key=np.int64, shares=np.int32, n=np.int32) for batch in batches for row in batch.to_pylist()]
        if rows:
            keys, shares, n = (np.concatenate(x) for x in zip(*rows))
            key, first, at = np.unique(keys, return_index=True, return_inverse=True)
            total, n = np.bincount(at, weights=shares), n[first].astype(np.int64)
            key = key[total >= _must_share(n, t)]
            for a in range(0, len(key), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(key[a : a + 100_000])], ["key"])

    return run


def _repeats(batches):
    """(token, times) of shingles that several sets of the partition have."""
    tokens, counts = [], []
    for batch in batches:
        t, c = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(0)] or [np.zeros(0, np.uint64)]), return_counts=True)
        tokens.append(t)
        counts.append(c)
    if tokens:
        token, at = np.unique(np.concatenate(tokens), return_inverse=True)
        times = np.bincount(at, weights=np.concatenate(counts), minlength=len(token)).astype(np.int64)
        often = times >= REPEATS
        yield pa.RecordBatch.from_arrays([pa.array(_long(token[often])), pa.array(times[often])], ["token", "times"])


def _tokens(t: Fraction, frequent, shards: int):
    """One row for each shard: the first shingles of the sets (key, shingles), as arrays."""

    def run(batches):
        tokens, times = frequent.value
        parts = []
        for batch in batches:
            for key, s in zip(batch.column(0).to_numpy(), batch.column(1)):
                s = np.frombuffer(s.as_buffer(), np.uint64)
                weight = np.zeros(len(s), np.int64)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                    weight = np.where(tokens[at] == s, times[at], 0)
                m = int(_prefix(len(s), t))
                first = s[np.lexsort((s, weight))[:m]]
                central = float(np.count_nonzero(weight) / len(s))
                parts.append((first, np.full(m, key, np.int64), np.full(m, len(s), np.int64), np.full(m, central, np.float32)))
        if not parts:
            return
        token, doc, n, central = (np.concatenate(x) for x in zip(*parts))
        shard = (mix64(token) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        for j in range(shards):
            pick = order[bounds[j] : bounds[j + 1]]
            if len(pick):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([j], pa.int32()), *(pa.array([x[pick].tobytes()], pa.binary()) for x in (token, doc, n, central))],
                    ["shard", "token", "doc", "n", "central"],
                )

    return run


def _shared(log_base: float):
    """From the arrays of a shard, the rows whose shingle another set has too, once for each list of members."""

    def run(batches):
        parts = []
        for batch in batches:
            for row in batch.to_pylist():
                parts.append(_arrays(row, token=np.uint64, doc=np.int64, n=np.int64, central=np.float32))
        if not parts:
            return
        token, doc, n, central = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(token, kind="stable")
        token = token[order]
        same = token[1:] == token[:-1]
        keep = np.zeros(len(token), bool)
        keep[1:] |= same
        keep[:-1] |= same
        token, order = token[keep], order[keep]
        if not len(token):
            return
        # Shingles with the same members make the same tile: one of them is enough.
        begin = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        sizes = np.diff(np.r_[begin, len(token)])
        members = np.add.reduceat(mix64(doc[order].view(np.uint64)), begin)
        first = np.zeros(len(begin), bool)
        first[np.unique(members + mix64(sizes.astype(np.uint64)), return_index=True)[1]] = True
        keep = np.repeat(first, sizes)
        token, order = token[keep], order[keep]
        band = np.floor(np.log(n[order]) / log_base).astype(np.int32)
        for a in range(0, len(token), 100_000):
            s = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_long(token[s])), pa.array(doc[order][s]), pa.array(n[order][s]), pa.array(band[s]), pa.array(central[order][s])],
                ["token", "doc", "n", "band", "central"],
            )

    return run


def _signatures(k: int):
    """(doc, n, bits, shingles) of the partition's different sets; doc is the set's key."""

    def run(batches):
        seen = set()
        for batch in batches:
            keyed = {_set_key(x): x for x in shingle_sets(batch.column(1), k) if len(x)}
            fresh = {key: x for key, x in keyed.items() if key not in seen}
            seen.update(fresh)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(fresh), pa.int64()), pa.array([len(x) for x in fresh.values()], pa.int64()), pa.array([_bitmap(x) for x in fresh.values()], pa.binary()), pa.array([x.tobytes() for x in fresh.values()], pa.binary())],
                ["doc", "n", "bits", "shingles"],
            )

    return run


def _bit_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def _bounded(n1, n2, b1, b2, t: Fraction) -> np.ndarray:
    """Whether the bitmaps leave room for an overlap o with o >= t * (n1 + n2 - o)."""
    over = np.minimum(n1 - np.bitwise_count(b1 & ~b2).sum(-1, dtype=np.int64), n2 - np.bitwise_count(b2 & ~b1).sum(-1, dtype=np.int64))
    return over * (t.numerator + t.denominator) >= t.numerator * (n1 + n2)


def _by_bits(t: Fraction):
    def run(batches):
        for batch in batches:
            n1, n2 = (batch.column(i).to_numpy() for i in (2, 3))
            if len(n1):
                ok = _bounded(n1, n2, _bit_rows(batch.column(4)), _bit_rows(batch.column(5)), t)
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], ["a", "b"])

    return run


def _exactly(t: Fraction):
    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both * t.denominator >= t.numerator * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    return run


def _tiles(t: Fraction):
    """Pairs of different classes that sizes and bitmaps allow, from blocks of tiles by others (or themselves).

    Rows come sorted by (token, x, y); left marks the rows of block x. Blocks are handled as they end, and their pairs in
    runs of PAIRS.
    """

    def allowed(block: list[np.ndarray]):
        doc, n, cls, left, same, bits = block
        rows = np.flatnonzero(left == 1)
        cols = rows if same[0] else np.flatnonzero(left == 0)
        for a in range(0, len(rows), max(1, PAIRS // max(len(cols), 1))):
            own = rows[a : a + max(1, PAIRS // max(len(cols), 1))]
            i, j = np.repeat(own, len(cols)), np.tile(cols, len(own))
            ok = (cls[i] != cls[j]) & (n[j] * t.denominator >= t.numerator * n[i]) & (n[i] * t.denominator >= t.numerator * n[j])
            if same[0]:
                ok &= i < j
            i, j = i[ok], j[ok]
            for c in range(0, len(i), 8192):
                p, q = i[c : c + 8192], j[c : c + 8192]
                ok = _bounded(n[p], n[q], bits[p], bits[q], t)
                if ok.any():
                    p, q = doc[p[ok]], doc[q[ok]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], ["a", "b"])

    def run(batches):
        held: list[list[np.ndarray]] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            token, x, y, doc, n, cls, left = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(7))
            columns = [doc, n, cls, left, x == y, _bit_rows(batch.column(7))]
            begin = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
            for a, b in zip(begin, np.r_[begin[1:], len(token)]):
                name = (token[a], x[a], y[a])
                if name != last and held:
                    yield from allowed([np.concatenate(c) for c in zip(*held)])
                    held = []
                last = name
                held.append([c[a:b] for c in columns])
        if held:
            yield from allowed([np.concatenate(c) for c in zip(*held)])

    return run


def _frequent(signed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The order's last shingles, sorted, and how often they repeat: at most ORDER_SHINGLES, as many as whole levels allow.

    A level is an eighth of an octave of counts; how many shingles each has is a few hundred rows, and only the shingles
    of the highest levels that fit together go to the driver.
    """
    counted = signed.select("shingles").mapInArrow(_repeats, "token long, times long").groupBy("token").agg(F.sum("times").alias("times"))
    counted = materialize(counted.withColumn("level", F.floor(F.log2("times") * 8).cast("int")), "jaccard-frequent")
    held, least = 0, None
    for row in counted.groupBy("level").count().orderBy(F.desc("level")).collect():
        held += row["count"]
        if held > ORDER_SHINGLES:
            break
        least = row["level"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    top = counted.where(F.col("level") >= least).select("token", "times").toPandas()
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["times"].to_numpy(np.int64)[order]


def link_components(docs: DataFrame, k: int = 5, threshold: str = "0.8") -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash, group_key) for every row of docs (doc_id, text).

    group_key names the component (null where the set is empty), whatever ids its rows have.

    k: words in a shingle; threshold: least Jaccard similarity of a link, as a decimal string.
    """
    spark = docs.sparkSession
    t = Fraction(threshold)
    log_base = -float(np.log(float(t))) if t < 1 else 1.0
    texts = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    hashed = texts.withColumn("text_hash", F.xxhash64("text"))
    members = materialize(hashed.mapInArrow(_scan(k), "doc_id long, n long, key long, text_hash long"), "jaccard-members")
    sets = members.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    # Shards of about SHARD_TOKENS shingles each, however large the input.
    total = members.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * float(1 - t)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least, int(total * LOOK // SHARD_TOKENS) + 1)
    looks = texts.mapInArrow(_looks(k, t, shards), "shard int, token binary, key binary, times binary, n binary")
    shares = looks.repartition(shards, "shard").mapInArrow(_shares(shards), "shard int, key binary, shares binary, n binary")
    passing = shares.repartition(shards, "shard").mapInArrow(_passing(t), "key long")
    # Rows whose id is null can't be found again by it; their texts are looked up by null-safe equality.
    wanted = materialize(sets.join(passing, "key").select("doc_id").distinct(), "jaccard-passing")
    found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")
    signed = materialize(found.mapInArrow(_signatures(k), "doc long, n long, bits binary, shingles binary"), "jaccard-sets")
    tokens, times = _frequent(signed)
    frequent = spark.sparkContext.broadcast((tokens, times))
    shards = max(least, int(signed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * float(1 - t) // SHARD_TOKENS) + 1)
    blobs = signed.select("doc", "shingles").mapInArrow(_tokens(t, frequent, shards), "shard int, token binary, doc binary, n binary, central binary")
    shared = blobs.repartition(shards, "shard").mapInArrow(_shared(log_base), "token long, doc long, n long, band int, central float")
    shared = materialize(shared, "jaccard-shared")

    def checked(pairs: DataFrame, bounded: bool) -> DataFrame:
        """Those of the pairs (a, b) that are links."""
        if not bounded:
            x = signed.select(F.col("doc").alias("a"), F.col("n").alias("n1"), F.col("bits").alias("b1"))
            y = signed.select(F.col("doc").alias("b"), F.col("n").alias("n2"), F.col("bits").alias("b2"))
            pairs = pairs.join(x, "a").join(y, "b").select("a", "b", "n1", "n2", "b1", "b2").mapInArrow(_by_bits(t), "a long, b long")
        x = signed.select(F.col("doc").alias("a"), F.col("shingles").alias("s1"))
        y = signed.select(F.col("doc").alias("b"), F.col("shingles").alias("s2"))
        return pairs.join(x, "a").join(y, "b").select("a", "b", "s1", "s2").mapInArrow(_exactly(t), "a long, b long")

    # Round 1: each member with the most central one of its tile.
    pivots = shared.groupBy("token", "band").agg(F.max(F.struct("central", F.negate("doc").alias("minus"), "n")).alias("p"))
    pivots = materialize(pivots.select("token", "band", F.negate("p.minus").alias("pivot"), F.col("p.n").alias("pivot_n")), "jaccard-pivots")
    fits = (F.col("n") * t.denominator >= F.col("pivot_n") * t.numerator) & (F.col("pivot_n") * t.denominator >= F.col("n") * t.numerator)
    first = shared.join(pivots, ["token", "band"]).where(fits & (F.col("doc") != F.col("pivot")))
    first = first.select(F.greatest("doc", "pivot").alias("a"), F.least("doc", "pivot").alias("b")).distinct()
    links = materialize(checked(first, False), "jaccard-links")
    classed = components(links, "jaccard-classes")

    # Round 2: tiles (all bands of a shingle, for sizes may differ across a border) that still hold several classes.
    rows = shared.join(classed.select(F.col("node").alias("doc"), "component"), "doc", "left").select("token", "doc", "n", F.coalesce("component", "doc").alias("class"))
    rows = materialize(rows, "jaccard-rows")
    members_of = F.sum(F.xxhash64("doc").cast("decimal(38,0)"))
    open_ = rows.groupBy("token").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count("*").alias("m"), members_of.alias("sig")).where("lo < hi")
    open_ = materialize(open_.groupBy("m", "sig").agg(F.min("token").alias("token")).select("token", "m"), "jaccard-open")
    # About SHARD_ROWS rows with their bitmaps to a task, however many there are.
    copies = open_.agg(F.coalesce(F.sum(F.col("m") * F.ceil(F.col("m") / BLOCK)), F.lit(0))).first()[0]
    parts = max(least, int(copies // SHARD_ROWS) + 1)
    rest = rows.join(open_, "token")
    # Tiles of up to BLOCK members are one block; larger ones are dealt over blocks by a hash of the member.
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    rest = rest.select("token", "doc", "n", "class", blocks.alias("blocks"), F.pmod(F.xxhash64("doc"), blocks).cast("int").alias("own"))
    paired = rest.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    paired = paired.select("token", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "doc", "n", "class", F.when(F.col("own") <= F.col("other"), 1).otherwise(0).alias("left"))
    paired = paired.join(signed.select("doc", "bits"), "doc")
    paired = paired.select("token", "x", "y", "doc", "n", "class", "left", "bits").repartition(parts, "token", "x", "y").sortWithinPartitions("token", "x", "y")
    second = paired.mapInArrow(_tiles(t), "a long, b long").distinct()
    second_links = checked(second, True)
    everything = materialize(links.union(second_links.select("a", "b")), "jaccard-all")
    final = components(everything, "jaccard-final")
    keyed = members.join(final.withColumnRenamed("node", "key"), "key", "left").select("doc_id", "n", "text_hash", F.when(F.col("n") > 0, F.coalesce("component", "key")).alias("c"))
    keyed = materialize(keyed, "jaccard-keyed")
    heads = materialize(keyed.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("head")), "jaccard-heads")
    out = keyed.where("c is not null").join(heads, "c").select("doc_id", F.col("n").alias("n_shingles"), F.col("head").alias("component_id"), "text_hash", F.col("c").alias("group_key"))
    return out.union(keyed.where("c is null").select("doc_id", "n", F.col("doc_id").alias("component_id"), "text_hash", F.lit(None).cast("long")))


def others_of_groups(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From link_components' result, (doc_id, text_hash) of the rows that are not their group's representative, and of
    representatives that occur in several rows.

    A group's representative is its row with the least id (null last), then the least hash of its text.
    """
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash")
    grouped = links.where("group_key is not null").select("group_key", order.alias("me"))
    heads = materialize(grouped.groupBy("group_key").agg(F.min("me").alias("head"), F.count("*").alias("rows")).where("rows > 1"), "jaccard-heads")
    rows = grouped.join(heads, "group_key")
    others = rows.where("me != head").select("me.doc_id", "me.text_hash").distinct()
    repeated = rows.where("me = head").groupBy("me").count().where("count > 1").select("me.doc_id", "me.text_hash")
    return others, repeated
