"""Best-fit packing planned on the histogram of lengths.

Documents become token ids, a closing id, and pieces of at most LENGTH ids; only longer documents are cut, and their
first piece is the short one. The driver plans best fit, longest first, over counts of lengths (at most LENGTH of them):
all pieces of one length go together into the groups of equally filled sequences that they fit best. The plan says which
ranks of a length take which places, and a piece finds its place by its rank within its length. Ranks are made in
BUCKETS parts of each length, so that a frequent length is no single task's, and the plan and the parts' offsets are
arrays of bounded size. Pieces of full length, most of a large corpus of long texts, fill a sequence each and need no
rank: their sequences have negative numbers.

Defined results: null text counts as empty and has the closing id alone; null ids stay null; repeated rows are packed
each, in an order that ties cannot change; whole texts are read however long, and white space of LONG_SPACE characters or
more without a break goes to the tokenizer itself; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, only

LENGTH = 1024
CLOSING = 2
#: Parts of each length in which ranks are made.
BUCKETS = 64
#: White space that the fast encoder's pattern may fail on, as it goes back over it step by step.
LONG_SPACE = 10_000


_long_space = re.compile(rf"\s{{{LONG_SPACE}}}")


class Encoder:
    """Ids of the byte-level vocabulary of a tokenizer file, by the file's rules for one text at a time.

    The file's merges become ranks for a byte-pair encoder that works on whole texts without keeping offsets; where the
    file is not of that kind, the tokenizer itself encodes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = self._ranks(path)

    @staticmethod
    def _ranks(path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = not spec.get("normalizer") and model["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not model.get("end_of_word_suffix") and not model.get("dropout")
        if not plain:
            return None
        import tiktoken

        # Byte-level files write each byte as a printable character: printable bytes as themselves, others from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        byte = {chr(b): b for b in shown}
        byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        own = {t["content"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in own}
        # The pattern that the ByteLevel kind stands for.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special) or _long_space.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder of a file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, size) of the pieces of n ids."""
    first = n % length or min(n, length)
    return [(0, first), *((a, length) for a in range(first, n, length))]


def _pieces(path: str, length: int):
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(enc.ids(text or ""), np.uint32(CLOSING)).astype("<u4")
                for j, (start, size) in enumerate(cut(len(ids), length)):
                    rows.append((doc, j, start, size, zlib.crc32(ids[start : start + size].tobytes())))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over counts of lengths.

    Returns runs (size, first rank, per sequence, first sequence, offset): from its first rank on, a run's pieces fill
    sequence after sequence with so many pieces each, the first of them at offset. Sequences that are filled alike are one
    group of neighbouring numbers; a group is split only where its pieces run out.
    """
    groups: list[list[tuple[int, int]]] = [[] for _ in range(length + 1)]  # by room: (first sequence, how many)
    runs, sequences = [], 0
    for size in sorted((s for s in counts if counts[s] > 0), reverse=True):
        rank, left = 0, counts[size]
        fits = sorted(r for r in range(size, length + 1) if groups[r])
        for r in fits:
            while left and groups[r]:
                first, many = groups[r].pop()
                each = r // size
                whole = min(many, left // each)
                if whole:
                    runs.append((size, rank, each, first, length - r))
                    groups[r - each * size].append((first, whole))
                    rank, left, first, many = rank + whole * each, left - whole * each, first + whole, many - whole
                if many and left:  # the last sequence takes fewer than would fit
                    runs.append((size, rank, left, first, length - r))
                    groups[r - left * size].append((first, 1))
                    rank, left, first, many = rank + left, 0, first + 1, many - 1
                if many:
                    groups[r].append((first, many))
                    if not left:
                        break
        if left:
            each = length // size
            whole = left // each
            if whole:
                runs.append((size, rank, each, sequences, 0))
                groups[length - each * size].append((sequences, whole))
                rank, left, sequences = rank + whole * each, left - whole * each, sequences + whole
            if left:
                runs.append((size, rank, left, sequences, 0))
                groups[length - left * size].append((sequences, 1))
                sequences += 1
    return runs


def _assign(shared):
    def run(batches):
        base, size, first, each, sequence, offset = shared.value
        for batch in batches:
            table = {name: batch.column(name) for name in batch.schema.names}
            n, bucket, rank = (table[c].to_numpy() for c in ("length", "bucket", "rank"))
            rank = rank - 1 + base[n, bucket]
            # Runs are sorted by size, then first rank: the last run of the size that begins at or before the rank.
            key = size * np.int64(1 << 44) + first
            at = np.searchsorted(key, n * np.int64(1 << 44) + rank, "right") - 1
            inside = rank - first[at]
            out = [*(table[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence[at] + inside // each[at]), pa.array(offset[at] + inside % each[at] * n)]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    path: a tokenizer file that every machine can read.
    """
    spark = docs.sparkSession
    texts = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = texts.mapInArrow(_pieces(path, length), "doc_id long, piece int, start long, length long, ids_crc32 long")
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int")
    pieces = materialize(pieces.withColumn("bucket", bucket).withColumn("serial", F.monotonically_increasing_id()), "pack-pieces")
    full, pieces = pieces.where(F.col("length") == length), pieces.where(F.col("length") < length)
    found = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n")).collect()  # at most length * BUCKETS rows
    parts = np.zeros((length + 1, BUCKETS), np.int64)
    for r in found:
        parts[r.length, r.bucket] = r.n
    counts = {int(s): int(n) for s, n in enumerate(parts.sum(1)) if n}
    runs = np.array(sorted(plan(counts, length)), np.int64).reshape(-1, 5)
    base = np.cumsum(parts, axis=1) - parts
    shared = spark.sparkContext.broadcast((base, *runs.T))
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start"))
    ranked = pieces.withColumn("rank", rank.cast("long"))
    placed = ranked.mapInArrow(_assign(shared), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    alone = full.select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("serial")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.union(alone)
