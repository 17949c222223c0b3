"""Language-model scoring with an Elias-Fano n-gram trie.

The model is interpolated with absolute discounting, of order two or three over add-ADD unigrams, counted over all
training documents. Its trie is split into shards by the hash of the first word. A shard has a level of words, one of
their successors and one of the successors' successors; where a node's successors begin is a monotone sequence in
Elias-Fano form, successors are hashes in order, and discounted probabilities and weights of the lower order are quantised
to a byte. Its levels are written to files, mapped into memory, and queried by searching a successor within the range of
its context. With keep, the shards' levels stay as a table, and Trie.loads opens one.

Documents form blocks of about BLOCK_WORDS words, written once with a key of their own. A block asks each shard once for
its different words, pairs and triples (with its training counts, from which the trie is built), and adds up the answers.
So what travels is in proportion to the different n-grams of blocks, and no machine holds the model or a vocabulary.

A context with very many successors (the begin of a text, a frequent word or pair) would make its shard a large one. Such
contexts, found from the blocks and at most HEAVY of them, are split by the successor's hash into nodes of their own that
lie in other shards; their totals are summed over all shards, and blocks apply them. Of any other context, a block sends
less than WIDE successors, or all blocks send less than SPLIT together, or it is not among the HEAVY widest.

Defined results: null text counts as empty and is scored as one end; null ids stay null, and a null held_out is false;
repeated rows and repeated ids count and are scored each; a very long text is a block of its own; ties don't arise; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed_words, materialize, mix64, only, slices

#: Words in a block; bytes of text for each shard.
BLOCK_WORDS, SHARD_BYTES = 600_000, 4 << 20
#: Unigram addition and discount.
ADD, DISCOUNT = 0.1, 0.75
BEGIN, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
#: Bits of a successor's hash within its context, by level; quantised values: 2 ** -OCTAVES to 1 in 254 steps, which are
#: finer the larger the value; 0 is none.
SYMBOL_BITS, OCTAVES = (32, 24), 40.0
#: What the probabilities of a split context's parts are relative to, until its total is known: counts up to this fit a byte.
SCALE = 2.0 ** (OCTAVES - 2)
#: Different successors in one block from which a context is reported, those that a node may have in all, most split contexts.
WIDE, SPLIT, HEAVY = 512, 1 << 17, 1 << 16


class EliasFano:
    """A monotone sequence of integers: low bits as they are, high bits as unary gaps."""

    def __init__(self, low: np.ndarray, high: np.ndarray, before: np.ndarray, shift: int):
        self.low, self.high, self.before, self.shift = low, high, before, shift

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        shift = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
        ones = (values >> np.uint64(shift)).astype(np.int64) + np.arange(n)
        bits = np.zeros(((int(ones[-1]) if n else 0) // 64 + 1) * 64, bool)
        bits[ones] = True
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        before = np.r_[0, np.cumsum(np.bitwise_count(high), dtype=np.int64)]
        return cls((values & np.uint64((1 << shift) - 1)).astype(np.uint32), high, before, shift)

    def get(self, i: np.ndarray) -> np.ndarray:
        """values[i], by selecting the i-th one among the high bits."""
        word = np.searchsorted(self.before, i, "right") - 1
        bits, left = self.high[word].copy(), (i - self.before[word]).astype(np.int64)
        place = np.zeros(len(i), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            up = left >= ones
            left -= np.where(up, ones, 0)
            place += np.where(up, width, 0)
            bits = np.where(up, bits >> np.uint64(width), bits)
        return ((word * 64 + place - i) << self.shift) | self.low[i].astype(np.int64)


def quantise(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        down = np.clip(-np.log2(p), 0, OCTAVES)
    return np.where(p > 0, 255 - np.rint(254 * np.sqrt(down / OCTAVES)), 0).astype(np.uint8)


VALUES = np.r_[0.0, np.exp2(-OCTAVES * ((255 - np.arange(1, 256)) / 254) ** 2)]
#: The code of 1: the lower order's weight where a context was never seen.
WHOLE = 255


class Trie:
    """The levels of a shard, in arrays that may be mapped from files."""

    FIELDS = ("words", "counts", *(f"{name}{level}" for level in (2, 3) for name in ("weights", "low", "high", "before", "shift", "symbols", "probabilities")))

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)
        self.pointers = {n: EliasFano(arrays[f"low{n}"], arrays[f"high{n}"], arrays[f"before{n}"], int(arrays[f"shift{n}"][0])) for n in (2, 3)}

    @classmethod
    def build(cls, words: np.ndarray, counts: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], part: np.ndarray) -> Trie:
        """words sorted; for each level (parent, symbol, count), sorted by parent and symbol; part: which words are parts of a
        split context, whose probabilities are relative to SCALE."""
        arrays = {"words": words, "counts": counts}
        above = len(words)
        for n, (parent, symbol, count) in zip((2, 3), levels):
            total, kinds = np.bincount(parent, weights=count, minlength=above), np.bincount(parent, weights=count > 0, minlength=above)
            whole = np.where(part, SCALE, total) if n == 2 else total
            with np.errstate(all="ignore"):
                weights = np.where(total > 0, DISCOUNT * kinds / total, 1.0)
                p = np.nan_to_num(np.maximum(count - DISCOUNT, 0) / whole[parent])
            ef = EliasFano.build(np.searchsorted(parent, np.arange(above + 1)))
            values = (quantise(weights), ef.low, ef.high, ef.before, np.array([ef.shift]), symbol.astype(np.uint32), quantise(p))
            arrays |= dict(zip((f"{name}{n}" for name in ("weights", "low", "high", "before", "shift", "symbols", "probabilities")), values))
            above = len(parent)
        return cls(**arrays)

    def save(self, folder: str) -> None:
        for name in self.FIELDS:
            np.save(os.path.join(folder, f"{name}.npy"), getattr(self, name))

    @classmethod
    def open(cls, folder: str) -> Trie:
        return cls(**{name: np.load(os.path.join(folder, f"{name}.npy"), mmap_mode="r") for name in cls.FIELDS})

    def dumps(self) -> bytes:
        arrays = [pa.array(np.asarray(getattr(self, name))) for name in self.FIELDS]
        table = pa.table([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in arrays], list(self.FIELDS))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return sink.getvalue().to_pybytes()

    @classmethod
    def loads(cls, data: bytes) -> Trie:
        row = pa.ipc.open_stream(data).read_all()
        return cls(**{name: row.column(name).combine_chunks().values.to_numpy(zero_copy_only=False) for name in cls.FIELDS})

    def word(self, hashes: np.ndarray) -> np.ndarray:
        """Places of words; -1 where there is none."""
        at = np.searchsorted(self.words, hashes)
        at = np.minimum(at, max(len(self.words) - 1, 0))
        return np.where(self.words[at] == hashes, at, -1) if len(self.words) else np.full(len(hashes), -1)

    def find(self, level: int, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Places of the successors: in each node's range, the first symbol that is not below the one asked for; -1 if it is another."""
        symbols, known = getattr(self, f"symbols{level}"), np.flatnonzero(node >= 0)
        found = np.full(len(node), -1, np.int64)
        if not len(symbols) or not len(known):
            return found
        low, high, symbol = self.pointers[level].get(node[known]), self.pointers[level].get(node[known] + 1), symbol[known]
        end = high.copy()
        busy = np.flatnonzero(low < high)
        while len(busy):
            middle = (low[busy] + high[busy]) >> 1
            below = symbols[middle] < symbol[busy]
            low[busy] = np.where(below, middle + 1, low[busy])
            high[busy] = np.where(below, high[busy], middle)
            busy = busy[low[busy] < high[busy]]
        inside = np.flatnonzero(low < end)
        same = symbols[low[inside]] == symbol[inside]
        found[known[inside[same]]] = low[inside[same]]
        return found


# --- blocks ------------------------------------------------------------------------------------


def _split(x: np.ndarray, size: int) -> np.ndarray:
    """Little-endian integers of so many bytes: a row of all first bytes, one of all second bytes, and so on."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T)


def _planes(x: np.ndarray, size: int) -> bytes:
    """Little-endian integers of so many bytes, all first bytes first: small ones compress to little."""
    return _split(x, size).tobytes()


def _from_planes(data, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(size, -1).T
    return out.view("<u8").ravel().astype(np.int64)


def _zip(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unzip(data) -> pa.Buffer:
    return pa.decompress(data[8:], int.from_bytes(bytes(data[:8]), "little"), codec="zstd")


def _squeezed(words: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes]:
    """Words, the most frequent first, and the place of each occurrence among them, compressed."""
    order = np.argsort(-np.bincount(at, minlength=len(words)), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return words[order].tobytes(), _zip(_planes(rank[at], 4))


def _unsqueezed(words, at) -> tuple[np.ndarray, np.ndarray]:
    """Words in order of their hashes, and the place of each occurrence."""
    words = np.frombuffer(words, np.uint64)
    order = np.argsort(words)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return words[order], rank[_from_planes(_unzip(at), 4)]


def _lookup(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted table; -1 for those that it does not have."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


class Heavy:
    """Contexts that are split: their hashes in order, and how many parts each has."""

    def __init__(self, keys: np.ndarray, parts: np.ndarray):
        self.keys, self.parts = keys, parts

    def nodes(self, which: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Hashes of the nodes that hold these successors of split contexts."""
        part = (successor >> np.uint64(8)) % self.parts[which].astype(np.uint64)
        return mix64(self.keys[which] + (part + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


NOTHING_HEAVY = Heavy(np.zeros(0, np.uint64), np.zeros(0, np.int64))


class Block:
    """Documents with their different words, pairs and triples, as the levels of a trie.

    Tokens of a document are BEGIN twice, its words, and END; all but the BEGINs are predicted. Nodes of the first level
    are words and the parts of split contexts; a split pair's triples lie on the second level, below its parts.
    """

    def __init__(self, held: np.ndarray, sizes: np.ndarray, words: np.ndarray, at: np.ndarray, heavy: Heavy, order: int):
        n, self.v, self.words, self.heavy = len(sizes), len(words), words, heavy
        self.sizes = sizes + 1
        first = np.r_[0, np.cumsum(sizes + 3)]
        tokens = np.empty(first[-1], np.int64)
        tokens[np.arange(len(at)) + np.repeat(np.arange(n) * 3 + 2, sizes)] = at
        tokens[first[:-1]] = tokens[first[:-1] + 1] = np.searchsorted(words, BEGIN)
        tokens[first[1:] - 1] = np.searchsorted(words, END)
        second = np.ones(len(tokens), bool)
        second[first[:-1]] = False
        third = second.copy()
        third[first[:-1] + 1] = False
        second, third = np.flatnonzero(second), np.flatnonzero(third)
        self.pairs, of = np.unique(tokens[second - 1] * self.v + tokens[second], return_inverse=True)
        pair = np.zeros(len(tokens), np.int64)
        pair[second] = of
        self.next, self.pair = tokens[third], pair[third]
        if order > 2:
            self.triples, self.triple = np.unique(pair[third - 1] * self.v + tokens[third], return_inverse=True)
        else:
            self.triples, self.triple = np.zeros(0, np.int64), np.zeros(0, np.int64)
        train = np.repeat(~held, self.sizes)
        self.word_counts = np.bincount(self.next[train], minlength=self.v)
        self.pair_counts = np.bincount(self.pair[train], minlength=len(self.pairs))
        self.triple_counts = np.bincount(self.triple[train], minlength=len(self.triples)) if order > 2 else np.zeros(0, np.int64)

    def pair_hashes(self, which=slice(None)) -> np.ndarray:
        first, last = np.divmod(self.pairs[which], self.v)
        return mix64(self.words[first] * np.uint64(0xD6E8FEB86659FD93) + mix64(self.words[last]))

    def wide(self) -> tuple[np.ndarray, np.ndarray]:
        """Contexts with WIDE successors or more: hashes, and how many successors."""
        out = []
        for entries, names in ((self.pairs, lambda i: self.words[i]), (self.triples, self.pair_hashes)):
            kinds = np.bincount(entries // self.v)
            many = np.flatnonzero(kinds >= WIDE)
            out.append((names(many), kinds[many]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def arrange(self) -> Block:
        """Lay the n-grams out as levels: nodes, then their successors, each in order of hashes."""
        v, heavy = self.v, self.heavy
        a, b = np.divmod(self.pairs, v)
        q, c = np.divmod(self.triples, v)
        self.split_word = _lookup(heavy.keys, self.words)
        split_pair = _lookup(heavy.keys, self.pair_hashes()) if len(heavy.keys) else np.full(len(self.pairs), -1)
        self.of_word, self.of_pair = self.split_word[a], split_pair[q]  # by pair and by triple
        moved, raised = np.flatnonzero(self.of_word >= 0), np.flatnonzero(self.of_pair >= 0)
        extra = [heavy.nodes(self.of_word[moved], self.words[b[moved]]), heavy.nodes(self.of_pair[raised], self.words[c[raised]])]
        self.nodes = np.unique(np.concatenate([self.words, *extra])) if len(moved) or len(raised) else self.words
        self.node = np.searchsorted(self.nodes, self.words)  # of each word
        self.node_counts = np.zeros(len(self.nodes), np.int64)
        self.node_counts[self.node] = self.word_counts
        self.node_heavy = np.full(len(self.nodes), -1)
        parent = self.node[a]
        parent[moved] = np.searchsorted(self.nodes, extra[0])
        above = np.searchsorted(self.nodes, extra[1])
        self.node_heavy[parent[moved]], self.node_heavy[above] = self.of_word[moved], self.of_pair[raised]
        key = np.concatenate([parent * v + b, above * v + c[raised]])
        order = np.argsort(key, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.pair_place = place[: len(a)]
        self.raised, self.raised_place = raised, place[len(a) :]
        self.counts2 = np.concatenate([self.pair_counts, self.triple_counts[raised]])[order]
        self.kids2 = np.bincount(key // v, minlength=len(self.nodes))
        self.symbols2 = self.words[key[order] % v] >> np.uint64(64 - SYMBOL_BITS[0])
        self.below = np.flatnonzero(self.of_pair < 0)
        key = self.pair_place[q[self.below]] * v + c[self.below]
        order = np.argsort(key, kind="stable")
        self.below_place = np.empty(len(order), np.int64)
        self.below_place[order] = np.arange(len(order))
        self.counts3 = self.triple_counts[self.below][order]
        self.kids3 = np.bincount(key // v, minlength=len(self.counts2))
        self.symbols3 = self.words[key[order] % v] >> np.uint64(64 - SYMBOL_BITS[1])
        return self


def _made():
    """One row for each block of documents."""

    def row(key: int, parts: list[tuple]) -> pa.RecordBatch:
        held, words, sizes = (np.concatenate(x) for x in list(zip(*parts))[1:])
        ids = pa.concat_arrays([p[0] for p in parts])
        words, at = np.unique(np.concatenate([words, [BEGIN, END]]), return_inverse=True)
        at = at[:-2]
        many = int(sizes.sum())
        values = (held.tobytes(), _planes(sizes, 4), *_squeezed(words, at))
        columns = [pa.array([key], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array([x], pa.binary()) for x in values), pa.array([many])]
        return pa.RecordBatch.from_arrays(columns, ["block", "ids", "held", "sizes", "words", "at", "many"])

    def run(batches):
        key, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            at = 0
            for part in slices(batch.column(2), 1 << 20):
                words, offsets = hashed_words(part)
                words = np.where((words == BEGIN) | (words == END), words + np.uint64(1), words)
                own = slice(at, at + len(part))
                at += len(part)
                ids = batch.column(0)[own].cast(pa.int64())
                parts.append((ids, batch.column(1).to_numpy(zero_copy_only=False)[own].astype(bool), words, np.diff(offsets)))
                size += len(words)
                if size >= BLOCK_WORDS:
                    yield row(key, parts)
                    key, parts, size = key + 1, [], 0
        if parts:
            yield row(key, parts)

    return run


BLOCKS = "block long, ids array<long>, held binary, sizes binary, words binary, at binary, many long"


def _read(held, sizes, words, at, heavy: Heavy, order: int) -> Block:
    """The block of a row's values."""
    words, at = _unsqueezed(words.as_buffer(), at.as_buffer())
    return Block(np.frombuffer(held.as_buffer(), bool), _from_planes(sizes.as_buffer(), 4), words, at, heavy, order)


def _wide(order: int):
    """(context, kinds): the wide contexts of each block."""

    def run(batches):
        for batch in batches:
            for own in zip(*(batch.column(c) for c in ("held", "sizes", "words", "at"))):
                context, kinds = _read(*own, NOTHING_HEAVY, order).wide()
                yield pa.RecordBatch.from_arrays([pa.array(context.view(np.int64)), pa.array(kinds)], ["context", "kinds"])

    return run


#: Of a block and shard: nodes, second and third symbols, and compressed numbers (split contexts, counts and kids by level).
ASKED = ("nodes", "symbols2", "symbols3", "numbers")
#: Rows for shards that go to the JVM at once.
SENT = 64


def _ask(bits: int, shared, order: int):
    """One row for each block and shard: the block's nodes, successors and theirs that belong there, with training counts."""

    def rows(block: Block):
        shard = (block.nodes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(block.nodes), np.int64)
        x = np.searchsorted(shard, np.arange((1 << bits) + 1))
        y = np.r_[0, np.cumsum(block.kids2)][x]
        z = np.r_[0, np.cumsum(block.kids3)][y]
        two, three = _split(block.symbols2, SYMBOL_BITS[0] // 8), _split(block.symbols3, SYMBOL_BITS[1] // 8)
        numbers = [[_split(v, 4) for v in level] for level in ((block.node_heavy + 1, block.node_counts, block.kids2), (block.counts2, block.kids3), (block.counts3,))]
        for j in np.flatnonzero(np.diff(x)):
            own = [slice(at[j], at[j + 1]) for at in (x, y, z)]
            listed = b"".join(v[:, part].tobytes() for level, part in zip(numbers, own) for v in level)
            yield int(j), block.nodes[own[0]].tobytes(), two[:, own[1]].tobytes(), three[:, own[2]].tobytes(), _zip(listed)

    def run(batches):
        heavy = shared.value
        for batch in batches:
            for key, *own in zip(batch.column("block").to_pylist(), *(batch.column(c) for c in ("held", "sizes", "words", "at"))):
                found = rows(_read(*own, heavy, order).arrange())
                while some := list(islice(found, SENT)):
                    shards, *values = zip(*some)
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(some), pa.int64()), pa.array(shards, pa.int32()), *(pa.array(v, pa.binary()) for v in values)], ["block", "shard", *ASKED])
                del found, some  # before the next block is laid out

    return run


def _asked(block: int, nodes, symbols2, symbols3, numbers) -> tuple:
    """(block, nodes, split contexts, counts, kids, symbols, counts, kids, symbols, counts) of a row of _ask."""
    nodes = np.frombuffer(nodes.as_buffer(), np.uint64)
    two, three = _from_planes(symbols2.as_buffer(), SYMBOL_BITS[0] // 8), _from_planes(symbols3.as_buffer(), SYMBOL_BITS[1] // 8)
    sizes = 4 * np.array([len(nodes)] * 3 + [len(two)] * 2 + [len(three)])
    listed = _unzip(numbers.as_buffer())
    heavy, counts, kids2, counts2, kids3, counts3 = (_from_planes(listed.slice(int(at), int(n)), 4) for at, n in zip(np.cumsum(sizes) - sizes, sizes))
    return block, nodes, heavy, counts, kids2, two, counts2, kids3, three, counts3


# --- shards ------------------------------------------------------------------------------------

ANSWERS = ("block", "place", "counts", "weights2", "pairs", "weights3", "triples", "total", "different", "context", "model")
_KINDS = (pa.int64(), pa.int64(), *(pa.binary(),) * 5, pa.int64(), pa.int64(), pa.int32(), pa.binary())
ANSWERED = "block long, place long, counts binary, weights2 binary, pairs binary, weights3 binary, triples binary, total long, different long, context int, model binary"


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Different keys in order, the place of every given one, and their summed counts."""
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(counts), minlength=len(key))
    return key, np.split(at, np.cumsum([len(k) for k in keys])[:-1]), total


def _answer(keep: bool):
    """Builds a shard's trie from what all blocks sent, and looks up what each asked for."""

    def run(table: pa.Table) -> pa.Table:
        rows = []
        for batch in table.to_batches():
            rows += [_asked(*row) for row in zip(batch.column("block").to_pylist(), *(batch.column(c) for c in ASKED))]
        words, node, counts = _summed([r[1] for r in rows], [r[3] for r in rows])
        which = np.full(len(words), -1)
        for r, at in zip(rows, node):
            which[at] = r[2] - 1
        b2, b3 = SYMBOL_BITS
        key2, at2, counts2 = _summed([(np.repeat(at, r[4]) << b2) | r[5] for r, at in zip(rows, node)], [r[6] for r in rows])
        key3, _, counts3 = _summed([(np.repeat(at, r[7]) << b3) | r[8] for r, at in zip(rows, at2)], [r[9] for r in rows])
        # What was never seen in training is no part of the trie.
        seen3 = counts3 > 0
        seen2 = counts2 > 0
        seen2[key3[seen3] >> b3] = True
        seen1 = counts > 0
        seen1[key2[seen2] >> b2] = True
        parent2, parent3 = np.cumsum(seen1)[key2[seen2] >> b2] - 1, np.cumsum(seen2)[key3[seen3] >> b3] - 1
        built = Trie.build(words[seen1], counts[seen1].astype(np.int64), [(parent2, key2[seen2] & ((1 << b2) - 1), counts2[seen2]), (parent3, key3[seen3] & ((1 << b3) - 1), counts3[seen3])], which[seen1] >= 0)
        out = [(None, None, None, None, None, None, None, int(counts.sum()), int((counts > 0).sum()), None, built.dumps() if keep else None)]
        partial, which = which[key2 >> b2], None
        for context in np.unique(partial[partial >= 0]):
            own = counts2[partial == context]
            out.append((*(None,) * 7, int(own.sum()), int((own > 0).sum()), int(context), None))
        del key2, key3, at2, counts2, counts3, words, node
        folder = tempfile.mkdtemp(prefix="trie-")  # this task's own, gone with it
        try:
            built.save(folder)
            del built
            trie = Trie.open(folder)

            def got(values: np.ndarray, at: np.ndarray, other: int) -> np.ndarray:
                return np.where(at >= 0, values[np.maximum(at, 0)] if len(values) else other, other)

            for block, nodes, _, _, kids2, symbols2, _, kids3, symbols3, _ in rows:
                word = trie.word(nodes)
                two = trie.find(2, np.repeat(word, kids2), symbols2)
                three = trie.find(3, np.repeat(two, kids3), symbols3)
                values = [_zip(got(v, at, other).astype(np.uint8).tobytes()) for v, at, other in ((trie.weights2, word, WHOLE), (trie.probabilities2, two, 0), (trie.weights3, two, WHOLE), (trie.probabilities3, three, 0))]
                out.append((block, int(nodes[0] >> np.uint64(1)), _zip(_planes(got(trie.counts, word, 0), 6)), *values, None, None, None, None))
        finally:
            shutil.rmtree(folder, ignore_errors=True)
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), _KINDS)], list(ANSWERS))

    return run


# --- scores ------------------------------------------------------------------------------------


def _score(total: int, different: int, shared, order: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _EMPTY
        heavy, factor, rest = shared.value
        answers = sorted(right.to_pylist(), key=lambda r: r["place"])
        counts = np.concatenate([_from_planes(_unzip(r["counts"]), 6) for r in answers])
        weights2, pairs, weights3, triples = (VALUES[np.concatenate([np.frombuffer(_unzip(r[c]), np.uint8) for r in answers])] for c in ("weights2", "pairs", "weights3", "triples"))
        (row,) = zip(*(left.combine_chunks().column(c) for c in ("ids", "held", "sizes", "words", "at")))
        block = _read(*row[1:], heavy, order).arrange()
        if len(counts) != len(block.nodes) or len(pairs) != len(block.counts2) or len(triples) != len(block.counts3):
            raise ValueError("a block's answers are not whole")
        c = counts[block.node]
        base = (c + ADD) / (total + ADD * (different + 1))
        a, b = np.divmod(block.pairs, block.v)
        seen, weight = pairs[block.pair_place], weights2[block.node[a]]
        split = block.of_word >= 0
        seen[split] *= factor[block.of_word[split]]
        weight[split] = rest[block.of_word[split]]
        two = seen + weight * base[b]
        p = two[block.pair]
        if order > 2:
            seen, weight = np.empty(len(block.triples)), weights3[block.pair_place[block.triples // block.v]]
            seen[block.below] = triples[block.below_place]
            own = block.of_pair[block.raised]
            seen[block.raised] = pairs[block.raised_place] * factor[own]
            weight[block.raised] = rest[own]
            p = seen[block.triple] + weight[block.triple] * p
        at = np.r_[0, np.cumsum(block.sizes)[:-1]]
        sums = [np.add.reduceat(x, at) for x in ((c > 0)[block.next].astype(np.int64), np.log10(base)[block.next], np.log10(np.minimum(p, 1.0)))]
        held = np.frombuffer(row[1].as_buffer(), bool)
        return pa.table({"doc_id": row[0].values, "held_out": held, "n_tokens": block.sizes, "n_known": sums[0], "train_tokens": np.full(len(held), total, np.int64), "base_score": sums[1], "score": sums[2]})

    return run


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_EMPTY = pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()), "train_tokens": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})


def _heavy(blocks: DataFrame, shards: int, order: int) -> Heavy:
    """The contexts to split: at most HEAVY, the widest first."""
    wide = blocks.select("held", "sizes", "words", "at").mapInArrow(_wide(order), "context long, kinds long")
    wide = wide.groupBy("context").agg(F.sum("kinds").alias("kinds")).where(F.col("kinds") > SPLIT)
    found = wide.orderBy(F.desc("kinds"), "context").limit(HEAVY).toPandas()
    keys = found["context"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    parts = np.clip(-(-found["kinds"].to_numpy(np.int64) // SPLIT) * 2, 2, max(shards, 2))
    return Heavy(keys[order], parts[order])


def score(docs: DataFrame, order: int = 3, keep: str | None = None) -> DataFrame:
    """Scores of docs (doc_id, text, held_out), learning from those that are not held out.

    order: words in the longest n-gram, 2 or 3; keep: a folder for the model's shards, as a table (shard, model).
    """
    if order not in (2, 3):
        raise ValueError(f"order {order} is not 2 or 3")
    spark = docs.sparkSession
    context = spark.sparkContext
    rows = only(docs, "doc_id", "held_out", "text").select(F.col("doc_id").cast("long"), F.coalesce(F.col("held_out").cast("boolean"), F.lit(False)).alias("held_out"), F.col("text").cast("string"))
    blocks = materialize(rows.mapInArrow(_made(), BLOCKS), "lm-blocks")
    many, size = blocks.agg(F.count("*"), F.coalesce(F.sum("many"), F.lit(0))).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(0, (max(least, int(size * 6 // SHARD_BYTES)) - 1).bit_length())  # a word is about six bytes of text
    heavy = _heavy(blocks, 1 << bits, order)
    shared = context.broadcast(heavy)  # at most HEAVY contexts
    asked = blocks.select("block", "held", "sizes", "words", "at").mapInArrow(_ask(bits, shared, order), "block long, shard int, " + ", ".join(f"{c} binary" for c in ASKED))
    answers = asked.repartition(1 << bits, "shard").groupBy("shard").applyInArrow(_answer(keep is not None), ANSWERED)
    answers = materialize(answers, "lm-answers")
    if keep:
        answers.where("model is not null").select("model").write.mode("overwrite").parquet(keep)
    total, different = answers.where("block is null and context is null").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("different"), F.lit(0))).first()
    sums = answers.where("context is not null").groupBy("context").agg(F.sum("total").alias("total"), F.sum("different").alias("kinds")).collect()  # at most HEAVY rows
    factor, rest = np.zeros(len(heavy.keys)), np.ones(len(heavy.keys))
    for r in sums:
        if r.total:
            factor[r.context], rest[r.context] = SCALE / r.total, DISCOUNT * r.kinds / r.total
    parts = max(least, many)
    told = answers.where("block is not null").select("block", "place", "counts", "weights2", "pairs", "weights3", "triples").repartition(parts, "block")
    placed = blocks.select("block", "ids", "held", "sizes", "words", "at").repartition(parts, "block")
    return placed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_score(total, different, context.broadcast((heavy, factor, rest)), order), SCHEMA)
