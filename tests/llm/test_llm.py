"""The training-data operators against brute force, on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weirgate.llm import chat, jaccard, language, mixing, ngram_lm, packing, pii, quality, queries, sharding, vectors
from weirgate.llm.common import components, shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=3):
    """Texts of many kinds: groups of near copies, shared passages, long, empty, null, repeated."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Été", "größe", "the", "THE"]
    passage = [r.choice(words) for _ in range(60)]
    texts = []
    for g in range(12):
        base = [r.choice(words) for _ in range(r.choice([3, 40, 150]))]
        for _ in range(r.choice([1, 2, 12])):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 6])):
                own[r.randrange(len(own))] = r.choice(words)
            texts.append(" ".join(own))
    for _ in range(20):
        own = [r.choice(words) for _ in range(r.choice([5, 80]))]
        texts.append(" ".join(own[:3] + passage + own[3:]))
    texts += [None, "", " \n\t", "a", "A", "a b", "x " * 3000, "one\x0btwo\x0cthree four", "   ", texts[0], texts[0]]
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["s1", "s2", "s3", None]), 0) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0]]


def frame(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, SCHEMA).withColumns({c: F.lit(7) for c in ("size", "slot", "key", "shard", "target", "kept", "spans", "n_words", "rank", "length")})


def sets_of(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(rows, k, num, den):
    own = [sets_of(t, k) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(own[i] & own[j])
            if both and den * both >= num * (len(own[i]) + len(own[j]) - both):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    return [(rows[i][0], len(own[i]), rows[i][0] if not own[i] else min(rows[j][0] for j in groups[root(i)])) for i in range(len(rows))]


@pytest.mark.parametrize("k,t,num,den", [(4, "0.85", 85, 100), (5, "0.8", 80, 100), (2, "0.5", 1, 2)])
def test_jaccard(spark, k, t, num, den, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)  # several blocks to a tile
    monkeypatch.setattr(jaccard, "PAIRS", 16)
    rows = corpus()
    got = jaccard.link_components(frame(spark, rows), k, t).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(brute_components(rows, k, num, den))


def test_bitmaps_bound_overlap_from_above():
    r = np.random.default_rng(1)
    for _ in range(200):
        x, y = (np.unique(r.integers(0, 300, r.integers(1, 200), dtype=np.uint64) << np.uint64(20)) for _ in range(2))
        bx, by = (np.frombuffer(jaccard._bitmap(v), np.uint64)[None] for v in (x, y))
        both = len(np.intersect1d(x, y))
        t = Fraction(both, len(x) + len(y) - both)
        assert jaccard._bounded(np.array([len(x)]), np.array([len(y)]), bx, by, t)[0]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 9), (5, 5), (20, 3), (100, 99)] + [(1000 + i, 1001 + i) for i in range(30)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 8: 8, 9: 8, 5: 5, 99: 99, 100: 99, **{1000 + i: 1000 for i in range(31)}}


def test_representatives(spark):
    rows = corpus()
    others, repeated = jaccard.others_of_groups(jaccard.link_components(frame(spark, rows), 5, "0.8"))
    expected = {d for d, n, c in brute_components(rows, 5, 80, 100) if n and d != c}
    assert {r.doc_id for r in others.collect()} == expected and {r.doc_id for r in repeated.collect()} == {0}


@pytest.mark.parametrize("name", ["jaccard", "shard", "mix", "quality", "pack", "lm", "chat", "pii", "vectors", "predict"])
def test_empty_tables(spark, name):
    empty = frame(spark, [])
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    make = {
        "jaccard": lambda: jaccard.link_components(empty),
        "shard": lambda: sharding.place(empty, 4),
        "mix": lambda: mixing.mix(empty),
        "quality": lambda: quality.measures(empty),
        "pack": lambda: packing.pack(empty, queries.tokenizer_path()),
        "lm": lambda: ngram_lm.score(empty.withColumn("held_out", F.lit(False))),
        "chat": lambda: chat.digests(chat.examples(talk)),
        "pii": lambda: pii.find(empty),
        "vectors": lambda: vectors.dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")),
        "predict": lambda: language.predict(empty, language.learn(empty)),
    }[name]
    assert make().count() == 0


def test_sharding(spark):
    rows = corpus() + [(None, "no id", None, None, 0)]
    placed = sharding.place(frame(spark, rows), 4).toPandas()
    assert len(placed) == len(rows)
    for _, own in placed.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert Counter(placed["size"]) == Counter(len((t or "").encode()) + 1 for _, t, *_ in rows)
    assert Counter(placed["text_crc32"]) == Counter(zlib.crc32((t or "").encode()) for _, t, *_ in rows)


def test_sharding_of_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE", 7, raising=False)  # several pieces
    rows = [(5, f"text {i:03}", None, None, 0) for i in range(300)] + [(None, "same text", None, None, 0)] * 300 + [(1000 + i, f"text {i:03}", None, None, 0) for i in range(300)]
    placed = sharding.place(frame(spark, rows), 4).toPandas()
    assert Counter(zip(placed["doc_id"].fillna(-1), placed["text_crc32"])) == Counter((-1 if d is None else d, zlib.crc32(t.encode())) for d, t, *_ in rows)
    sizes = placed.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= 20 and placed["vslot"].nunique() > 700
    for _, own in placed.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))


def test_slot_maps(spark, tmp_path):
    r = random.Random(1)
    sizes = {s: r.randint(1, 100) for s in range(256)}
    first = sharding.first_map(sizes, 8, 256)
    assert max(sharding.loads(first, sizes)) - min(sharding.loads(first, sizes)) <= 100
    grown = sharding.grow(first, sizes)
    moved = [i for i in range(256) if first.owner[i] != grown.owner[i]]
    assert moved and all(grown.owner[i] == 8 for i in moved) and max(sharding.loads(grown, sizes)) <= 1.2 * sum(sizes.values()) / 9
    heavy = {**sizes, 3: 400}
    again = sharding.rebalance(first, heavy)
    assert max(sharding.loads(again, heavy)) <= max(sharding.loads(first, heavy)) and again.version == 2
    first.save(spark, str(tmp_path))
    again.save(spark, str(tmp_path))
    assert sharding.SlotMap.load(spark, str(tmp_path), 1) == first and sharding.SlotMap.load(spark, str(tmp_path), 2) == again


def test_place_keeps_its_slot_map(spark, tmp_path):
    r, maps = random.Random(4), str(tmp_path / "maps")
    rows = [(i, "x" * r.randint(1, 90), None, None, 0) for i in range(400)]
    run = lambda rows, n: {g.doc_id: g for g in sharding.place(frame(spark, rows), n, maps=maps).collect()}
    first, again = run(rows, 4), run(rows, 4)
    assert {g.map_version for g in first.values()} == {1} and first == again
    more = run(rows + [(1000 + i, "y" * 80, None, None, 0) for i in range(100)], 4)
    assert sum(more[i].shard != first[i].shard for i in first) < 60
    version = more[0].map_version
    assert sharding.SlotMap.latest(spark, maps).version == version and sharding.SlotMap.load(spark, maps, 1).shards == 4
    grown = run(rows, 5)
    assert grown[0].map_version > version and {g.shard for g in grown.values()} == set(range(5))
    with pytest.raises(ValueError):
        run(rows, 3)


def test_vectors_with_odd_rows(spark):
    r = np.random.default_rng(5)
    base = r.standard_normal((40, 16))
    x = np.vstack([base, base[:10] + 0.02 * r.standard_normal((10, 16)), np.repeat(base[:1], 5, 0), base[1] + 0.05 * r.standard_normal((60, 16))])
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [float("inf")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, [1.0])]
    got = {g.vec_id: g for g in vectors.dedup(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([label[link[i]].min() for i in range(len(x))])
    exact = {i: (int(link[i].sum()) - 1, int(label[i])) for i in range(len(x))}
    found, all_ = sum(got[i].n_links for i in exact), sum(n for n, _ in exact.values())
    assert found >= 0.9 * all_ and all(got[i].n_links <= exact[i][0] for i in exact)
    assert sum((got[i].n_links, got[i].component_id) == exact[i] for i in exact) >= 0.9 * len(x)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in odd)


def test_vectors_of_several_lengths(spark):
    r = np.random.default_rng(8)
    parts, exact, at = [], {}, 0
    for dim, n in ((16, 60), (8, 30), (3, 500), (1, 4)):
        base = r.standard_normal((n // 2, dim))
        x = np.vstack([base, base + 0.02 * r.standard_normal(base.shape), base[:1]])
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        link = unit @ unit.T >= 0.95
        label = np.arange(len(x))
        for _ in range(len(x)):
            label = np.array([label[link[i]].min() for i in range(len(x))])
        exact |= {at + i: (int(link[i].sum()) - 1, at + int(label[i])) for i in range(len(x))}
        parts += [(at + i, [float(v) for v in row]) for i, row in enumerate(x)]
        at += len(x)
    odd = [(9000, []), (9001, [0.0] * 8), (9002, None), (9003, [float("nan")] * 3)]
    got = {g.vec_id: (g.n_links, g.component_id) for g in vectors.dedup(spark.createDataFrame(parts + odd, "vec_id long, embedding array<double>")).collect()}
    assert got == exact | {i: (0, i) for i, _ in odd}


def test_vectors_travel_whole():
    r = np.random.default_rng(4)
    x = np.vstack([r.standard_normal((5, 7)).astype(np.float32).astype(float), r.standard_normal((5, 7)), [[1e-300, 1, 0, 0, 0, 0, 0]]])
    packed = vectors._packed(x)
    assert [len(p) for p in packed] == [28] * 5 + [56] * 6 and (vectors._unpacked(packed, 7) == x).all()


@pytest.mark.parametrize("dim", [16, 64])
def test_vectors_among_many_leaders(spark, monkeypatch, dim):
    """Recall of at least 0.9 where leaders, not blocks, decide which pairs are met: links near the threshold, 12 leaders or more."""
    monkeypatch.setattr(vectors, "PER_LEADER", 100)
    r = np.random.default_rng(dim)
    base = r.standard_normal((900, dim))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    turned = [base + s / np.sqrt(dim) * r.standard_normal(base.shape) for s in (0.2, 0.3)]
    x = np.vstack([base, *turned]).astype(np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.95).sum(1) - 1
    got = {g.vec_id: g.n_links for g in vectors.dedup(spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    assert links.sum() > 900 and all(got[i] <= links[i] for i in got) and sum(got.values()) >= 0.9 * links.sum()


def test_codes_estimate_without_bias():
    r = np.random.default_rng(2)
    x = r.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes, factor, turned = vectors.encode(x, vectors.rotation(64))
    estimate, spread = vectors.bound(codes, factor, turned)
    error = estimate - x @ x.T
    assert abs(error[~np.eye(300, dtype=bool)].mean()) < 0.01 and (np.abs(error) <= spread + 1e-6).mean() > 0.999


def test_mixing(spark):
    rows = corpus()
    got = mixing.mix(frame(spark, rows)).toPandas()
    again = mixing.mix(frame(spark, rows)).toPandas()
    key = ["doc_id", "size", "taken", "target"]
    assert Counter(map(tuple, got[key].values.tolist())) == Counter(map(tuple, again[key].values.tolist()))
    size = Counter()
    for _, t, _, s, _ in rows:
        size[s] += len(WORD.findall(t or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(size.values()), set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * size[s] for s in over}
        left -= sum(2 * size[s] for s in over)
        free -= over
    for s in order:
        own = got[got["source"].isna() if s is None else got["source"] == s]
        assert math.isclose(own["target"].iloc[0], target[s]) and (own["taken"] <= 2 * own["size"]).all()
        assert abs(own["taken"].sum() - target[s]) <= own["size"].max()


def test_mixing_takes_the_smallest_keys(spark):
    """Which documents are taken, against keys sorted and summed one by one; and no range holds much of a source."""
    r = random.Random(5)
    rows = [(i, " ".join("AB12 CD34 17".split()[: r.randint(1, 3)] * r.randint(1, 9)), None, r.choice(["a", "a", "a", None]), 0) for i in range(3000)] + [(9000, "w " * 30_000, None, None, 0)]
    docs = frame(spark, rows)
    got = mixing.mix(docs, keep_text=False).toPandas()
    assert "text" not in got.columns and Counter(got.taken) == Counter(mixing.mix(docs).toPandas().taken)
    text, w = F.col("text"), F.greatest(mixing.quality(F.col("text")), F.lit(mixing.MIN_WEIGHT))
    u = (F.pmod(F.xxhash64(F.lit("mix"), "doc_id", F.crc32(text.cast("binary"))), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    keys = docs.select("doc_id", "source", (-F.log(u) / w).alias("key"), mixing.n_words(text).alias("n")).toPandas()
    taken = dict(zip(got.doc_id, zip(got.copies, got.target, got.source_size)))
    for _, own in keys.groupby(keys.source.fillna("~")):
        upto = 0
        for d, n in own.sort_values(["key", "doc_id"])[["doc_id", "n"]].itertuples(index=False):
            copies, target, size = taken[d]
            whole = int(target // size)
            assert copies == min(2, whole + (upto + n / 2 <= target - whole * size))
            upto += n
    ranges = Counter(np.floor(np.log2(keys.key[keys.source == "a"]) * mixing.STEPS))
    assert max(ranges.values()) <= 12


def test_quality(spark):
    rows = corpus() + [(800 + i, t, None, None, 0) for i, t in enumerate(["a b c a b c", "x\nx\n\ny\nx", "a a a a", "Fine line here, it is. " * 9 + "\nHome | About | Help\nHome | About | Help\nClick here now.", "#tag $5 <b> 100%\n"])]
    got = quality.measures(frame(spark, rows)).toPandas()
    for r, (_, t, *_) in zip(got.sort_values("doc_id", kind="stable").itertuples(), sorted(rows, key=lambda x: x[0])):
        t = t or ""
        w = WORD.findall(t)
        tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.kept and r.base_failed)
    assert got[got.doc_id == 803].clean_text.iloc[0].count("\n") == 0


def test_packing(spark):
    rows = corpus() + [(810, "word " * 5000, None, None, 0), (811, "<|endoftext|> x", None, None, 0)]
    got = packing.pack(frame(spark, rows), queries.tokenizer_path(), 1024).toPandas()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    ids = {d: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for d, t, *_ in rows}
    for d, own in got.groupby("doc_id"):
        for p in own.itertuples():
            assert zlib.crc32(np.array(ids[d][p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32
        assert own["length"].sum() == len(ids[d]) * sum(r[0] == d for r in rows)
        assert (own[own.piece > 0]["length"] == 1024).all()
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert list(own["offset"]) == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() <= 1024


def test_plan_is_best_fit():
    r = random.Random(4)
    for _ in range(30):
        counts = {r.randint(1, 64): r.randint(1, 20) for _ in range(r.randint(1, 12))}
        runs, used, seen = packing.plan(counts, 64), defaultdict(list), Counter()
        for size, rank, each, first, offset in runs:
            end = min([x[1] for x in runs if x[0] == size and x[1] > rank], default=counts[size])
            for i in range(rank, end):
                used[first + (i - rank) // each].append((offset + (i - rank) % each * size, size))
                seen[size] += 1
        assert seen == Counter(counts)
        for own in used.values():
            own.sort()
            assert [o for o, _ in own] == [sum(s for _, s in own[:i]) for i in range(len(own))] and sum(s for _, s in own) <= 64
        room = []  # best fit, longest first, one by one
        for size in sorted((s for s in counts for _ in range(counts[s])), reverse=True):
            fit = [i for i, x in enumerate(room) if x >= size]
            if fit:
                room[min(fit, key=room.__getitem__)] -= size
            else:
                room.append(64 - size)
        assert len(used) == len(room)


def test_encoder_is_the_tokenizer():
    enc, r = packing.encoder(queries.tokenizer_path()), random.Random(1)
    for _ in range(500):
        t = "".join(r.choice("ab Zé\n\t 　's1²漢😀_.<|endoftext|>") for _ in range(30))
        assert enc.ids(t).tolist() == enc.slow.encode(t, add_special_tokens=False).ids


def test_encoder_of_long_runs():
    enc = packing.encoder(queries.tokenizer_path())
    for t in ("\n" * 1_000_000, " " * 1_000_000, "x" + " \t" * 500_000 + "y", "ab" * 500_000, "7" * 1_000_000, "a " * 9_999 + " " * 9_999 + "b"):
        assert enc.ids(t).tolist() == enc.slow.encode(t, add_special_tokens=False).ids


def test_packing_of_long_texts(spark):
    """White space without a break, full pieces, repeated and null ids, texts that fill a sequence but for the closing id."""
    rows = [(1, "\n" * 400_000, None, None, 0), (1, "\n" * 400_000, None, None, 0), (None, "word " * 3000, None, None, 0), (None, None, None, None, 0), (4, "word " * 1022 + "word", None, None, 0)]
    got = packing.pack(frame(spark, rows), queries.tokenizer_path(), 1024).toPandas()
    enc = packing.encoder(queries.tokenizer_path())
    expected = Counter((-1 if d is None else d, j, a, n) for d, t, *_ in rows for j, (a, n) in enumerate(packing.cut(len(enc.ids(t or "")) + 1)))
    assert Counter(zip(got.doc_id.fillna(-1), got.piece, got.start, got.length)) == expected
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert list(own["offset"]) == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() <= 1024


def test_elias_fano():
    r = np.random.default_rng(3)
    for n, top in ((1, 1), (5, 3), (1000, 50), (1000, 10**9)):
        v = np.sort(r.integers(0, top, n))
        assert (ngram_lm.EliasFano.build(v).get(np.arange(n)) == v).all()


def brute_scores(rows, held, order):
    """(n_tokens, n_known, total, base, score) of each row, by the interpolated model without tries or bytes."""
    tokens = [["<", "<", *(t or "").encode().lower().split(), ">"] for _, t, *_ in rows]
    counts = [Counter() for _ in range(order + 1)]
    for own, out in zip(tokens, held):
        if not out:
            for i in range(2, len(own)):
                for n in range(1, order + 1):
                    counts[n][tuple(own[i - n + 1 : i + 1])] += 1
    total, kinds = sum(counts[1].values()), len(counts[1])
    context, after = Counter(), Counter()
    for n in range(2, order + 1):
        for gram, c in counts[n].items():
            context[gram[:-1]] += c
            after[gram[:-1]] += 1

    def p(own, i, n):
        if n == 1:
            return (counts[1][own[i],] + 0.1) / (total + 0.1 * (kinds + 1))
        gram = tuple(own[i - n + 1 : i + 1])
        if not context[gram[:-1]]:
            return p(own, i, n - 1)
        return (max(counts[n][gram] - 0.75, 0) + 0.75 * after[gram[:-1]] * p(own, i, n - 1)) / context[gram[:-1]]

    return [(len(own) - 2, sum(counts[1][w,] > 0 for w in own[2:]), total, sum(math.log10(p(own, i, 1)) for i in range(2, len(own))), sum(math.log10(p(own, i, order)) for i in range(2, len(own)))) for own in tokens]


def check_scores(got, rows, held, order):
    key = lambda d, base: (d is None, d or 0, round(base, 6))
    expected = sorted(zip([r[0] for r in rows], held, brute_scores(rows, held, order)), key=lambda x: key(x[0], x[2][3]))
    assert len(got) == len(expected)
    for r, (d, out, (n, known, total, base, score)) in zip(sorted(got, key=lambda r: key(r.doc_id, r.base_score)), expected):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (d, out, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and abs(r.score - score) <= 0.02 * n


@pytest.mark.parametrize("order,wide", [(2, 10**9), (3, 10**9), (3, 2), (2, 2)])
def test_language_model(spark, monkeypatch, order, wide):
    monkeypatch.setattr(ngram_lm, "BLOCK_WORDS", 300)  # several blocks
    monkeypatch.setattr(ngram_lm, "WIDE", wide)  # 2: most contexts are split
    monkeypatch.setattr(ngram_lm, "SPLIT", wide)
    rows = [(None if i % 17 == 0 else d, *rest) for i, (d, *rest) in enumerate(corpus())]
    df = frame(spark, rows).withColumn("held_out", F.crc32(F.coalesce("text", F.lit("x")).cast("binary")) % 5 == 0)
    held = [zlib.crc32(("x" if t is None else t).encode()) % 5 == 0 for _, t, *_ in rows]
    check_scores(ngram_lm.score(df, order).collect(), rows, held, order)


@pytest.mark.parametrize("texts", [["apple pear quince"], [None], ["a b c", "d e", "f"], ["x " * 5], ["", " "]])
def test_language_model_of_few_documents(spark, texts):
    """Many more shards than words."""
    rows, was = [(i, t, None, None, 0) for i, t in enumerate(texts)], spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        for held in ([False] * len(rows), [True] * len(rows)):
            check_scores(ngram_lm.score(frame(spark, rows).withColumn("held_out", F.lit(held[0]))).collect(), rows, held, 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_language_model_of_repeated_ids(spark, tmp_path):
    """Blocks of equal ids and sizes keep their own words, whatever partition they come from."""
    rows = [(1, "apple pear quince", None, None, 0), (1, "kiwi fig lime", None, None, 0), (None, "one two", None, None, 0), (None, "three four", None, None, 0)]
    for i, r in enumerate(rows):
        frame(spark, [r]).coalesce(1).write.parquet(str(tmp_path / f"docs/part={i}"))
    df = spark.read.parquet(str(tmp_path / "docs")).withColumn("held_out", F.lit(None).cast("boolean"))
    check_scores(ngram_lm.score(df, keep=str(tmp_path / "model")).collect(), rows, [False] * 4, 3)
    tries = [ngram_lm.Trie.loads(r.model) for r in spark.read.parquet(str(tmp_path / "model")).collect()]
    assert sum(int(t.counts.sum()) for t in tries) == sum(len(t.split()) + 1 for _, t, *_ in rows)
    assert sum(len(t.probabilities2) - 1 for t in tries if len(t.probabilities2)) > 0


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "\\### A: </turn>\n\\h<#:"), (1, 1, "assistant", "ok </turn>"), (1, 2, "user", None), (2, 1, "assistant", "b"), (2, 0, None, "a: # <"), (2, 2, "assistant", ""), (3, 0, "sys: #", "x"), (None, 0, "assistant", "y"), (4, 0, "user", "z" * 5000), (4, 0, "user", "z" * 5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("last", F.lit(1))
    got = {r.conv_id: r for r in chat.digests(chat.examples(df)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted([(t, r or "", x or "") for c, t, r, x in rows if c == conv])
        said, loss = "".join(f"{r}\n{x}\n" for _, r, x in own), "".join(x for _, r, x in own if r == "assistant")
        g = got[conv]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.examples(df).where("conv_id = 2").count() == 2 and chat.examples(df).where("conv_id = 1").count() == 2


def luhn(x):
    return sum((v := int(c) * (1 + i % 2)) - 9 * (v > 9) for i, c in enumerate(reversed(x))) % 10 == 0


def base_spans(t):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, pattern in kinds.items():
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255 or kind == "card" and not (13 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_secret_around_a_base_span(spark):
    token = "9c7d498a8f76dc87564274036988f668b67d153d"
    texts = [f'token = "{token}" ok', f"{token}\n", f'api_key: "{token}" to a@b.com [at] example [dot] org', "card 4242 4242 4242 4242 x", "mail john [at] b.com@c.org now"]
    df = pii.find(frame(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)]))
    got = {g.doc_id: g for g in df.select("doc_id", "text", pii.joined(F.col("base_spans")).alias("base"), pii.joined(F.col("spans")).alias("all"), pii.redact(F.col("text"), F.col("spans")).alias("out")).collect()}
    for g in got.values():
        base, found = g.base.split(","), [s.split(":") for s in g.all.split(",")]
        assert base == base_spans(g.text) and set(base) <= set(g.all.split(","))
        assert all(a[0] != b[0] or int(a[2]) <= int(b[1]) for a, b in zip(found, found[1:]))
    for i in range(3):
        at = texts[i].index(token)
        assert f"card:{at + 14}:{at + 28}" in got[i].base and f"secret:{at}:{at + 40}" in got[i].all
    assert [got[i].out for i in (0, 1, 3)] == ['token = "[SECRET]" ok', "[SECRET]\n", "card [CARD] x"]
    assert got[2].out.startswith('api_key: "[SECRET]" to [EMAIL]') and "example" not in got[2].out
    assert got[4].out == "mail [EMAIL][EMAIL] now"


def test_pii(spark):
    r = random.Random(2)
    texts = ["".join(r.choice(["a", "b.", "@", "1", "12", "4242 4242 4242 4242", "-", " ", "+1 (555) 010-9999", "10.0.0.1", "é", "😀", "_", "..", "a@b.co", "\n"]) for _ in range(25)) for _ in range(60)]
    texts += [None, "", "9" * 20000, "a@" + "b." * 3000 + "c", "1." * 5000, "a" * 30000 + "@b.c", 'key token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"', "x a@b.c_d@e.ff 256.1.1.1"]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    found = pii.find(frame(spark, rows)).select("doc_id", "text", pii.joined(F.col("base_spans")).alias("b"), pii.joined(F.col("spans")).alias("s"), pii.redact(F.col("text"), F.col("spans")).alias("out"))
    for g in found.collect():
        assert [x for x in g.b.split(",") if x] == base_spans(texts[g.doc_id] or "")
        assert set(x for x in g.b.split(",") if x) <= set(g.s.split(","))
        places = sorted(tuple(map(int, x.split(":")[1:])) for x in g.s.split(",") if x)
        assert not places or all((g.text or "")[a:b] not in g.out or (g.text or "").count((g.text or "")[a:b]) > 1 or b - a < 20 for a, b in places)
    secret = found.where(F.col("text").startswith("key token")).first()
    assert secret.s.startswith("secret:") and secret.out == 'key token = "[SECRET]"'


def brute_spans(t, model, thresholds):
    """All spans, from the generators' matches, features, trees, thresholds and the rule of overlaps, one by one."""
    import regex

    base = [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in (x.split(":") for x in base_spans(t))]
    out = list(base)
    for kind, pattern, _ in pii.PROPOSE:
        k = pii.KINDS.index(kind)
        for m in regex.finditer(pattern, t):
            v, digits = m.group(), re.sub("[^0-9]", "", m.group())
            if kind == "card" and not 13 <= len(digits) <= 19 or kind == "secret" and not (len(digits) >= 3 and re.search("[A-Za-z]", v)):
                continue
            if any(a <= m.start() and m.end() <= b for _, a, b in base):
                continue
            before = t[max(0, m.start() - 32) : m.start()]
            before = "".join(c.lower() if c.isascii() else c for c in before)
            share = [len(re.findall(p, v)) / len(v) for p in ("[A-Za-z]", "[A-Z]", "[a-z]", "[^0-9A-Za-z]", "[0-9a-fA-F]")]
            f = [float(kind == x) for x in (*pii.KINDS[:1], *pii.KINDS[2:])] + [len(v), len(digits), *share]
            f += [float(12 <= len(digits) <= 19 and luhn(digits)), len(re.findall("[0-9][A-Za-z]|[A-Za-z][0-9]", v))]
            f += [float(bool(re.search(re.sub(r"\\x\{(..)\}", r"\\x\1", p), before))) for p in pii.WORDS.values()]
            if pii.predict(model, np.array([f]))[0] < thresholds[k]:
                continue
            a, b = m.span()
            same = [x for x in base if x[0] == k]
            a = max([e for _, s, e in same if s <= m.start() < e], default=a)
            b = min([s for _, s, e in same if s < m.end() <= e], default=b)
            out.append((k, a, b))
    return sorted(out)


def test_pii_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pii, "PIECE", 3)  # several pieces to an array and a text
    r = random.Random(12)
    hexed = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    some = lambda: r.choice([
        "a.b@c.de", "x [at] y [dot] org", "x [at] b.com@c.org", "4242 4242 4242 4242", "4242424242424241", "call 555-010-9999", "order 555-010-9999", "123-45-6789", "ssn 123-45-6789",
        f'token = "{hexed(40)}"', f"commit {hexed(40)}", hexed(20) + "4242424242424242" + hexed(8), "10.0.0.1", "+1 (555) 010-9999", " ", "\n", "é😀", "word", ", "])
    texts = ["".join(some() + r.choice(["", " ", " "]) for _ in range(r.choice([1, 5, 30]))) for _ in range(80)] + [None, ""]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    found = pii.find(frame(spark, rows)).select("doc_id", "spans", pii.redact(F.col("text"), F.col("spans")).alias("out")).collect()
    trained = pii.trained(spark)
    assert len({k for g in found for k, *_ in g.spans}) >= 5
    for g in found:
        t = texts[g.doc_id]
        assert [tuple(x) for x in g.spans] == brute_spans(t or "", *trained)
        out, at = [], 0
        for a, b, k in sorted((a, b, k) for k, a, b in g.spans):
            if a >= at:
                out += [t[at:a], f"[{pii.KINDS[k].upper()}]"]
            at = max(at, b)
        assert g.out == (t if t is None else "".join(out) + t[at:])


def test_pii_of_many_matches(spark):
    """A long list costs in proportion to its length."""
    import time

    n = 60_000
    rows = [(1, "".join(f"u{i}@ex.org, 4242 4242 4242 4242, x [at] y [dot] org; " for i in range(n // 3)), None, None, 0)]
    pii.trained(spark)
    began = time.monotonic()
    g = pii.find(frame(spark, rows)).select(F.size("base_spans").alias("n"), F.size("spans").alias("m"), F.length(pii.redact(F.col("text"), F.col("spans"))).alias("size")).first()
    assert time.monotonic() - began < 60
    assert g.n == n // 3 * 2 and g.m >= n // 3 * 2 and 0 < g.size < len(rows[0][1])


def test_language_accuracy(spark):
    r = random.Random(6)
    syllables = {"aa": ["tha", "wer", "ing"], "bb": ["que", "aux", "elle"], "cc": ["sch", "ung", "keit"]}
    rows = [(i, " ".join("".join(r.choice(syllables[lang]) for _ in range(3)) for _ in range(20)), lang, None, 0) for i in range(90) for lang in [r.choice(list(syllables))]]
    odd = [(200, None, "aa", None, 0), (201, "12 3 !", "aa", None, 0), (202, "12 —", None, None, 0), (203, "é" * 9, None, None, 0)]
    df = frame(spark, rows + odd)
    got = {g.doc_id: g for g in language.predict(df, language.learn(df.where("doc_id % 3 <> 0"))).collect()}
    assert all(got[d].lang_pred == lang and 0 <= got[d].score <= 1 for d, _, lang, *_ in rows)
    assert [got[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and got[203].lang_pred in syllables
    share = language.decide(language.learn(df)[1], language.trigrams(pa.array([rows[0][1] + " " + next(t for _, t, x, *_ in rows if x != rows[0][2])]))[0])[1]
    assert 0.3 < share < 0.7  # half of each


def test_shingles_are_whole():
    (one,) = shingle_sets(pa.array(["A b c D e"]), 4)
    (two,) = shingle_sets(pa.array(["a B  C\nd E"]), 4)
    assert len(one) == 2 and (one == two).all()


def test_pipeline(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    r = random.Random(9)
    text = lambda n: " ".join(" ".join(r.choice(["re", "tion", "an", "the", "ou", "lo"]) + r.choice(["ba", "ke", "mi", "zu"]) + str(r.choice("abcdefgh")) for _ in range(9)) + "." for _ in range(n))
    texts = [text(20) for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    rows += [(50, texts[0] + " Extra.", "en", "s0", 0), (51, "too short.", "en", "s0", 0), (52, text(20) + " Mail a.b@c.de now.", None, None, None), rows[3], (53, None, "en", "s0", 0)]
    docs, out = spark.createDataFrame(rows, SCHEMA), {}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        out[name] = docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert tuple(docs.columns) == pipeline.COLUMNS
    assert {d.doc_id for d in out["quality"].collect()} == {*range(12), 50, 52}
    assert sorted(d.doc_id for d in out["near_duplicates"].collect()) == [*range(12), 52]
    hidden = {d.doc_id: d.text for d in out["personal_data"].collect()}
    assert hidden[52].endswith("Mail [EMAIL] now.") and hidden[1] == texts[1]
    assert set(Counter(d.doc_id for d in out["mixture"].collect()).values()) <= {1, 2}
    assert out["packing"].count() > 0 and pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("k,t", [(4, "0.85"), (5, "0.8"), (2, "0.5")])
def test_jaccard_of_small_sets_of_unlike_sizes(spark, k, t):
    """Sets whose sizes differ by a step of the prefix length: each pair links only with its other half."""
    rows = []
    for n in range(1, 48):
        for cut in (1, 2, 3, 5, 8):
            if n > cut:
                words = [f"{n}x{cut}y{i}" for i in range(n + k - 1)]
                rows += [(len(rows), " ".join(words), "en", "s", 0), (len(rows) + 1, " ".join(words[: len(words) - cut]), "en", "s", 0)]
    got = jaccard.link_components(frame(spark, rows), k, t).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(brute_components(rows, k, int(float(t) * 100), 100))


@pytest.mark.parametrize("t", ["0.5", "0.6", "0.8", "0.85", "0.95", "1"])
def test_partners_must_share_what_is_asked(t):
    """For all sizes that can link, the least number of common shingles looked at is no less than asked for."""
    t = Fraction(t)
    sizes = np.arange(1, 301)
    asked, outside = jaccard._must_share(sizes, t), np.array([jaccard._prefix(int(n), t) - 1 for n in sizes])
    looked = np.minimum(sizes, jaccard.LOOK * outside + 1)
    for a in sizes:
        for b in range(math.ceil(t * int(a)), min(300, math.floor(int(a) / t)) + 1):
            common = math.ceil(t * (int(a) + b) / (1 + t))
            mine, other = looked[a - 1] - (a - common), looked[b - 1] - (b - common)
            assert min(mine, other if looked[b - 1] < b else mine) >= asked[a - 1], (a, b)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, tmp_path, name):
    """The queries with SQL, over rows with nulls, ties, other line ends and marks at a line's very end."""
    import duckdb

    sentence = " ".join(f"word{i}" for i in range(60)) + "."
    odd = [sentence, sentence + "\u0085", sentence + " ", sentence + "\r", sentence + "\n\nHome | News | Help\n" + sentence, "\u0085".join([sentence] * 3)]
    rows = corpus() + [(900 + i, t, None, None, 0) for i, t in enumerate(odd)]
    talk = [(1, 0, "user", "a<b#\\c"), (1, 1, "assistant", "fine\né"), (2, 0, "assistant", None), (2, None, None, "x"), (3, 0, "user", "q")]
    # The SQL knows documents by their ids, so repeated rows are left to the brute-force tests.
    frame(spark, rows).dropDuplicates(["doc_id"]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    connection = duckdb.connect()
    for table in ("documents", "conversations"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, str(tmp_path))
    names = sorted(got.columns)
    expected = connection.sql(queries.ORACLE_SQL[name]).fetchdf()
    assert names == sorted(expected.columns)
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(expected[names].itertuples(index=False, name=None))
