"""Language identification as a mixture: expectation-maximisation over n-gram likelihoods.

Training counts hashed byte trigrams of letters (BUCKETS of them, over all labelled training rows) for each language. A
document's trigrams are a mixture of the languages' distributions; expectation-maximisation estimates the proportions, and
the set of languages is the one with the best likelihood less PENALTY / 2 * log(trigrams) for each language beyond the
first. The prediction is the set's largest language and the score its proportion.

Defined results: null text, or text without a letter, is `und` with score 0; if nothing was learned, so is every text; ties
go to the language that is first by code point; repeated rows are predicted alike; whole texts are read; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, slices, text_buffer

BUCKETS = 1 << 14
#: Added to each count; weight of a language in the penalty; steps; dependence of neighbouring trigrams.
ADD, PENALTY, STEPS, DEPENDENT = 0.5, 8.0, 12, 1 / 3
UNKNOWN = "und"

#: Lower-cased letters and all bytes beyond ASCII; anything else is a gap.
_LETTER = np.zeros(256, np.uint8)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all trigrams (gaps count once at a word's edges), and the n + 1 offsets of the rows."""
    data, offsets = text_buffer(column)
    letters = _LETTER[data]
    # a gap after each row keeps rows apart
    n = len(offsets) - 1
    padded = np.zeros(len(data) + n + 1, np.uint8)
    padded[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets)) + 1] = letters
    a, b, c = (padded[i : len(padded) - 2 + i].astype(np.uint32) for i in range(3))
    keep = b != 0
    rows = np.cumsum(np.r_[0, np.bincount(np.repeat(np.arange(n), np.diff(offsets)), weights=letters != 0, minlength=n)]).astype(np.int64)
    code = ((a << 16) | (b << 8) | c)[keep]
    return ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64), rows


def _count(batches):
    """(lang, bucket, n) of a partition."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        at = 0
        for part in slices(batch.column(1)):
            own = langs[at : at + len(part)]
            at += len(part)
            bucket, rows = trigrams(part)
            of = np.repeat(np.arange(len(part)), np.diff(rows))
            for lang in sorted(set(own)):
                mine = bucket[(own == lang)[of]]
                total[lang] = total.get(lang, 0) + np.bincount(mine, minlength=BUCKETS)
    for lang, counts in total.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(counts[some])], ["lang", "bucket", "n"])


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their trigram log-probabilities from docs (text, lang): BUCKETS values for each language."""
    rows = only(docs, "lang", "text").select(F.col("lang").cast("string"), F.col("text").cast("string")).where("lang is not null and text is not null")
    counts = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(counts["lang"]), key=lambda x: x.encode())
    table = np.full((len(langs), BUCKETS), ADD)
    table[[langs.index(x) for x in counts["lang"]], counts["bucket"].to_numpy(int)] += counts["n"].to_numpy(float)
    return langs, np.log(table / table.sum(1, keepdims=True))


def _mixture(p: np.ndarray, n: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Proportions of the rows of p that best explain counts n, and the log-likelihood."""
    share = np.full(len(p), 1 / len(p))
    for _ in range(steps):
        joint = share[:, None] * p
        share = (joint * (n / joint.sum(0))).sum(1) / n.sum()
    return share, float((n * np.log(share @ p)).sum())


def decide(log_p: np.ndarray, bucket: np.ndarray) -> tuple[int, float]:
    """The language and its proportion for a document's trigrams."""
    u, n = np.unique(bucket, return_counts=True)
    own = log_p[:, u]
    single = own @ n
    best = int(single.argmax())
    if len(log_p) == 1:
        return best, 1.0
    p = np.exp(own)
    share, _ = _mixture(p, n)
    order = np.argsort(-share, kind="stable")
    value, chosen = single[best] * DEPENDENT, (best, 1.0)
    for k in range(2, len(order) + 1):
        if share[order[k - 1]] < 0.02:
            break
        part, fit = _mixture(p[order[:k]], n)
        scored = fit * DEPENDENT - PENALTY / 2 * (k - 1) * np.log(n.sum() + 1)
        if scored > value:
            value, chosen = scored, (int(order[part.argmax()]), float(part.max()))
    return chosen


def _predict(shared):
    def run(batches):
        langs, log_p = shared.value
        for batch in batches:
            names, scores = [], []
            for part in slices(batch.column(1)):
                bucket, rows = trigrams(part)
                for text, a, b in zip(part, rows[:-1], rows[1:]):
                    if a == b or not langs or not any(c.isalpha() for c in text.as_py()):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                    else:
                        best, share = decide(log_p, bucket[a:b])
                        names.append(langs[best])
                        scores.append(min(1.0, max(0.0, share)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score) of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double")


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of, F.lit(0))
