"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each source has a budget of words. Whole copies of the source (complete epochs) come first; what is left of the budget
is a sample without replacement in which a document of weight w has the exponential key -ln(u) / w: the keys are sorted
within the source and documents are taken from the smallest key on while the middle of their words is within the budget.
u comes from a hash of the document, so reruns agree.

The running sum is made in two levels, so that no task holds a source: keys fall into ranges of a STEPS-th of an octave,
sums of ranges are accumulated over a source's ranges, and rows are accumulated within their range only. A weight moves a
document's key by octaves and leaves its distribution over them, so whatever the weights are, a range has at most
ln 2 / e / STEPS of a source's documents (0.03 %) in expectation, and a source has at most 110 * STEPS ranges.

Defined results: null text has no words and is taken 0 times or more without counting; whole texts are counted however
long; null source is a source, last in order; a source without words has target 0; repeated rows count each; rows with
equal keys are taken by id, then size; an empty table gives an empty table; weights that
are null, not finite or below MIN_WEIGHT count as MIN_WEIGHT; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, n_words

#: Ranges of keys in an octave.
STEPS = 1024
MIN_WEIGHT = 0.05
#: Weights of sources in code-point order, repeating; share of all words to take; most copies of a document.
CYCLE, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0


def quality(text: Column) -> Column:
    """A document's weight from its text: the share of characters that are no symbols, digits or capitals, squared."""
    n = F.length(text)
    odd = F.regexp_count(text, F.lit(r"[#*$%&|<>=0-9A-Z]"))
    return F.when(n > 0, F.pow(1 - odd / n, F.lit(2.0))).otherwise(F.lit(1.0))


def targets(sizes: DataFrame) -> DataFrame:
    """sizes with target, from rows (_null, _source, source_size), one for each source.

    Resharing the excess until no source is above MOST times its size gives min(MOST * size, level * weight) with one
    level for all. With sources ordered by MOST * size / weight, the level is that of the first one that it leaves
    under its cap; as levels only fall from there on, that is the largest of those that fit.
    """
    place = F.row_number().over(Window.orderBy("_null", "_source")) - 1
    weight = F.element_at(F.array(*map(F.lit, CYCLE)), (place % len(CYCLE) + 1).cast("int"))
    every = Window.partitionBy()
    x = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * MOST).withColumn("_total", F.sum("source_size").over(every) * SHARE)
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_null", "_source")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    x = x.withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after))
    level = F.max(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))).over(every)
    x = x.withColumn("target", F.least("_cap", F.coalesce(level * F.col("_w"), F.col("_cap"))))
    return x.select("_null", "_source", "source_size", "target")


def mix(docs: DataFrame, weight: Column | None = None, keep_text: bool = True) -> DataFrame:
    """docs with size, source_size, target, copies (how often the mix takes the document) and taken (words).

    Columns of docs with these names are replaced. Without keep_text the result has no text, which is then read once: what
    is known of the documents goes to the shared folder.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "taken", "_key", "_bucket", "_source", "_null", "_upto", "_base", "_words")
    text = F.col("text").cast("string")
    w = F.coalesce(weight if weight is not None else quality(text), F.lit(MIN_WEIGHT))
    w = F.when(F.isnan(w) | (w < MIN_WEIGHT), F.lit(MIN_WEIGHT)).when(w > 1e6, F.lit(1e6)).otherwise(w)
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    u = (F.pmod(F.xxhash64(F.lit("mix"), "doc_id", crc), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    source = F.col("source").cast("string")
    keyed = docs.select("*", source.isNull().alias("_null"), F.coalesce(source, F.lit("")).alias("_source"), n_words(text).alias("size"), (-F.log(u) / w).alias("_key"))
    return spread(keyed if keep_text else materialize(keyed.drop("text"), "mix-keys"))


def spread(keyed: DataFrame) -> DataFrame:
    """The mix of rows that have _null, _source, size and _key; see mix."""
    own = [c for c in keyed.columns if c not in ("_null", "_source", "_key")]
    rows = keyed.withColumn("_bucket", F.floor(F.log2("_key") * STEPS).cast("int"))
    sums = rows.groupBy("_null", "_source", "_bucket").agg(F.sum("size").alias("_words"))
    goal = targets(sums.groupBy("_null", "_source").agg(F.sum("_words").alias("source_size")))
    up = Window.partitionBy("_null", "_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("_null", "_source", "_bucket", F.coalesce(F.sum("_words").over(up), F.lit(0)).alias("_base"))
    base = base.join(goal, ["_null", "_source"])
    inside = Window.partitionBy("_null", "_source", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = rows.withColumn("_upto", F.sum("size").over(inside)).join(base, ["_null", "_source", "_bucket"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    left = F.col("target") - epochs * F.col("source_size")
    middle = F.col("_base") + F.col("_upto") - F.col("size") / 2
    copies = F.least(epochs + F.when(middle <= left, 1).otherwise(0), F.lit(int(MOST))).cast("int")
    x = x.select(*own, "source_size", "target", copies.alias("copies"))
    return x.withColumn("taken", (F.col("size") * F.col("copies")).cast("long"))
