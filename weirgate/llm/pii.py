r"""Personal data by candidate gradient boosting, in DataFrame functions only.

High-recall patterns propose spans that may overlap; boosted trees score each from its format and the words before it;
a threshold for each kind, set on held-out rows to a precision of at least PRECISION, selects redactions. The trees are
fitted on the driver over a fixed set of labelled rows made from templates (ROWS of them, a bound that does not grow
with the data) through the same expressions that score documents, and are applied as CASE expressions. Spans that the
base rules find are always kept; the method adds others, also such as reach beyond a base span (a secret around a run of
digits that passes for a card).

Spans count code points, end exclusive. Patterns use possessive repeats and start at the edge of a run, so that long runs
cost linear time and no stack; what they find is the leftmost non-overlapping matches of the plain patterns.

The cost of a text is in proportion to its length and n log n in its spans: positions and reaches are running sums and
maxima, made in pieces of PIECE (see running), and cuts are taken from stretches of PIECE characters.

Defined results: null text counts as empty and has no spans; whole texts are read however long; spans of one kind do not
overlap, spans of different kinds may, and equal candidates of different kinds each count; a candidate's context ends
BEFORE characters before it, generators of emails stop at the lengths that addresses have (64 and 63 characters, eight
labels); repeated rows are judged alike; an empty table gives an empty table; other columns stay unless they have the names
of results, which replace them.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import UPPER, LOWER, let

#: Base patterns (fixed by the contract), in order of kind.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that any text with a valid match passes.
MAY_HOLD = {"email": r"@[A-Za-z0-9-]+\.", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"(?:[0-9][\x20-]?){13}", "phone": r"\+[0-9]"}
#: Generators of further candidates: kind and pattern.
PROPOSE = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}+(?: ?(?:[\[(](?:dot|DOT)[\])]|\.) ?[A-Za-z0-9-]{2,63}+){1,8}+", r"[\[(](?:at|AT)[\])]"),
    ("card", r"[0-9](?:[\x20-]?+[0-9])++", MAY_HOLD["card"]),
    ("phone", r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])", r"[0-9]{3}[ .-][0-9]{4}"),
    ("secret", r"(?:(?<![0-9A-Za-z+/_-])|\G)[0-9A-Za-z+/_-]{16,}+", r"[0-9A-Za-z+/_-]{16}"),
    ("id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]"),
)
KINDS = ("email", "ip", "card", "phone", "secret", "id")
#: Characters before a span that are context; how many matches before a span hold as many characters at least.
BEFORE, MATCHES = 32, 4
#: Elements of an array, or characters of a text, that are handled together.
PIECE = 256
WORDS = {
    "cue_secret": r"(?:token|secret|password|passwd|api[_ -]?key|credential|bearer|private key)[^\n]{0,6}$",
    "cue_money": r"(?:card|visa|mastercard|amex|credit|debit|carte|karte|tarjeta)[^\n]{0,12}$",
    "cue_call": r"(?:phone|tel|call|mobile|fax|cell|telefon|t\x{E9}l\x{E9}phone|tel\x{E9}fono)[^\n]{0,12}$",
    "cue_person": r"(?:ssn|social security|passport|insurance number|national id)[^\n]{0,12}$",
    "cue_mail": r"(?:mail|contact|write to|reach)[^\n]{0,12}$",
    "cue_other": r"(?:isbn|issn|doi|commit|sha|md5|hash|order|item|serial|version|invoice|page|http|www|build)[^\n]{0,12}$",
    "assigned": r"[=:]\s*[\"']?$",
}
FEATURES = (*KINDS[:1], *KINDS[2:], "length", "digits", "letters", "upper", "lower", "marks", "hex", "luhn", "switches", *WORDS)
#: Labelled rows, rounds, depth-two trees' step, and the precision asked of a threshold.
ROWS, ROUNDS, STEP, PRECISION = 4000, 40, 0.3, 0.97


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The array's running sums or maxima (step, associative), made for each PIECE elements and over the pieces."""
    none = F.array().cast("array<bigint>")

    def scan(xs: Column) -> Column:
        return F.aggregate(xs, none, lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) > 0, step(F.element_at(acc, -1), x)).otherwise(x))))

    def joined_up(parts: Column) -> Column:
        def with_ends(ends: Column) -> Column:
            return F.flatten(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.transform(p, lambda x: step(F.get(ends, i - 1), x)))))

        return let(scan(F.transform(parts, lambda p: F.element_at(p, -1))), with_ends)

    def split(xs: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(xs), F.lit(PIECE))
        return F.when(F.size(xs) <= PIECE, scan(xs)).otherwise(let(F.transform(starts, lambda a: scan(F.slice(xs, a, F.lit(PIECE)))), joined_up))

    return let(values.cast("array<bigint>"), split)


_PLACES = "array<struct<start:bigint,end:bigint,value:string,before:string>>"


def places(text: Column, pattern: str, guard: str) -> Column:
    """Array of (start, end, value, before) of the pattern's matches, from the pieces between them; before is the context."""

    def of(found: Column) -> Column:
        def cut(parts: Column) -> Column:
            def context(i: Column) -> Column:
                some = [F.coalesce(F.right(F.get(x, i - d), F.lit(BEFORE)), F.lit("")) for d in range(MATCHES, -1, -1) for x in (parts, found)][:-1]
                return F.right(F.concat(*some), F.lit(BEFORE))

            def placed(ends: Column) -> Column:
                return F.transform(found, lambda v, i: F.struct((F.get(ends, i) - F.length(v)).alias("start"), F.get(ends, i).alias("end"), v.alias("value"), context(i).alias("before")))

            return let(running(F.transform(found, lambda v, i: F.length(v) + F.length(F.get(parts, i))), lambda s, x: s + x), placed)

        return let(F.split(text, pattern, -1), cut)

    none = F.array().cast(_PLACES)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(guard), let(matches, lambda found: F.when(F.size(found) > 0, of(found)).otherwise(none))).otherwise(none)


def reaches(spans: Column, points: Column) -> Column:
    """For each point, of the spans that start at it or before: the last start and the furthest end; -1 if there is none."""
    some = F.transform(spans, lambda s: F.struct(s["start"].alias("at"), F.lit(-1).alias("i"), s["start"].alias("start"), s["end"].alias("end")))
    asked = F.transform(points, lambda p, i: F.struct(p.alias("at"), i.alias("i"), F.lit(-1).cast("bigint").alias("start"), F.lit(-1).cast("bigint").alias("end")))
    larger = lambda s, x: F.greatest(s, x)

    def merged(xs: Column) -> Column:
        def told(starts: Column) -> Column:
            def and_ends(ends: Column) -> Column:
                every = F.transform(xs, lambda x, j: F.struct(x["i"].alias("i"), F.get(starts, j).alias("start"), F.get(ends, j).alias("end")))
                return F.array_sort(F.filter(every, lambda x: x["i"] >= 0))

            return let(running(F.transform(xs, lambda x: x["end"]), larger), and_ends)

        return let(running(F.transform(xs, lambda x: x["start"]), larger), told)

    kind = "array<struct<at:bigint,i:int,start:bigint,end:bigint>>"
    return let(F.array_sort(F.concat(some.cast(kind), asked.cast(kind))), merged)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's test."""
    back = F.reverse(digits)

    def step(s: Column, i: Column) -> Column:
        d = F.ascii(F.substring(back, i, F.lit(1))) - 48
        return s + F.when(i % 2 == 1, d).when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), step) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The base rule that a match of the kind must meet."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.try_cast("double") <= 255)
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _features(kind: Column, value: Column, before: Column) -> Column:
    """The features of a candidate, in the order of FEATURES, as an array of doubles."""
    n = F.greatest(F.length(value), F.lit(1))
    digits = F.regexp_replace(value, "[^0-9]", "")
    before = F.translate(before, UPPER, LOWER)
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    out = [(kind == KINDS.index(k)).cast("double") for k in (*KINDS[:1], *KINDS[2:])]
    out += [n, F.length(digits), share("[A-Za-z]"), share("[A-Z]"), share("[a-z]"), share("[^0-9A-Za-z]"), share("[0-9a-fA-F]")]
    out += [(F.length(digits).between(12, 19) & luhn(digits)).cast("double"), F.regexp_count(value, F.lit("[0-9][A-Za-z]|[A-Za-z][0-9]"))]
    out += [before.rlike(p).cast("double") for p in WORDS.values()]
    return F.array(*(x.cast("double") for x in out))


def candidates(text: Column) -> Column:
    """Array of (kind, start, end, features) from all generators."""

    def proposed(kind: str, pattern: str, guard: str) -> Column:
        def kept(x: Column) -> Column:
            n = F.regexp_count(x["value"], F.lit("[0-9]"))
            return n.between(13, 19) if kind == "card" else (n >= 3) & x["value"].rlike("[A-Za-z]") if kind == "secret" else F.lit(True)

        return F.transform(F.filter(places(text, pattern, guard), kept), lambda x: F.struct(F.lit(KINDS.index(kind)).alias("kind"), x.alias("x")))

    def scored(c: Column) -> Column:
        x = c["x"]
        return F.struct(c["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), _features(c["kind"], x["value"], x["before"]).alias("f"))

    return F.transform(F.concat(*(proposed(*x) for x in PROPOSE)), scored)


# --- the model -------------------------------------------------------------------------------


def labelled_rows(seed: int = 7) -> list[tuple[str, int, int, int]]:
    """(text, start, end, private) rows from templates: the span that a generator should propose, and whether it is private."""
    r = random.Random(seed)
    some = lambda xs: r.choice(xs)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    hexed = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(n))
    word = lambda: "".join(r.choice(["an", "re", "ti", "on", "the", "ou", "ea", "er", "st", "la", "de", "ge"]) for _ in range(r.randint(1, 4)))

    def checked(n: int, good: bool) -> str:
        body = digits(n - 1)
        total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(body)))
        last = (10 - total % 10) % 10
        return body + str(last if good else (last + r.randint(1, 9)) % 10)

    def spaced(x: str) -> str:
        return x if r.random() < 0.6 else some([" ", "-"]).join(x[i : i + 4] for i in range(0, len(x), 4))

    out = []
    for _ in range(ROWS):
        what = r.randrange(12)
        quote = some(['"', "", "'"])
        prose = " ".join(word() for _ in range(r.randint(1, 6))) + some([" ", ". ", "\n", ", "])
        if what == 0:
            cue, span, y = some(["token", "TOKEN", "secret", "api_key", "password", "Api key"]) + some([" = ", "=", ": "]) + quote, some([hexed(40), hexed(32), mixed(24), mixed(32), hexed(64), hexed(40).upper()]), 1
        elif what == 1:
            cue, span, y = some(["commit ", "sha ", "md5 hash ", "build ", "http://x/", "serial "]), some([hexed(40), hexed(32), mixed(20)]), 0
        elif what == 2:
            cue, span, y = "", some([f"{word()}{word()}{word()}{word()}{word()}{word()}-{digits(3)}", f"{word()}_{word()}_{word()}_{word()}_{digits(4)}", "/".join(["a" + word(), word(), digits(4), word(), word()])]).ljust(17, "a"), 0
        elif what == 3:
            cue, span, y = some(["", "", "card ", "Visa: ", "pay "]), spaced(checked(16, r.random() < 0.3)), 1
        elif what == 4:
            cue, span, y = some(["isbn ", "order ", "serial ", "invoice ", "item "]), spaced(checked(some([13, 13, 14, 18]), r.random() < 0.1)), 0
        elif what == 5:
            cue, span, y = some(["", "call ", "tel. ", "phone: ", "fax "]), some([f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"{digits(3)} {digits(3)} {digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}"]), 1
        elif what == 6:
            cue, span, y = some(["order ", "item ", "serial ", "version ", "page "]), some([f"{digits(3)}-{digits(3)}-{digits(4)}", f"{digits(3)} {digits(3)} {digits(4)}"]), 0
        elif what == 7:
            cue, span, y = some(["mail ", "contact ", "", "write to "]), f"{word()}{some(['.', ''])}{word()} [at] {word()} [dot] {some(['com', 'org', 'net'])}", 1
        elif what == 8:
            cue, span, y = some(["ssn ", "", "social security: ", "passport "]), f"{digits(3)}-{digits(2)}-{digits(4)}", 1
        elif what == 9:
            cue, span, y = some(["order ", "item ", "invoice ", "serial "]), f"{digits(3)}-{digits(2)}-{digits(4)}", 0
        elif what == 10:
            cue, span, y = "", some([mixed(28) + digits(3), hexed(40), hexed(48)]), 1
        else:
            cue, span, y = some(["", "a total of ", "page "]), spaced(checked(some([13, 14, 15, 17, 18, 19]), False)), 0
        before = prose + cue
        out.append((before + span + quote + " " + word(), len(before), len(before) + len(span), y))
    return out


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list]:
    """Boosted depth-two trees for the log-odds: the start, and (feature, cut, left, right) trees of nested leaves."""
    start = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    score, trees = np.full(len(y), start), []
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 17)[1:-1], method="lower")) for j in range(x.shape[1])]

    def split(rows: np.ndarray, g: np.ndarray, h: np.ndarray):
        best, gs, hs = (1e-6, None, None), g[rows].sum(), h[rows].sum()
        for j, own in enumerate(cuts):
            for c in own:
                left = x[rows, j] <= c
                gl, hl = g[rows][left].sum(), h[rows][left].sum()
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                if gain > best[0]:
                    best = (gain, j, float(c))
        return best[1:]

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
        j, c = split(rows, g, h) if depth and len(rows) > 20 else (None, None)
        if j is None:
            value = float(STEP * g[rows].sum() / (h[rows].sum() + 1)) if len(rows) else 0.0
            score[rows] += value
            return value
        left = x[rows, j] <= c
        return (j, c, grow(rows[left], g, h, depth - 1), grow(rows[~left], g, h, depth - 1))

    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        trees.append(grow(np.arange(len(y)), y - p, p * (1 - p), 2))
    return start, trees


def predict(model: tuple[float, list], x: np.ndarray) -> np.ndarray:
    def one(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    return np.array([1 / (1 + np.exp(-(model[0] + sum(one(t, row) for t in model[1])))) for row in x])


def score(model: tuple[float, list], f: str) -> str:
    """The model's probability as a SQL expression over the feature array f."""

    def one(tree) -> str:
        if not isinstance(tree, tuple):
            return f"{tree!r}D"
        return f"CASE WHEN get({f}, {tree[0]}) <= {tree[1]!r}D THEN {one(tree[2])} ELSE {one(tree[3])} END"

    return f"1 / (1 + exp(-({' + '.join([one(model[0]), *map(one, model[1])])})))"


@lru_cache(maxsize=4)
def _trained(seed: int, app: str) -> tuple[tuple[float, list], tuple[float, ...]]:
    spark = SparkSession.getActiveSession()
    rows = labelled_rows(seed)
    df = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(rows)], "i int, text string").repartition(4)
    found = df.select("i", F.explode(candidates(F.col("text"))).alias("c")).select("i", "c.*").collect()  # at most a few for each of ROWS rows
    x, y, kinds, held = [], [], [], []
    for c in found:
        _, start, end, private = rows[c.i]
        over = c.start < end and start < c.end
        x.append(c.f)
        y.append(float(private and over))
        kinds.append(c.kind)
        held.append(c.i % 3 == 0)
    x, y, kinds, held = np.array(x), np.array(y), np.array(kinds), np.array(held)
    model = fit(x[~held], y[~held])
    p, thresholds = predict(model, x[held]), []
    for k in range(len(KINDS)):
        own = kinds[held] == k
        good = [t for t in np.linspace(0.2, 0.95, 16) if (p[own] >= t).any() and y[held][own][p[own] >= t].mean() >= PRECISION]
        thresholds.append(float(min(good, default=0.95)))
    return model, tuple(thresholds)


def trained(spark: SparkSession, seed: int = 7) -> tuple[tuple[float, list], tuple[float, ...]]:
    """The model and the threshold of each kind; fitted once for each application."""
    return _trained(seed, spark.sparkContext.applicationId)


# --- the operator ----------------------------------------------------------------------------

_SPANS = "array<struct<kind:int,start:bigint,end:bigint>>"


_OWN = ("base_spans", "spans", "_cands", "_held", "_chosen", *(f"_{x}{k}" for k in range(len(KINDS)) for x in ("mine", "left", "right")))


def find(docs: DataFrame) -> DataFrame:
    """docs with base_spans and spans: arrays of (kind, start, end), kind an index into KINDS, sorted.

    Columns of docs with the names in _OWN are replaced or dropped.
    """
    model, thresholds = trained(docs.sparkSession)
    docs = docs.drop(*_OWN)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def based(k: int, kind: str, pattern: str) -> Column:
        ok = F.filter(places(text, pattern, MAY_HOLD[kind]), lambda x: valid(kind, x["value"]))
        return F.transform(ok, lambda x: F.struct(F.lit(k).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    def asked(spans: Column, of: str, point: Callable[[Column], Column]) -> Column:
        return F.when(F.size(of) > 0, reaches(spans, F.transform(of, point)))

    # One column after another, as nested functions take the analyzer a step each.
    out = docs.withColumn("base_spans", F.array_sort(F.concat(*(based(k, *x) for k, x in enumerate(BASE.items())))).cast(_SPANS))
    out = out.withColumn("_cands", candidates(text))
    # Only candidates that no base span holds whole are scored.
    out = out.withColumn("_held", asked(F.col("base_spans"), "_cands", lambda c: c["start"]))
    # Columns that a function's body would name are bound outside it, or the optimizer may compute them there for each element.
    limit = ", ".join(f"{t!r}D" for t in thresholds)
    wanted = f"filter(_cands, (c, i) -> get(held, i).end < c.end AND {score(model, 'c.f')} >= get(array({limit}), c.kind))"
    chosen = f"transform({wanted}, c -> struct(c.kind, c.start, c.end))"
    out = out.withColumn("_chosen", F.expr(f"element_at(transform(array(_held), held -> {chosen}), 1)").cast(_SPANS))
    added = [F.filter("_chosen", lambda c: ~c["kind"].isin(*range(len(BASE))))]
    for k in sorted({KINDS.index(x[0]) for x in PROPOSE} & set(range(len(BASE)))):
        # Without what base spans of the candidate's kind hold of its ends; no generator makes one around such a span.
        mine, left, right = f"_mine{k}", f"_left{k}", f"_right{k}"
        same = F.filter("base_spans", lambda b: b["kind"] == k)
        out = out.withColumn(mine, F.filter("_chosen", lambda c: c["kind"] == k))
        out = out.withColumns({left: asked(same, mine, lambda c: c["start"]), right: asked(same, mine, lambda c: c["end"] - 1)})

        def trimmed(reach: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                a, b = F.get(reach["a"], i), F.get(reach["b"], i)
                start = F.when(a["end"] > c["start"], a["end"]).otherwise(c["start"])
                return F.struct(c["kind"].alias("kind"), start.alias("start"), F.when(b["end"] >= c["end"], b["start"]).otherwise(c["end"]).alias("end"))

            return F.transform(mine, one)

        added.append(let(F.struct(F.col(left).alias("a"), F.col(right).alias("b")), trimmed).cast(_SPANS))
    out = out.withColumn("spans", F.array_sort(F.concat("base_spans", *added)))
    return out.select(*docs.columns, "base_spans", "spans")


def joined(spans: Column) -> Column:
    """kind:start:end by kind, then start, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """text with each stretch of overlapping spans replaced by its first kind in brackets."""
    names = F.array(*map(F.lit, [k.upper() for k in KINDS]))
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def written(parts: Column, xs: Column, ends: Column) -> Column:
        def cut(a: Column, b: Column) -> Column:
            """Characters a to before b, from the parts of PIECE characters that hold them."""
            i, j = (F.floor(x / PIECE).cast("int") for x in (a, b))
            part = lambda x: F.coalesce(F.get(parts, x), F.lit(""))
            at = lambda x, of: (x - of.cast("bigint") * PIECE).cast("int")
            within = F.substring(part(i), at(a, i) + 1, (b - a).cast("int"))
            across = F.concat(F.substring(part(i), at(a, i) + 1, F.lit(PIECE)), F.array_join(F.slice(parts, i + 2, F.greatest(j - i - 1, F.lit(0))), ""), F.substring(part(j), F.lit(1), at(b, j)))
            return F.when(i == j, within).otherwise(across)

        def one(s: Column, i: Column) -> Column:
            before = F.coalesce(F.get(ends, i - 1), F.lit(0).cast("bigint"))
            said = F.concat(cut(before, s["start"]), F.lit("["), F.get(names, s["kind"]), F.lit("]"))
            return F.when(s["start"] >= before, said).otherwise(F.lit(""))

        return F.concat(F.array_join(F.transform(xs, one), ""), cut(F.element_at(ends, -1), F.length(text).cast("bigint")))

    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}+"), F.lit(0))
    ends = lambda xs: running(F.transform(xs, lambda x: x["end"]), lambda s, x: F.greatest(s, x))
    whole = let(parts, lambda ps: let(by_place, lambda xs: let(ends(xs), lambda es: written(ps, xs, es))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
