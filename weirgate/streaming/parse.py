"""Change events as column expressions: decode, classify and normalise records of a topic without Python.

Values are looked at as variants, whose types tell booleans, integers and digit strings apart. Each record gets one reason
code by the first rule that it breaks, or becomes an event or a tombstone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..entities import ENTITIES, Entity

#: Reason codes of records that are no events (fixed values).
REASONS = ("invalid_json", "missing_key", "unknown_topic", "invalid_envelope", "unsupported_operation", "invalid_schema", "missing_batch_id", "missing_source_lsn")
#: The type name of logical decimals in a change event's schema (fixed value).
DECIMAL_NAME = "org.apache.kafka.connect.data.Decimal"
EVENT_COLUMNS = ("entity", "operation", "key_json", "before_json", "after_json", "row_json", "batch_id", "source_lsn", "source_timestamp_ms", "transaction_order", "topic", "partition", "offset", "kafka_timestamp", "raw_payload", "is_tombstone", "event_date")


def at(variant: Column, *path: str) -> Column:
    """A member of a variant object; null where there is none."""
    steps = "".join(f"['{p}']" for p in path)
    return F.try_variant_get(variant, f"${steps}", "variant")


def kind(variant: Column) -> Column:
    return F.schema_of_variant(variant)


def is_object(variant: Column) -> Column:
    return F.coalesce(kind(variant).startswith("OBJECT"), F.lit(False))


def object_of(variant: Column) -> Column:
    """The variant if it is an object."""
    return F.when(is_object(variant), variant)


def text_of(variant: Column) -> Column:
    """A JSON string's text; null for other kinds."""
    return F.when(kind(variant) == "STRING", F.try_variant_get(variant, "$", "string"))


def parsed(text: Column) -> Column:
    """A JSON object; null for anything else."""
    return object_of(F.try_parse_json(text))


def unwrapped(document: Column) -> Column:
    """The payload of a {schema, payload} document, or the document itself where it has neither."""
    bare = at(document, "schema").isNull() & at(document, "payload").isNull()
    return F.when(bare, document).otherwise(object_of(at(document, "payload")))


def natural(variant: Column) -> Column:
    """A JSON integer, or a string of digits, that is not negative; no booleans."""
    number = F.when(kind(variant) == "BIGINT", F.try_variant_get(variant, "$", "bigint"))
    text = text_of(variant)
    digits = F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
    found = F.coalesce(number, digits)
    return F.when(found >= 0, found)


def positive(variant: Column) -> Column:
    found = natural(variant)
    return F.when(found > 0, found)


def entity_of(topic: Column) -> Column:
    """The last component of a topic, if it names an entity."""
    name = F.lower(F.element_at(F.split(topic, r"\."), -1))
    return F.when(name.isin(*ENTITIES), name)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is written and computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def decoded_decimal(text: Column, scale: Column) -> Column:
    """Plain decimal text of a base64 big-endian two's-complement number of any length; null if it is none."""
    base64 = r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"
    wide = lambda x: x.cast("decimal(38,0)")

    def number(digits: Column) -> Column:
        n = (F.length(digits) / 2).cast("int")
        byte = lambda i: F.conv(F.substring(digits, i * 2 - 1, F.lit(2)), 16, 10)
        # The first byte counts down from zero if its high bit is set; the others add to 256 times what is before.
        first = byte(F.lit(1)).cast("int")
        start = wide(F.when(first >= 128, first - 256).otherwise(first))
        rest = F.when(n > 1, F.sequence(F.lit(2), n)).otherwise(F.array().cast("array<int>"))
        x = F.aggregate(rest, start, lambda acc, i: wide(acc * 256 + wide(byte(i))))
        short = let(x, lambda v: F.struct((v < 0).alias("below"), F.abs(v).cast("string").alias("digits")))
        return F.when(n.between(1, 15), short).when(n > 15, F.struct((first >= 128).alias("below"), long_digits(digits, n, first >= 128).alias("digits")))

    def long_digits(digits: Column, n: Column, below: Column) -> Column:
        """Digits of the magnitude, in limbs of nine digits, the lowest first; a negative number's bytes are inverted, and one added."""

        def push(limbs: Column, times: int, plus: Column) -> Column:
            zero = F.struct(plus.cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))

            def add(acc: Column, limb: Column) -> Column:
                v = limb * times + acc["carry"]
                return F.struct(F.floor(v / 1_000_000_000).cast("bigint").alias("carry"), F.concat(acc["out"], F.array(v % 1_000_000_000)).alias("out"))

            return F.aggregate(limbs, zero, add, lambda acc: F.when(acc["carry"] > 0, F.concat(acc["out"], F.array(acc["carry"]))).otherwise(acc["out"]))

        byte = lambda i: F.conv(F.substring(digits, i * 2 - 1, F.lit(2)), 16, 10).cast("bigint")
        own = lambda i: F.when(below, F.lit(255) - byte(i)).otherwise(byte(i))
        limbs = F.aggregate(F.sequence(F.lit(1), n), F.array(F.lit(0).cast("bigint")), lambda acc, i: push(acc, 256, own(i)))
        limbs = push(limbs, 1, F.when(below, 1).otherwise(0))
        texts = F.transform(F.reverse(limbs), lambda x, i: F.when(i == 0, x.cast("string")).otherwise(F.lpad(x.cast("string"), 9, "0")))
        return F.regexp_replace(F.array_join(texts, ""), "^0+(?=.)", "")

    def shown(v: Column) -> Column:
        x, s = v["x"], v["s"]
        point = lambda p: F.concat(F.substring(p, F.lit(1), F.length(p) - s), F.when(s > 0, F.concat(F.lit("."), F.substring(p, F.length(p) - s + 1, s))).otherwise(F.lit("")))
        padded = let(x["digits"], lambda p: F.when(F.length(p) <= s, F.lpad(p, s + 1, "0")).otherwise(p))
        return F.concat(F.when(x["below"], F.lit("-")).otherwise(F.lit("")), let(padded, point))

    raw = let(text, lambda t: F.when(t.rlike(base64) & (F.length(t) > 0), F.hex(F.try_to_binary(t, F.lit("base64")))))
    return let(F.struct(let(raw, number).alias("x"), scale.cast("int").alias("s")), shown)


def declared_scale(document: Column, image: str, field: str) -> Column:
    """The scale that a document's schema declares for a logical decimal field of an image."""
    fields = F.try_variant_get(document, "$.schema.fields", "array<variant>")
    of_image = F.element_at(F.filter(fields, lambda f: text_of(at(f, "field")) == image), 1)
    inner = F.try_variant_get(of_image, "$.fields", "array<variant>")
    own = F.element_at(F.filter(inner, lambda f: (text_of(at(f, "field")) == field) & (text_of(at(f, "name")) == DECIMAL_NAME)), -1)
    return natural(at(own, "parameters", "scale"))


def decimal_texts(entity: Entity, document: Column, image: Column, name: str) -> Column:
    """A struct of an image's decimal fields as text, binary forms decoded; null without such fields."""
    found = []
    for field, kind_ in entity.fields.items():
        if kind_ == "decimal":
            text = text_of(at(image, field))
            found.append(F.coalesce(decoded_decimal(text, declared_scale(document, name, field)), text).alias(field))
    return F.struct(*found) if found else F.lit(None)


def field_ok(entity: Entity, field: str, value: Column, text: Column) -> Column:
    """Whether a present field has its declared kind."""
    k = kind(value)
    kinds = {
        "boolean": k == "BOOLEAN",
        "integer": k == "BIGINT",
        "decimal": (k == "BIGINT") | k.startswith("DECIMAL") | k.isin("DOUBLE", "FLOAT") | ((k == "STRING") & text.rlike(r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$")),
        "string": k == "STRING",
        "timestamp": (k == "BIGINT") | ((k == "STRING") & text.rlike(r"\S")),
    }
    return F.coalesce(kinds[entity.fields[field]], F.lit(False))


def row_faults(entity: Entity, image: Column, decimals: Column) -> Column:
    """What is wrong with a row, as text: required fields that are missing, known fields that have another kind; empty if none."""
    missing, others = [], []
    for field, kind_ in entity.fields.items():
        value = at(image, field)
        empty = value.isNull() | (kind(value) == "VOID")
        ok = field_ok(entity, field, value, decimals[field] if kind_ == "decimal" else text_of(value))
        if field in entity.required:
            missing.append(F.when(empty, F.lit(field)))
        others.append(F.when(~empty & ~ok, F.lit(f"{field} is no {kind_}")))
    listed = F.concat_ws(", ", *missing)
    return F.concat_ws("; ", F.when(listed != "", F.concat(F.lit("missing: "), listed)), *others)


def key_json(entity: Entity, holder: Column) -> Column:
    """The entity's key in an object as canonical JSON (sorted, compact); null if a part is missing, blank or no key type."""
    parts = []
    for field in sorted(entity.key):
        value = at(holder, field)
        text = text_of(value)
        shown = F.when(kind(value) == "BIGINT", F.try_variant_get(value, "$", "bigint").cast("string")).when(text.rlike(r"\S"), F.to_json(value))
        parts.append(F.concat(F.lit(f'"{field}":'), shown))
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit(","), part)
    return F.concat(F.lit("{"), joined, F.lit("}"))


def by_entity(name: Column, make) -> Column:
    """An expression that depends on which entity a record is of."""
    out = None
    for e in ENTITIES.values():
        out = F.when(name == e.name, make(e)) if out is None else out.when(name == e.name, make(e))
    return out


def row_json(entity: Entity, image: Column, decimals: Column) -> Column:
    """An image's declared fields as JSON text, decimals decoded, ready for from_json."""
    out = []
    for field, kind_ in entity.fields.items():
        value = at(image, field)
        shown = F.when(kind(value) == "VOID", F.lit(None).cast("string"))
        if kind_ == "decimal":  # digits, signs and points need no escaping; other text is no valid row's
            shown = shown.when(decimals[field].isNotNull() & ~decimals[field].rlike(r'["\\\\]'), F.concat(F.lit('"'), decimals[field], F.lit('"')))
        out.append(F.concat(F.lit(f'"{field}":'), shown.otherwise(F.to_json(value))))
    return F.concat(F.lit("{"), F.concat_ws(",", *out), F.lit("}"))


def event_day(milliseconds: Column, received: Column, arrived: Column | None = None) -> Column:
    """The day of the event's own time, else of its record's, else of the run's."""
    return F.coalesce(F.to_date(F.timestamp_millis(milliseconds)), F.to_date(received), F.to_date(arrived if arrived is not None else F.lit("1970-01-01").cast("timestamp")))


def classified(records: DataFrame, arrived: Column | None = None) -> DataFrame:
    """Every record with its reason code (null for events and tombstones) and the columns of events.

    arrived: the time that dates records which carry none; the run's, so that replays agree.
    """
    r = records.withColumns({"raw_payload": F.make_valid_utf8(F.col("value").cast("string")), "_key": F.make_valid_utf8(F.col("key").cast("string")), "entity": entity_of(F.col("topic"))})
    r = r.withColumns({"_doc": parsed(F.col("raw_payload")), "_keydoc": unwrapped(parsed(F.col("_key")))})
    r = r.withColumn("_env", unwrapped(F.col("_doc")))
    r = r.withColumn("_op", F.when(text_of(at(F.col("_env"), "op")).isin("c", "u", "d", "r"), text_of(at(F.col("_env"), "op"))))
    env = F.col("_env")
    r = r.withColumns({"_before": object_of(at(env, "before")), "_after": object_of(at(env, "after")), "_source": object_of(at(env, "source")), "_tx": object_of(at(env, "transaction"))})
    r = r.withColumn("_row", F.when(F.col("_op") == "d", F.col("_before")).otherwise(F.col("_after")))
    row, doc = F.col("_row"), F.col("_doc")
    # Decimals are decoded once for each image, in a step of their own, so that no expression repeats it.
    priced = {e.name: e for e in ENTITIES.values() if "decimal" in e.fields.values()}
    for image in ("before", "after"):
        decoded = reduce(lambda acc, e: acc.when(F.col("entity") == e.name, decimal_texts(e, doc, F.col(f"_{image}"), image)), list(priced.values())[1:], F.when(F.col("entity") == next(iter(priced)), decimal_texts(next(iter(priced.values())), doc, F.col(f"_{image}"), image)))
        r = r.withColumn(f"_{image}_decimals", decoded)
    r = r.withColumn("_decimals", F.when(F.col("_op") == "d", F.col("_before_decimals")).otherwise(F.col("_after_decimals")))
    r = r.withColumns(
        {
            "_fault": by_entity(F.col("entity"), lambda e: row_faults(e, row, F.col("_decimals"))),
            "_row_key": by_entity(F.col("entity"), lambda e: key_json(e, row)),
            "_message_key": by_entity(F.col("entity"), lambda e: key_json(e, F.col("_keydoc"))),
            "source_lsn": natural(at(F.col("_source"), "lsn")),
            "batch_id": F.coalesce(positive(at(row, "batch_id")), positive(at(F.col("_source"), "batch_id"))),
        }
    )
    tombstone = F.col("value").isNull()
    reason = (
        F.when(F.col("entity").isNull(), "unknown_topic")
        .when(tombstone & F.col("_message_key").isNull(), "missing_key")
        .when(tombstone, F.lit(None).cast("string"))
        .when(doc.isNull(), "invalid_json")
        .when(env.isNull(), "invalid_envelope")
        .when(F.col("_op").isNull(), "unsupported_operation")
        .when(row.isNull() | F.col("_source").isNull(), "invalid_envelope")
        .when(F.col("source_lsn").isNull(), "missing_source_lsn")
        .when((F.coalesce(F.col("_fault"), F.lit("?")) != "") | F.col("_row_key").isNull(), "invalid_schema")
        .when(F.col("_message_key").isNull(), "missing_key")
        .when(F.col("_message_key") != F.col("_row_key"), "invalid_schema")
        .when(F.col("batch_id").isNull(), "missing_batch_id")
    )
    order = F.coalesce(F.nullif(natural(at(F.col("_tx"), "data_collection_order")), F.lit(0)), F.nullif(natural(at(F.col("_tx"), "total_order")), F.lit(0)), F.lit(0)).cast("bigint")
    ts = F.coalesce(natural(at(F.col("_source"), "ts_ms")), natural(at(env, "ts_ms")))
    day = event_day(ts, F.col("timestamp"), arrived)

    def image_json(name: str) -> Column:
        return F.when(F.col(f"_{name}").isNotNull(), by_entity(F.col("entity"), lambda e: row_json(e, F.col(f"_{name}"), F.col(f"_{name}_decimals"))))

    live = ~tombstone
    r = r.withColumns(
        {
            "reason_code": reason,
            "is_tombstone": tombstone,
            "operation": F.when(live, F.col("_op")).otherwise(F.lit("t")),
            "key_json": F.col("_message_key"),
            "before_json": F.when(live, image_json("before")),
            "after_json": F.when(live, image_json("after")),
            "transaction_order": F.when(live, order),
            "source_timestamp_ms": F.when(live, ts),
            "kafka_timestamp": F.col("timestamp"),
            "event_date": day,
        }
    )
    r = r.withColumn("row_json", F.when(F.col("_op") == "d", F.col("before_json")).otherwise(F.col("after_json")))
    # One row from one row: a filter on the reason is not copied into every step above, which would repeat all of them.
    done = r.select(F.explode(F.array(F.struct("reason_code", F.col("_fault").alias("fault"), *EVENT_COLUMNS))).alias("r"))
    return done.select("r.*")


def events(parsed_records: DataFrame) -> DataFrame:
    """The events and tombstones among classified records."""
    return parsed_records.where("reason_code is null").select(*EVENT_COLUMNS)


def dead_letters(parsed_records: DataFrame) -> DataFrame:
    """The rest: why, where it was, and what it said."""
    fault = F.when(F.col("reason_code") == "invalid_schema", F.coalesce(F.nullif(F.col("fault"), F.lit("")), F.lit("the key is not the row's")))
    detail = F.concat(F.lit("record breaks the rule "), F.col("reason_code"), F.coalesce(F.concat(F.lit(": "), fault), F.lit("")))
    return parsed_records.where("reason_code is not null").select("reason_code", detail.alias("detail"), "entity", "topic", "partition", "offset", "kafka_timestamp", "raw_payload", "event_date")
