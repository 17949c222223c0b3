"""Units of the engine, and the retail source end to end."""

import base64
import json
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weirgate import publish, retail
from weirgate.context import Layout, Run, component
from weirgate.entities import ENTITIES
from weirgate.functions import expressions as X
from weirgate.functions.canonical import decimal_text, encode
from weirgate.operators import checks, merge, snapshot
from weirgate.pipeline import ancestors, run_pipeline
from weirgate.plans import serving
from weirgate.reconcile import measures
from weirgate.reconcile.rules import RETAIL, Aggregate, Rule, load
from weirgate.reconcile.service import Check, Report, compare_reports, validate
from weirgate.session import object_store
from weirgate.sources import tables
from weirgate.streaming import parse

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
DAY = datetime(2025, 1, 1, tzinfo=UTC)


def a_run(batch=3):
    return Run.named(retail.interval(1)[0], retail.interval(3)[1], batch)


def test_run_refuses_bad_values_and_names_are_stable():
    assert a_run() == a_run() and a_run().run_id != a_run(2).run_id
    for args in (("", 1, DAY, DAY), ("x", 0, DAY, DAY.replace(day=2)), ("x", True, DAY, DAY.replace(day=2)), ("x", 1, DAY, DAY), ("x", 1, DAY.replace(tzinfo=None), DAY), ("../x", 1, DAY, DAY.replace(day=2))):
        with pytest.raises((ValueError, TypeError)):
            Run(*args)


def test_paths_are_encoded():
    layout = Layout("s3a://lake/")
    assert layout.bronze_day("orders", "run 1/2", 7, date(2025, 1, 2)) == "s3a://lake/bronze/entity=orders/run_id=run%201%2F2/stream_batch=00000000000000000007/event_date=2025-01-02"
    assert layout.checkpoint("a/b", "t.x") == "s3a://lake/checkpoints/a%2Fb/t.x"
    with pytest.raises(ValueError):
        component("..")


def test_identifiers_and_store_settings():
    assert X.quoted("a.b") == "`a`.`b`" and X.quoted("a", upper=True) == "`A`"
    for bad in ("a b", "a;drop", "", "a.", "`a`"):
        with pytest.raises(ValueError):
            X.quoted(bad)
    assert object_store({}) == {}
    with pytest.raises(ValueError):
        object_store({"OBJECT_STORE_KEY": "k"})
    assert object_store({"OBJECT_STORE_KEY": "k", "OBJECT_STORE_SECRET": "s", "OBJECT_STORE_ENDPOINT": "http://h"})["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_rules_are_checked():
    assert [len(r.checks) for r in RETAIL] == [8, 12, 11, 12]
    with pytest.raises(ValueError):
        Rule("a", {"x": "text"}, ("y",), {})
    with pytest.raises(ValueError):
        Rule("a", {"x": "number"}, ("x",), {})
    with pytest.raises(ValueError):
        load({"entities": [{"entity": "a", "columns": {"x": "text"}, "key": ["x"], "other": 1}]})
    assert load({"entities": [{"entity": "a", "columns": {"x": "text"}, "key": ["x"]}]})[0].key == ("x",)


def test_missing_paths_are_empty_but_other_errors_raise(spark, tmp_path):
    schema = ENTITIES["orders"].silver_type()
    assert tables.silver(spark, str(tmp_path / "none"), schema).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        tables.silver(spark, str(tmp_path / "bad"), schema).collect()


def test_stored_tables_are_counted(spark, tmp_path):
    assert tables.written(spark.range(5), str(tmp_path / "t")).count() == 5 == tables.footer_rows(spark, str(tmp_path / "t"))


def test_lossless_types(spark):
    df = spark.createDataFrame([(Decimal("3"), 1, "x")], "ID decimal(10,0), FLAG int, NAME string")
    assert tables.lossless(df, {"id": "bigint", "flag": "boolean", "name": "string"}).first() == (3, True, "x")
    with pytest.raises(Exception):
        tables.lossless(spark.createDataFrame([(Decimal("3.5"),)], "id decimal(10,1)"), {"id": "bigint"}).collect()
    with pytest.raises(TypeError):
        tables.lossless(df, {"name": "bigint"})


def test_cutoff_ignores_loading_batches(spark):
    b = retail.batch_table(spark, 3, loading=True)
    assert tables.cutoff(b, datetime(2025, 1, 3)) == 2
    with pytest.raises(LookupError):
        tables.cutoff(b, datetime(2024, 1, 1))


def test_reads_once(spark):
    calls = []
    once = tables.Once(lambda e, b: (calls.append((e, b)), spark.range(b))[1])
    assert once("a", 2).count() == once("a", 2).count() == 2 and once("a", 3).count() == 3
    once.clear()
    assert calls == [("a", 2), ("a", 3)]


event = st.tuples(st.integers(1, 3), st.sampled_from("cud"), st.integers(1, 4), st.integers(1, 5), st.integers(0, 2), st.booleans())


@quick
@given(st.lists(event, max_size=25), st.integers(1, 5))
def test_state_is_a_fold(spark, rows, batch):
    made = [(f'{{"k":{k}}}', op, b, lsn, tx, 0, i, tomb, date(2025, 1, 1)) for i, (k, op, b, lsn, tx, tomb) in enumerate(rows)]
    df = spark.createDataFrame(made, "key_json string, operation string, batch_id long, source_lsn long, transaction_order long, partition int, offset long, is_tombstone boolean, event_date date")
    best = {}
    for r in made:
        if r[2] <= batch and not r[7] and (r[0] not in best or r[3:7] > best[r[0]][3:7]):
            best[r[0]] = r
    expected = {r[0]: r[6] for r in best.values() if r[1] != "d"}
    assert {r.key_json: r.offset for r in snapshot.current_events(df, batch).collect()} == expected
    by_max = snapshot.latest_by_max(snapshot.admitted(df, batch), ("key_json",), snapshot.SOURCE_ORDER).where("operation <> 'd'")
    assert {r.key_json: r.offset for r in by_max.collect()} == expected


def test_repeated_keys_raise(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "a int, b int")
    with pytest.raises(ValueError):
        snapshot.unique(df, ("a",))
    assert snapshot.unique(df, ("a", "b")) is df


def test_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    row = lambda *r: spark.createDataFrame(list(r), "id int, v string, batch long")
    merge.store(spark, path, row((1, "a", 1), (2, "b", 1)), ("id",), "batch")
    merge.store(spark, path, row((2, "c", 2), (3, "d", 2), (4, "old", 0)), ("id",), "batch")
    assert sorted(tuple(r) for r in merge.current(spark, path).collect()) == [(1, "a", 1), (2, "c", 2), (3, "d", 2)]
    assert merge.versions(spark, path) == [1, 2]
    with pytest.raises(ValueError):
        merge.merge(None, row((1, "a", 1), (1, "b", 1)), ("id",))
    with pytest.raises(ValueError):
        merge.upsert(row((1, "a", 1)), spark.createDataFrame([(1, "a")], "id int, v string"), ("id",))


def test_canonical_text(spark):
    df = spark.createDataFrame([("e\u0301", Decimal("1.500"), True, 3, date(2025, 1, 2), 0.1, datetime(2025, 1, 2, 3))], "s string, m decimal(10,3), b boolean, i int, d date, f double, t timestamp_ntz")
    out = encode(df.drop("t"), {"s": "text", "m": "decimal", "b": "boolean", "i": "integer", "d": "date", "f": "float"}).first()
    assert tuple(out) == ("S:\u00e9", "M:1.5", "B:1", "I:3", "D:2025-01-02", "F:0.10000000000000001")
    with pytest.raises(TypeError):
        encode(df, {"t": "timestamp"})
    with pytest.raises(TypeError):
        encode(df, {"b": "integer"})
    with pytest.raises(Exception):
        encode(spark.createDataFrame([(float("inf"),)], "f double"), {"f": "float"}).collect()
    zeros = spark.createDataFrame([(Decimal("0.00"),), (Decimal("-0.10"),), (Decimal("100"),), (None,)], "m decimal(10,2)")
    assert [r.m for r in encode(zeros, {"m": "decimal"}).collect()] == ["M:0", "M:-0.1", "M:100", "N"]


SALES = Rule("sales", {"id": "integer", "group": "text", "amount": "integer"}, ("id",), {"group": ("group",)}, (Aggregate("by_group", "sum", "amount", ("group",)), Aggregate("all", "max", "amount")))


def sales(spark, rows):
    return spark.createDataFrame(rows, "id long, `group` string, amount long")


def test_checksums_and_groups(spark):
    a, b, c = ([(1, "x", 5), (2, "y", None)], [(2, "y", None), (1, "x", 5)], [(1, "x", 5), (2, "y", 0)])
    for mode in ("exact", "sums"):
        x, y, z = (measures.CHECKSUMS[mode](sales(spark, r), SALES).first() for r in (a, b, c))
        assert x == y and x["amount"] != z["amount"] and x["group"] == z["group"]
    assert {r.group: r.value for r in measures.aggregate(sales(spark, a), SALES, SALES.aggregates[0]).collect()} == {"S:x": "M:5", "S:y": "N"}
    assert measures.aggregate(sales(spark, []), SALES, SALES.aggregates[1]).count() == 0


def test_validation_fails_closed(spark):
    rows = [(1, "x", 5), (2, "y", 6)]
    good = lambda e: sales(spark, rows)
    none = lambda e: sales(spark, []).select("id")

    def broken(e):
        raise RuntimeError("gone")

    assert validate(a_run(), good, good, none, [SALES]).passed
    bad = validate(a_run(), good, lambda e: sales(spark, [(1, "x", 5), (2, "y", 7)]), none, [SALES])
    assert {c.name for c in bad.failures} == {"checksum:amount", "aggregate:by_group", "aggregate:all"}
    assert [c.name for c in validate(a_run(), good, broken, none, [SALES]).failures] == ["query_error"]
    assert not validate(a_run(), good, good, None, [SALES]).passed
    assert not validate(a_run(), good, good, none, []).passed
    empty = lambda e: sales(spark, [])
    assert {c.name for c in validate(a_run(), empty, empty, none, [SALES]).failures} == {"non_empty"}
    left = validate(a_run(), good, good, lambda e: sales(spark, rows[:1]).select("id"), [SALES])
    assert [(c.name, c.actual) for c in left.failures] == [("deleted_absent", '["I:1"]')]


def test_reports_are_compared():
    one = Report("r", 1, (Check("e", "a", True, "1", "1"), Check("e", "b", True, "2", "2")))
    two = Report("r", 1, (Check("e", "a", True, "1", "1"),))
    three = Report("r", 1, (Check("e", "a", False, "1", "9"), Check("e", "b", True, "2", "2")))
    assert compare_reports({"x": one, "y": one})["agreed"]
    assert compare_reports({"x": one, "y": two})["missing"] == [{"entity": "e", "name": "b", "missing_on": ["y"]}]
    assert compare_reports({"x": one, "y": three})["failed_targets"] == ["y"] and not compare_reports({"x": one})["agreed"]


def test_reports_tell_groups_beyond_those_shown(spark):
    rows = [(i, f"g{i:03}", i) for i in range(150)]
    source, none = (lambda e: sales(spark, rows)), (lambda e: sales(spark, []).select("id"))
    made = {t: validate(a_run(), source, lambda e, k=k: sales(spark, [*rows[:k], (k, f"g{k:03}", -1), *rows[k + 1 :]]), none, [SALES], "sums") for t, k in (("x", 140), ("y", 141))}
    by_group = {t: next(c for c in r.checks if c.name == "aggregate:by_group") for t, r in made.items()}
    for t, k in (("x", 140), ("y", 141)):
        assert f'"S:g{k}": "M:{k}"' in by_group[t].expected and f'"S:g{k}": "M:-1"' in by_group[t].actual and "150 groups in all" in by_group[t].actual
    assert "aggregate:by_group" in [d["name"] for d in compare_reports(made)["disagreements"]]
    left = validate(a_run(), source, source, lambda e: sales(spark, rows[:120]).select("id"), [SALES], "sums").failures
    assert [c.name for c in left] == ["deleted_absent"] and "120 groups in all" in left[0].actual
    one, two = (Report("r", 1, (Check("e", "a", True, x, "1"),)) for x in ("1", "2"))
    assert [d["name"] for d in compare_reports({"x": one, "y": two})["disagreements"]] == ["a"]


def test_gates(spark, tmp_path):
    run, registry = a_run(), publish.Registry(str(tmp_path / "control"))
    spark.range(2).withColumn("pipeline_batch_id", F.lit(3)).write.parquet(str(tmp_path / "t"))
    passed, failed = Report(run.run_id, 3, (Check("e", "a", True),)), Report(run.run_id, 3, (Check("e", "a", False),))
    promote = lambda report, names={"t": str(tmp_path / "t")}, r=run, **k: publish.promote(spark, registry, r, report, names, **k)
    for report in (failed, passed):  # the second has no audit row yet
        with pytest.raises(publish.Refused):
            promote(report)
    # A passed report publishes nothing without data tests, or with failed ones, however often it is tried.
    for tests in (None, ["fact_order.order_id unique"]):
        registry.record_validation(passed, failed_tests=tests)
        assert registry.validations()[run.run_id]["status"] == "failed"
        for _ in range(2):
            with pytest.raises(publish.Refused):
                promote(passed)
    registry.record_validation(passed, failed_tests=[])
    with pytest.raises(Exception):
        promote(passed, {"t": str(tmp_path / "t"), "u": str(tmp_path / "missing")})
    assert registry.manifest() == {} and registry.publications() == {}
    assert promote(passed) == "published" and promote(passed) == "unchanged"
    assert publish.views(spark, registry)["t"].count() == 2 and registry.status(spark).first().status == "passed"
    older = a_run(2)
    registry.record_validation(Report(older.run_id, 2, passed.checks), failed_tests=[])
    with pytest.raises(publish.Refused):
        promote(Report(older.run_id, 2, passed.checks), r=older)
    silent = publish.Discarded(str(tmp_path / "other"))
    silent.record_validation(passed)
    assert silent.validations() == {}


def test_declared_tests_are_all_there_and_find_faults(spark):
    from weirgate.operators.declared import DECLARED, violations

    by_group = {g: sum(len(t.split()) for n, cs in DECLARED.items() if n.startswith(g) for t in cs.values()) for g in ("silver", "stg", "orders_e", "order_items_e", "validation", "dim", "fact")}
    assert by_group["silver"] == 22 and by_group["stg"] == 30 and by_group["orders_e"] + by_group["order_items_e"] + by_group["validation"] == 20 and by_group["dim"] + by_group["fact"] == 46
    child = spark.createDataFrame([(1, "a", -1), (1, None, 0), (9, "z", 5)], "id int, s string, n int")
    found = violations("child", {"child": child, "parent": spark.createDataFrame([(1,)], "k int")}, {"id": "unique to:parent.k", "s": "filled in:a,b", "n": "not_negative positive", "id,n": "unique"})
    assert dict(found.collect()) == {"child.id unique": 1, "child.id to:parent.k": 1, "child.s filled": 1, "child.s in:a,b": 1, "child.n not_negative": 1, "child.n positive": 2, "child.id,n unique": 0}


def test_values_at_their_own_scale(spark):
    rows = [(Decimal("0.123456789012"), Decimal(10**37)), (Decimal("0.123456789011"), Decimal(-5)), (Decimal("-0.000000000000"), Decimal(0))]
    df = spark.createDataFrame(rows, "a decimal(20,12), b decimal(38,0)")
    got = [tuple(r) for r in df.select(decimal_text(F.col("a")), decimal_text(F.col("b"))).collect()]
    assert got == [("0.123456789012", str(10**37)), ("0.123456789011", "-5"), ("0", "0")]
    values = [10**47 + 7, -(10**47) - 7, 2**151, -(2**159), -1, 2**119, -(2**120)]
    coded = [(base64.b64encode(v.to_bytes(n, "big", signed=True)).decode(), 2) for v in values for n in (20, 33)]
    out = spark.createDataFrame(coded, "t string, s long").select(parse.decoded_decimal(F.col("t"), F.col("s")).alias("x")).collect()
    shown = lambda v: f"{'-' * (v < 0)}{abs(v) // 100}.{abs(v) % 100:02}"
    assert [r.x for r in out] == [shown(v) for v in values for _ in range(2)]
    with pytest.raises(Exception):
        spark.createDataFrame([("no time",)], "t string").select(X.instant(F.col("t"))).collect()


def test_exact_checksums_are_bounded(spark, monkeypatch):
    from weirgate.reconcile import service

    monkeypatch.setattr(service, "EXACT_ROWS", 2)
    source = lambda e: sales(spark, [(i, "g", i) for i in range(3)])
    assert [c.name for c in validate(a_run(), source, source, None, [SALES], "exact").failures][-1] == "query_error"


def test_data_tests_find_faults(spark):
    df = spark.createDataFrame([(1, "a", -1), (1, None, 0), (2, "z", 5)], "id int, s string, n int")
    assert checks.is_null(df, "s").count() == 1 and checks.repeats(df, ("id",)).count() == 1
    assert checks.unaccepted(df, "s", ("a",)).count() == 1
    assert checks.negative(df, "n").count() == 1 and checks.not_positive(df, "n").count() == 2
    assert checks.orphans(df, "s", spark.createDataFrame([("a",)], "k string"), "k").first().s == "z"


def python_reason(topic, key, value):
    """A plain twin of the classification, for records of orders."""
    if topic.rsplit(".", 1)[-1].lower() not in ENTITIES:
        return "unknown_topic"

    def loads(x):
        try:
            out = json.loads(x)
        except (TypeError, ValueError):
            return None
        return out if isinstance(out, dict) else None

    def unwrap(x):
        if x is None or ("schema" not in x and "payload" not in x):
            return x
        return x["payload"] if isinstance(x.get("payload"), dict) else None

    def whole(x):
        return x if type(x) is int else None

    k = unwrap(loads(key))
    key_ok = k is not None and whole(k.get("order_id")) is not None
    if value is None:
        return None if key_ok else "missing_key"
    doc = loads(value)
    if doc is None:
        return "invalid_json"
    env = unwrap(doc)
    if env is None:
        return "invalid_envelope"
    if env.get("op") not in ("c", "u", "d", "r"):
        return "unsupported_operation"
    row, src = env.get("before" if env["op"] == "d" else "after"), env.get("source")
    if not isinstance(row, dict) or not isinstance(src, dict):
        return "invalid_envelope"
    number = lambda x: x if type(x) is int and x >= 0 else int(x) if isinstance(x, str) and x.isdigit() else None
    if number(src.get("lsn")) is None:
        return "missing_source_lsn"
    if any(whole(row.get(f)) is None for f in ("order_id", "customer_id")) or not isinstance(row.get("status"), str):
        return "invalid_schema"
    if row.get("batch_id") is not None and whole(row["batch_id"]) is None:
        return "invalid_schema"
    if not key_ok:
        return "missing_key"
    if k["order_id"] != row["order_id"]:
        return "invalid_schema"
    return None if (number(row.get("batch_id")) or number(src.get("batch_id"))) else "missing_batch_id"


scalar = st.sampled_from([1, 2, "1", "x", True, None, -1, 0])
row = st.one_of(st.none(), st.just(5), st.fixed_dictionaries({"order_id": st.sampled_from([1, "1", None]), "customer_id": st.sampled_from([2, True]), "ordered_at": st.just("t"), "status": st.sampled_from(["paid", 3]), "updated_at": st.just("t"), "batch_id": scalar}))
body = st.fixed_dictionaries({"op": st.sampled_from(["c", "d", "t", 1]), "before": row, "after": row, "source": st.one_of(st.none(), st.fixed_dictionaries({"lsn": scalar, "batch_id": scalar}))})
record = st.tuples(st.sampled_from(["a.orders", "a.none"]), st.sampled_from(['{"order_id":1}', '{"order_id":2}', '{"payload":{"order_id":1}}', "{", None, '{"payload":1}']), st.one_of(st.none(), st.sampled_from(["{", "[]"]), body.map(json.dumps), body.map(lambda b: json.dumps({"payload": b}))))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(record, min_size=60, max_size=120))
def test_classification_matches_a_plain_twin(spark, cases):
    rows = [(None if k is None else k.encode(), None if v is None else v.encode(), t, 0, i, DAY) for i, (t, k, v) in enumerate(cases)]
    found = {r.offset: r.reason_code for r in parse.classified(spark.createDataFrame(rows, tables.RECORD)).select("offset", "reason_code").collect()}
    assert found == {i: python_reason(*c) for i, c in enumerate(cases)}


@quick
@given(st.lists(st.tuples(st.integers(-(2**60), 2**60), st.integers(0, 6)), min_size=1, max_size=20))
def test_binary_decimals(spark, values):
    coded = [(base64.b64encode(v.to_bytes(v.bit_length() // 8 + 1, "big", signed=True)).decode(), s) for v, s in values]
    df = spark.createDataFrame(coded, "t string, s long").select(parse.decoded_decimal(F.col("t"), F.col("s")).alias("x"))
    assert [r.x for r in df.collect()] == [format(Decimal(v).scaleb(-s), "f") for v, s in values]


def test_binary_decimal_in_an_event(spark):
    field = lambda name: {"field": name, "fields": [{"field": "unit_price", "name": parse.DECIMAL_NAME, "parameters": {"scale": "2"}}]}
    after = {"product_id": 5, "sku": "s", "name": "n", "category": "c", "unit_price": "B8s=", "active": True, "updated_at": "t", "batch_id": 1}
    value = {"schema": {"fields": [field("before"), field("after")]}, "payload": {"op": "c", "after": after, "source": {"lsn": 1}}}
    rows = [(b'{"product_id":5}', json.dumps(value).encode(), "x.products", 0, 0, DAY), (b"\xff", b'\xff{"a"', "x.products", 0, 1, DAY)]
    out = parse.classified(spark.createDataFrame(rows, tables.RECORD))
    assert json.loads(parse.events(out).first().row_json)["unit_price"] == "19.95"
    letter = parse.dead_letters(out).first()
    assert letter.reason_code == "invalid_json" and letter.raw_payload.startswith("\ufffd")


def test_models_are_ordered():
    names = ancestors(["fact_order", "dim_date"])
    assert names.index("stg_orders") < names.index("orders_enriched") < names.index("fact_order") and "stg_products" not in names


def test_top_is_bounded(spark):
    with pytest.raises(ValueError):
        serving.product_performance(None, None, None, DAY, DAY, 101)


def test_retail_history(spark):
    src = retail.source(3)
    assert [sum(1 for x in src.log if x[4] == b) for b in (1, 2, 3)] == [10, 7, 9]
    items = retail.history_table(spark, src, "order_items")
    state = snapshot.history_state(items, ("order_id", "line_number"), 2).select(F.sum(F.col("quantity") * F.col("unit_price")).alias("r")).first().r
    assert state == Decimal("143.45")
    assert [tuple(r) for r in snapshot.history_deleted(items, ("order_id", "line_number"), 3).collect()] == [(5002, 1)]


def test_pipeline_end_to_end_and_corruption(spark, tmp_path):
    src = retail.source(3)
    retail.topic_table(spark, src).coalesce(1).write.parquet(str(tmp_path / "log"))
    registry, layout = publish.Registry(str(tmp_path / "control")), Layout(str(tmp_path / "root"))
    history = {e: retail.history_table(spark, src, e).persist() for e in ENTITIES}
    out = run_pipeline(spark, layout, a_run(), registry, history.__getitem__, log=str(tmp_path / "log"))
    assert out.report.passed and len(out.report.checks) == 43 and out.failed_tests == [] and out.published == "published"
    views = publish.views(spark, registry)
    assert {v: df.count() for v, df in views.items()} == {"dim_customer": 3, "dim_product": 4, "dim_date": 4, "fact_order": 3, "fact_order_item": 6}
    assert serving.kpis(views["fact_order"], date(2025, 1, 1), date(2025, 1, 3)).first() == (Decimal("162.85"), 3, 3, Decimal("54.283333"))
    actual = {(c.entity, c.name): c.actual for c in out.report.checks}
    assert json.loads(actual["order_items", "aggregate:price_sum_by_product"]) == {"I:2001": "M:39.9", "I:2002": "M:46.5", "I:2004": "M:17"}
    # One changed value in the source fails exactly its checksum, and the published run stays.
    wrong = dict(history, customers=history["customers"].withColumn("email", F.when(F.col("customer_id") == 1001, "x@y.z").otherwise(F.col("email"))))
    again = run_pipeline(spark, layout, Run("second", 3, *retail.interval(3)), registry, wrong.__getitem__, archive=layout.root)
    assert [(c.entity, c.name) for c in again.report.failures] == [("customers", "checksum:email")] and again.published is None
    assert registry.manifest()["run_id"] == out.run.run_id


def test_batches_happen_once(monkeypatch):
    src = retail.source(2)
    before = {e: dict(rows) for e, rows in src.rows.items()}, list(src.log)
    assert not retail.apply(src, 2) and (src.rows, src.log) == before
    drop = src.drop

    def fail(*key):
        drop(*key)
        raise RuntimeError("lost connection")

    monkeypatch.setattr(src, "drop", fail)
    with pytest.raises(RuntimeError):
        retail.apply(src, 3)
    assert (src.rows, src.log) == before and src.completed == {1, 2}
    monkeypatch.undo()
    assert retail.apply(src, 3) and src.log == retail.source(3).log
