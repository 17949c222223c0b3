"""Every registered query of the engine against its SQL, on the smallest tables."""

import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from weirgate import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, date) else v


def shown(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, oracle, name):
    df = queries.QUERIES[name](spark, SF)
    expected = oracle.sql(queries.ORACLE_SQL[name])
    names = sorted(df.columns)
    assert names == sorted(expected.columns)
    got = shown(df.select(*(f"`{n}`" for n in names)).collect())
    assert got == shown(expected.select(*(f'"{n}"' for n in names)).fetchall())


def test_summed_checksums_see_changes(spark):
    from pyspark.sql import functions as F

    from weirgate.reconcile import measures

    source, candidate = queries.both_sides(spark, SF)
    a, b = (measures.summed_checksums(x, queries.PAIR).first() for x in (source, source.orderBy(F.desc("quantity")).repartition(3)))
    assert a == b != measures.summed_checksums(candidate, queries.PAIR).first()
    assert queries.QUERIES["rc_checksum_scalable"](spark, SF).first() == a
