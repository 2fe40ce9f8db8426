"""Table digests: independent of row order, sensitive to every value."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyfield.catalog.standins import digest_sql
from tallyfield.operators.digest import table_digest


def digest(df):
    return tuple(table_digest(df, "t").first())


def test_digest_ignores_order_and_sees_every_change(spark, tables):
    rows = tables.read("orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    whole = digest(rows)
    assert whole[1] == rows.count() and whole == digest(rows.repartition(7).orderBy(F.rand(1)))
    key = rows.agg(F.max("o_orderkey")).first()[0]
    last = F.col("o_orderkey") == key
    changes = {
        "o_totalprice": F.col("o_totalprice") + 0.001, "o_orderstatus": F.lit(None).cast("string"),
        "o_orderdate": F.col("o_orderdate") + F.expr("interval 1 second"),
    }
    for name, value in changes.items():
        changed = digest(rows.withColumn(name, F.when(last, value).otherwise(F.col(name))))
        assert changed[1] == whole[1] and changed[2] != whole[2], name
    assert digest(rows.union(rows.where(last)))[2] != whole[2] and digest(rows.limit(0)) == ("t", 0, 0)


def test_digest_of_sums_in_another_order_is_the_same(spark):
    rows = spark.createDataFrame([(0.1 + 0.2,), (1.5,), (-2.25,)], "x double")
    assert digest(rows) == digest(spark.createDataFrame([(0.3,), (-2.25,), (1.5,)], "x double"))


@pytest.mark.parametrize("value", ["NULL::DOUBLE", "1.5::DOUBLE", "-0.25::DOUBLE", "DATE '2020-02-29'", "true", "'a|b'", "7::BIGINT",
                                   "TIMESTAMP '2020-01-01 10:00:00'"])
def test_digest_is_that_of_sql(spark, value):
    sql = f"SELECT {value} AS v, 2 AS w"
    theirs = duckdb.connect().execute(digest_sql("t", sql)).fetchone()
    ours = spark.sql(sql.replace("::DOUBLE", "D").replace("NULLD", "cast(NULL AS double)").replace("::BIGINT", "L"))
    assert digest(ours) == theirs
