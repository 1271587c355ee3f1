"""Statements that try to leave the Gold view: refused on the analyzed plan, without running anything."""

import pytest
from pyspark.errors import AnalysisException

from contrail.plans import UnsafeQueryError, gold_sql, register_gold

SECRET = "java_method('java.lang.System', 'getProperty', 'user.name')"
WIDE = "SELECT " + ", ".join(f"{i} AS c{i}" for i in range(40))
HOSTILE = [
    f"{WIDE}, {SECRET} FROM flights_gold",
    "SELECT * FROM IDENTIFIER('other')",
    "SELECT * FROM IDENTIFIER('ot' || 'her')",
    "SELECT IDENTIFIER('java_' || 'method')('java.lang.System', 'getProperty', 'user.name') FROM flights_gold",
    "SELECT * FROM (WITH other AS (SELECT 1 AS a) SELECT * FROM other) x, other",
    "SELECT * FROM other",
    "SELECT * FROM flights_gold g JOIN other o ON g.id = o.id",
    "SELECT * FROM flights_gold WHERE id IN (SELECT id FROM other)",
    "SELECT (SELECT max(id) FROM other) AS m FROM flights_gold",
    "SELECT * FROM flights_gold WHERE EXISTS (SELECT 1 FROM (SELECT * FROM other) y WHERE y.id = flights_gold.id)",
    "SELECT * FROM parquet.`/root/testdata/sf0.001/events.parquet`",
    "SELECT * FROM text.`/etc/hostname`",
    "SELECT * FROM global_temp.shared",
    "SELECT * FROM spark_catalog.default.stored",
    "SELECT * FROM stored",
    "SELECT * FROM range(10)",
    "SELECT * FROM IDENTIFIER('ra' || 'nge')(10)",
    "SELECT * FROM sql_keywords()",
    "SELECT * FROM collations()",
    f"SELECT transform(array(1), x -> {SECRET}) FROM flights_gold",
    "SELECT try_reflect('java.lang.System', 'getProperty', 'user.name') FROM flights_gold",
    f"SELECT count(*) FROM flights_gold GROUP BY {SECRET}",
    f"SELECT count(*) OVER (PARTITION BY {SECRET}) FROM flights_gold",
    "SELECT own_function(id) FROM flights_gold",
]
FINE = [
    ("SELECT count(*) FROM flights_gold", 1),
    ("SELECT a.id FROM flights_gold a JOIN FLIGHTS_GOLD b USING (id)", 3),
    ("SELECT * FROM (WITH other AS (SELECT id FROM flights_gold) SELECT * FROM other) x", 3),
    ("SELECT id, row_number() OVER (ORDER BY id) FROM flights_gold WHERE id > (SELECT min(id) FROM flights_gold)", 2),
    ("SELECT g.id, v.col1 FROM flights_gold g CROSS JOIN (VALUES (1), (2)) v", 6),
    ("SELECT explode(array(id, id)) FROM flights_gold", 6),
    ("SELECT 'java_method(reflect)' AS t, 1 AS one", 1),
    (f"{WIDE} FROM flights_gold", 3),
    ("SELECT id FROM flights_gold LATERAL VIEW explode(array(1)) t AS z", 3),
]


@pytest.fixture(scope="module")
def gold(spark):
    spark.range(3).createOrReplaceTempView("other")
    spark.range(3).createOrReplaceGlobalTempView("shared")
    spark.sql("DROP TABLE IF EXISTS stored")
    spark.range(3).write.mode("overwrite").saveAsTable("stored")
    spark.udf.register("own_function", lambda x: x, "long")
    register_gold(spark.range(3))
    yield
    spark.sql("DROP TABLE stored")
    spark.catalog.dropGlobalTempView("shared")


@pytest.mark.parametrize("stmt", HOSTILE)
def test_hostile_statement_is_refused(spark, gold, stmt):
    with pytest.raises((UnsafeQueryError, AnalysisException)) as e:
        gold_sql(spark, stmt)
    assert isinstance(e.value, UnsafeQueryError) or "own_function" in stmt


@pytest.mark.parametrize("stmt,rows", FINE)
def test_plain_statement_runs(spark, gold, stmt, rows):
    assert len(gold_sql(spark, stmt).collect()) == rows


def test_mistakes_stay_mistakes_and_settings_are_taken_along(spark, gold):
    with pytest.raises(AnalysisException, match="nope"):
        gold_sql(spark, "SELECT nope FROM flights_gold")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert gold_sql(spark, "SELECT current_timezone() AS z").first().z == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [t.name for t in spark.catalog.listTables("global_temp") if t.name.startswith("flights_gold_")] == []
