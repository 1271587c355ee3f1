"""Read-only SQL guard: rule order and quirks, reproduced exactly."""

import pytest

from contrail.plans import UnsafeQueryError, check_statement, gold_sql, register_gold, sql_audit

CASES = [
    ("select 1", None),
    ("SELECT created_at FROM t", "CREATE"),
    ("with x as (select 1) select * from x", "not_select"),
    ("select a from t union all select b from u", None),
    ("select a from t union select b from u", r"UNION\s+SELECT"),
    ("select xp_cmd from t", None),  # upper-cased text never contains 'xp_'
    ("select 1;", None),
    ("select '--' from t", "--"),
    ("\n  select 1  \n", None),
    ("select 1; drop table t", "DROP"),
    ("select 1; select 2", r";\s*\w"),
    ("select /* hi */ 1", r"/\*"),
    ("select 1 from t where x = 'EXECUTE'", "EXEC"),  # EXEC shadows EXECUTE
    ("select 1; é", r";\s*\w"),  # Unicode space and letter, as in Python
    ("delete from t", "not_select"),
]


@pytest.mark.parametrize("sql,rule", CASES)
def test_single_statement(spark, sql, rule):
    got_rule, msg = check_statement(spark, sql)
    assert got_rule == rule
    if rule is None:
        assert msg is None
    elif rule == "not_select":
        assert msg == "Only SELECT queries allowed."
    elif rule.isalpha():
        assert msg == f"Blocked keyword detected: {rule}"
    else:
        assert msg == "Suspicious SQL pattern detected."


def test_table_audit_matches_single(spark):
    df = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(CASES)], "stmt_id bigint, q string")
    got = {r.stmt_id: (r.rule, r.allowed) for r in sql_audit(df).collect()}
    for i, (_, rule) in enumerate(CASES):
        assert got[i] == (rule, rule is None)


def test_gold_sql_guards_and_runs(spark):
    register_gold(spark.createDataFrame([("a", "AIRBORNE")], "icao24 string, status string"))
    assert gold_sql(spark, "SELECT count(*) AS n FROM flights_gold").first().n == 1
    with pytest.raises(UnsafeQueryError, match="Blocked keyword detected: DROP"):
        gold_sql(spark, "SELECT 1; DROP TABLE flights_gold")


# Python-side evaluation of the same rules, used as the oracle for parity.
def _python_rule(sql: str):
    import re

    from contrail import schema as S

    q = sql.strip().upper()
    if not q.startswith(S.GUARD_PREFIX):
        return "not_select"
    for kw in S.GUARD_KEYWORDS:
        if kw in q:
            return kw
    for pat in S.GUARD_PATTERNS:
        if re.search(pat, q):
            return pat
    return None


def test_guard_matches_python_rules_on_random_statements(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    pieces = st.sampled_from([
        "select", "SELECT ", " from t", " union ", " union all ", "select", ";", "; ", "--", "/*", "*/",
        "xp_", "drop", "created_at", "exec", "é", "ü", "_", "1", " ", "\t", "\n", "\x0b", "\x1c", "\xa0",
        " ", "　", "'", "a", "Z",
    ])
    stmts = st.lists(st.text(st.sampled_from("ab;- \t\n\x0b\xa0 é1_"), max_size=3) | pieces, max_size=8).map("".join)

    @settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(stmts, min_size=1, max_size=30))
    def check(batch):
        df = spark.createDataFrame([(i, q) for i, q in enumerate(batch)], "stmt_id bigint, q string")
        got = {r.stmt_id: r.rule for r in sql_audit(df).collect()}
        for i, q in enumerate(batch):
            assert got[i] == _python_rule(q), (q, got[i], _python_rule(q))

    check()


def test_null_statement_is_refused(spark):
    from contrail.plans import sql_audit

    (r,) = sql_audit(spark.createDataFrame([(None,)], "q string")).collect()
    assert (r.allowed, r.rule) == (False, "not_select")


@pytest.mark.parametrize("stmt", [
    "SELECT java_method('java.lang.System', 'currentTimeMillis') FROM flights_gold",
    "SELECT `reflect`('java.lang.System', 'currentTimeMillis') FROM flights_gold",
    "SELECT try_reflect('a', 'b') FROM flights_gold",
    "SELECT count(*) FROM parquet.`/root/testdata/sf0.001/nation.parquet`",
    "SELECT (SELECT max(n_name) FROM parquet.`/root/testdata/sf0.001/nation.parquet`) FROM flights_gold",
    "SELECT * FROM flights_gold WHERE status IN (SELECT id FROM other_table)",
    "SELECT * FROM range(5)",
])
def test_gold_sql_stays_on_the_gold_view(spark, stmt):
    from contrail.plans import UnsafeQueryError, gold_sql, register_gold

    register_gold(spark.range(2).withColumnRenamed("id", "status"))
    with pytest.raises(UnsafeQueryError):
        gold_sql(spark, stmt)
    ok = "SELECT * FROM (WITH x AS (SELECT status FROM flights_gold) SELECT count(*) AS n FROM x) y"
    assert gold_sql(spark, ok).first().n == 2
