"""Query surface over the Gold table: guarded read-only SQL, the statement
audit, and the example questions as DataFrame functions."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.functions.audit import guard_message, guard_rule

GOLD_VIEW = "flights_gold"


class UnsafeQueryError(ValueError):
    """The statement failed the read-only guard."""


# ---------------------------------------------------------------------------
# Guard and audit
# ---------------------------------------------------------------------------


def sql_audit(statements: DataFrame, col: str = "q") -> DataFrame:
    """Add ``allowed`` / ``rule`` / ``message`` for every statement in a table.

    Pure column expressions, so auditing a statement log of any size is a
    map-only job."""
    rule = guard_rule(F.col(col))
    return statements.withColumn("rule", rule).select(
        "*",
        F.col("rule").isNull().alias("allowed"),
        guard_message(F.col("rule")).alias("message"),
    )


def check_statement(spark: SparkSession, sql: str) -> tuple[str | None, str | None]:
    """(rule, message) for one statement, evaluated with the same expressions as
    :func:`sql_audit` on a one-row local relation (runs on the driver)."""
    row = sql_audit(spark.createDataFrame([(sql,)], "q string")).first()
    return row["rule"], row["message"]


def register_gold(gold_df: DataFrame, name: str = GOLD_VIEW) -> None:
    gold_df.createOrReplaceTempView(name)


# Plan nodes without children that read nothing by themselves; every other leaf is a table, a file or a range.
_OWN_LEAVES = {"OneRowRelation", "LocalRelation", "CTERelationRef"}
# Functions that make rows out of values; other row-making functions list what the engine knows.
_GENERATORS = {"Explode", "PosExplode", "Inline", "Stack", "JsonTuple", "GeneratorOuter", "VariantExplode", "ReplicateRows"}
# Function classes that call code outside the engine's own functions, and the names of those that analysis itself would look classes up for.
_REFLECTION = {"CallMethodViaReflection", "TryReflect"}
_REFLECTION_NAMES = {"java_method", "reflect", "try_reflect"}
_FOREIGN_KINDS = ("UDF", "UDAF", "UDTF", "ScalaAggregator", "HiveUDAFFunction", "ApplyFunctionExpression")


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _foreign(expr) -> str | None:
    """Why an expression of an analyzed plan, or one inside it, can't be used."""
    kind = _kind(expr)
    if kind in _REFLECTION or (kind == "UnresolvedFunction" and _items(expr.nameParts())[-1].lower() in _REFLECTION_NAMES):
        return "reflection can't be used"
    if any(k in kind for k in _FOREIGN_KINDS):
        return "user-defined functions can't be used"
    return next(filter(None, map(_foreign, _items(expr.children()))), None)


def _beyond(plan, view: str) -> str | None:
    """Why an analyzed plan reaches beyond the view, or null. The view's own plan isn't looked into."""
    kind, children = _kind(plan), _items(plan.children())
    if kind == "View":
        name = plan.desc().identifier().unquotedString()
        return None if plan.isTempView() and name == view else f"only {view} can be queried, not {name}"
    if not children and kind not in _OWN_LEAVES:
        return f"only {view} can be queried, not a {kind}"
    if kind == "Generate" and _kind(plan.generator()) not in _GENERATORS:
        return "table functions can't be used"
    reasons = [*map(_foreign, _items(plan.expressions()))]
    reasons += [_beyond(p, view) for p in [*children, *_items(plan.subqueries())]]
    return next(filter(None, reasons), None)


def _named_reflection(parsed) -> str | None:
    """Reflection that a parsed plan names outright."""
    below = [*_items(parsed.children()), *_items(parsed.innerChildren()), *_items(parsed.subqueries())]
    reasons = [*map(_foreign, _items(parsed.expressions())), *map(_named_reflection, below)]
    return next(filter(None, reasons), None)


def _query_session(spark: SparkSession, view: str) -> SparkSession:
    """A session with the caller's settings in which the view is the only temporary one and paths aren't tables."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.runSQLOnFiles", "false")
    passage = f"{view}_{uuid.uuid4().hex}"
    spark.table(view).createOrReplaceGlobalTempView(passage)
    try:
        own.table(f"{spark.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{passage}").createOrReplaceTempView(view)
    finally:
        spark.catalog.dropGlobalTempView(passage)
    return own


def check_scope(session: SparkSession, sql: str, view: str = GOLD_VIEW) -> str | None:
    """Why a statement reaches beyond the Gold view, or null: it may read no other relation (file, table,
    view, range), call no table function that lists what the engine knows, no reflection and no user-defined function.

    Decided on the analyzed plan, node by node and with all subqueries: names are resolved by then, however they were
    written, and nothing has run. ``session`` is one of :func:`_query_session`, where other sessions' views don't exist."""
    state = session._jsparkSession.sessionState()
    parsed = state.sqlParser().parsePlan(sql)
    if reason := _named_reflection(parsed):
        return reason
    try:
        plan = state.executePlan(parsed, getattr(state, "executePlan$default$2")()).analyzed()
    except AnalysisException as e:
        if (e.getCondition() or "").startswith(("TABLE_OR_VIEW_NOT_FOUND", "UNSUPPORTED_DATASOURCE_FOR_DIRECT_QUERY")):
            return f"only {view} can be queried: {str(e).splitlines()[0]}"
        raise
    return _beyond(plan, view)


def gold_sql(spark: SparkSession, sql: str) -> DataFrame:
    """Run one read-only statement against the registered Gold view.

    Raises :class:`UnsafeQueryError` with the guard's message when the statement
    is refused, or with the reason when it reaches beyond the Gold view. Returns a
    lazy DataFrame: the caller decides how much to fetch."""
    rule, message = check_statement(spark, sql)
    if rule is None:
        session = _query_session(spark, GOLD_VIEW)
        message = check_scope(session, sql)
    if message is not None:
        raise UnsafeQueryError(message)
    return session.sql(sql)


# ---------------------------------------------------------------------------
# Example questions
# ---------------------------------------------------------------------------


def airborne(
    gold_df: DataFrame,
    *,
    bbox: tuple[float, float, float, float] | None = None,
    origin: str | None = None,
    by: str | None = None,
) -> DataFrame:
    """Count AIRBORNE flights, optionally inside ``bbox`` = (lat_min, lat_max,
    lon_min, lon_max) (inclusive; a location) and/or from ``origin`` country
    (registration, not location). ``by`` groups the count."""
    df = gold_df.filter(F.col("status") == S.STATUS_AIRBORNE)
    if bbox is not None:
        la0, la1, lo0, lo1 = bbox
        df = df.filter(F.col("latitude").between(la0, la1) & F.col("longitude").between(lo0, lo1))
    if origin is not None:
        df = df.filter(F.col("origin_country") == origin)
    n = F.count(F.lit(1)).alias("n_airborne")
    return df.groupBy(by).agg(n) if by else df.agg(n)


def top_countries(gold_df: DataFrame, k: int = 1) -> DataFrame:
    """The k origin countries with most flights; ties broken by name.
    ``orderBy`` + ``limit`` plans as a top-k (TakeOrderedAndProject), not a sort."""
    counts = gold_df.groupBy("origin_country").agg(F.count(F.lit(1)).alias("n_flights"))
    return counts.orderBy(F.col("n_flights").desc(), F.col("origin_country").asc()).limit(k)


def inactive_flights(gold_df: DataFrame) -> DataFrame:
    return gold_df.filter(F.col("status") == S.STATUS_INACTIVE)


def adsb_share(gold_df: DataFrame) -> DataFrame:
    """Percentage of flights tracked by ADS-B; null for an empty table."""
    adsb = F.count_if(F.col("source_type") == "ADS-B")
    return gold_df.agg(F.try_divide(F.lit(100.0) * adsb, F.count(F.lit(1))).alias("adsb_pct"))


def climb_descend(gold_df: DataFrame) -> DataFrame:
    """Flights per vertical direction (sign of ``vertical_rate``)."""
    vr = F.col("vertical_rate")
    direction = (
        F.when(vr > 0, "climbing").when(vr < 0, "descending").when(vr == 0, "level").otherwise("unknown")
    )
    return gold_df.groupBy(direction.alias("direction")).agg(F.count(F.lit(1)).alias("n_flights"))
