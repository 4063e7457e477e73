"""The registered queries, each with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import values
from holdfast.functions.numbers import known
from holdfast.functions.readout import readout
from holdfast.operators import boosting, cleaning, domain, encoding, envelope, holdout, metrics, quantiles, sparse, trees
from holdfast.plans import fixtures, serving, training
from holdfast.plans.fixtures import with_accounts
from holdfast.runtime import materialize, scratch_path
from holdfast.sources import accounts, models, requests
from holdfast.streaming import scorer

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CATALOG_TREES = values.TREES


def register(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if oracle is not None:
            ORACLES[query.__name__] = oracle
        return query

    return add


def per_session(build: Callable[[SparkSession, str], object]):
    """Run `build` once per (application, data folder)."""
    results: dict[tuple[str, str], object] = {}

    @functools.wraps(build)
    def get(spark: SparkSession, sf_dir: str):
        where = (spark.sparkContext.applicationId, sf_dir)
        if where not in results:
            results[where] = build(spark, sf_dir)
        return results[where]

    return get


# SQL parts of the oracles.

_FLAG = "CAST(CASE WHEN {0}='Yes' THEN 1 ELSE 0 END AS INT) AS {0}"
_NUMBER = "TRY_CAST(trim(TotalCharges) AS DOUBLE)"
_CHARGES = f"CASE WHEN {_NUMBER} IS NULL OR isnan({_NUMBER}) THEN 0.0 ELSE {_NUMBER} END"


def _clean_columns(with_id: bool = True) -> str:
    columns = []
    for name in fixtures.ACCOUNT:
        if name in values.YES_NO or name == values.TARGET:
            columns.append(_FLAG.format(name))
        elif name == "TotalCharges":
            columns.append(f"{_CHARGES} AS TotalCharges")
        elif with_id or name != values.ID:
            columns.append(name)
    return ", ".join(columns)


CLEAN = f"(SELECT {_clean_columns()} FROM accounts_raw)"
PASSED = ["SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService", "PaperlessBilling",
          "MonthlyCharges", "TotalCharges"]
INDICATORS = [(c, level) for c in values.CATEGORICAL for level in sorted(values.LEVELS[c])[1:]]
FEATURES = PASSED + [f"{c}_{level}" for c, level in INDICATORS]


def _indicator_columns() -> str:
    return ", ".join(
        f"CAST(CASE WHEN {c}='{level}' THEN 1 ELSE 0 END AS INT) AS \"{c}_{level}\"" for c, level in INDICATORS
    )


def _levels_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(row_number() OVER (ORDER BY level) - 1 AS INT) AS position, level "
        f"FROM (SELECT DISTINCT {c} AS level FROM {table} WHERE {c} IS NOT NULL)"
        for c in columns
    )


def _split_sql(table: str, key: str, label: str, counted: bool = False) -> str:
    """The sides of all rows or, where keys repeat, how many of each class go to each side."""
    side = (
        "CASE WHEN row_number() OVER (PARTITION BY base.label ORDER BY digest) <= quota "
        "THEN 'train' ELSE 'test' END AS split FROM base JOIN quotas ON base.label = quotas.label"
    )
    result = f"SELECT base.id AS {key}, base.label AS {label}, {side}"
    if counted:
        result = f"SELECT {label}, split, count(*) AS n FROM (SELECT base.label AS {label}, {side}) GROUP BY ALL"
    return (
        f"base AS (SELECT {key} AS id, {label} AS label, "
        f"md5(concat_ws('|', CAST({key} AS VARCHAR), '{values.SEED}')) AS digest FROM {table}), "
        "classes AS (SELECT label, CAST(count(*) AS HUGEINT) AS k FROM base GROUP BY label), "
        f"sizes AS (SELECT sum(k) AS n, sum(k) - CAST(ceil(CAST({values.TEST_SIZE} AS DOUBLE)*sum(k)) AS HUGEINT) "
        "AS n_train FROM classes), "
        "shares AS (SELECT label, k*n_train//n AS whole, "
        "row_number() OVER (ORDER BY k*n_train%n DESC, label) AS place, n_train FROM classes, sizes), "
        "quotas AS (SELECT label, whole + CASE WHEN place <= n_train - (SELECT sum(whole) FROM shares) "
        "THEN 1 ELSE 0 END AS quota FROM shares) " + result
    )


def _auc_sql(table: str, label: str, score: str) -> str:
    return (
        f"ranked AS (SELECT {label} AS y, "
        f"rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1)/2.0 AS place FROM {table}) "
        "SELECT (sum(CASE WHEN y=1 THEN CAST(place AS DOUBLE) END) - CAST(sum(y) AS DOUBLE)*(sum(y)+1)/2)"
        "/(CAST(sum(y) AS DOUBLE)*(count(*)-sum(y))) AS auc FROM ranked"
    )


_COUNTS = ", ".join(
    f"CAST(count(*) FILTER (WHERE label={y} AND prediction={p}) AS BIGINT) AS {name}"
    for name, y, p in [("tp", 1, 1), ("fp", 0, 1), ("tn", 0, 0), ("fn", 1, 0)]
)


# Scans and sinks.


@per_session
def raw_csv(spark: SparkSession, sf_dir: str) -> str:
    """The raw accounts as CSV files, blanks kept."""
    path = scratch_path(spark, "accounts_csv")
    writer = fixtures.accounts_raw(spark, sf_dir).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@register(with_accounts("SELECT * FROM accounts_raw"))
def scan_accounts(spark, sf_dir):
    return accounts.scan_accounts(spark, raw_csv(spark, sf_dir))


@register(with_accounts("SELECT * FROM accounts_raw"))
def scan_accounts_reordered(spark, sf_dir):
    """Columns are found by name: here in another order, with one that is not known."""
    path = scratch_path(spark, "accounts_reordered")
    raw = fixtures.accounts_raw(spark, sf_dir)
    writer = raw.select(F.lit("x").alias("note"), *reversed(raw.columns)).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return accounts.scan_accounts(spark, path)


@register(with_accounts(f"SELECT * FROM {CLEAN}"))
def write_clean_csv_with_id(spark, sf_dir):
    path = scratch_path(spark, "clean_csv_with_id")
    accounts.write_table(cleaning.clean_accounts(fixtures.accounts_raw(spark, sf_dir), keep_id=True), path, "csv")
    return accounts.scan_clean(spark, path, "csv")


@register(with_accounts(f"SELECT * FROM {CLEAN}"))
def write_clean_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "clean")
    accounts.write_table(cleaning.clean_accounts(fixtures.accounts_raw(spark, sf_dir), keep_id=True), path)
    return accounts.scan_clean(spark, path)


@register(with_accounts(f"SELECT {_clean_columns(with_id=False)} FROM accounts_raw"))
def write_clean_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "clean_csv")
    raw = accounts.scan_accounts(spark, raw_csv(spark, sf_dir))
    accounts.write_table(cleaning.clean_accounts(raw), path, "csv")
    return accounts.scan_clean(spark, path, "csv")


@register(with_accounts("SELECT * FROM requests_raw"))
def scan_requests(spark, sf_dir):
    path = scratch_path(spark, "requests")
    fixtures.requests_raw(spark, sf_dir).write.json(path)
    return requests.scan_requests(spark, path, "json")


@register(with_accounts("SELECT content_type, value FROM (SELECT 'application/json' AS content_type, value FROM requests_raw)"))
def scan_request_lines(spark, sf_dir):
    path = scratch_path(spark, "request_lines")
    fixtures.requests_raw(spark, sf_dir).select("value").write.text(path)
    return requests.scan_requests(spark, path).select("content_type", "value")


def _other_split(spark: SparkSession, path: str, size: str) -> int:
    """Bytes of a split other than `size`: at least 50,000, and as many splits as cores have a few dozen of."""
    store = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    held = store.getContentSummary(spark._jvm.org.apache.hadoop.fs.Path(path)).getLength()
    usual = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)
    return max(50_000, min(usual // 2, held // (32 * spark.sparkContext.defaultParallelism)))


@register(with_accounts("SELECT value, count(*) AS copies, count(*) AS ids, CAST(1 AS INT) AS same FROM "
                        "(SELECT value FROM requests_raw UNION ALL SELECT value FROM requests_raw WHERE request_id % 3 = 0) GROUP BY value"))
def request_line_ids(spark, sf_dir):
    """Do lines, some of them repeated, get ids of their own, and the same ones however their files are split?"""
    path = scratch_path(spark, "repeated_lines")
    lines = fixtures.requests_raw(spark, sf_dir)
    repeated = lines.unionByName(lines.where("request_id % 3 = 0")).select("value")
    tasks = lines.rdd.getNumPartitions()
    # The copies of a line go to one file, so files repeat lines however many there are.
    (repeated.repartition(tasks, "value") if tasks > 1 else repeated.coalesce(1)).write.text(path)
    size = "spark.sql.files.maxPartitionBytes"
    first = materialize(requests.scan_requests(spark, path))
    before = spark.conf.get(size)
    spark.conf.set(size, str(_other_split(spark, path, before)))
    try:
        again = materialize(requests.scan_requests(spark, path))
    finally:
        spark.conf.set(size, before)
    known_again = again.select("request_id", F.col("value").alias("_value"))
    both = first.join(known_again, "request_id", "left")
    same = F.coalesce((F.col("value") == F.col("_value")).cast("int"), F.lit(0))
    return both.groupBy("value").agg(
        F.count(F.lit(1)).alias("copies"), F.countDistinct("request_id").alias("ids"), F.min(same).alias("same")
    )


@register(with_accounts("SELECT * FROM accounts_raw"))
def scan_accounts_mixed(spark, sf_dir):
    """A folder of files with different orders of columns, and others beside them."""
    path = scratch_path(spark, "mixed")
    raw = fixtures.accounts_raw(spark, sf_dir)
    digit = F.substring("customerID", -1, 1).cast("int") % 3
    for i, columns in enumerate([raw.columns, raw.columns[::-1], [*raw.columns[5:], "more", *raw.columns[:5]]]):
        part = raw.where(digit == i).withColumn("more", F.lit("x")).select(*columns)
        writer = part.write.mode("append").option("header", True)
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return accounts.scan_accounts(spark, path)


# Cleaning.


@register(with_accounts(f"SELECT {', '.join(c for c in fixtures.ACCOUNT if c != values.ID)} FROM accounts_raw"))
def drop_identifier(spark, sf_dir):
    return cleaning.drop_identifier(fixtures.accounts_raw(spark, sf_dir))


@register(with_accounts("SELECT customerID, nullif(trim(TotalCharges), '') AS TotalCharges FROM accounts_raw"))
def trim_blank(spark, sf_dir):
    return cleaning.trim_blank(fixtures.accounts_raw(spark, sf_dir)).select("customerID", "TotalCharges")


@register(
    with_accounts(
        f"SELECT customerID, CASE WHEN isnan({_NUMBER}) THEN NULL ELSE {_NUMBER} END AS TotalCharges, "
        f"CASE WHEN isnan({_NUMBER}) THEN 1 ELSE 0 END AS is_nan FROM accounts_raw"
    )
)
def lenient_cast(spark, sf_dir):
    number = cleaning.cast_lenient(cleaning.trim_blank(fixtures.accounts_raw(spark, sf_dir)))
    return number.select(
        "customerID",
        known(F.col("TotalCharges")).alias("TotalCharges"),
        F.isnan("TotalCharges").cast("int").alias("is_nan"),
    )


@register(with_accounts(f"SELECT customerID, {_CHARGES} AS TotalCharges FROM accounts_raw"))
def fill_missing(spark, sf_dir):
    number = cleaning.cast_lenient(cleaning.trim_blank(fixtures.accounts_raw(spark, sf_dir)))
    return cleaning.fill_missing(number).select("customerID", "TotalCharges")


@register(with_accounts(f"SELECT customerID, {_FLAG.format('Churn')} FROM accounts_raw"))
def encode_target(spark, sf_dir):
    return cleaning.encode_target(fixtures.accounts_raw(spark, sf_dir)).select("customerID", "Churn")


@register(
    with_accounts(
        f"SELECT customerID, SeniorCitizen, {', '.join(_FLAG.format(c) for c in values.YES_NO)} FROM accounts_raw"
    )
)
def encode_binary(spark, sf_dir):
    flags = cleaning.encode_binary(fixtures.accounts_raw(spark, sf_dir))
    return flags.select("customerID", "SeniorCitizen", *values.YES_NO)


@register(with_accounts(f"SELECT {_clean_columns(with_id=False)} FROM accounts_raw"))
def clean_accounts(spark, sf_dir):
    return cleaning.clean_accounts(fixtures.accounts_raw(spark, sf_dir))


_LEVEL_CHECKS = [(c, f"{c} IS NULL OR CAST({c} AS VARCHAR) NOT IN ({', '.join(repr(x) for x in levels)})")
                 for c, levels in values.LEVELS.items()]
_RANGE_CHECKS = [
    (c, f"TRY_CAST({c} AS DOUBLE) IS NULL OR isnan(TRY_CAST({c} AS DOUBLE)) OR TRY_CAST({c} AS DOUBLE) < 0")
    for c in values.NON_NEGATIVE
]


_WITH_NAN = "CASE WHEN customerID LIKE '%13' THEN CAST('NaN' AS DOUBLE) ELSE MonthlyCharges END"


@register(
    with_accounts(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", replace(CAST({c} AS VARCHAR), 'nan', 'NaN') AS value, count(*) AS count "
            f"FROM (SELECT * REPLACE ({_WITH_NAN} AS MonthlyCharges) FROM accounts_raw) WHERE {bad} GROUP BY 2"
            for c, bad in _LEVEL_CHECKS + _RANGE_CHECKS
        )
    )
)
def domain_violations(spark, sf_dir):
    """With numbers that are NaN among the charges."""
    raw = fixtures.accounts_raw(spark, sf_dir)
    return domain.domain_violations(raw.withColumn("MonthlyCharges", F.expr(_WITH_NAN)))


# Features.


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_accounts(fixtures.accounts_raw(spark, sf_dir), keep_id=True)


def _manifest(clean: DataFrame) -> list[encoding.Feature]:
    return encoding.manifest(clean.columns, encoding.category_levels(clean))


@register(with_accounts(_levels_sql("accounts_raw", values.CATEGORICAL)))
def category_levels(spark, sf_dir):
    return encoding.level_table(fixtures.accounts_raw(spark, sf_dir))


@register(_levels_sql("orders", ["o_orderstatus", "o_orderpriority"]))
def category_levels_orders(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders")
    return encoding.level_table(orders, ["o_orderstatus", "o_orderpriority"])


@register(
    _levels_sql("(SELECT CAST(l_partkey AS VARCHAR) AS l_partkey, l_returnflag FROM lineitem)", ["l_partkey", "l_returnflag"])
)
def category_levels_lineitem(spark, sf_dir):
    """Thousands of levels, none through the driver."""
    return encoding.level_table(fixtures.table(spark, sf_dir, "lineitem"), ["l_partkey", "l_returnflag"])


_SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register(
    "SELECT c_custkey, "
    + ", ".join(f"CAST(CASE WHEN c_mktsegment='{s}' THEN 1 ELSE 0 END AS INT) AS c_mktsegment_{s}" for s in _SEGMENTS)
    + " FROM customer"
)
def one_hot_customer(spark, sf_dir):
    customers = fixtures.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return encoding.one_hot(customers, encoding.category_levels(customers, ["c_mktsegment"]))


@register(with_accounts(f"SELECT customerID, {', '.join(PASSED)}, Churn, {_indicator_columns()} FROM {CLEAN}"))
def one_hot(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    return encoding.one_hot(clean, encoding.category_levels(clean))


@register(
    "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag='N' THEN 1 ELSE 0 END AS INT) AS l_returnflag_N, "
    "CAST(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END AS INT) AS l_returnflag_R, "
    "CAST(CASE WHEN l_linestatus='O' THEN 1 ELSE 0 END AS INT) AS l_linestatus_O FROM lineitem"
)
def one_hot_lineitem(spark, sf_dir):
    columns = ["l_returnflag", "l_linestatus"]
    lines = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *columns)
    return encoding.one_hot(lines, encoding.category_levels(lines, columns))


@register(
    with_accounts(
        "SELECT customerID, concat_ws(',', "
        + ", ".join(f'CAST(CAST("{name}" AS DOUBLE) AS VARCHAR)' for name in FEATURES)
        + f") AS features FROM (SELECT customerID, {', '.join(PASSED)}, {_indicator_columns()} FROM {CLEAN})"
    )
)
def assemble_features(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    features = _manifest(clean)
    vectors = encoding.assemble_features(
        encoding.encode_align(clean, features, [values.ID]), features, [values.ID]
    )
    numbers = vector_to_array("features").cast("array<string>")
    return vectors.select("customerID", F.array_join(numbers, ",").alias("features"))


@register(
    with_accounts(
        f"SELECT CAST(i AS INT) AS position, name FROM (SELECT unnest({PASSED!r}) AS name, unnest(range({len(PASSED)})) AS i) "
        f"UNION ALL SELECT CAST({len(PASSED)} - 1 + row_number() OVER (ORDER BY list_position({values.CATEGORICAL!r}, "
        "\"column\"), position) AS INT), concat(\"column\", '_', level) "
        "FROM (" + _levels_sql("accounts_raw", values.CATEGORICAL) + ") WHERE position > 0"
    )
)
def feature_manifest(spark, sf_dir):
    return encoding.manifest_frame(spark, _manifest(_clean(spark, sf_dir))).select("position", "name")


@register(
    with_accounts(
        f"SELECT customerID, {', '.join(PASSED[:-1])}, "
        f"CASE WHEN isnan({_NUMBER}) THEN NULL ELSE {_NUMBER} END AS TotalCharges, "
        + ", ".join(f'0 AS "{name}"' for name in FEATURES[len(PASSED) :])
        + f" FROM (SELECT a.TotalCharges, c.* EXCLUDE (TotalCharges) FROM accounts_raw a JOIN {CLEAN} c USING (customerID))"
    )
)
def align_columns(spark, sf_dir):
    """Absent indicators become 0, text columns go, nulls stay."""
    raw = cleaning.encode_binary(cleaning.cast_lenient(fixtures.accounts_raw(spark, sf_dir)))
    rows = raw.withColumn("TotalCharges", known(F.col("TotalCharges")))
    return encoding.align_columns(rows, FEATURES, [values.ID])


_UNSEEN = "CASE WHEN customerID LIKE '%7' THEN 'Weekly' ELSE Contract END"


@register(
    with_accounts(
        f"SELECT customerID, {', '.join(PASSED)}, {_indicator_columns()} "
        f"FROM (SELECT * REPLACE ({_UNSEEN} AS Contract) FROM {CLEAN})"
    )
)
def encode_align(spark, sf_dir):
    """Stored levels on a table with a level that they do not know."""
    clean = _clean(spark, sf_dir)
    changed = clean.withColumn("Contract", F.expr(_UNSEEN))
    return encoding.encode_align(changed, _manifest(clean), [values.ID])


_LINES = "(SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_partkey AS VARCHAR) AS l_partkey, l_returnflag FROM lineitem)"
_LINE_LEVELS = (
    f"parts AS (SELECT level, row_number() OVER (ORDER BY level) - 1 AS i FROM (SELECT DISTINCT l_partkey AS level FROM {_LINES})), "
    f"flags AS (SELECT level, row_number() OVER (ORDER BY level) - 1 AS i FROM (SELECT DISTINCT l_returnflag AS level FROM {_LINES})), "
    "n AS (SELECT (SELECT count(*) FROM parts) AS n_parts, (SELECT count(*) FROM flags) AS n_flags)"
)


def _line_manifest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    columns = ["l_partkey", "l_returnflag"]
    lines = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", *columns)
    lines = lines.withColumn("l_partkey", F.col("l_partkey").cast("string"))
    return lines, materialize(sparse.manifest_table(lines.columns[2:], columns, encoding.level_table(lines, columns)))


@register(
    f"WITH {_LINE_LEVELS} SELECT CAST(0 AS INT) AS position, 'l_quantity' AS name, 'l_quantity' AS source, CAST(NULL AS VARCHAR) AS level "
    "UNION ALL SELECT CAST(i AS INT), concat('l_partkey_', level), 'l_partkey', level FROM parts WHERE i > 0 "
    "UNION ALL SELECT CAST(n_parts - 1 + i AS INT), concat('l_returnflag_', level), 'l_returnflag', level FROM flags, n WHERE i > 0"
)
def manifest_lineitem(spark, sf_dir):
    """A manifest of thousands of features, none through the driver."""
    return _line_manifest(spark, sf_dir)[1].select("position", "name", "source", "level")


@register(
    f"WITH {_LINE_LEVELS} SELECT l_orderkey, l_linenumber, CAST(n_parts - 1 + n_flags AS INT) AS size, "
    "concat_ws(',', 0, CASE WHEN p.i > 0 THEN p.i END, CASE WHEN f.i > 0 THEN n_parts - 1 + f.i END) AS indices, "
    "CAST(l_quantity AS DOUBLE) + CASE WHEN p.i > 0 THEN 1 ELSE 0 END + CASE WHEN f.i > 0 THEN 1 ELSE 0 END AS total "
    f"FROM {_LINES} JOIN parts p ON p.level = l_partkey JOIN flags f ON f.level = l_returnflag, n"
)
def encode_sparse_lineitem(spark, sf_dir):
    """Thousands of levels by one lookup a column."""
    lines, table = _line_manifest(spark, sf_dir)
    found = sparse.encode_sparse(lines, table, ["l_orderkey", "l_linenumber"])
    return found.select(
        "l_orderkey",
        "l_linenumber",
        "features.size",
        F.array_join(F.col("features.indices").cast("array<string>"), ",").alias("indices"),
        F.aggregate("features.values", F.lit(0.0), lambda a, v: a + v).alias("total"),
    )


@register(ORACLES["encode_align"])
def encode_align_by_lookup(spark, sf_dir):
    """Stored levels, as a table, on a table with a level that they do not know."""
    clean = _clean(spark, sf_dir)
    table = materialize(sparse.manifest_table(clean.columns, values.CATEGORICAL, encoding.level_table(clean)))
    found = sparse.encode_sparse(clean.withColumn("Contract", F.expr(_UNSEEN)), table, [values.ID])
    numbers = sparse.dense(F.col("features"))
    types = encoding.encode_align(clean, _manifest(clean)).schema
    columns = [F.get(numbers, F.lit(i)).cast(types[name].dataType).alias(name) for i, name in enumerate(FEATURES)]
    return found.select(values.ID, *columns)


# Split.


@register(with_accounts("SELECT * FROM (WITH " + _split_sql("accounts_raw", "customerID", "Churn") + ")"))
def stratified_split(spark, sf_dir):
    rows = fixtures.accounts_raw(spark, sf_dir).select("customerID", "Churn")
    return holdout.stratified_split(rows, "Churn", "customerID")


@register("WITH " + _split_sql("orders", "o_orderkey", "o_orderstatus"))
def stratified_split_orders(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return holdout.stratified_split(orders, "o_orderstatus", "o_orderkey")


@register("WITH " + _split_sql("lineitem", "l_orderkey", "l_partkey", counted=True))
def stratified_split_lineitem(spark, sf_dir):
    """Thousands of classes."""
    lines = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    split = holdout.stratified_split(lines, "l_partkey", "l_orderkey")
    return split.groupBy("l_partkey", "split").agg(F.count("*").alias("n"))


_HOT = "CASE WHEN o_orderkey%3=0 THEN -1 ELSE o_orderkey END AS hot"


@register("WITH " + _split_sql(f"(SELECT o_orderstatus, {_HOT} FROM orders)", "hot", "o_orderstatus", counted=True))
def stratified_split_hot_key(spark, sf_dir):
    """A third of the rows share one key; they are told apart by the whole row."""
    orders = fixtures.table(spark, sf_dir, "orders").selectExpr(_HOT, "o_orderstatus", "o_totalprice")
    split = holdout.stratified_split(orders, "o_orderstatus", "hot")
    return split.groupBy("o_orderstatus", "split").agg(F.count("*").alias("n"))


# Evaluation.


@register(with_accounts(f"SELECT {_COUNTS} FROM scored"))
def confusion(spark, sf_dir):
    return metrics.confusion(fixtures.scored(spark, sf_dir))


@register(with_accounts("SELECT round(auc, 10) AS auc FROM (WITH " + _auc_sql("scored", "label", "probability") + ")"))
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(fixtures.scored(spark, sf_dir)).select(F.round("auc", 10).alias("auc"))


_EVENTS = "(SELECT CASE WHEN event_type='purchase' THEN 1 ELSE 0 END AS label, value FROM events)"


@register("SELECT round(auc, 10) AS auc FROM (WITH " + _auc_sql(_EVENTS, "label", "value") + ")")
def roc_auc_events(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    labelled = events.select((F.col("event_type") == "purchase").cast("int").alias("label"), "value")
    return metrics.roc_auc(labelled, score="value").select(F.round("auc", 10).alias("auc"))


_RETURNS = "(SELECT CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END AS label, l_extendedprice FROM lineitem)"


@register("SELECT round(auc, 10) AS auc FROM (WITH " + _auc_sql(_RETURNS, "label", "l_extendedprice") + ")")
def roc_auc_lineitem(spark, sf_dir):
    """Ranked by many ranges of scores."""
    lines = fixtures.table(spark, sf_dir, "lineitem")
    labelled = lines.select((F.col("l_returnflag") == "R").cast("int").alias("label"), "l_extendedprice")
    area = metrics.roc_auc(labelled, score="l_extendedprice", per_bucket=5000)
    return area.select(F.round("auc", 10).alias("auc"))


@register(
    with_accounts(
        f"SELECT metric, CAST(round_even(value, 4) AS DOUBLE) AS value FROM (WITH c AS (SELECT {_COUNTS} FROM scored), "
        f"a AS (WITH {_auc_sql('scored', 'label', 'probability')}) "
        "SELECT 'accuracy' AS metric, CAST(tp+tn AS DOUBLE)/(tp+fp+tn+fn) AS value FROM c "
        "UNION ALL SELECT 'precision', CASE WHEN tp+fp>0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0.0 END FROM c "
        "UNION ALL SELECT 'recall', CASE WHEN tp+fn>0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0.0 END FROM c "
        "UNION ALL SELECT 'auc', auc FROM a)"
    )
)
def metrics_report(spark, sf_dir):
    return metrics.metrics_report(fixtures.scored(spark, sf_dir))


# Requests.


@register(
    with_accounts(
        "SELECT k AS request_id, CASE WHEN k%8=3 THEN concat(head,ten,rest) ELSE value END AS payload "
        "FROM parts JOIN requests_raw ON request_id = k"
    )
)
def unwrap_body(spark, sf_dir):
    return envelope.unwrap_body(fixtures.requests_raw(spark, sf_dir)).select("request_id", "payload")


_POSITIONS = "(SELECT k AS request_id, unnest(CASE WHEN k%8 IN (4,6) THEN [0,1] ELSE [0] END) AS position, accounts.* FROM accounts WHERE k%8<>7 AND k%61<>0)"
_LACKS_TENURE = "(request_id%8=5 OR (request_id%8=6 AND position=1))"


@register(
    with_accounts(
        "SELECT request_id, CAST(position AS INT) AS position, "
        "gender, Contract, "
        f"CASE WHEN {_LACKS_TENURE} THEN NULL ELSE CAST(tenure AS VARCHAR) END AS tenure, "
        f"CAST(MonthlyCharges AS VARCHAR) AS MonthlyCharges FROM {_POSITIONS}"
    )
)
def parse_requests(spark, sf_dir):
    names = ["gender", "Contract", "tenure", "MonthlyCharges"]
    records = envelope.request_records(envelope.parse_requests(fixtures.requests_raw(spark, sf_dir), names))
    return records.select(
        "request_id", "position", *[F.col("record")[name].cast("string").alias(name) for name in names]
    )


@register(
    with_accounts(
        "SELECT request_id, CAST(position AS INT) AS position, "
        "CAST(SeniorCitizen AS DOUBLE) AS SeniorCitizen, "
        + ", ".join(f"CAST(CASE WHEN {c}='Yes' THEN 1 ELSE 0 END AS DOUBLE) AS {c}" for c in values.YES_NO)
        + ", CASE WHEN request_id%8=5 THEN 0.0 WHEN request_id%8=6 AND position=1 THEN NULL "
        "ELSE CAST(tenure AS DOUBLE) END AS tenure, MonthlyCharges, "
        "CAST((1825+hm*10)*ht AS DOUBLE)/100 AS TotalCharges, "
        + ", ".join(
            f"CAST(CASE WHEN {c}='{level}' THEN 1 ELSE 0 END AS DOUBLE) AS \"{c}_{level}\"" for c, level in INDICATORS
        )
        + f" FROM {_POSITIONS}"
    )
)
def align_requests(spark, sf_dir):
    features = _manifest(_clean(spark, sf_dir))
    parsed = envelope.parse_requests(fixtures.requests_raw(spark, sf_dir), *envelope.wanted_keys(features))
    records = envelope.align_requests(parsed, features).where("position is not null")
    return envelope.spread_values(records, features).drop("error")


@register(ORACLES["align_requests"])
def align_requests_by_keys(spark, sf_dir):
    """The same by looking up the keys that records have in a manifest that is a table."""
    clean = _clean(spark, sf_dir)
    table = sparse.manifest_table(clean.columns, values.CATEGORICAL, encoding.level_table(clean))
    parsed = envelope.parse_requests(fixtures.requests_raw(spark, sf_dir), None)
    records = sparse.align_sparse(parsed, materialize(table)).where("position is not null")
    rows = records.select("request_id", "position", "error", sparse.dense(F.col("features")).alias("values"))
    return envelope.spread_values(rows, _manifest(clean)).drop("error")


_ERROR = "CASE WHEN k%61=0 THEN 'Unsupported content type: text/csv' WHEN k%8=7 THEN 'malformed JSON' END"
_STRICT_ERROR = _ERROR.replace(" END", " WHEN k%8=6 THEN 'missing value: tenure' END")


@register(
    with_accounts(
        "SELECT k AS request_id, CAST(500 AS INT) AS status, "
        f"concat('{{\"error\":\"', {_STRICT_ERROR}, '\"}}') AS body, {_STRICT_ERROR} AS error FROM helpers "
        "WHERE k%61=0 OR k%8 IN (6,7)"
    )
)
def request_errors(spark, sf_dir):
    """With missing numbers as errors."""
    features = _manifest(_clean(spark, sf_dir))
    parsed = envelope.parse_requests(fixtures.requests_raw(spark, sf_dir), *envelope.wanted_keys(features))
    aligned = envelope.align_requests(parsed, features)
    return envelope.request_errors(envelope.settle_missing(aligned, features, fill=None))


_ODD = (
    "CASE k%4 WHEN 0 THEN '{\"tenure\":\"7\"}' WHEN 1 THEN '{\"tenure\":Infinity}' "
    "WHEN 2 THEN '{\"tenure\":null}' ELSE '{\"tenure\":7}' END"
)


@register(
    with_accounts(
        "SELECT k%50 AS request_id, CAST(CASE WHEN k%4<2 THEN 500 ELSE 200 END AS INT) AS status, "
        "CASE WHEN k%4<2 THEN 'not a number: tenure' END AS error FROM helpers"
    )
)
def score_odd_requests(spark, sf_dir):
    """Numbers as texts, without end, or null; and ids that many requests share."""
    wide = fixtures.accounts_wide(spark, sf_dir)
    odd = wide.selectExpr("k%50 AS request_id", "'application/json' AS content_type", f"{_ODD} AS value")
    return serving.score_requests(odd, trained(spark, sf_dir).stored).select("request_id", "status", "error")


def _event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.table(spark, sf_dir, "events")
    return events.selectExpr("event_id AS request_id", "'application/json' AS content_type", "props AS value")


@register(
    "SELECT event_id AS request_id, CAST(0 AS INT) AS position, json_extract_string(props, '$.k') AS k FROM events"
)
def parse_events(spark, sf_dir):
    records = envelope.request_records(envelope.parse_requests(_event_requests(spark, sf_dir), ["k"]))
    return records.select("request_id", "position", F.col("record.k").cast("string").alias("k"))


_FORM = {
    "customerID": "customerID",
    "Contract": "Contract",
    "SeniorCitizen": "CAST(SeniorCitizen AS STRING)",
    "Partner": "CASE WHEN Partner='Yes' THEN '1' ELSE '0 (none)' END",
    "tenure": "concat(' ', CAST(tenure AS STRING), ' months')",
    "MonthlyCharges": "concat(CAST(MonthlyCharges AS STRING), '$')",
    "TotalCharges": "TotalCharges",
}


@register(
    with_accounts(
        "SELECT customerID, Contract, CAST(SeniorCitizen AS BIGINT) AS SeniorCitizen, "
        "CAST(CASE WHEN Partner='Yes' THEN 1 ELSE 0 END AS BIGINT) AS Partner, CAST(tenure AS BIGINT) AS tenure, "
        f"MonthlyCharges, CASE WHEN NOT isnan({_NUMBER}) THEN {_NUMBER} END AS TotalCharges FROM accounts_raw"
    )
)
def type_fields(spark, sf_dir):
    form = fixtures.accounts_raw(spark, sf_dir).selectExpr(*[f"{e} AS {name}" for name, e in _FORM.items()])
    return envelope.type_fields(form)


_RESULTS = "account_id//3 AS request_id, account_id%3 AS position, prediction, probability"
_RESPONSES = (
    "SELECT request_id, CAST(200 AS INT) AS status, concat('{\"predictions\":[', "
    "string_agg(CAST(prediction AS VARCHAR), ',' ORDER BY position), '],\"probabilities\":[', "
    "string_agg(CAST(probability AS VARCHAR), ',' ORDER BY position), ']}') AS body "
    f"FROM (SELECT {_RESULTS} FROM scored) GROUP BY request_id"
)


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = fixtures.scored(spark, sf_dir).selectExpr(
        "account_id div 3 AS request_id", "account_id % 3 AS position", "prediction", "probability"
    )
    return envelope.build_responses(results).drop("error")


@register(with_accounts(_RESPONSES))
def build_responses(spark, sf_dir):
    return _responses(spark, sf_dir)


@register(
    with_accounts(
        "SELECT concat('{\"request_id\":', request_id, ',\"status\":200,\"body\":\"', "
        f"replace(body, '\"', concat(chr(92), '\"')), '\"}}') AS value FROM ({_RESPONSES})"
    )
)
def write_responses_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "responses")
    requests.write_responses(_responses(spark, sf_dir), path)
    return spark.read.text(path)


# Readout.


@register(
    with_accounts(
        "SELECT account_id, label, prediction, probability, floor(churn*10+0.5)/10 AS churn_pct, "
        "floor((100-churn)*10+0.5)/10 AS retention_pct, "
        f"CASE WHEN 100-churn >= {values.LOW_RISK_FROM} THEN 'low' WHEN 100-churn >= {values.MEDIUM_RISK_FROM} "
        "THEN 'med' ELSE 'high' END AS tier, CAST(floor((100-churn)/100*5+0.5) AS INT) AS bars, "
        "CASE WHEN prediction=1 THEN replace('" + values.CHURN_VERDICT + "', '{}', pct) "
        "ELSE replace('" + values.STAY_VERDICT + "', '{}', pct) END AS verdict "
        "FROM (SELECT *, CAST(floor(churn*10+0.5)/10 AS VARCHAR) AS pct "
        "FROM (SELECT *, probability*100 AS churn FROM scored))"
    )
)
def readout_accounts(spark, sf_dir):
    return readout(fixtures.scored(spark, sf_dir))


_EVENT_SCORES = (
    "event_id AS account_id, CAST(event_id%2 AS INT) AS label, "
    "CAST(CASE WHEN (event_id*7919)%100003 > 50001 THEN 1 ELSE 0 END AS INT) AS prediction, "
    "CAST((event_id*7919)%100003 AS DOUBLE)/100003 AS probability"
)


@register(ORACLES["readout_accounts"].replace("scored AS (SELECT", f"scored AS (SELECT {_EVENT_SCORES} FROM events), unused AS (SELECT"))
def readout_events(spark, sf_dir):
    """Probabilities with more decimals than are shown."""
    return readout(fixtures.table(spark, sf_dir, "events").selectExpr(*_EVENT_SCORES.replace(", ", "\n").split("\n")))


QUERIES["readout"] = QUERIES.pop("readout_accounts")
ORACLES["readout"] = ORACLES.pop("readout_accounts")


# Model.


@per_session
def trained(spark: SparkSession, sf_dir: str) -> training.Trained:
    """One fit for all the queries that need a model."""
    raw = fixtures.accounts_raw(spark, sf_dir)
    return training.run(spark, raw, scratch_path(spark, "model"), max_iter=CATALOG_TREES)


@register()
def fit_holdout(spark, sf_dir):
    """The report of the shared fit on its holdout."""
    return trained(spark, sf_dir).report()


@register()
def fit_documents_holdout(spark, sf_dir):
    """The same job on another problem: the quality of documents from their length and origin."""
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    labels = fixtures.table(spark, sf_dir, "labels").select("doc_id", "quality")
    path = scratch_path(spark, "documents")
    accounts.write_table(documents.join(labels, "doc_id"), path)
    fitted = training.train(
        accounts.scan_clean(spark, path), "doc_id", "quality", ["lang", "source"], max_iter=CATALOG_TREES
    )
    return fitted.report("quality")


@register()
def score_holdout(spark, sf_dir):
    return trained(spark, sf_dir).holdout


@register()
def score_accounts(spark, sf_dir):
    stored = trained(spark, sf_dir).stored
    return boosting.score_table(_clean(spark, sf_dir), stored.model, stored.features, keep=[values.ID])


@register()
def score_accounts_parity(spark, sf_dir):
    stored = trained(spark, sf_dir).stored
    return boosting.score_table(
        _clean(spark, sf_dir), stored.model, stored.features, boosting.REFERENCE_PARITY, [values.ID]
    )


# Scores by value. On the two indicators of one category, trees of depth 2 part its levels exactly,
# so the margin of a level follows from the share p of churners among its training rows alone.

_CONTRACT = (
    "SELECT * FROM (WITH RECURSIVE sides AS (SELECT * FROM (WITH "
    + _split_sql("accounts_raw", "customerID", "Churn")
    + ")), known AS (SELECT customerID, Contract, CAST(CASE WHEN a.Churn='Yes' THEN 1 ELSE 0 END AS INT) AS Churn, split "
    "FROM accounts_raw a JOIN sides USING (customerID)), "
    "shares AS (SELECT Contract, CAST(avg(Churn) AS DOUBLE) AS p FROM known WHERE split='train' GROUP BY Contract), "
    "steps AS (SELECT Contract, p, 1 AS i, 2*p-1 AS f FROM shares UNION ALL "
    f"SELECT Contract, p, i+1, f+CAST({values.LEARNING_RATE} AS DOUBLE)*(4*p/(1+exp(2*f))-4*(1-p)/(1+exp(-2*f))) "
    f"FROM steps WHERE i<{CATALOG_TREES}), "
    "levels AS (SELECT Contract, round(1/(1+exp(-2*f)), 6) AS probability, CAST(CASE WHEN f>0 THEN 1 ELSE 0 END AS INT) "
    f"AS prediction FROM steps WHERE i={CATALOG_TREES}), "
    "held AS (SELECT customerID, Churn, Churn AS label, prediction, probability FROM known JOIN levels USING (Contract) "
    "WHERE split='test') {0})"
)


@per_session
def contract_model(spark: SparkSession, sf_dir: str) -> training.Trained:
    clean = _clean(spark, sf_dir).select("customerID", "Contract", "Churn")
    path = scratch_path(spark, "contract")
    accounts.write_table(clean, path)
    return training.train(
        accounts.scan_clean(spark, path), categorical=["Contract"], max_iter=CATALOG_TREES, max_depth=2
    )


@register(with_accounts(_CONTRACT.format("SELECT customerID, Churn, prediction, probability FROM held")))
def contract_scores(spark, sf_dir):
    """Fitted classes and probabilities of the holdout."""
    held = contract_model(spark, sf_dir).holdout
    return held.select("customerID", "Churn", "prediction", F.round("probability", 6).alias("probability"))


@register(
    with_accounts(
        "SELECT metric, CAST(round_even(value, 4) AS DOUBLE) AS value FROM ("
        + _CONTRACT.format(
            f", c AS (SELECT {_COUNTS} FROM held), a AS (WITH {_auc_sql('held', 'label', 'probability')}) "
            "SELECT 'accuracy' AS metric, CAST(tp+tn AS DOUBLE)/(tp+fp+tn+fn) AS value FROM c "
            "UNION ALL SELECT 'precision', CASE WHEN tp+fp>0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0.0 END FROM c "
            "UNION ALL SELECT 'recall', CASE WHEN tp+fn>0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0.0 END FROM c "
            "UNION ALL SELECT 'auc', auc FROM a"
        )
        + ")"
    )
)
def contract_report(spark, sf_dir):
    return contract_model(spark, sf_dir).report()


_CONTRACT_RESPONSES = with_accounts(
    "SELECT k AS request_id, CAST(CASE WHEN k%61=0 OR k%8=7 THEN 500 ELSE 200 END AS INT) AS status, "
    "CASE WHEN k%61=0 OR k%8=7 THEN NULL WHEN k%8 IN (4,6) THEN concat(probability, ',', probability) "
    "ELSE CAST(probability AS VARCHAR) END AS probabilities FROM accounts JOIN ("
    + _CONTRACT.format("SELECT Contract, probability FROM levels")
    + ") USING (Contract)"
)


def _probabilities(responses: DataFrame) -> DataFrame:
    found = F.from_json("body", "probabilities array<double>").probabilities
    rounded = F.transform(found, lambda p: F.round(p, 6).cast("string"))
    return responses.select("request_id", "status", F.array_join(rounded, ",").alias("probabilities"))


@register(_CONTRACT_RESPONSES)
def contract_requests(spark, sf_dir):
    """The same model over JSON requests."""
    stored = contract_model(spark, sf_dir).stored
    return _probabilities(serving.score_requests(fixtures.requests_raw(spark, sf_dir), stored))


@register(_CONTRACT_RESPONSES)
def contract_stream(spark, sf_dir):
    """The same model over a stream of request files."""
    out = scratch_path(spark, "contract_responses")
    stored = contract_model(spark, sf_dir).stored
    query = scorer.score_stream(_request_stream(spark, sf_dir), stored, out, scratch_path(spark, "contract_state"))
    query.awaitTermination()
    return _probabilities(spark.read.parquet(out))


@register(
    with_accounts(
        "SELECT event_id AS request_id, probability FROM events, ("
        + _CONTRACT.format("SELECT probability FROM levels WHERE Contract='Month-to-month'")
        + ")"
    )
)
def predict_event_stream(spark, sf_dir):
    """Events as a stream: their texts lack the category, so each is scored as its first level."""
    path, out = scratch_path(spark, "event_files"), scratch_path(spark, "event_predictions")
    _event_requests(spark, sf_dir).write.json(path)
    query = scorer.predict_stream(
        requests.stream_requests(spark, path, "json"),
        contract_model(spark, sf_dir).stored,
        out,
        scratch_path(spark, "event_state"),
    )
    query.awaitTermination()
    return spark.read.parquet(out).select("request_id", F.round("probability", 6).alias("probability"))


# Second-order trees on one number column with missing values: trees of depth 2 part its two numbers and the missing ones,
# so the margin of each group follows from its number and share of churners.

SECOND_ORDER_TREES = 30
_TIER = "CASE Contract WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 1 END"

_SECOND_ORDER = (
    _CONTRACT.replace("CAST(avg(Churn) AS DOUBLE) AS p", "CAST(avg(Churn) AS DOUBLE) AS p, count(*) AS n")
    .replace(
        _CONTRACT[_CONTRACT.index("steps AS (") : _CONTRACT.index("levels AS (")],
        "steps AS (SELECT Contract, p, n, 0 AS i, CAST(0 AS DOUBLE) AS f FROM shares UNION ALL "
        f"SELECT Contract, p, n, i+1, f+CAST({values.LEARNING_RATE} AS DOUBLE)*n*(p-1/(1+exp(-f)))/(n/(1+exp(-f))/(1+exp(f))+1) "
        f"FROM steps WHERE i<{SECOND_ORDER_TREES}), ",
    )
    .replace("round(1/(1+exp(-2*f)), 6)", "round(1/(1+exp(-f)), 6)")
    .replace(f"WHERE i={CATALOG_TREES})", f"WHERE i={SECOND_ORDER_TREES})")
)


@per_session
def second_order_model(spark: SparkSession, sf_dir: str) -> training.Trained:
    path = scratch_path(spark, "tiers")
    accounts.write_table(_clean(spark, sf_dir).select("customerID", F.expr(_TIER).alias("tier"), "Churn"), path)
    return training.train(
        accounts.scan_clean(spark, path), categorical=[], second_order=True, max_iter=SECOND_ORDER_TREES, max_depth=2
    )


@register(with_accounts(_SECOND_ORDER.format("SELECT customerID, Churn, prediction, probability FROM held")))
def second_order_scores(spark, sf_dir):
    """Regularised leaf weights by value, and where missing numbers go."""
    held = second_order_model(spark, sf_dir).holdout
    return held.select("customerID", "Churn", "prediction", F.round("probability", 6).alias("probability"))


@register(with_accounts("SELECT customerID, CAST(1 AS INT) AS same FROM accounts_raw"))
def node_table_scores(spark, sf_dir):
    """Do the shared model's nodes, as a stored table, give each account the score that the model gives it?"""
    stored = trained(spark, sf_dir).stored
    path = scratch_path(spark, "nodes")
    found = trees.from_pipeline(stored.model, scratch_path(spark, "stage"))
    trees.node_table(spark, found).write.parquet(path)
    again = trees.from_nodes(spark.read.parquet(path).collect(), found.base, found.link)
    features = boosting.scoring_features(_clean(spark, sf_dir), stored.features, keep=[values.ID])
    rows = encoding.feature_values(features, stored.features, [values.ID])
    rows = rows.withColumn("values", encoding.filled(F.col("values"), values.STAND_IN))
    first = boosting.predict_values(rows, stored.model, [values.ID, "values"])
    first = first.withColumnsRenamed({"probability": "first", "prediction": "first_class"})
    both = trees.predict_trees(first, again, [F.col(values.ID), F.col("first"), F.col("first_class")])
    same = (F.abs(both["first"] - both.probability) < 1e-9) & (both.first_class == both.prediction)
    return both.select("customerID", F.coalesce(same.cast("int"), F.lit(0)).alias("same"))


_NUMBERS = ["l_quantity", "l_discount", "l_tax"]


@register(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS cut FROM "
        f"(SELECT DISTINCT {c} FROM lineitem WHERE {c} > (SELECT min({c}) FROM lineitem))"
        for c in _NUMBERS
    )
)
def quantile_cuts_lineitem(spark, sf_dir):
    """Split candidates of columns with few values: all but the least."""
    rows = fixtures.table(spark, sf_dir, "lineitem").select(F.array(*[F.col(c).cast("double") for c in _NUMBERS]).alias("values"))
    cuts = quantiles.quantile_cuts(rows, 255)
    return spark.createDataFrame([(_NUMBERS[i], cut) for i, found in cuts.items() for cut in found], "`column` string, cut double")


_PADDED = "CASE WHEN customerID LIKE '%3' THEN concat(Contract, ' ') WHEN customerID LIKE '%5' THEN 'N/A' ELSE Contract END"


@register(with_accounts("SELECT * FROM (WITH " + _split_sql("accounts_raw", "customerID", "Churn") + ") WHERE split='test'")
          .replace("SELECT * FROM (WITH base", "SELECT customerID, CAST(1 AS INT) AS same FROM (WITH base", 1))
def score_padded_rows(spark, sf_dir):
    """Does a table with padded and missing categories get the scores that the fit gave its holdout?"""
    clean = _clean(spark, sf_dir).select("customerID", F.expr(_PADDED).alias("Contract"), "Churn")
    path = scratch_path(spark, "padded")
    accounts.write_table(clean, path)
    table = accounts.scan_clean(spark, path)
    fitted = training.train(table, categorical=["Contract"], max_iter=CATALOG_TREES, max_depth=2)
    scored = boosting.score_table(clean, fitted.stored.model, fitted.stored.features, keep=[values.ID])
    held = fitted.holdout.select("customerID", F.col("probability").alias("held"))
    same = F.coalesce((F.col("held") == F.col("probability")).cast("int"), F.lit(0)).alias("same")
    return held.join(scored, "customerID").select("customerID", same)


def _plausible(scored: DataFrame) -> Column:
    """Does the class follow from a probability in (0, 1)?"""
    p = scored.probability
    follows = (p > 0) & (p < 1) & (scored.prediction == (p > 0.5).cast("int"))
    return F.coalesce(follows.cast("int"), F.lit(0)).alias("plausible")


@register(
    with_accounts(
        "SELECT customerID, CAST(CASE WHEN Churn='Yes' THEN 1 ELSE 0 END AS INT) AS Churn, CAST(1 AS INT) AS plausible "
        "FROM (WITH " + _split_sql("accounts_raw", "customerID", "Churn") + ") WHERE split = 'test'"
    )
)
def score_holdout_rows(spark, sf_dir):
    """Which accounts are held out, and are their scores plausible?"""
    held = trained(spark, sf_dir).holdout
    return held.select("customerID", "Churn", _plausible(held))


@register(with_accounts("SELECT customerID, CAST(1 AS INT) AS plausible FROM accounts_raw"))
def score_accounts_rows(spark, sf_dir):
    scored = score_accounts(spark, sf_dir)
    return scored.select("customerID", _plausible(scored))


@register(with_accounts("SELECT customerID, CAST(1 AS INT) AS same FROM accounts_raw"))
def score_accounts_parity_rows(spark, sf_dir):
    """Does parity score each account as if it had the first level of every category?"""
    stored = trained(spark, sf_dir).stored
    first_levels = {c: F.lit(sorted(values.LEVELS[c])[0]) for c in values.CATEGORICAL}
    baseline = _clean(spark, sf_dir).withColumns(first_levels)
    features = boosting.scoring_features(baseline, stored.features, keep=[values.ID])
    numbers = [f.name for f in stored.features if f.level is None]
    expected = boosting.predict(features, stored.model, stored.features, [values.ID, *numbers])
    both = boosting.predict(
        boosting.scoring_features(
            expected.withColumnsRenamed({"probability": "expected", "prediction": "expected_class"}),
            stored.features,
            boosting.REFERENCE_PARITY,
            [values.ID, "expected", "expected_class"],
        ),
        stored.model,
        stored.features,
        [values.ID, "expected", "expected_class"],
    )
    same = (both.expected == both.probability) & (both.expected_class == both.prediction)
    return both.select("customerID", F.coalesce(same.cast("int"), F.lit(0)).alias("same"))


@register(with_accounts("SELECT customerID, CAST(1 AS INT) AS same FROM accounts_raw"))
def model_roundtrip(spark, sf_dir):
    """Do the saved and reloaded model and manifest score each account as the fitted ones?"""
    fitted = trained(spark, sf_dir).stored
    path = scratch_path(spark, "roundtrip")
    models.save_model(spark, fitted, path)
    loaded = models.load_model(spark, path)
    features = encoding.encode_align(_clean(spark, sf_dir), fitted.features, [values.ID])
    first = boosting.predict(features, fitted.model, fitted.features, [values.ID, *FEATURES])
    again = first.withColumnsRenamed({"probability": "first", "prediction": "first_prediction"})
    both = boosting.predict(
        again, loaded.model, loaded.features, [values.ID, "first", "first_prediction"]
    )
    same = both["first"].eqNullSafe(both.probability) & both.first_prediction.eqNullSafe(both.prediction)
    return both.select("customerID", same.cast("int").alias("same"))


_STATUS = (
    f"SELECT k AS request_id, CAST(CASE WHEN {_ERROR} IS NULL THEN 200 ELSE 500 END AS INT) AS status, "
    f"CAST(CASE WHEN {_ERROR} IS NOT NULL THEN 0 WHEN k%8 IN (4,6) THEN 2 ELSE 1 END AS INT) AS n_predictions, "
    f"{_ERROR} AS error FROM helpers"
)


def _status(responses: DataFrame) -> DataFrame:
    """What can be told of responses without knowing the model."""
    results = F.from_json("body", "predictions array<int>, probabilities array<double>")
    fine = F.size(F.filter(results.probabilities, lambda p: (p >= 0) & (p <= 1)))
    return responses.select(
        "request_id", "status", F.coalesce(F.greatest(fine, F.lit(0)), F.lit(0)).alias("n_predictions"), "error"
    )


@register()
def score_requests(spark, sf_dir):
    return serving.score_requests(fixtures.requests_raw(spark, sf_dir), trained(spark, sf_dir).stored)


@register(with_accounts(_STATUS))
def score_requests_status(spark, sf_dir):
    return _status(serving.score_requests(fixtures.requests_raw(spark, sf_dir), trained(spark, sf_dir).stored))


@register()
def score_requests_parity(spark, sf_dir):
    stored = trained(spark, sf_dir).stored
    return serving.score_requests(fixtures.requests_raw(spark, sf_dir), stored, boosting.REFERENCE_PARITY)


def _request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "request_files")
    fixtures.requests_raw(spark, sf_dir).write.json(path)
    return requests.stream_requests(spark, path, "json")


@register()
def score_stream(spark, sf_dir):
    out = scratch_path(spark, "stream_responses")
    query = scorer.score_stream(
        _request_stream(spark, sf_dir), trained(spark, sf_dir).stored, out, scratch_path(spark, "stream_state")
    )
    query.awaitTermination()
    return spark.read.parquet(out).drop("batch")


@register(with_accounts(_STATUS))
def score_stream_status(spark, sf_dir):
    return _status(score_stream(spark, sf_dir))


@register()
def predict_stream(spark, sf_dir):
    out = scratch_path(spark, "stream_predictions")
    query = scorer.predict_stream(
        _request_stream(spark, sf_dir), trained(spark, sf_dir).stored, out, scratch_path(spark, "stream_state")
    )
    query.awaitTermination()
    return spark.read.parquet(out)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, fit, score and read out all accounts."""
    return readout(score_accounts(spark, sf_dir))
