"""Test inputs, derived from the given tables by SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdfast.runtime import spread

# Step 1: pseudo-random small numbers per account.
HELPERS = {
    "k": "c_custkey",
    "hg": "(c_custkey*7919+13)%1009%2",
    "hs": "(c_custkey*7877+5)%1013%6",
    "hp": "(c_custkey*7853+3)%1019%2",
    "hd": "(c_custkey*7867+29)%997%3",
    "ht": "(c_custkey*7841+7)%1021%73",
    "hf": "(c_custkey*7793+31)%1049%10",
    "hl": "(c_custkey*7759+37)%1051%2",
    "hi": "(c_custkey*7829+11)%1031%3",
    "hc": "(c_custkey*7817+17)%1033%3",
    "hb": "(c_custkey*7753+41)%1063%2",
    "hy": "(c_custkey*7741+43)%1069%4",
    "hm": "(c_custkey*7789+19)%1039",
    "hu": "(c_custkey*7727+47)%1087%100",
    "a1": "(c_custkey*7723+1)%1091%2",
    "a2": "(c_custkey*7717+1)%1091%2",
    "a3": "(c_custkey*7703+1)%1091%2",
    "a4": "(c_custkey*7699+1)%1091%2",
    "a5": "(c_custkey*7691+1)%1091%2",
    "a6": "(c_custkey*7687+1)%1091%2",
}


def _yes_no(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'Yes' ELSE 'No' END"


def _add_on(helper: str) -> str:
    return f"CASE WHEN hi=2 THEN 'No internet service' WHEN {helper}=0 THEN 'Yes' ELSE 'No' END"


# Step 2: the account columns. Blank, null, malformed and NaN charges are deliberate.
ACCOUNT = {
    "customerID": "concat('A', CAST(k AS STRING))",
    "gender": "CASE WHEN hg=0 THEN 'Female' ELSE 'Male' END",
    "SeniorCitizen": "CAST(CASE WHEN hs=0 THEN 1 ELSE 0 END AS INT)",
    "Partner": _yes_no("hp=0"),
    "Dependents": _yes_no("hd=0"),
    "tenure": "CAST(ht AS INT)",
    "PhoneService": "CASE WHEN hf=0 THEN 'No' ELSE 'Yes' END",
    "MultipleLines": "CASE WHEN hf=0 THEN 'No phone service' WHEN hl=0 THEN 'Yes' ELSE 'No' END",
    "InternetService": "CASE hi WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END",
    "OnlineSecurity": _add_on("a1"),
    "OnlineBackup": _add_on("a2"),
    "DeviceProtection": _add_on("a3"),
    "TechSupport": _add_on("a4"),
    "StreamingTV": _add_on("a5"),
    "StreamingMovies": _add_on("a6"),
    "Contract": "CASE hc WHEN 0 THEN 'Month-to-month' WHEN 1 THEN 'One year' ELSE 'Two year' END",
    "PaperlessBilling": _yes_no("hb=0"),
    "PaymentMethod": (
        "CASE hy WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check' "
        "WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END"
    ),
    "MonthlyCharges": "CAST(1825+hm*10 AS DOUBLE)/100",
    "TotalCharges": (
        "CASE WHEN ht=0 THEN ' ' WHEN k%97=0 THEN NULL WHEN k%89=0 THEN 'n/a' WHEN k%83=0 THEN 'NaN' "
        "ELSE CAST(CAST((1825+hm*10)*ht AS DOUBLE)/100 AS STRING) END"
    ),
    "Churn": _yes_no(
        "(CASE hc WHEN 0 THEN 55 WHEN 1 THEN 20 ELSE 8 END)+(CASE WHEN hi=1 THEN 20 ELSE 0 END)-ht*0.4 > hu"
    ),
}


def _one_zero(column: str) -> str:
    return f"CASE WHEN {column}='Yes' THEN '1' ELSE '0' END"


def _text(column: str) -> str:
    return f""",',"{column}":"', {column}, '"'"""


# Parts of a request text, over the account columns and helpers.
HEAD = (
    """concat('{"gender":"', gender, '","SeniorCitizen":', SeniorCitizen, ',"Partner":', """
    + _one_zero("Partner")
    + """, ',"Dependents":', """
    + _one_zero("Dependents")
    + ")"
)
TENURE = """concat(',"tenure":', tenure)"""
REST = (
    """concat(',"PhoneService":', """
    + _one_zero("PhoneService")
    + "".join(
        _text(c)
        for c in [
            "MultipleLines",
            "InternetService",
            "OnlineSecurity",
            "OnlineBackup",
            "DeviceProtection",
            "TechSupport",
            "StreamingTV",
            "StreamingMovies",
            "Contract",
        ]
    )
    + """, ',"PaperlessBilling":', """
    + _one_zero("PaperlessBilling")
    + _text("PaymentMethod")
    + """, ',"MonthlyCharges":', MonthlyCharges, ',"TotalCharges":', CAST((1825+hm*10)*ht AS DOUBLE)/100, '}')"""
)

REQUEST = {
    "request_id": "k",
    "content_type": "CASE WHEN k%61=0 THEN 'text/csv' ELSE 'application/json' END",
    "value": (
        "CASE k%8 "
        """WHEN 3 THEN concat('{"body":"', """
        "replace(concat(head,ten,rest), chr(34), concat(chr(92),chr(34))), "
        """'"}') """
        "WHEN 4 THEN concat('[', head,ten,rest, ',', head,ten,rest, ']') "
        "WHEN 5 THEN concat(head,rest) "
        "WHEN 6 THEN concat('[', head,ten,rest, ',', head,rest, ']') "
        "WHEN 7 THEN concat(head,ten) "
        "ELSE concat(head,ten,rest) END"
    ),
}

# A deterministic stand-in for model output; 101 distinct scores, so there are ties.
SCORED = {
    "account_id": "k",
    "label": "CAST(CASE WHEN Churn='Yes' THEN 1 ELSE 0 END AS INT)",
    "prediction": "CAST(CASE WHEN (hc*31+hi*17+ht*5+hu)%101 > 50 THEN 1 ELSE 0 END AS INT)",
    "probability": "CAST((hc*31+hi*17+ht*5+hu)%101 AS DOUBLE)/100",
}


def _list(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


def with_accounts(query: str) -> str:
    """DuckDB SQL over the derived tables accounts_raw, requests_raw and scored."""
    return (
        f"WITH helpers AS (SELECT {_list(HELPERS)} FROM customer), "
        f"accounts AS (SELECT *, {_list(ACCOUNT)} FROM helpers), "
        f"accounts_raw AS (SELECT {', '.join(ACCOUNT)} FROM accounts), "
        f"parts AS (SELECT *, {HEAD} AS head, {TENURE} AS ten, {REST} AS rest FROM accounts), "
        f"requests_raw AS (SELECT {_list(REQUEST)} FROM parts), "
        f"scored AS (SELECT {_list(SCORED)} FROM accounts) "
        f"{query}"
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _expressions(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def accounts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Helpers and account columns. The keys are dealt out first, as a row group holds up to a million."""
    helpers = spread(table(spark, sf_dir, "customer").select("c_custkey")).selectExpr(*_expressions(HELPERS))
    return helpers.selectExpr("*", *_expressions(ACCOUNT))


def accounts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts_wide(spark, sf_dir).select(*ACCOUNT)


def requests_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = accounts_wide(spark, sf_dir).selectExpr("*", f"{HEAD} AS head", f"{TENURE} AS ten", f"{REST} AS rest")
    return parts.selectExpr(*_expressions(REQUEST))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts_wide(spark, sf_dir).selectExpr(*_expressions(SCORED))
