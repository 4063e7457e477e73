"""Fixed values of the account data set: columns, levels and texts."""

from pyspark.sql import types as T

# Names and meanings come from the data set, not from this code.
ID = "customerID"
TARGET = "Churn"

YES_NO = ["Partner", "Dependents", "PhoneService", "PaperlessBilling"]

CATEGORICAL = [
    "gender",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "Contract",
    "PaymentMethod",
]

INT_FIELDS = ["SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService", "PaperlessBilling"]
FLOAT_FIELDS = ["MonthlyCharges", "TotalCharges"]

_YES_NO_LEVELS = ["Yes", "No"]
_ADD_ON_LEVELS = ["No", "Yes", "No internet service"]

# Allowed levels of the raw table, by column.
LEVELS = {
    "gender": ["Female", "Male"],
    "SeniorCitizen": ["0", "1"],
    "Partner": _YES_NO_LEVELS,
    "Dependents": _YES_NO_LEVELS,
    "PhoneService": _YES_NO_LEVELS,
    "MultipleLines": ["No", "Yes", "No phone service"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "OnlineSecurity": _ADD_ON_LEVELS,
    "OnlineBackup": _ADD_ON_LEVELS,
    "DeviceProtection": _ADD_ON_LEVELS,
    "TechSupport": _ADD_ON_LEVELS,
    "StreamingTV": _ADD_ON_LEVELS,
    "StreamingMovies": _ADD_ON_LEVELS,
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaperlessBilling": _YES_NO_LEVELS,
    "PaymentMethod": [
        "Electronic check",
        "Mailed check",
        "Bank transfer (automatic)",
        "Credit card (automatic)",
    ],
}

# Numeric columns that must not be negative.
NON_NEGATIVE = ["tenure", "MonthlyCharges", "TotalCharges"]

# Column order of the raw table. Charges are text because blanks occur in them.
RAW_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in [
            (ID, T.StringType()),
            ("gender", T.StringType()),
            ("SeniorCitizen", T.IntegerType()),
            ("Partner", T.StringType()),
            ("Dependents", T.StringType()),
            ("tenure", T.IntegerType()),
            ("PhoneService", T.StringType()),
            ("MultipleLines", T.StringType()),
            ("InternetService", T.StringType()),
            ("OnlineSecurity", T.StringType()),
            ("OnlineBackup", T.StringType()),
            ("DeviceProtection", T.StringType()),
            ("TechSupport", T.StringType()),
            ("StreamingTV", T.StringType()),
            ("StreamingMovies", T.StringType()),
            ("Contract", T.StringType()),
            ("PaperlessBilling", T.StringType()),
            ("PaymentMethod", T.StringType()),
            ("MonthlyCharges", T.DoubleType()),
            ("TotalCharges", T.StringType()),
            (TARGET, T.StringType()),
        ]
    ]
)

# The same table after cleaning; the id is kept only on request.
CLEAN_SCHEMA = T.StructType(
    [
        T.StructField(
            f.name,
            T.IntegerType()
            if f.name in YES_NO or f.name == TARGET
            else T.DoubleType()
            if f.name == "TotalCharges"
            else f.dataType,
        )
        for f in RAW_SCHEMA.fields
    ]
)

# Texts that the reader of the cleaned CSV takes as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]

JSON_TYPE = "application/json"

# Readout texts and limits.
LOW_RISK_FROM = 65
MEDIUM_RISK_FROM = 40
BARS = 5
CHURN_VERDICT = "Weak signal. This profile is predicted to churn — {}% churn probability."
STAY_VERDICT = "Signal holding. This profile is predicted to stay — {}% churn probability."

# Stands for a missing number: below all others, so a tree can part it from them.
STAND_IN = -1e30

# The training configuration.
TREES = 200
DEPTH = 5
LEARNING_RATE = 0.1
TEST_SIZE = 0.2
SEED = 42
