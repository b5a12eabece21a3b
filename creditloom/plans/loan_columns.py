"""Column names, codes and constants of the loan tables.

Fixed values: these must equal the data's own names and the published parameters.
"""

KEY = "SK_ID_CURR"
LABEL = "TARGET"

EMPLOYED_SENTINEL = 365243
DAYS_PER_YEAR = 365.25
UNKNOWN_GENDER = "XNA"

EXTERNAL_SCORES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]

INQUIRY_COUNTS = [
    "AMT_REQ_CREDIT_BUREAU_HOUR",
    "AMT_REQ_CREDIT_BUREAU_DAY",
    "AMT_REQ_CREDIT_BUREAU_WEEK",
    "AMT_REQ_CREDIT_BUREAU_MON",
    "AMT_REQ_CREDIT_BUREAU_QRT",
    "AMT_REQ_CREDIT_BUREAU_YEAR",
]

# 14 building measures in three variants each, and five that occur once.
HOUSING_MEASURES = [
    "APARTMENTS",
    "BASEMENTAREA",
    "YEARS_BEGINEXPLUATATION",
    "YEARS_BUILD",
    "COMMONAREA",
    "ELEVATORS",
    "ENTRANCES",
    "FLOORSMAX",
    "FLOORSMIN",
    "LANDAREA",
    "LIVINGAPARTMENTS",
    "LIVINGAREA",
    "NONLIVINGAPARTMENTS",
    "NONLIVINGAREA",
]
HOUSING = [f"{m}_{v}" for v in ("AVG", "MODE", "MEDI") for m in HOUSING_MEASURES] + [
    "FONDKAPREMONT_MODE",
    "HOUSETYPE_MODE",
    "TOTALAREA_MODE",
    "WALLSMATERIAL_MODE",
    "EMERGENCYSTATE_MODE",
]

MISSING_FLAGGED = [
    "DAYS_EMPLOYED",
    "OWN_CAR_AGE",
    "OBS_30_CNT_SOCIAL_CIRCLE",
    "DEF_30_CNT_SOCIAL_CIRCLE",
    "OBS_60_CNT_SOCIAL_CIRCLE",
    "DEF_60_CNT_SOCIAL_CIRCLE",
    "AMT_GOODS_PRICE",
    "AMT_ANNUITY",
    "NAME_TYPE_SUITE",
    "CNT_FAM_MEMBERS",
]

AGE_EDGES = [25, 30, 35, 40, 45, 50, 55, 60]
AGE_LABELS = ["20-24", "25-29", "30-34", "35-39", "40-44", "45-49", "50-54", "55-59", "60+"]
LEVEL_LABELS = ["Low", "Medium", "High", "Very High"]
CREDIT_INCOME_EDGES = [2.0, 4.0, 6.0]
EXT_MEAN_EDGES = [0.3, 0.5, 0.7]

ENGINEERED = [
    "EMPLOYED_YEARS",
    "REGISTRATION_YEARS",
    "ID_PUBLISH_YEARS",
    "PHONE_CHANGE_YEARS",
    "EMPLOYED_TO_AGE_RATIO",
    "CREDIT_INCOME_RATIO",
    "ANNUITY_INCOME_RATIO",
    "LOAN_TO_VALUE_RATIO",
    "CREDIT_TERM_MONTHS",
    "GOODS_TO_INCOME_RATIO",
    "EXT_SOURCE_MEAN",
    "EXT_SOURCE_1x2",
    "EXT_SOURCE_1x3",
    "EXT_SOURCE_2x3",
    "EXT_SOURCE_1_SQ",
    "EXT_SOURCE_2_SQ",
    "EXT_SOURCE_3_SQ",
]

# Value model: amounts are divided by the exchange rate; shares are of the loan amount.
EXCHANGE_RATE = 22.0
NET_MARGIN = 0.04
LOSS_GIVEN_DEFAULT = 0.60
RECOVERY = 0.25
CHOSEN_THRESHOLD = 0.63
DEFAULT_THRESHOLD = 0.50
REVIEW_BAND = (0.50, 0.75)
COST_FACTORS = [0.8, 1.0, 1.2]

# Denial reasons: features, plain-language reason, category of the notice.
REASONS = [
    (
        ("EXT_SOURCE_MEAN", "EXT_SOURCE_2x3", "EXT_SOURCE_1x3"),
        "Limited or insufficient external credit history; "
        "credit scores from credit reference agencies are too low",
        "Credit history / credit score",
    ),
    (
        ("INST_LATE_RATIO",),
        "Delinquent past or present credit obligations — "
        "a pattern of late installment payments on prior loans",
        "Delinquency on accounts",
    ),
    (
        ("BUREAU_DEBT_CREDIT_RATIO",),
        "Proportion of revolving credit balances to revolving credit limits is too high; "
        "excessive obligations in relation to income",
        "Excessive obligations / high utilization",
    ),
    (
        ("LOAN_TO_VALUE_RATIO",),
        "The amount of credit requested is too high relative to the value of the goods being purchased",
        "Amount of credit requested",
    ),
    (
        ("PREV_REFUSAL_RATE", "PREV_CREDIT_REQUEST_RATIO"),
        "Number of recent inquiries or prior credit refusals on file; "
        "prior applications for credit with this lender were declined",
        "Number of recent inquiries / prior refusals",
    ),
    (
        ("CREDIT_TERM_MONTHS",),
        "Length of time accounts have been established is insufficient "
        "relative to the loan term requested",
        "Length of credit history",
    ),
    (
        ("EMPLOYED_YEARS",),
        "Length of employment is insufficient to demonstrate income stability",
        "Employment history / income stability",
    ),
    (
        ("ANNUITY_INCOME_RATIO",),
        "Debt-to-income ratio is too high; "
        "monthly loan payment is too large relative to declared income",
        "Debt-to-income / excessive obligations",
    ),
]
# Never cited as a reason for denial.
PROTECTED = ["CODE_GENDER", "NAME_EDUCATION_TYPE"]

GENDER_NAMES = {"F": "Female", "M": "Male"}
EDUCATION_SHORTENING = [(" / secondary special", ""), ("secondary", "Secondary")]

# Published settings of the boosted model. Leaf count and L1/L2 weights have no Spark ML twin and
# are kept for reference only.
TUNED = {
    "n_estimators": 453,
    "learning_rate": 0.0523,
    "num_leaves": 83,
    "max_depth": 8,
    "min_child_samples": 43,
    "subsample": 0.7562,
    "colsample_bytree": 0.7814,
    "reg_alpha": 0.3971,
    "reg_lambda": 0.6289,
}
# Search space: ("int", low, high) excludes high; ("float", low, width) is [low, low + width].
SEARCH_SPACE = {
    "n_estimators": ("int", 100, 500),
    "learning_rate": ("float", 0.01, 0.2),
    "num_leaves": ("int", 20, 150),
    "max_depth": ("int", 3, 10),
    "min_child_samples": ("int", 10, 100),
    "subsample": ("float", 0.6, 0.4),
    "colsample_bytree": ("float", 0.6, 0.4),
    "reg_alpha": ("float", 0.0, 1.0),
    "reg_lambda": ("float", 0.0, 1.0),
}
