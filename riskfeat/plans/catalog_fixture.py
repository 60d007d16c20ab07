"""What the fixture data implies for the cleaning plan (used by the oracles).

Shares are for the training part (``IS_TRAIN = 1``, 4 of every 5 keys):
``OWN_CAR_AGE`` is 62.5% null (dropped), ``HALF_MISSING`` exactly 50% (kept
and imputed), ``DAYS_EMPLOYED`` about 24% null after the sentinel fix.
"""

from __future__ import annotations

DROPPED = ["OWN_CAR_AGE"]
EXT = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
NUM_IMPUTE = ["DAYS_EMPLOYED", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS", "HALF_MISSING"]
CAT_IMPUTE = ["OCCUPATION_TYPE"]
FLAGGED_COLUMNS = EXT + NUM_IMPUTE + CAT_IMPUTE

NUMERIC_FIT = [
    "DAYS_EMPLOYED", "DAYS_BIRTH", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "AMT_INCOME_TOTAL",
    "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_CHILDREN", "CNT_FAM_MEMBERS",
    "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "HALF_MISSING",
    "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3", "FLAG_DOCUMENT_4", "FLAG_DOCUMENT_5", "FLAG_DOCUMENT_6",
    "FLAG_DOCUMENT_7", "FLAG_DOCUMENT_8", "FLAG_DOCUMENT_9", "FLAG_UNEMPLOYED_UNKNOWN",
]
STRING_FIT = ["OCCUPATION_TYPE", "CODE_GENDER"]

APPLICANT_COLUMNS = [
    "SK_ID_CURR", "IS_TRAIN", "TARGET", "DAYS_EMPLOYED", "DAYS_BIRTH", "DAYS_REGISTRATION",
    "DAYS_ID_PUBLISH", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE",
    "CNT_CHILDREN", "CNT_FAM_MEMBERS", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
    "OWN_CAR_AGE", "HALF_MISSING", "OCCUPATION_TYPE", "CODE_GENDER",
    "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3", "FLAG_DOCUMENT_4", "FLAG_DOCUMENT_5",
    "FLAG_DOCUMENT_6", "FLAG_DOCUMENT_7", "FLAG_DOCUMENT_8", "FLAG_DOCUMENT_9",
]

HISTORY_COLUMNS = {
    "bureau": [
        "BUREAU_NUM_CREDITS", "BUREAU_NUM_ACTIVE", "BUREAU_NUM_CLOSED", "BUREAU_TOTAL_CREDIT",
        "BUREAU_TOTAL_DEBT", "BUREAU_TOTAL_OVERDUE", "BUREAU_MAX_OVERDUE",
        "BUREAU_DAYS_MOST_RECENT_CREDIT", "BUREAU_DAYS_OLDEST_CREDIT", "BUREAU_AVG_DAYS_CREDIT",
        "BUREAU_NUM_CREDIT_TYPES", "BUREAU_DEBT_TO_CREDIT_RATIO", "BUREAU_OVERDUE_TO_CREDIT_RATIO",
        "BUREAU_ACTIVE_RATIO",
    ],
    "prev_app": [
        "PREV_NUM_APPLICATIONS", "PREV_NUM_APPROVED", "PREV_NUM_REFUSED", "PREV_NUM_CANCELED",
        "PREV_AVG_APPLICATION_AMT", "PREV_MAX_APPLICATION_AMT", "PREV_AVG_CREDIT_AMT",
        "PREV_MAX_CREDIT_AMT", "PREV_AVG_DOWN_PAYMENT", "PREV_TOTAL_DOWN_PAYMENT",
        "PREV_DAYS_MOST_RECENT", "PREV_AVG_DAYS_DECISION", "PREV_APPROVAL_RATE",
        "PREV_REFUSAL_RATE", "PREV_CREDIT_TO_APPLICATION_RATIO",
    ],
    "installments": [
        "INST_NUM_PAYMENTS", "INST_NUM_LATE_PAYMENTS", "INST_MAX_DAYS_PAST_DUE",
        "INST_AVG_DAYS_PAST_DUE", "INST_AVG_PAYMENT_AMT", "INST_TOTAL_PAYMENT_AMT",
        "INST_AVG_PAYMENT_DIFF", "INST_LATE_PAYMENT_RATE",
    ],
    "credit_card": [
        "CC_NUM_RECORDS", "CC_AVG_BALANCE", "CC_MAX_BALANCE", "CC_MIN_BALANCE",
        "CC_AVG_CREDIT_LIMIT", "CC_MAX_CREDIT_LIMIT", "CC_AVG_DRAWINGS", "CC_TOTAL_DRAWINGS",
        "CC_AVG_PAYMENT", "CC_AVG_TOTAL_PAYMENT", "CC_AVG_MIN_PAYMENT", "CC_UTILIZATION_RATE",
        "CC_PAYMENT_TO_BALANCE_RATIO",
    ],
    "pos_cash": [
        "POS_NUM_RECORDS", "POS_NUM_ACTIVE", "POS_NUM_COMPLETED", "POS_MAX_DPD", "POS_AVG_DPD",
        "POS_MAX_DPD_DEF", "POS_AVG_INSTALMENTS", "POS_AVG_FUTURE_INSTALMENTS",
        "POS_COMPLETION_RATE",
    ],
}
