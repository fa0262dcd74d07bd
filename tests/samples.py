"""Hand-written inputs, one row per rule."""

TRANSACTION = (
    "transaction_id string, date string, client_id string, card_id string, amount string, "
    "use_chip string, merchant_id string, merchant_city string, merchant_state string, mcc string, "
    "errors string"
)

# id, date, client, card, amount, chip, merchant, city, state, mcc, errors
TRANSACTIONS = [
    ("plain", "2010-01-01 00:01:00", "u1", "c1", "$12.50", "Swipe Transaction", "m1", "X", "TX", "5411", None),
    ("at100", "2010-01-02", "u1", "c1", "$100.00", "Swipe Transaction", "m1", "X", "TX", "5411", None),
    ("above100", "2010-01-02", "u1", "c1", "$100.01", "Swipe Transaction", "m1", "X", "TX", "5411", None),
    ("at200", "2010-01-02", "u1", "c1", "$200.00", "Swipe Transaction", "m1", "X", "TX", "5411", None),
    ("above200", "2010-01-02", "u1", "c1", "$200.01", "Swipe Transaction", "m1", "X", "TX", "5411", None),
    ("at500", "2010-01-02", "u1", "c1", "$500.00", "Swipe Transaction", "m1", "X", "TX", "5411", None),
    ("above500", "2010-01-02", "u1", "c1", "$500.01", "Swipe Transaction", "m1", "X", "TX", "5411", None),
    ("online", "3/4/2011 5:06", "u1", "c1", "$1,234.50", " online transaction ", "m2", None, None, "5411", None),
    ("nochip", "2011-05-01", "u1", "c1", "$5.00", None, "m3", "", "TX", "9999", None),
    ("blank_error", "2011-05-01", "u1", "c1", "$5.00", "Swipe Transaction", "m3", None, "TX", "0742", " "),
    ("nan_error", "2011-05-01", "u1", "c1", "$5.00", "Swipe Transaction", "m3", "", "TX", "742", "nan"),
    ("error", "2011-05-01", "u1", "c1", "$5.00", "Swipe Transaction", "m3", None, "TX", "742", "Bad PIN"),
    ("abroad", "2011-05-01", "u1", "c1", "$0.00", "Swipe Transaction", "m4", "Rome", "Italy", "5411", None),
    ("lower", "2011-05-01", "u1", "c1", "$5.00", "Swipe Transaction", "m4", "X", "tx", "5411", None),
    ("far", "2011-05-01", "u1", "c1", "$5.00", "Swipe Transaction", "m4", "X", "AK", "5411", None),
    ("dark", "2012-12-30 23:00:00", "u2", "c2", "$5.00", "Swipe Transaction", "m5", "X", "TX", "5411", None),
    ("three", "2012-01-01", "u2", "c1", "$5.00", "Online Transaction", "m5", None, None, "5411", None),
    ("four", "2012-01-01", "u2", "c1", "$5.00", "Online Transaction", "m5", None, None, "5411", "Bad CVV"),
    ("all", "2012-01-01", "u2", "c2", "$900.00", "Online Transaction", "m5", None, "AK", "5411", "Bad CVV"),
    ("orphan", "2012-01-01", "u9", "c9", "$5.00", "Swipe Transaction", "m6", "X", "TX", "5411", None),
    ("negative", "2012-01-01", "u1", "c1", "$-77.00", "Swipe Transaction", "m6", "X", "TX", "5411", None),
    ("bad_amount", "2012-01-01", "u1", "c1", "abc", "Swipe Transaction", "m6", "X", "TX", "5411", None),
    ("no_amount", "2012-01-01", "u1", "c1", None, "Swipe Transaction", "m6", "X", "TX", "5411", None),
    ("bad_date", "not-a-date", "u1", "c1", "$5.00", "Swipe Transaction", "m6", "X", "TX", "5411", None),
    ("no_date", None, "u1", "c1", "$5.00", "Swipe Transaction", "m6", "X", "TX", "5411", None),
]
USERS = [
    ("u1", 40, "Female", 31.05, -97.56, "$0", "$100", 700),
    ("u2", 50, "Male", 31.05, -97.56, "$50,000", "$100,000", 650),
]
USER = (
    "user_id string, current_age int, gender string, latitude double, longitude double, "
    "yearly_income string, total_debt string, credit_score int"
)
CARDS = [
    ("c1", "Visa", "Debit", "yes", "$9,000", "No", "u1"),
    ("c2", "Amex", "Credit", " yes", "$1", "TRUE", "u2"),
]
CARD = (
    "card_id string, card_brand string, card_type string, has_chip string, credit_limit string, "
    "card_on_dark_web string, client_id string"
)
MCC = [("5411", "Grocery Stores"), ("742", "Veterinary")]
LABELS = [("above100", True), ("plain", False), ("dark", True)]


def inputs(spark):
    from cardwarden.sources.star import Inputs

    return Inputs(
        transactions=spark.createDataFrame(TRANSACTIONS, TRANSACTION),
        users=spark.createDataFrame(USERS, USER),
        cards=spark.createDataFrame(CARDS, CARD),
        mcc=spark.createDataFrame(MCC, "mcc string, mcc_description string"),
        labels=spark.createDataFrame(LABELS, "transaction_id string, is_fraud boolean"),
    )
