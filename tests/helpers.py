from datetime import date, datetime

EVENT = "event_id string, event_time timestamp, event_date date, event_type string, product_id bigint, category_id bigint, category_code string, brand string, price double, user_id bigint, user_session string"


def at(text):
    return datetime.fromisoformat(text)


def events(spark, rows):
    """(time, type, product, price, user, session) rows as canonical events."""
    out = []
    for k, (when, kind, product, price, user, session) in enumerate(rows):
        t = at(when)
        out.append((f"{k:03d}", t, date(t.year, t.month, t.day), kind, product, 100, "electronics.audio", "Acme", price, user, session))
    return spark.createDataFrame(out, EVENT)


SIX = [
    ("2020-04-01 10:00:00", "view", 10, 10.0, 1, "sess-1"),
    ("2020-04-01 10:01:00", "view", 11, 12.0, 1, "sess-1"),
    ("2020-04-01 10:01:30", "cart", 10, 10.0, 1, "sess-1"),
    ("2020-04-01 10:02:00", "cart", 11, 12.0, 1, "sess-1"),
    ("2020-04-01 10:02:00", "purchase", 10, 10.0, 1, "sess-1"),
    ("2020-04-01 10:02:30", "purchase", 11, 12.0, 1, "sess-1"),
]
RAW_COLUMNS = ["event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id", "user_session"]


def raw(**changes):
    row = dict(zip(RAW_COLUMNS, ["2020-04-01T10:00:00Z", "view", "101", "200", "electronics.audio", "Acme", "10.00", "1", "sess-1"], strict=True))
    return {**row, **changes}
