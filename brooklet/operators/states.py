"""Mergeable states of the history marts, so that a batch reads no events outside its dates.

* buyer_days: purchases and money of each (date, user). A date's rows depend on that date alone.
* buyer_months: the distinct (user, month) of purchases. A late event adds a row, and a user's first month, the least of the rows, follows.
* baskets: the distinct (date, session, product) of purchases, by date as well, since a late event may number a day's sessions anew.

The marts are functions of these states; ``marts`` composes both, so a full run and
a run by states are the same code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from brooklet.functions.expressions import exact_sum, is_type


@dataclass(frozen=True)
class State:
    """A state table: schema, partition column, and whether the batch's dates are replaced (else new rows are added)."""

    name: str
    schema: StructType
    partition: str
    by_date: bool


def _schema(**fields: T.DataType) -> StructType:
    return StructType([T.StructField(n, t) for n, t in fields.items()])


STATES = {
    s.name: s
    for s in (
        State("buyer_days", _schema(event_date=T.DateType(), user_id=T.LongType(), purchases=T.LongType(), spent=T.DecimalType(28, 4)), "event_date", True),
        State("buyer_months", _schema(month=T.DateType(), user_id=T.LongType()), "month", False),
        State("baskets", _schema(event_date=T.DateType(), session_id=T.StringType(), product_id=T.LongType()), "event_date", True),
    )
}
#: The state that each history mart is made of.
STATE_OF = {"cohort_retention": "buyer_months", "repeat_purchase": "buyer_months", "product_affinity": "baskets", "rfm_segmentation": "buyer_days"}


def _bought(events: DataFrame) -> DataFrame:
    return events.where(is_type("purchase"))


def buyer_days(silver: DataFrame) -> DataFrame:
    per = _bought(silver).where("user_id IS NOT NULL").groupBy("event_date", "user_id")
    return per.agg(F.count(F.lit(1)).alias("purchases"), exact_sum(F.coalesce("price", F.lit(0.0))).alias("spent"))


def buyer_months(silver: DataFrame) -> DataFrame:
    return _bought(silver).where("user_id IS NOT NULL").select(F.trunc("event_date", "month").alias("month"), "user_id").distinct()


def basket_rows(sessions: DataFrame) -> DataFrame:
    """The rows of baskets as they come, repeats included."""
    return _bought(sessions).where("product_id IS NOT NULL AND session_id IS NOT NULL").select("event_date", "session_id", "product_id")


def baskets(sessions: DataFrame) -> DataFrame:
    return basket_rows(sessions).distinct()
