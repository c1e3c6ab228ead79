"""Sessions: the given one, or one derived per day and user from gaps of inactivity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooklet.functions.expressions import unused, whole_seconds

GAP_SECONDS = 30 * 60
#: Rows of one user and day that one task may hold, and the most pieces that a longer day is cut into.
ROWS_PER_TASK, PIECES = 200_000, 4096


def sessionize(events: DataFrame, gap_seconds: int = GAP_SECONDS, most: int = ROWS_PER_TASK) -> DataFrame:
    """Adds session_id.

    Rows with a user_session keep it. The others of a day and user share a derived
    session until a gap of more than ``gap_seconds`` or a row with a session comes
    between. Null users of a day are one anonymous user. One shuffle on (date, user).

    A user's day of more than ``most`` rows (a bot, or all anonymous visits; an aggregate over date and
    user alone finds them) is cut into pieces by quantiles of time, which tasks of their own number; a scan over one
    row for each piece carries the numbers on. Rows of one instant share a piece.
    """
    day = ["event_date", "user_id"]
    counts = events.groupBy(*day).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    longest = counts.agg(F.max("n")).first()[0]
    if longest is None:
        numbered = _numbered(events, day, gap_seconds)
    else:
        (rows,) = unused(events.columns, "rows")
        sides = events.alias("e"), counts.select(*[F.col(c).alias(f"{rows}_{c}") for c in day]).alias("c")
        same = reduce(Column.__and__, [F.col(f"e.{c}").eqNullSafe(F.col(f"c.{rows}_{c}")) for c in day])
        usual = sides[0].join(sides[1], same, "left_anti")
        long_days = sides[0].join(sides[1], same, "left_semi")
        numbered = _numbered(usual, day, gap_seconds).unionByName(_numbered_pieces(long_days, gap_seconds, min(PIECES, -(-longest // most) + 1)))
    return numbered.withColumn("session_id", _session_id()).drop("session_number")


def _opens(before: Column, before_given: Column, given: Column, at: Column, gap_seconds: int) -> Column:
    """Whether a row starts a derived session, from the row before it (nulls: none)."""
    return ~given & (before.isNull() | before_given | (whole_seconds(before, at) > gap_seconds))


def _numbered(events: DataFrame, group: list[str], gap_seconds: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy("event_time", "event_id")
    given = F.col("user_session").isNotNull()
    opens = _opens(F.lag("event_time").over(order), F.lag(given).over(order), given, F.col("event_time"), gap_seconds)
    return events.withColumn("session_number", F.sum(opens.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def _numbered_pieces(events: DataFrame, gap_seconds: int, pieces: int) -> DataFrame:
    """The same by pieces of bounded size: numbers inside each piece, after those of the day's earlier pieces.

    A piece's summary (first row, last row, sessions opened inside) is all that the next one needs.
    """
    names = events.columns
    nobody, user, bounds, piece, inner, running, offset, last, n = unused(names, "nobody", "user", "bounds", "piece", "inner", "running", "offset", "last", "n")
    day = ["event_date", nobody, user]
    given, at = F.col("user_session").isNotNull(), F.unix_micros("event_time")
    keyed = events.withColumns({nobody: F.col("user_id").isNull(), user: F.coalesce("user_id", F.lit(0))})
    cuts = keyed.groupBy(*day).agg(F.percentile_approx(at, [k / pieces for k in range(1, pieces)], 4 * pieces).alias(bounds))
    cut = keyed.join(cuts, day).withColumn(piece, F.size(F.filter(bounds, lambda b: b < at))).drop(bounds)
    order = Window.partitionBy(*day, piece).orderBy("event_time", "event_id")
    before = F.lag("event_time").over(order)
    opened = cut.withColumn(inner, (_opens(before, F.lag(given).over(order), given, F.col("event_time"), gap_seconds) & before.isNotNull()).cast("long"))
    opened = opened.withColumn(running, F.sum(inner).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    row = F.struct(F.col("event_time").alias("at"), F.col("event_id").alias("id"), given.alias("given"))
    per = opened.groupBy(*day, piece).agg(F.min(row).alias("first"), F.max(row).alias(last), F.sum(inner).alias(n))
    # One row for each piece.
    days = Window.partitionBy(*day).orderBy(piece)
    end = F.lag(last).over(days)
    opens = per.withColumn("opens", _opens(end["at"], end["given"], F.col("first.given"), F.col("first.at"), gap_seconds).cast("long"))
    earlier = F.coalesce(F.sum(F.col(n) + F.col("opens")).over(days.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carried = opens.select(*day, piece, (earlier + F.col("opens")).alias(offset))
    return opened.join(carried, [*day, piece]).select(*names, (F.col(offset) + F.col(running)).alias("session_number"))


def _session_id() -> Column:
    digits = F.col("session_number").cast("string")
    derived = F.concat_ws(
        "-",
        F.lit("derived"),
        F.coalesce(F.col("user_id").cast("string"), F.lit("anonymous")),
        F.date_format("event_date", "yyyyMMdd"),
        F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits),
    )
    return F.coalesce("user_session", derived)
