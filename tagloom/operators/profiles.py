"""Per-user aggregates of orders and web logs, shared by the tag jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.modal import most_frequent


# Length of ``yyyy-MM-dd``.
DAY_LENGTH = 10


# Sums of money are exact, so that neither the order of rows nor a partial sum shows in
# them; they become double at the end.
MONEY = "decimal(28,8)"
SUMS = ("amount", "coupon_amount")


def _money(name: str) -> Column:
    return F.col(name).try_cast(MONEY)


def _final(name: str, total: Column) -> Column:
    return (total.cast("double") if name in SUMS else total).alias(name)


def _coupon_used() -> Column:
    return F.when(_money("couponcodevalue") > 0, 1).otherwise(0)


def _order_aggregates(orders: DataFrame) -> dict[str, Column]:
    """The totals that the columns of ``orders`` allow."""
    needs = {
        "last_finish": ("finishtime", lambda: F.max(F.col("finishtime").try_cast("bigint"))),
        "orders": ("ordersn", lambda: F.count("ordersn")),
        "amount": ("orderamount", lambda: F.sum(_money("orderamount"))),
        "coupon_orders": ("couponcodevalue", lambda: F.sum(_coupon_used())),
        "coupon_amount": ("couponcodevalue", lambda: F.sum(_money("couponcodevalue"))),
    }
    return {
        name: aggregate()
        for name, (column, aggregate) in needs.items()
        if column in orders.columns
    }


def order_totals(orders: DataFrame, user_id: str = "memberid") -> DataFrame:
    """One row per member: last finish time, order count, amounts and coupon use, as far
    as the columns are there."""
    totals = [_final(name, column) for name, column in _order_aggregates(orders).items()]
    return orders.groupBy(F.col(user_id).cast("string").alias("userId")).agg(*totals)


def order_state(orders: DataFrame, user_id: str = "memberid") -> DataFrame:
    """Totals by member and payment code, ``(userId, payment, uses, ...)``, that can be added
    to those of other orders; see ``unite_order_states``. Sums are exact decimals."""
    return orders.groupBy(
        F.col(user_id).cast("string").alias("userId"), F.col("paymentcode").alias("payment")
    ).agg(
        F.count(F.lit(1)).alias("uses"),
        *[column.alias(name) for name, column in _order_aggregates(orders).items()],
    )


def unite_order_states(*states: DataFrame) -> DataFrame:
    """The state of all orders together, for orders that are in one state each."""
    together = reduce(DataFrame.unionByName, states)
    kinds = {f.name: f.dataType for f in states[0].schema}
    return together.groupBy("userId", "payment").agg(
        *[
            (F.max(c) if c == "last_finish" else F.sum(c)).cast(kind).alias(c)
            for c, kind in kinds.items()
            if c not in ("userId", "payment")
        ]
    )


def profile_of_order_state(state: DataFrame) -> DataFrame:
    """``order_profile`` of the orders in a state."""
    return state.groupBy("userId").agg(
        most_frequent(F.col("payment"), F.col("uses")).alias("payment"),
        *[
            _final(name, (F.max if name == "last_finish" else F.sum)(name))
            for name in state.columns
            if name not in ("userId", "payment", "uses")
        ],
    )


def order_profile(orders: DataFrame, user_id: str = "memberid") -> DataFrame:
    """``order_totals`` plus the most used payment code, from one scan of the orders."""
    return profile_of_order_state(order_state(orders, user_id))


# Bytes of a text that count in its order, in two halves.
HIGH_BYTES, LOW_BYTES = 7, 8


def text_order(text: Column) -> Column:
    """A number that orders texts by their first 15 bytes. Unlike text, a maximum of numbers
    is kept in place by a hash aggregate."""
    digits = F.rpad(F.hex(F.substring(text, 1, DAY_LENGTH)), 2 * (HIGH_BYTES + LOW_BYTES), "0")
    high = F.conv(F.substring(digits, 1, 2 * HIGH_BYTES), 16, 10).cast("decimal(17,0)")
    low = F.conv(F.substring(digits, 2 * HIGH_BYTES + 1, 2 * LOW_BYTES), 16, 10).cast("decimal(20,0)")
    return (high * F.lit(str(1 << 8 * LOW_BYTES)).cast("decimal(20,0)") + low).cast("decimal(38,0)")


def text_of_order(number: Column) -> Column:
    """The text of ``text_order``, without NULs at its end and cut after 15 bytes."""
    base = F.lit(str(1 << 8 * LOW_BYTES)).cast("decimal(20,0)")
    low = number % base
    high = ((number - low) / base).cast("decimal(17,0)")
    digits = F.concat(
        F.lpad(F.conv(high.cast("string"), 10, 16), 2 * HIGH_BYTES, "0"),
        F.lpad(F.conv(low.cast("decimal(20,0)").cast("string"), 10, 16), 2 * LOW_BYTES, "0"),
    )
    return F.rtrim(F.decode(F.unhex(digits), "UTF-8"), F.lit("\0"))


def _latest_day(logs: DataFrame) -> dict[str, Column]:
    """Two maxima of the day as text: as a day number where the text is just a day, as
    ``text_order`` where it is anything else, which is rare. Both keep in place in a hash
    aggregate."""
    day = F.substring(F.col("log_time").cast("string"), 1, DAY_LENGTH)
    date = day.try_cast("date")
    plain = F.coalesce(date.cast("string") == day, F.lit(False))
    return {
        "last_day": F.max(F.when(plain, F.unix_date(date))),
        "last_odd": F.max(F.when(~plain, text_order(day))),
    }


def _with_latest_text(profile: DataFrame, *columns: str | Column) -> DataFrame:
    plain = F.date_from_unix_date("last_day").cast("string")
    odd = F.when(F.col("last_odd").isNotNull(), text_of_order(F.col("last_odd")))
    return profile.select("userId", F.greatest(plain, odd).alias("last_log"), *columns)


def log_profile(logs: DataFrame, user_id: str = "global_user_id", approx: bool = False) -> DataFrame:
    """One row per visitor: last log day (as text), page views and distinct pages.

    The day is the start of the highest log time; cutting before the maximum gives the
    same text, except that of odd texts the first 15 bytes count. Distinct pages are counted
    by (visitor, page) first, then by visitor, so a hot visitor's pages are spread over the
    tasks. With ``approx`` they are estimated from a sketch per visitor, within a few percent
    and in one shuffle of one row per visitor and task.
    """
    if approx:
        return profile_of_log_state(log_state(logs, user_id))
    grouped = logs.groupBy(F.col(user_id).cast("string").alias("userId")).agg(
        *[column.alias(name) for name, column in _latest_day(logs).items()],
        F.count("loc_url").alias("views"),
        F.countDistinct("loc_url").alias("pages"),
    )
    return _with_latest_text(grouped, "views", "pages")


def log_state(logs: DataFrame, user_id: str = "global_user_id") -> DataFrame:
    """``(userId, last_day, last_odd, views, pages)`` that can be united with those of other
    logs: ``pages`` is a HyperLogLog sketch."""
    return logs.groupBy(F.col(user_id).cast("string").alias("userId")).agg(
        *[column.alias(name) for name, column in _latest_day(logs).items()],
        F.count("loc_url").alias("views"),
        F.hll_sketch_agg(F.col("loc_url").cast("string")).alias("pages"),
    )


def unite_log_states(*states: DataFrame) -> DataFrame:
    """The state of all logs together; a page in several states counts once."""
    return (
        reduce(DataFrame.unionByName, states)
        .groupBy("userId")
        .agg(
            F.max("last_day").alias("last_day"),
            F.max("last_odd").alias("last_odd"),
            F.sum("views").alias("views"),
            F.hll_union_agg("pages").alias("pages"),
        )
    )


def profile_of_log_state(state: DataFrame) -> DataFrame:
    """``log_profile`` of the logs in a state, with estimated distinct pages."""
    return _with_latest_text(state, "views", F.hll_sketch_estimate("pages").alias("pages"))
