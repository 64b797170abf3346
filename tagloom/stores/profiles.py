"""Per-user totals that grow with the orders and logs instead of being counted anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.profiles import (
    log_state,
    order_state,
    profile_of_log_state,
    profile_of_order_state,
    unite_log_states,
    unite_order_states,
)
from tagloom.stores.buckets import BucketStore

ORDER_STATE = (
    "userId string, payment string, uses bigint, last_finish bigint, orders bigint, "
    "amount decimal(38,8), coupon_orders bigint, coupon_amount decimal(38,8)"
)
LOG_STATE = "userId string, last_day int, last_odd decimal(38,0), views bigint, pages binary"


class OrderProfileStore(BucketStore):
    """Order totals of each user and payment code, bucketed by user.

    ``add`` takes orders that were never added before: what was added stays counted. It
    reads them, and the buckets of their users, and nothing else. Orders need the columns
    ``memberid, paymentcode, finishtime, ordersn, orderamount, couponcodevalue``.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, **retention):
        super().__init__(spark, root, ORDER_STATE, "userId", buckets, **retention)

    def add(self, orders: DataFrame, user_id: str = "memberid") -> int:
        batch = order_state(orders, user_id).select(*self._casts())
        return self.update(batch, lambda new, old: new if old is None else unite_order_states(new, old), dealt=False)

    def profile(self) -> DataFrame:
        """``order_profile`` of all orders added so far."""
        return profile_of_order_state(self.read())


class LogProfileStore(BucketStore):
    """Page views, last day and a sketch of the pages of each visitor, bucketed by visitor."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, **retention):
        super().__init__(spark, root, LOG_STATE, "userId", buckets, **retention)

    def add(self, logs: DataFrame, user_id: str = "global_user_id") -> int:
        batch = log_state(logs, user_id).select(*self._casts())
        return self.update(batch, lambda new, old: new if old is None else unite_log_states(new, old), dealt=False)

    def profile(self) -> DataFrame:
        """``log_profile`` with ``approx`` of all logs added so far."""
        return profile_of_log_state(self.read())
