"""Hand-made order rows."""

from __future__ import annotations

from datetime import UTC, datetime
from decimal import Decimal

ITEM_SCHEMA = (
    "ORDER_ID string, LINEITEM_ID string, RESTAURANT_ID string, CREATION_TIME_UTC timestamp, USER_ID string,"
    " IS_LOYALTY string, ITEM_CATEGORY string, ITEM_NAME string, ITEM_PRICE float, ITEM_QUANTITY int"
)
OPTION_SCHEMA = (
    "ORDER_ID string, LINEITEM_ID string, OPTION_GROUP_NAME string, OPTION_NAME string,"
    " OPTION_PRICE decimal(18,0), OPTION_QUANTITY decimal(18,0)"
)
ORDER_SCHEMA = (
    "ORDER_ID string, RESTAURANT_ID string, USER_ID string, LOYALTY_FLAG int, ORDER_TIMESTAMP timestamp,"
    " ORDER_REVENUE decimal(30,2), HAS_DISCOUNT int, TOTAL_ITEM_QUANTITY bigint, ORDER_DATE date"
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def item(order="O1", line="L1", restaurant="R1", time="2024-05-01 10:00:00", user="u1", loyalty=None,
         category="Pizza", price=10.0, quantity=1):
    return (order, line, restaurant, at(time), user, loyalty, category, "thing", price, quantity)


def option(order="O1", line="L1", price=1, quantity=1, name="o"):
    return (order, line, "g", name, Decimal(price), Decimal(quantity))


def order(number, user="u1", time="2024-05-01 10:00:00", revenue="10.00", restaurant="R1", loyalty=None, discount=0):
    moment = at(time)
    return (number, restaurant, user, loyalty, moment, Decimal(revenue), discount, 1, moment.date())
