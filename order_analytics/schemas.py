"""Typed-layer tables: columns, types, logical keys, and which casts a gate watches."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Column names and types of the three typed tables and of the lineage columns.
LINEAGE_FIELDS = (
    T.StructField("_INGESTED_AT", T.TimestampType()),
    T.StructField("_SOURCE_TABLE", T.StringType()),
    T.StructField("_LOAD_TYPE", T.StringType()),
)
LINEAGE = tuple(field.name for field in LINEAGE_FIELDS)

ORDER_ITEM_FIELDS = (
    T.StructField("APP_NAME", T.StringType()),
    T.StructField("RESTAURANT_ID", T.StringType()),
    T.StructField("CREATION_TIME_UTC", T.TimestampType()),
    T.StructField("ORDER_ID", T.StringType()),
    T.StructField("USER_ID", T.StringType()),
    T.StructField("PRINTED_CARD_NUMBER", T.StringType()),
    T.StructField("IS_LOYALTY", T.StringType()),
    T.StructField("CURRENCY", T.StringType()),
    T.StructField("LINEITEM_ID", T.StringType()),
    T.StructField("ITEM_CATEGORY", T.StringType()),
    T.StructField("ITEM_NAME", T.StringType()),
    T.StructField("ITEM_PRICE", T.FloatType()),
    T.StructField("ITEM_QUANTITY", T.IntegerType()),
)

OPTION_FIELDS = (
    T.StructField("ORDER_ID", T.StringType()),
    T.StructField("LINEITEM_ID", T.StringType()),
    T.StructField("OPTION_GROUP_NAME", T.StringType()),
    T.StructField("OPTION_NAME", T.StringType()),
    T.StructField("OPTION_PRICE", T.DecimalType(18, 0)),
    T.StructField("OPTION_QUANTITY", T.DecimalType(18, 0)),
)

CALENDAR_FIELDS = (
    T.StructField("DATE_KEY", T.DateType()),
    T.StructField("YEAR", T.ShortType()),
    T.StructField("MONTH", T.ByteType()),
    T.StructField("WEEK", T.ByteType()),
    T.StructField("DAY_OF_WEEK", T.StringType()),
    T.StructField("IS_WEEKEND", T.StringType()),
    T.StructField("IS_HOLIDAY", T.StringType()),
    T.StructField("HOLIDAY_NAME", T.StringType()),
)


@dataclass(frozen=True)
class TableSpec:
    """One typed table. ``offset_timestamps`` names columns that arrive as text with a zone offset."""

    name: str
    fields: tuple[T.StructField, ...]
    key: tuple[str, ...]
    offset_timestamps: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*self.fields, *LINEAGE_FIELDS])

    @property
    def business_columns(self) -> list[str]:
        return [field.name for field in self.fields]

    def with_types(self, **types: T.DataType) -> TableSpec:
        """The same table with other column types, e.g. prices as decimals with cents."""
        fields = [T.StructField(field.name, types.get(field.name, field.dataType)) for field in self.fields]
        return replace(self, fields=tuple(fields))

    @property
    def decimals(self) -> list[str]:
        return [field.name for field in self.fields if isinstance(field.dataType, T.DecimalType)]

    @property
    def watched_casts(self) -> list[str]:
        """Columns whose conversion can fail: all that are not text."""
        return [field.name for field in self.schema if not isinstance(field.dataType, T.StringType)]


ORDER_ITEMS = TableSpec(
    "order_items",
    ORDER_ITEM_FIELDS,
    ("ORDER_ID", "LINEITEM_ID", "RESTAURANT_ID", "CREATION_TIME_UTC"),
    ("CREATION_TIME_UTC",),
)
ORDER_ITEM_OPTIONS = TableSpec(
    "order_item_options",
    OPTION_FIELDS,
    ("ORDER_ID", "LINEITEM_ID", "OPTION_GROUP_NAME", "OPTION_NAME"),
)
DATE_DIM = TableSpec("date_dim", CALENDAR_FIELDS, ("DATE_KEY",))

TABLES = {spec.name: spec for spec in (DATE_DIM, ORDER_ITEM_OPTIONS, ORDER_ITEMS)}
