"""The retail star schema: column types, keys, foreign keys and length limits.

Fixed values: the table and column names, types, VARCHAR lengths and NUMERIC
precisions below must equal the source schema for results to agree.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    max_length: int | None = None  # VARCHAR(n)


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...]
    foreign_keys: tuple[tuple[str, str, str], ...] = field(default_factory=tuple)  # (column, parent, parent column)

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, True) for c in self.columns])

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


INT, LONG, DATE, BOOL = T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType()

# Schema of the nine tables (names, types, lengths, precisions, keys).
DIM_PRODUCTS = TableSpec(
    "dim_products",
    (
        Column("product_sku", INT),
        Column("product_full_description", T.StringType()),
        Column("product_gender", T.StringType(), 20),
        Column("product_category", T.StringType(), 50),
        Column("product_name", T.StringType(), 50),
        Column("product_size", T.StringType(), 10),
        Column("product_color", T.StringType(), 20),
    ),
    ("product_sku",),
)
DIM_WAREHOUSES = TableSpec(
    "dim_warehouses",
    (
        Column("warehouse_id", INT),
        Column("warehouse_location", T.StringType(), 50),
        Column("region", T.StringType(), 50),
        Column("capacity", INT),
    ),
    ("warehouse_id",),
)
DIM_RETAILERS = TableSpec(
    "dim_retailers",
    (
        Column("retailer_id", INT),
        Column("retailer_channel", T.StringType(), 20),
        Column("retailer_name", T.StringType(), 50),
        Column("city", T.StringType(), 50),
        Column("region", T.StringType(), 50),
        Column("area", T.StringType(), 20),
        Column("country", T.StringType(), 50),
        Column("distance_from_warehouse", T.DecimalType(10, 2)),
    ),
    ("retailer_id",),
)
DIM_CUSTOMERS = TableSpec(
    "dim_customers",
    (
        Column("customer_id", INT),
        Column("customer_name", T.StringType(), 50),
        Column("age_group", T.StringType(), 20),
        Column("gender", T.StringType(), 20),
        Column("region", T.StringType(), 50),
        Column("channel", T.StringType(), 20),
        Column("loyalty_score", T.DecimalType(5, 1)),
    ),
    ("customer_id",),
)
DIM_PROMOTIONS = TableSpec(
    "dim_promotions",
    (
        Column("promotion_id", INT),
        Column("product_sku", INT),
        Column("start_date", DATE),
        Column("end_date", DATE),
        Column("discount_percentage", T.DecimalType(10, 1)),
        Column("campaign_name", T.StringType(), 50),
    ),
    ("promotion_id",),
    (("product_sku", "dim_products", "product_sku"),),
)
DIM_DATE = TableSpec(
    "dim_date",
    (
        Column("date", DATE),
        Column("year", INT),
        Column("month", INT),
        Column("quarter", INT),
        Column("weekday", T.StringType(), 20),
        Column("is_holiday", BOOL),
    ),
    ("date",),
)
FACT_ORDERS = TableSpec(
    "fact_orders",
    (
        Column("order_id", INT),
        Column("order_date", DATE),
        Column("retailer_id", INT),
        Column("product_sku", INT),
        Column("product_price", T.DecimalType(10, 2)),
        Column("product_cost", T.DecimalType(10, 2)),
        Column("order_quantity", INT),
        Column("customer_id", INT),
        Column("product_discount", T.DecimalType(10, 2)),
    ),
    ("order_id",),
    (
        ("retailer_id", "dim_retailers", "retailer_id"),
        ("product_sku", "dim_products", "product_sku"),
        ("customer_id", "dim_customers", "customer_id"),
    ),
)
FACT_SHIPPINGS = TableSpec(
    "fact_shippings",
    (
        Column("order_id", INT),
        Column("order_date", DATE),
        Column("ship_date", DATE),
        Column("delivery_duration", INT),
        Column("delivery_date", DATE),
        Column("shipping_method", T.StringType(), 20),
        Column("carrier", T.StringType(), 20),
        Column("shipping_cost", T.DecimalType(10, 2)),
        Column("delivery_status", T.StringType(), 20),
        Column("warehouse_id", INT),
    ),
    ("order_id",),
    (
        ("order_id", "fact_orders", "order_id"),
        ("warehouse_id", "dim_warehouses", "warehouse_id"),
    ),
)
FACT_RETURNS = TableSpec(
    "fact_returns",
    (
        Column("return_id", LONG),
        Column("order_id", INT),
        Column("product_sku", INT),
        Column("return_quantity", INT),
        Column("return_year", INT),
        Column("return_month", INT),
        Column("return_day", INT),
        Column("returndate", T.TimestampNTZType()),
    ),
    ("return_id",),
    (
        ("order_id", "fact_orders", "order_id"),
        ("product_sku", "dim_products", "product_sku"),
    ),
)

# Load order: parents before children, as foreign keys require.
LOAD_ORDER = (
    DIM_PRODUCTS,
    DIM_WAREHOUSES,
    DIM_RETAILERS,
    DIM_CUSTOMERS,
    FACT_ORDERS,
    DIM_PROMOTIONS,
    FACT_SHIPPINGS,
    FACT_RETURNS,
    DIM_DATE,
)
SPECS = {spec.name: spec for spec in LOAD_ORDER}

# The column domains stated by the source data generator.
DOMAINS = {
    ("dim_customers", "age_group"): ("18-25", "26-35", "36-45", "46-60", "60+"),
    ("fact_shippings", "delivery_status"): ("on-time", "delayed", "returned"),
    ("fact_shippings", "carrier"): ("fedex", "ups", "dhl", "usps"),
    ("fact_shippings", "shipping_method"): ("standard", "express", "same-day"),
    ("dim_retailers", "retailer_channel"): ("online", "in-store", "distributor"),
}
