"""Table contracts: the types a job reads and the types it must write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Metadata key of a text column's greatest length.
MAX_LENGTH = "max_length"


def text(name: str, most: int, nullable: bool = True) -> T.StructField:
    """A text column that holds at most ``most`` characters."""
    return T.StructField(name, T.StringType(), nullable, {MAX_LENGTH: most})


CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)
ORDERS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("order_updated_at", T.TimestampNTZType()),
        T.StructField("order_status", T.StringType()),
    ]
)
ORDER_ITEMS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.DecimalType(18, 2)),
        T.StructField("line_total", T.DecimalType(18, 4)),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)
PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("sku", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DecimalType(18, 2)),
    ]
)
CUSTOMER_LTV = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("ltv_score", T.DoubleType(), False),
        text("ltv_tier", 16, False),
        T.StructField("predicted_revenue_12m", T.DoubleType(), False),
        T.StructField("churn_risk_score", T.DoubleType(), False),
        T.StructField("computed_at", T.TimestampNTZType(), False),
    ]
)
INVENTORY_REORDER_PLAN = T.StructType(
    [
        T.StructField("product_id", T.LongType(), False),
        text("sku", 64, False),
        T.StructField("current_stock", T.DecimalType(18, 2), False),
        T.StructField("reorder_qty", T.DecimalType(18, 2), False),
        T.StructField("reorder_point", T.DoubleType(), False),
        T.StructField("safety_stock", T.DoubleType(), False),
        text("abc_class", 1, False),
        T.StructField("computed_at", T.TimestampNTZType(), False),
    ]
)
EVENTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("event_ts", T.TimestampNTZType()),
    ]
)
# The columns that staging orders must have; others may follow.
SALES_STAGING = T.StructType(
    [
        T.StructField("order_id", T.LongType(), False),
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("order_date", T.DateType(), False),
        T.StructField("total_amount", T.DoubleType(), False),
    ]
)
SIGNALS = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("error_signature", T.StringType()),
        T.StructField("log_excerpt", T.StringType()),
        T.StructField("artifacts", T.ArrayType(T.StringType())),
        T.StructField("code_paths", T.ArrayType(T.StringType())),
        T.StructField("config", T.MapType(T.StringType(), T.StringType())),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema`` by name, casting to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def contract_errors(schema: T.StructType, prefix: str = "") -> Column:
    """Why a row does not fit ``schema``: ``null:<column>`` and ``length:<column>`` texts, none if it fits."""
    found = []
    for field in schema.fields:
        value = F.col(f"{prefix}{field.name}")
        if not field.nullable:
            found.append(F.when(value.isNull(), F.lit(f"null:{field.name}")))
        if MAX_LENGTH in field.metadata:
            found.append(F.when(F.length(value) > field.metadata[MAX_LENGTH], F.lit(f"length:{field.name}")))
    if not found:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*found))


def required_not_null(df: DataFrame, schema: T.StructType, keep: Sequence[Column] = ()) -> DataFrame:
    """Fail the running job on a NULL in a NOT NULL column or a text longer than its column.

    The check is part of the row expression, so it costs no extra pass.
    """
    checked = []
    for field in schema.fields:
        value = F.col(field.name)
        if not field.nullable:
            message = f"NULL in required column {field.name}"
            value = F.when(value.isNull(), F.raise_error(F.lit(message)).cast(field.dataType)).otherwise(value)
        if MAX_LENGTH in field.metadata:
            most = field.metadata[MAX_LENGTH]
            message = f"more than {most} characters in column {field.name}"
            value = F.when(F.length(F.col(field.name)) > most, F.raise_error(F.lit(message)).cast("string")).otherwise(value)
        checked.append(value.alias(field.name))
    return df.select(*checked, *keep)


def split_on_nulls(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(loadable rows, rows that do not fit ``schema``: see :func:`contract_errors`)."""
    broken = F.size(contract_errors(schema)) > 0
    return df.filter(~broken), df.filter(broken)


def exact(df: DataFrame, name: str, scale: int):
    """Column ``name`` as a decimal, so that sums do not depend on row order.

    A value that has more digits than the decimal holds fails the running job.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return F.col(name)
    held = T.DecimalType(18, scale)
    value = F.col(name).try_cast(held)
    read = kind if isinstance(kind, T.FloatType) else T.DoubleType()
    lost = F.col(name).isNotNull() & ~F.coalesce(value.cast(read) == F.col(name).cast(read), F.lit(False))
    message = F.concat(F.lit(f"{name} does not fit {held.simpleString()}: "), F.col(name).cast("string"))
    return F.when(lost, F.raise_error(message).cast(held)).otherwise(value)
