"""Silver entities: a cleansing specification per entity instead of code per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.cleanse import apply_rule, at_least, bucket
from stratalake.functions.keys import surrogate_key
from stratalake.operators.audit import add_silver_audit
from stratalake.operators.joins import join_aggregate
from stratalake.operators.quality import completeness


@dataclass(frozen=True)
class Entity:
    """How bronze text becomes a silver entity: a rule per column, the key and the required fields."""

    name: str
    key: str
    rules: Mapping[str, str]
    required: Sequence[str]
    derived: Mapping[str, Column] = field(default_factory=dict)


# Column rules and required fields of the entities.
CUSTOMER = Entity(
    "customer",
    "customer_id",
    {
        "customer_id": "int",
        "store_id": "int",
        "first_name": "text",
        "last_name": "text",
        "email": "lower",
        "address_id": "int",
        "activebool": "flag",
        "create_date": "date",
        "last_update": "timestamp",
        "active": "int",
    },
    ("customer_id", "first_name", "last_name", "store_id", "address_id"),
)
FILM_RULES = {
    "film_id": "int",
    "title": "text",
    "description": "text",
    "release_year": "int",
    "language_id": "int",
    "rental_duration": "int",
    "rental_rate": "decimal(18,4)",
    "length": "int",
    "replacement_cost": "decimal(18,4)",
    "rating": "upper",
    "special_features": "text_or_null",
    "last_update": "timestamp",
}
LANGUAGE = Entity(
    "language",
    "language_id",
    {"language_id": "int", "name": "text", "last_update": "timestamp"},
    ("language_id", "name"),
)
RENTAL = Entity(
    "rental",
    "rental_id",
    {
        "rental_id": "long",
        "rental_date": "timestamp",
        "inventory_id": "long",
        "customer_id": "int",
        "return_date": "timestamp",
        "staff_id": "int",
        "last_update": "timestamp",
    },
    ("rental_id", "rental_date", "customer_id"),
)
PAYMENT = Entity(
    "payment",
    "payment_id",
    {
        "payment_id": "long",
        "customer_id": "int",
        "staff_id": "int",
        "rental_id": "long",
        "amount": "decimal(18,4)",
        "payment_date": "timestamp",
    },
    ("payment_id", "rental_id", "amount"),
)


def film(short: int = 90, medium: int = 120, new_since: int = 2005, rate_factor: int = 10) -> Entity:
    """Film entity with its length bands, new-release year and revenue estimate."""
    return Entity(
        "film",
        "film_id",
        FILM_RULES,
        ("film_id", "title", "language_id", "rental_duration", "rental_rate"),
        {
            "sl_revenue_potential": F.col("rental_rate") * rate_factor,
            "sl_is_new_release": at_least(F.col("release_year"), new_since),
            "sl_length_category": bucket(
                F.col("length"), [("<=", short, "Short"), ("<=", medium, "Medium")], "Long"
            ),
        },
    )


def cleanse(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Apply the rule of every column that is present; other columns pass."""
    present = {c: apply_rule(F.col(c), r) for c, r in rules.items() if c in df.columns}
    return df.withColumns(present)


def silver_entity(bronze: DataFrame, entity: Entity, batch_id: str, at: Column) -> DataFrame:
    """Typed columns, derived columns, quality score, audit and the deterministic silver key."""
    typed = cleanse(bronze, entity.rules).withColumns(dict(entity.derived))
    scored = typed.withColumn("sl_data_quality_score", completeness(typed, entity.required))
    keyed = scored.withColumn(f"sl_{entity.name}_key", surrogate_key(f"sl_{entity.name}", entity.key))
    audited = add_silver_audit(keyed, entity.name, batch_id, at)
    columns = [c for c in entity.rules if c in bronze.columns]
    return audited.select(
        f"sl_{entity.name}_key",
        *columns,
        *entity.derived,
        "sl_data_quality_score",
        "sl_created_time",
        "sl_updated_time",
        "sl_source_bronze_key",
        "sl_is_active",
        "sl_batch_id",
    )


def inferred_entity(
    source: DataFrame, entity: str, key: str, defaults: Mapping[str, Column], batch_id: str, at: Column
) -> DataFrame:
    """Entity known only by the ids other rows mention: one row per id, the rest from defaults.

    Ids are made distinct before the key is added, so a shared id yields one row.
    """
    ids = source.select(F.col(key).try_cast("int").alias(key)).where(F.col(key).isNotNull()).distinct()
    rows = ids.withColumns({f"sl_{entity}_key": surrogate_key(f"sl_{entity}", key), **defaults})
    return add_silver_audit(rows, entity, batch_id, at)


def placeholder_address(at: Column) -> dict[str, Column]:
    """Default attributes of an address whose source is not landed."""
    # Placeholder attributes.
    texts = {"address": "123 Main St", "district": "Central", "postal_code": "12345", "phone": "555-0123"}
    columns = {name: F.lit(value) for name, value in texts.items()}
    columns["address2"] = F.lit(None).cast("string")
    columns["city_id"] = F.lit(1)
    columns["last_update"] = at
    return columns


def enrich_customer(silver: DataFrame, rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """Fill lifetime value, rental count and last rental date of silver customers."""
    activity = rentals.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("sl_rental_count"), F.to_date(F.max("rental_date")).alias("sl_last_rental_date")
    )
    spent = payments.groupBy("customer_id").agg(F.sum("amount").alias("sl_lifetime_value"))
    with_rentals = join_aggregate(silver, activity, "customer_id", ["sl_rental_count"])
    return join_aggregate(with_rentals, spent, "customer_id", ["sl_lifetime_value"])


