"""The complete refresh of the rental domain as steps for :func:`pipeline.run`.

Sources are named ``source.<table>``; every later table reads written tables only, and
gold reads silver and gold. Wide dimensions and marts of other modules can be added as
further steps.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.cleanse import apply_rule
from stratalake.functions.keys import fold_keys, surrogate_key, unfold_keys
from stratalake.operators import audit, joins
from stratalake.plans import dims, facts, metrics, silver
from stratalake.plans.pipeline import Step
from stratalake.sources.tables import to_strings

# Natural key of each landed table.
NATURAL_KEYS = {
    "actor": ["actor_id"],
    "customer": ["customer_id"],
    "film": ["film_id"],
    "language": ["language_id"],
    "payment": ["payment_id"],
    "rental": ["rental_id"],
}


@dataclass(frozen=True)
class Settings:
    """What a refresh depends on besides its input."""

    execution: str
    load_time: Callable[[], Column]
    as_of: Callable[[], Column]
    tiers: Sequence = dims.TIERS
    high_value: object = dims.TIERS[1]
    ratings: Mapping[str, str] | None = None
    revenue_tiers: Sequence = tuple(dims.REVENUE_TIERS)
    feature_length: int = dims.FEATURE_LENGTH
    short: int = 90
    medium: int = 120
    source: str = "source"

    def batch(self, layer: str) -> str:
        return audit.batch_label(layer, self.execution)


# Rentals carry their film and store where the source knows them.
RENTAL = replace(silver.RENTAL, rules={**silver.RENTAL.rules, "film_id": "int", "store_id": "int"})
_IDS = {e.name: (e.key, e.rules[e.key]) for e in (silver.LANGUAGE, silver.CUSTOMER, RENTAL, silver.PAYMENT)}
_IDS["film"] = ("film_id", silver.FILM_RULES["film_id"])


def unusable_id(table: str) -> Callable[[DataFrame], Column] | None:
    """The id column's name for landed rows of an entity whose id does not fit its rule, else NULL."""
    if table not in _IDS:
        return None
    key, rule = _IDS[table]
    return lambda df: F.when(apply_rule(F.col(key), rule).isNull(), F.lit(key))


def bronze_steps(settings: Settings, tables: Mapping[str, Sequence[str]]) -> list[Step]:
    """Land every table as text with audit columns; ``tables`` maps a table to its natural key.

    Rows without a usable id are landed too, as rejected: dimensions and facts leave out exactly
    these, the run lists them, and ``pipeline.land_corrected`` replays them.
    """

    def land(table: str, key: Sequence[str]) -> Step:
        def build(df: DataFrame) -> DataFrame:
            return audit.add_bronze_audit(
                to_strings(df), table, f"{settings.source}.{table}", settings.batch("bronze_basic"), settings.load_time(), list(key)
            )

        return Step(f"bronze.{table}", [f"source.{table}"], build, rejects=unusable_id(table))

    return [land(table, key) for table, key in tables.items()]


def silver_steps(settings: Settings) -> list[Step]:
    """Typed entities, and the address and store entities their ids imply."""
    batch = settings.batch("silver_dimensional")

    def clean(entity: silver.Entity) -> Step:
        def build(df: DataFrame) -> DataFrame:
            return silver.silver_entity(df, entity, batch, settings.load_time())

        return Step(f"silver.{entity.name}", [f"bronze.{entity.name}"], build)

    def addresses(customers: DataFrame) -> DataFrame:
        at = settings.load_time()
        return silver.inferred_entity(customers, "address", "address_id", silver.placeholder_address(at), batch, at)

    def stores(customers: DataFrame) -> DataFrame:
        defaults = {"manager_staff_id": F.lit(1), "address_id": F.col("store_id"), "last_update": settings.load_time()}
        return silver.inferred_entity(customers, "store", "store_id", defaults, batch, settings.load_time())

    film = silver.film(settings.short, settings.medium)
    return [
        Step("silver.address", ["bronze.customer"], addresses),
        Step("silver.store", ["bronze.customer"], stores),
        *[clean(e) for e in (silver.LANGUAGE, silver.CUSTOMER, film, RENTAL, silver.PAYMENT)],
    ]


def _dimension_key(name: str) -> Column:
    """The key that the dimensions derive from an id."""
    return surrogate_key(f"gl_dim_{name}", f"{name}_id")


def _rental_keys(rental: DataFrame) -> dict[str, Column]:
    """The keys that the lower layers derive from the id of a rental."""
    made = {"sl_rental_key": "sl_rental", "sl_source_bronze_key": "br_rental"}
    return {name: surrogate_key(entity, "rental_id") for name, entity in made.items() if name in rental.columns}


def gold_steps(settings: Settings) -> list[Step]:
    """Calendar, dimensions, the fact with its dimension keys, and customer metrics."""
    batch = settings.batch("gold_dimensional")

    def audited(df: DataFrame, entity: str) -> DataFrame:
        return audit.add_gold_audit(df, entity, batch, settings.load_time())

    def dates(rentals: DataFrame) -> DataFrame:
        return dims.with_unknown_date(dims.calendar_for(rentals, "rental_date", "return_date"))

    def stores(store: DataFrame, address: DataFrame) -> DataFrame:
        return audited(dims.store_dimension(store, address), "store")

    def customers(customer: DataFrame, address: DataFrame, store: DataFrame, rental: DataFrame, payment: DataFrame) -> DataFrame:
        # The layers hold no city names, only ids, and a district is none.
        places = store.select("store_id", F.col("store_address").alias("address"), F.lit(None).cast("string").alias("city"))
        # A customer without a usable id gets no dimension row; it is in bronze.customer_rejected.
        known = customer.where(F.col("customer_id").isNotNull())
        wide = dims.customer_dimension(
            known, address, places, rental, payment, settings.as_of(), settings.tiers, settings.high_value
        )
        return audited(wide, "customer").drop("sl_created_time", "sl_updated_time", "sl_source_bronze_key", "sl_is_active", "sl_batch_id")

    def films(film: DataFrame, language: DataFrame) -> DataFrame:
        ratings = dims.RATING_GROUPS if settings.ratings is None else settings.ratings
        return audited(dims.film_dimension(film, language, ratings, settings.feature_length, settings.revenue_tiers), "film")

    def staff(rental: DataFrame) -> DataFrame:
        return audited(dims.staff_dimension(rental), "staff")

    def fact(rental: DataFrame, payment: DataFrame, customer: DataFrame, member: DataFrame, film: DataFrame, store: DataFrame) -> DataFrame:
        rows = facts.paid_rentals(fold_keys(rental, _rental_keys(rental)), payment)
        members = {"customer": customer, "staff": member, "film": film, "store": store}
        lookups = [(d, f"{n}_id", f"{n}_id", f"gl_dim_{n}_key", _dimension_key(n)) for n, d in members.items()]
        return joins.irregular_keys(rows, [x for x in lookups if x[1] in rows.columns])

    def whole_fact(rows: DataFrame) -> DataFrame:
        found = [n for n in ("customer", "staff", "film", "store") if f"gl_dim_{n}_key" in rows.columns]
        absent = [n for n in ("customer", "staff", "film", "store") if n not in found]
        rows = unfold_keys(rows, _rental_keys(rows))
        keyed = joins.derived_keys(facts.with_measures(rows), {f"gl_dim_{n}_key": _dimension_key(n) for n in found})
        keyed = keyed.withColumns({f"gl_dim_{n}_key": F.lit("-1") for n in absent}) if absent else keyed
        # Keys come behind the measures.
        keys = [f"gl_dim_{n}_key" for n in (*found, *absent)]
        return audited(keyed.select(*[c for c in keyed.columns if c not in keys], *keys), "rental")

    def scores(rows: DataFrame) -> DataFrame:
        return audited(metrics.customer_metrics(rows, settings.tiers, settings.high_value), "customer_metrics")

    return [
        Step("gold.dim_date", ["silver.rental"], dates),
        Step("gold.dim_store", ["silver.store", "silver.address"], stores),
        Step("gold.dim_customer", ["silver.customer", "silver.address", "gold.dim_store", "silver.rental", "silver.payment"], customers),
        Step("gold.dim_film", ["silver.film", "silver.language"], films),
        Step("gold.dim_staff", ["silver.rental"], staff),
        Step(
            "gold.fact_rental",
            ["silver.rental", "silver.payment", "gold.dim_customer", "gold.dim_staff", "gold.dim_film", "gold.dim_store"],
            fact,
            month="rental_date",
            widen=whole_fact,
        ),
        Step("gold.customer_metrics", ["gold.fact_rental"], scores),
    ]


def full_refresh(settings: Settings, tables: Mapping[str, Sequence[str]] | None = None) -> list[Step]:
    """All three layers in order."""
    return [*bronze_steps(settings, tables or NATURAL_KEYS), *silver_steps(settings), *gold_steps(settings)]
