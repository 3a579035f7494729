"""Numeric and banding expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.text import as_col, holds


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields NULL for a zero or missing denominator."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def gap(a: Column | str, b: Column | str) -> Column:
    """How far two amounts lie apart."""
    return F.abs(as_col(a) - as_col(b))


def started_units(c: Column | str, unit: float) -> Column:
    """Number of started units (for example kilograms) in an amount."""
    return F.ceil(as_col(c) / F.lit(unit))


# Tariffs of the two drop-off networks, and the zones priced as main.
@dataclass(frozen=True)
class FlatTariff:
    base: float = 40.90
    per_kg: float = 5.50
    handling: float = 6.75
    flat_limit: float = 1000.0


@dataclass(frozen=True)
class ZonedTariff:
    main_base: float = 54.57
    main_per_kg: float = 4.95
    other_base: float = 81.43
    other_per_kg: float = 6.86
    flat_limit: float = 2000.0
    main_zones: tuple[str, ...] = ("Main Centre", "Local", "Main Township", "Local Township")


def flat_tariff(mass: Column | str, t: FlatTariff = FlatTariff()) -> Column:
    """Flat price up to a mass, beyond it a price per started kilogram."""
    m = as_col(mass)
    heavy = F.lit(t.base) + F.lit(t.per_kg) * started_units(m, 1000.0) + F.lit(t.handling)
    return F.when(m <= t.flat_limit, F.lit(t.base) + F.lit(t.handling)).when(
        m > t.flat_limit, heavy
    )


def zoned_tariff(
    mass: Column | str, zone: Column | str, t: ZonedTariff = ZonedTariff()
) -> Column:
    """As `flat_tariff`, with dearer rates outside the main zones; no zone counts as outside."""
    m = as_col(mass)
    is_main = F.coalesce(as_col(zone).isin(*t.main_zones), F.lit(False))
    base = F.when(is_main, F.lit(t.main_base)).otherwise(F.lit(t.other_base))
    per_kg = F.when(is_main, F.lit(t.main_per_kg)).otherwise(F.lit(t.other_per_kg))
    return F.when(m <= t.flat_limit, base).when(
        m > t.flat_limit, base + per_kg * started_units(m, 1000.0)
    )


# Substring rules that name a delivery zone's service class, in
# order of application; a later match overrides an earlier one.
ZONE_RULES = (
    ("Local", "Local"),
    ("Outlying", "Outlying"),
    ("Main", "Main"),
    ("National", "Speed Services"),
    ("Regional", "Post office/Post-Net"),
    ("International", "International"),
)


def classify_last_match(
    c: Column | str, rules: Sequence[tuple[str, str]] = ZONE_RULES
) -> Column:
    """Label of the last rule whose substring occurs; NULL where none does."""
    text = as_col(c)
    chain = F
    for needle, label in reversed(rules):
        chain = chain.when(holds(text, needle), F.lit(label))
    return chain
