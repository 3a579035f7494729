"""Cost and collection time of customer returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.calendar import busdays, year_month
from quayside.functions.numeric import classify_last_match, flat_tariff, zoned_tariff
from quayside.functions.text import prefix
from quayside.operators.aggregates import DECILES, QUARTILES, describe, group_agg, unstack
from quayside.operators.quantiles import describe_spread
from quayside.operators.reshape import columns_to_rows

# Shipment types that are returns.
RETURN_TYPES = ("SPR", "COL")
# The study looks at pick-ups before this month.
MONTH_LIMIT = 12
MONTHS = tuple(range(1, MONTH_LIMIT))

QUARTILE_NAMES = {f"p{round(q * 100)}": q for q in QUARTILES}
DECILE_NAMES = {f"p{round(q * 100)}": q for q in DECILES}


def returns(shipments: DataFrame) -> DataFrame:
    """Return shipments with their collection delay in business days."""
    rows = shipments.withColumn("type", prefix("shipment_id", 3)).filter(
        F.col("type").isin(*RETURN_TYPES)
    )
    rows = rows.withColumn("delay", busdays("poh_date", "pod_date"))
    return rows.withColumn("delay", F.when(F.col("delay") >= 0, F.col("delay")))


def courier_returns(shipments: DataFrame) -> DataFrame:
    """Charged returns: further parcels of the same return carry no charge."""
    return returns(shipments).filter(F.col("charge_out") > 0)


def summary(df: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Describe several columns over all rows, one output row each, with totals.

    Charges are free numbers, so their exact quantiles are spread over tasks.
    """
    values = df.select(*[F.col(c).cast("double").alias(name) for name, c in measures.items()])
    long = columns_to_rows(values, [], list(measures), "measure", "value")
    return describe_spread(long, ["measure"], "value", QUARTILE_NAMES, total="total")


def collection_summary(shipments: DataFrame) -> DataFrame:
    return summary(courier_returns(shipments), {"charge_out": "charge_out", "delay": "delay"})


def post_office_summary(shipments: DataFrame) -> DataFrame:
    priced = returns(shipments).withColumn("charge", flat_tariff("chargeable_mass"))
    return summary(priced, {"post_office_charge": "charge"})


def counter_summary(shipments: DataFrame) -> DataFrame:
    priced = returns(shipments).withColumn("charge", zoned_tariff("chargeable_mass", "zone"))
    return summary(priced, {"counter_charge": "charge"})


def sla_rows(shipments: DataFrame) -> DataFrame:
    """Courier returns by month and service zone; zones that fit no rule drop out later."""
    rows = courier_returns(shipments).withColumn("month", year_month("poh_date")[1])
    return rows.filter(F.col("month") < MONTH_LIMIT).withColumn(
        "sla_zone", classify_last_match("zone")
    )


def collected_by_zone(rows: DataFrame) -> DataFrame:
    """Statistics skip open returns by themselves, so only groups are filtered."""
    return describe(rows, ["sla_zone"], "delay", DECILE_NAMES).filter("n > 0")


def not_collected_by_zone(rows: DataFrame) -> DataFrame:
    open_rows = F.count_if(F.col("delay").isNull()).alias("n")
    return group_agg(rows, ["sla_zone"], open_rows).filter("n > 0")


def collected_by_month(rows: DataFrame) -> DataFrame:
    """Statistics per zone as rows, months as columns."""
    stats = describe(rows, ["sla_zone", "month"], "delay", DECILE_NAMES).filter("n > 0")
    stats = stats.withColumn("n", F.col("n").cast("double"))
    names = ["n", "mean", "std", "min", *DECILE_NAMES, "max"]
    long = columns_to_rows(stats, ["sla_zone", "month"], names, "statistic", "value")
    wide = long.groupBy("sla_zone", "statistic").pivot("month", list(MONTHS)).agg(
        F.first("value")
    )
    return _month_names(wide)


def not_collected_by_month(rows: DataFrame) -> DataFrame:
    open_rows = F.nullif(F.count_if(F.col("delay").isNull()), F.lit(0))
    wide = unstack(rows, ["sla_zone"], "month", MONTHS, open_rows)
    return _month_names(wide.dropna(how="all", subset=[str(m) for m in MONTHS]))


def _month_names(wide: DataFrame) -> DataFrame:
    return wide.withColumnsRenamed({str(m): f"m{m}" for m in MONTHS})
