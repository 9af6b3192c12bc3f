"""The register tables: counts, links and consistency."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def register_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table"), "record_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def register_link(
    main: DataFrame, link: DataFrame, key: str = "organisation_number", link_key: str | None = None
) -> DataFrame:
    """Main rows with their linked rows; main rows without one stay.

    Link columns that the main table has too are taken from the main table.  With
    ``link_key`` the link's own ``key`` column, if any, becomes ``linked_<key>``.
    """
    other = link
    if link_key:
        other = link.withColumnsRenamed({key: f"linked_{key}", link_key: key})
    extra = [c for c in other.columns if c == key or c not in main.columns]
    other = other.select(*extra)
    # Inner plus anti instead of left outer: an inner join lets adaptive execution
    # split the linked rows of one organisation that has very many.
    linked = main.join(other, key)
    alone = main.join(other.select(key), key, "left_anti")
    return linked.unionByName(alone, allowMissingColumns=True)


def _differs(total: Column, parts: Column) -> Column:
    return F.coalesce(total != parts, F.lit(False))


def register_consistency(partb: DataFrame) -> DataFrame:
    """How many filings break each documented sum; a missing amount breaks none."""
    c = F.col
    rules = {
        "assets_own_use": _differs(
            c("assets_own_use"), c("assets_total_fixed") - c("assets_long_term_investment")
        ),
        "assets_total_liabilities": _differs(
            c("assets_total_liabilities"),
            c("creditors_one_year_total_current") + c("creditors_falling_due_after_one_year"),
        ),
        "funds_total": _differs(c("funds_total"), c("assets_total_assets_and_liabilities")),
    }
    counted = partb.agg(*(F.count_if(broken).alias(name) for name, broken in rules.items()))
    return counted.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(name).alias("check"), c(name).alias("violations"))
                    for name in rules
                )
            )
        )
    )


def register_latest_filing(partb: DataFrame) -> DataFrame:
    """Latest filing per organisation, by the order number the register gives."""
    return partb.where(F.col("fin_period_order_number") == 1)


def register_filing_order(partb: DataFrame) -> DataFrame:
    """Organisations whose filing numbered 1 is not the one of their newest period."""
    first = F.when(F.col("fin_period_order_number") == 1, F.col("fin_period_end_date"))
    return (
        partb.groupBy("organisation_number")
        .agg(F.max(first).alias("numbered_first"), F.max("fin_period_end_date").alias("newest"))
        .where(~F.col("numbered_first").eqNullSafe(F.col("newest")))
    )


def register_main(charity: DataFrame) -> DataFrame:
    """Main organisations, without linked ones."""
    return charity.where(F.col("linked_charity_number") == 0)
