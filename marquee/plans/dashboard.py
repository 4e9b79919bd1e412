"""The dashboard's three pages as named result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.aggregates import (
    category_months, category_shares, kpis, months_of_year, most_common, tag_shares, top_categories, top_cities,
)
from marquee.operators.filters import in_rolling_window, keep_year, mapped_counts


def overview(events: DataFrame) -> dict[str, DataFrame]:
    return {
        "kpis": kpis(events, cities="city", categories="primary_category"),
        "categories": category_shares(events, "primary_category"),
        "tags": tag_shares(events),
        "mapped": mapped_counts(events),
    }


def rolling_trends(events: DataFrame, today, months: int = 12) -> dict[str, DataFrame]:
    window = events.filter(in_rolling_window(F.col("date"), today, months))
    return {
        "kpis": kpis(window, cities="city"),
        "top": top_categories(window, "primary_category"),
        "months": category_months(window, "primary_category", "date", today),
        "mapped": mapped_counts(window),
    }


def year_trends(events: DataFrame, year: int | None = None, current_year: int | None = None) -> dict[str, DataFrame]:
    chosen = keep_year(events, year=year, current_year=current_year)
    return {
        "kpis": kpis(chosen, cities="city"),
        "months": months_of_year(chosen, "date"),
        "cities": top_cities(chosen),
        "mapped": mapped_counts(chosen),
    }


def host_overview(events: DataFrame, host: str = "host_name") -> dict[str, DataFrame]:
    hosts = most_common(events, host, ["inferred_host_type", "inferred_gtm_segment"])
    return {
        "kpis": kpis(events, hosts=host, cities="city"),
        "types": category_shares(hosts, "inferred_host_type"),
        "segments": category_shares(hosts, "inferred_gtm_segment"),
    }
