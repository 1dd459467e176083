"""Fill the HTML templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.functions import formats as fmt
from staylift.functions.text import fill, optional_block
from staylift.operators.scoring import shows_package
from staylift.sources.templates import as_column

NO_PACKAGE = "미가입"
HOST = "호스트"


def _text(column: str, default: str = "") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(default))


def render_upsell(targets: DataFrame, template: DataFrame | str) -> DataFrame:
    """Add ``html``. The comparison block stays only where competitors in the region advertise."""
    values = {
        "host_name": _text("host_name", HOST),
        "acm_name": _text("acm_name"),
        "acm_id": _text("acm_id"),
        "res_90d": _text("res_90d", "0"),
        "gmv_90d_fmt": fmt.thousands(F.col("gmv_90d")),
        "current_pkg": F.coalesce(F.nullif("advert_name", F.lit("")), F.lit(NO_PACKAGE)),
        "avg_res": fmt.one_decimal(F.col("avg_res")),
        "ad_acm_cnt": _text("ad_acm_cnt", "0"),
        "extra_rev_fmt": fmt.thousands(F.col("extra_rev_90d")),
        "rec_package": _text("rec_package"),
        "rec_rate_pct": fmt.rate_percent(F.col("rec_rate")),
        "email_body": _text("body"),
    }
    return _rendered(targets, template, values, "compare", F.col("ad_acm_cnt") > 0)


def render_report(hosts: DataFrame, template: DataFrame | str, month: Column) -> DataFrame:
    """Add ``html``. The package line is left out for hosts without a booking last month."""
    perf, change = F.col("perf"), F.col("change_pct")
    show = shows_package(perf)
    values = {
        "month_label": month,
        "host_name": _text("host_name", HOST),
        "acm_name": _text("acm_name"),
        "acm_id": _text("acm_id"),
        "pkg_name": _text("advert_name"),
        "show_pkg": F.when(show, "True").otherwise("False"),
        "res_this_month": _text("res_this_month", "0"),
        "gmv_this_fmt": fmt.thousands(F.col("gmv_this_month")),
        "res_last_month": _text("res_last_month", "0"),
        "change_arrow": fmt.change_arrow(change),
        "change_color": fmt.change_color(change),
        "region_avg_res": fmt.one_decimal(F.col("region_avg_res")),
        "perf_label": fmt.lookup(perf, fmt.PERF_LABELS, "—"),
        "email_body": _text("body"),
    }
    return _rendered(hosts, template, values, "show_pkg", show)


def _rendered(
    df: DataFrame, template: DataFrame | str, values: dict[str, Column], block: str, keep: Column
) -> DataFrame:
    filled = df.withColumn("html", fill(as_column(template), values))
    return filled.withColumn("html", optional_block(F.col("html"), block, keep))
