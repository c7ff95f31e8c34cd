"""Intents, invoices and settlement: staging, pricing, daily metrics, cohorts, costs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.addresses import unpadded
from ..functions.amounts import lossy_double, lossy_long, percent, ratio, scaled
from ..functions.buckets import discount_bucket, sunday_week
from ..functions.labels import mapped
from ..operators.joins import full_on, lookup, lookup_roles, price_roles

FEE_SHARE = 0.0001
DONE = "SETTLED_AND_COMPLETED"
UNSUPPORTED = "DISPATCHED_UNSUPPORTED"
SETTLED = ("DISPATCHED", "SETTLED")

# fixed value: one chain the registry does not list
EXTRA_CHAIN_ID = 25327


def _epoch(c: str) -> Column:
    return F.timestamp_seconds(lossy_long(c))


def _tokens(tokens: DataFrame) -> DataFrame:
    return tokens.select("domain_id", "symbol", "decimals", F.lower("address").alias("address")).distinct()


# --- staging --------------------------------------------------------------------------


def stage_intents(raw: DataFrame, tokens: DataFrame, chains: DataFrame) -> DataFrame:
    """20-byte addresses, UTC times, amounts in token units (18 places in, the token's own out)."""
    rows = raw.withColumns(
        {
            "from_chain_id": lossy_long("origin_origin"),
            "to_chain_id": lossy_long("settlement_domain"),
            "from_asset_address": unpadded("origin_input_asset"),
            "to_asset_address": F.lower("settlement_asset"),
        }
    )
    rows = lookup_roles(rows, chains, "chain_id", "name", {"from_chain_id": "from_chain_name", "to_chain_id": "to_chain_name"})
    known = _tokens(tokens)
    rows = lookup(
        rows, known, {"from_chain_id": "domain_id", "from_asset_address": "address"}, {"symbol": "from_asset_symbol"}
    )
    rows = lookup(
        rows, known, {"to_chain_id": "domain_id", "to_asset_address": "address"},
        {"symbol": "to_asset_symbol", "decimals": "to_asset_decimals"},
    )
    return rows.select(
        F.col("uploaded_at").cast("timestamp").alias("updated_at"),
        "id", "status", "hub_status",
        unpadded("origin_initiator").alias("origin_initiator"),
        F.col("origin_transaction_hash").alias("from_hash"),
        _epoch("origin_timestamp").alias("origin_timestamp"),
        "from_chain_id", "from_chain_name", "from_asset_address", "from_asset_symbol",
        F.lit(18).cast("bigint").alias("from_asset_decimals"),
        scaled("origin_amount", 18).alias("from_asset_amount"),
        _epoch("settlement_timestamp").alias("settlement_timestamp"),
        "to_chain_id", "to_chain_name", "to_asset_address", "to_asset_symbol", "to_asset_decimals",
        scaled("settlement_amount", F.col("to_asset_decimals")).alias("to_asset_amount"),
        _epoch("hub_added_timestamp").alias("hub_added_timestamp"),
        _epoch("hub_settlement_enqueued_timestamp").alias("hub_settlement_enqueued_timestamp"),
        F.lit(FEE_SHARE).alias("fee_value"),
        lossy_double("hub_settlement_enqueued_timestamp").alias("hub_settlement_enqueued_timestamp_epoch"),
        scaled("hub_settlement_amount", 18).alias("hub_settlement_amount"),
        lossy_double("hub_added_timestamp").alias("hub_added_timestamp_epoch"),
    )


def stage_invoices(raw: DataFrame, tokens: DataFrame, chains: DataFrame) -> DataFrame:
    rows = raw.withColumns(
        {"from_chain_id": lossy_long("origin_origin"), "from_asset_address": unpadded("origin_input_asset")}
    )
    rows = lookup_roles(rows, chains, "chain_id", "name", {"from_chain_id": "from_chain_name"})
    rows = lookup(
        rows, _tokens(tokens), {"from_chain_id": "domain_id", "from_asset_address": "address"}, {"symbol": "from_asset_symbol"}
    )
    return rows.select(
        F.col("uploaded_at").cast("timestamp").alias("updated_at"),
        "id", "hub_invoice_id", "hub_invoice_intent_id", "origin_status", "hub_status",
        _epoch("origin_timestamp").alias("origin_timestamp"),
        lossy_long("hub_invoice_enqueued_timestamp").alias("hub_invoice_enqueued_timestamp"),
        lossy_long("hub_invoice_entry_epoch").alias("hub_invoice_entry_epoch"),
        lossy_long("hub_settlement_epoch").alias("hub_settlement_epoch"),
        unpadded("origin_initiator").alias("origin_initiator"),
        "from_chain_id", "from_chain_name", "from_asset_address", "from_asset_symbol",
        F.lit(18).cast("bigint").alias("from_asset_decimals"),
        scaled("hub_invoice_amount", 18).alias("hub_invoice_amount"),
    )


def symbol_minutes(minute_prices: DataFrame) -> DataFrame:
    """One price per symbol and minute; prices of several chains are averaged, so a join cannot fan out."""
    return minute_prices.groupBy("symbol", F.col("minute").alias("date")).agg(F.avg("price").alias("price"))


def clean_intents(staged: DataFrame, minute_prices: DataFrame) -> DataFrame:
    rows = price_roles(
        staged, symbol_minutes(minute_prices), {"from_asset_price": ("from_asset_symbol", "origin_timestamp")}, unit="minute"
    )
    price = F.col("from_asset_price")
    return rows.withColumns(
        {
            "from_asset_amount_usd": price * F.col("from_asset_amount"),
            "to_asset_price": price,
            "to_asset_amount_usd": price * F.col("to_asset_amount"),
            "hub_settlement_amount_usd": price * F.col("hub_settlement_amount"),
        }
    )


def clean_invoices(staged: DataFrame, minute_prices: DataFrame) -> DataFrame:
    rows = price_roles(
        staged, symbol_minutes(minute_prices), {"from_asset_price": ("from_asset_symbol", "origin_timestamp")}, unit="minute"
    )
    return rows.withColumn("hub_invoice_amount_usd", F.col("hub_invoice_amount") * F.col("from_asset_price"))


_INVOICE_VALUES = (
    "hub_invoice_id", "hub_invoice_intent_id", "hub_invoice_enqueued_timestamp", "hub_invoice_entry_epoch",
    "hub_settlement_epoch", "hub_invoice_amount_usd",
)


def _supported(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("status") == DONE) & (F.col("hub_status") != UNSUPPORTED))


def intents_with_invoices(intents: DataFrame, invoices: DataFrame) -> DataFrame:
    """Completed intents with their invoice, discount, revenue, duration and fee."""
    held = invoices.select("id", F.col("id").alias("invoice_intent_id"), *_INVOICE_VALUES)
    rows = _supported(intents).join(held, "id", "left")
    invoiced = F.col("invoice_intent_id").isNotNull()
    revenue = F.col("fee_value") * F.col("from_asset_amount_usd")
    rows = rows.withColumns(
        {
            "discount_bps_mm": F.when(
                invoiced & F.col("hub_status").isin(*SETTLED),
                (ratio("hub_settlement_amount_usd", "from_asset_amount_usd") - 1) * 10_000,
            ),
            "settlement_duration_minutes": F.timestamp_diff(
                "MINUTE", F.col("origin_timestamp"), F.col("hub_settlement_enqueued_timestamp")
            ),
            "protocol_revenue_usd": revenue,
            "discounts_by_mm_usd": F.when(
                invoiced, F.col("hub_invoice_amount_usd") - F.col("to_asset_amount_usd")
            ).otherwise(0.0),
        }
    )
    fee = F.col("protocol_revenue_usd") + F.col("discounts_by_mm_usd")
    return rows.withColumns(
        {
            "discount_bucket": discount_bucket("discount_bps_mm"),
            "settled_in_6hrs_flag": F.when(
                F.col("settlement_duration_minutes") <= 360, "settled within 6hrs"
            ).otherwise("settled in greater than 6hrs"),
            "rebalancing_fee_usd": fee,
            "discount_bps_rebalancer": ratio(fee * 10_000, "from_asset_amount_usd"),
        }
    )


# --- daily marts ------------------------------------------------------------------------

ROUTE = (
    "from_chain_id", "from_chain_name", "from_asset_address", "from_asset_symbol",
    "to_chain_id", "to_chain_name", "to_asset_address", "to_asset_symbol",
)


def _origin_day() -> Column:
    return F.date_trunc("day", "origin_timestamp").alias("day")


def _hours_between(start: str, end: str) -> Column:
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 3600.0


def netting_daily(intents: DataFrame, invoices: DataFrame) -> DataFrame:
    """Completed intents that never became an invoice, per day and route."""
    rows = _supported(intents).join(invoices.select("id"), "id", "left_anti")
    return rows.groupBy(_origin_day(), *ROUTE).agg(
        F.max("updated_at").alias("updated_at"),
        F.avg("from_asset_price").alias("avg_from_asset_price"),
        F.sum("from_asset_amount").alias("netting_volume"),
        F.sum("from_asset_amount_usd").alias("netting_volume_usd"),
        F.avg(_hours_between("origin_timestamp", "settlement_timestamp")).alias("netting_avg_time_in_hrs"),
        F.sum(F.col("fee_value") * F.col("from_asset_amount_usd")).alias("netting_protocol_revenue_usd"),
        F.count("id").alias("netting_total_intents"),
        F.avg("from_asset_amount_usd").alias("netting_avg_intent_size_usd"),
    )


def settled_daily(intents: DataFrame, invoices: DataFrame) -> DataFrame:
    """Invoiced intents settled by market makers, per day and route."""
    held = invoices.select("id", "hub_invoice_amount_usd", "hub_settlement_epoch", "hub_invoice_entry_epoch")
    rows = intents.where((F.col("status") == DONE) & F.col("hub_status").isin(*SETTLED)).join(held, "id")
    amount, invoice = F.col("from_asset_amount_usd"), F.col("hub_invoice_amount_usd")
    discount = invoice - F.col("to_asset_amount_usd")
    fee = F.col("fee_value") * amount
    waited = (F.col("hub_settlement_enqueued_timestamp_epoch") - F.col("hub_added_timestamp_epoch")) / 3600
    out = rows.groupBy(_origin_day(), *ROUTE).agg(
        F.max("updated_at").alias("updated_at"),
        F.count("id").alias("total_intents_by_mm"),
        F.sum(amount).alias("volume_settled_by_mm_usd"),
        F.sum(fee).alias("protocol_revenue_mm_usd"),
        F.sum(discount).alias("discounts_by_mm_usd"),
        F.avg(discount).alias("avg_discounts_by_mm_usd"),
        F.sum(invoice - amount - fee).alias("rewards_for_invoices_usd"),
        F.avg(invoice - amount).alias("avg_rewards_by_invoice_usd"),
        F.avg(waited).alias("avg_settlement_time_in_hrs_by_mm"),
        F.round(F.avg(F.col("hub_settlement_epoch") - F.col("hub_invoice_entry_epoch")), 0).alias("avg_discount_epoch_by_mm"),
    )
    return out.withColumn("apy", ratio("discounts_by_mm_usd", "volume_settled_by_mm_usd") * 365 * 100)


def settlement_daily(netted: DataFrame, settled: DataFrame) -> DataFrame:
    """Both marts side by side with their totals; routes match on ids and addresses."""
    on = ["day", "from_chain_id", "to_chain_id", "from_asset_address", "to_asset_address"]
    labels = ("from_chain_name", "to_chain_name", "from_asset_symbol", "to_asset_symbol", "updated_at")
    other = settled.withColumnsRenamed({c: f"__{c}" for c in labels})
    rows = full_on(netted, other, on)
    rows = rows.withColumns({c: F.coalesce(c, f"__{c}") for c in labels}).drop(*[f"__{c}" for c in labels])

    def total(*columns: str) -> Column:
        out = F.coalesce(F.col(columns[0]), F.lit(0))
        for c in columns[1:]:
            out = out + F.coalesce(F.col(c), F.lit(0))
        return out

    return rows.withColumns(
        {
            "total_volume_usd": total("netting_volume_usd", "volume_settled_by_mm_usd"),
            "total_intents": total("netting_total_intents", "total_intents_by_mm"),
            "total_protocol_revenue_usd": total("netting_protocol_revenue_usd", "protocol_revenue_mm_usd"),
            "total_rebalancing_fee_usd": total(
                "netting_protocol_revenue_usd", "protocol_revenue_mm_usd", "discounts_by_mm_usd"
            ),
        }
    )


# --- the same in token units -----------------------------------------------------------


def _between(rows: DataFrame, from_date: str | None, to_date: str | None, ts: str = "origin_timestamp") -> DataFrame:
    """Days ``from_date`` to ``to_date``, both included."""
    if from_date:
        rows = rows.where(F.col(ts) >= F.lit(from_date).cast("timestamp"))
    if to_date:
        rows = rows.where(F.col(ts) < F.date_add(F.lit(to_date).cast("date"), 1).cast("timestamp"))
    return rows


def settlement_metrics(
    intents: DataFrame, invoices: DataFrame, kind: str, grain: str = "day", by_route: bool = True,
    from_date: str | None = None, to_date: str | None = None,
) -> DataFrame:
    """``kind``: netting, settled, overall or apy. ``grain``: day, or range for one row per route.

    Works on staged intents and invoices, amounts in token units.
    """
    if grain not in ("day", "range"):
        raise ValueError(f"grain must be day or range, not {grain}")
    keys = ([_origin_day()] if grain == "day" else []) + (
        ["from_chain_id", "from_asset_symbol", "to_chain_id", "to_asset_symbol"] if by_route else []
    )
    rows = _between(intents.where(F.col("status") == DONE), from_date, to_date)
    held = invoices.select(
        "id", F.lit(True).alias("__invoiced"), "hub_invoice_amount", "hub_settlement_epoch", "hub_invoice_entry_epoch"
    )
    amount, invoice = F.col("from_asset_amount"), F.col("hub_invoice_amount")
    discount, fee = invoice - F.col("to_asset_amount"), F.col("from_asset_amount") * FEE_SHARE
    if kind == "netting":
        netted = rows.where(F.col("hub_status") != UNSUPPORTED).join(held.select("id"), "id", "left_anti")
        return netted.groupBy(*keys).agg(
            F.sum(amount).alias("netting_volume"),
            F.avg(_hours_between("origin_timestamp", "settlement_timestamp")).alias("avg_netting_time_in_hrs"),
        )
    if kind == "overall":
        every = rows.where(F.col("hub_status") != UNSUPPORTED).join(held, "id", "left")
        discounted = F.when(F.col("__invoiced"), discount).otherwise(0.0)
        return every.groupBy(*keys).agg(
            F.sum(amount).alias("clearing_volume"),
            F.sum(fee).alias("protocol_revenue"),
            (F.sum(discounted) + F.sum(fee)).alias("rebalancing_fee"),
            F.avg(amount).alias("avg_intent_size"),
            F.count("id").alias("total_intents"),
        )
    settled = rows.where(F.col("hub_status").isin(*SETTLED)).join(held, "id")
    if kind == "apy":
        out = settled.groupBy(*keys).agg(F.sum(amount).alias("volume_settled_by_mm"), F.sum(discount).alias("discounts_by_mm"))
    elif kind == "settled":
        waited = (F.col("hub_settlement_enqueued_timestamp_epoch") - F.col("hub_added_timestamp_epoch")) / 3600
        out = settled.groupBy(*keys).agg(
            F.sum(amount).alias("volume_settled_by_mm"),
            F.count("id").alias("total_invoices_by_mm"),
            F.sum(discount).alias("discounts_by_mm"),
            F.avg(discount).alias("avg_discounts_by_mm"),
            F.sum(invoice - amount - fee).alias("rewards_for_invoices"),
            F.avg(invoice - amount).alias("avg_rewards_by_invoices"),
            F.avg(waited).alias("avg_settlement_time_in_hrs_by_mm"),
            F.round(F.avg(F.col("hub_settlement_epoch") - F.col("hub_invoice_entry_epoch")), 0).alias(
                "avg_discount_epoch_by_mm"
            ),
        )
    else:
        raise ValueError(f"unknown kind {kind}")
    return out.withColumn("apy", ratio("discounts_by_mm", "volume_settled_by_mm") * 365 * 100)


def settlement_rates(
    intents: DataFrame, invoices: DataFrame, grain: str = "day", from_date: str | None = None, to_date: str | None = None,
) -> DataFrame:
    """Share settled in time: 6 and 24 h for all intents, 1 and 3 h for invoiced ones.

    Each share is taken per bucket of its own width and averaged. Intents are counted
    per hour once; the four widths and both populations come from those counts, so no
    full join is needed.
    """
    rows = _supported(_between(intents, from_date, to_date))
    held = invoices.select("id", F.col("hub_invoice_enqueued_timestamp").alias("__queued"), F.lit(True).alias("__invoiced"))
    rows = rows.join(held, "id", "left")
    route = [c for c in ROUTE if not c.endswith("_name")]
    taken = F.col("hub_settlement_enqueued_timestamp_epoch") - F.unix_timestamp("origin_timestamp")
    mm = F.coalesce("__invoiced", F.lit(False)) & F.col("hub_status").isin(*SETTLED)
    queue = F.col("hub_settlement_enqueued_timestamp_epoch") - F.col("__queued")
    hourly = rows.groupBy(F.date_trunc("hour", "origin_timestamp").alias("hour"), *route).agg(
        F.count("id").alias("n"), F.count_if(mm).alias("n_mm"),
        F.count_if(taken < 6 * 3600).alias("s6"), F.count_if(taken < 24 * 3600).alias("s24"),
        F.count_if(mm & (queue < 3600)).alias("s1"), F.count_if(mm & (queue < 3 * 3600)).alias("s3"),
    )
    widths = F.explode(
        F.array(
            *[
                F.struct(F.lit(w).alias("width"), F.col(n).alias("total"), F.col(f"s{w}").alias("settled"))
                for w, n in ((6, "n"), (24, "n"), (1, "n_mm"), (3, "n_mm"))
            ]
        )
    )
    wide = hourly.select("hour", *route, widths.alias("w")).select("hour", *route, "w.*")
    start = F.col("hour") - F.make_dt_interval(hours=F.hour("hour") % F.col("width"))
    buckets = (
        wide.groupBy("width", *route, start.alias("bucket"))
        .agg(F.sum("total").alias("total"), F.sum("settled").alias("settled"))
        .where("total > 0")
    )
    keys = ([F.date_trunc("day", "bucket").alias("day")] if grain == "day" else []) + route
    out = buckets.groupBy(*keys).pivot("width", [6, 24, 1, 3]).agg(
        F.avg("settled").alias("settled"),
        F.avg("total").alias("total"),
        F.round(F.avg(F.col("settled") * 100.0 / F.col("total")), 2).alias("rate"),
    )
    names = {}
    for w in (6, 24):
        names |= {f"{w}_settled": f"avg_intents_settled_in_{w}_hrs", f"{w}_total": f"avg_intents_in_{w}_hrs"}
        names[f"{w}_rate"] = f"daily_avg_settlement_rate_{w}h"
    for w in (1, 3):
        names |= {f"{w}_settled": f"mm_avg_intents_settled_in_{w}_hr", f"{w}_total": f"mm_avg_intents_in_{w}_hr"}
        names[f"{w}_rate"] = f"mm_daily_avg_settlement_rate_{w}h_percentage"
    return out.withColumnsRenamed(names)


# --- OKRs and cohorts ---------------------------------------------------------------------


def okr_daily(rows: DataFrame, as_of: str) -> DataFrame:
    """Headline metrics per settlement day, before ``as_of``. ``rows``: intents with invoices."""
    took = _hours_between("origin_timestamp", "settlement_timestamp")
    days = rows.where(F.col("settlement_timestamp") < F.lit(as_of).cast("date").cast("timestamp"))
    invoiced = F.col("invoice_intent_id").isNotNull()
    return days.groupBy(F.date_trunc("day", "settlement_timestamp").alias("day")).agg(
        F.sum("from_asset_amount_usd").alias("volume_usd"),
        F.avg("rebalancing_fee_usd").alias("avg_rebalancing_fee_usd"),
        F.avg("discount_bps_rebalancer").alias("avg_rebalancing_fee_bps"),
        F.avg(F.when(invoiced, took)).alias("avg_settlement_time_hrs"),
        (F.count_if(took <= 6) * 100.0 / F.count("id")).alias("pct_intents_settled_within_6hrs"),
        (F.count_if(~invoiced) * 100.0 / F.count("id")).alias("pct_intents_netted_in_24hrs"),
    )


def cohort_ndr_gdr(rows: DataFrame, as_of: str) -> DataFrame:
    """Weekly net and gross dollar retention by the week a user first settled (weeks start on Sunday).

    Everything comes from one user-week table; the cohort's first spend is carried to
    the user's other weeks by a join on the user, not by a window over raw rows.
    """
    weekly = rows.groupBy("origin_initiator", sunday_week("settlement_timestamp").alias("week")).agg(
        F.sum("from_asset_amount_usd").alias("spend")
    )
    before = F.col("settlement_timestamp") < F.lit(as_of).cast("date").cast("timestamp")
    cohorts = rows.where(before).groupBy("origin_initiator").agg(
        sunday_week(F.min("settlement_timestamp")).alias("cohort_week")
    )
    spent = weekly.join(cohorts, "origin_initiator")
    first = spent.where("week = cohort_week").select("origin_initiator", F.col("spend").alias("first_spend"))
    users = spent.join(first, "origin_initiator", "left").groupBy("origin_initiator", "cohort_week", "first_spend").agg(
        F.sum("spend").alias("total"),
        F.sum(F.when(F.col("week") > F.col("cohort_week"), F.least("spend", "first_spend")).otherwise(0.0)).alias("retained"),
    )
    out = users.groupBy("cohort_week").agg(
        F.coalesce(F.sum("first_spend"), F.lit(0.0)).alias("starting_revenue"),
        F.sum("total").alias("__total"),
        F.sum("first_spend").alias("total_starting_revenue"),
        F.sum("retained").alias("total_retained_revenue"),
    )
    return out.select(
        "cohort_week",
        "starting_revenue",
        (F.col("__total") - F.col("starting_revenue")).alias("expansion_revenue"),
        ratio("__total", "starting_revenue").alias("ndr_percentage"),
        "total_starting_revenue",
        "total_retained_revenue",
        ratio("total_retained_revenue", "total_starting_revenue").alias("gdr_percentage"),
    )


def wallet_retention(activity: DataFrame, wallet: str = "initiator", ts: str = "timestamp") -> DataFrame:
    """Distinct users per cohort week (Monday) and week, as a share of the cohort's first week."""
    weeks = activity.select(
        F.col(wallet).alias("origin_wallet"), F.date_trunc("week", F.timestamp_seconds(ts)).alias("week")
    ).distinct()
    cohorts = weeks.groupBy("origin_wallet").agg(F.min("week").alias("cohort_week"))
    users = weeks.join(cohorts, "origin_wallet").groupBy("cohort_week", "week").agg(F.count(F.lit(1)).alias("users"))
    first = F.first("users").over(Window.partitionBy("cohort_week").orderBy("week"))
    since = (F.unix_timestamp("week") - F.unix_timestamp("cohort_week")) / 604800
    return users.select(
        "cohort_week", "week", "users",
        F.floor(since).alias("weeks_since_cohort"), (F.col("users") / first).alias("retention_rate"),
    )


def cohort_matrix(retention: DataFrame) -> DataFrame:
    """The cells of the cohort matrix, one row per cohort and week number, for every week there is."""
    cells = retention.groupBy("cohort_week", F.col("weeks_since_cohort").alias("week_number"))
    return cells.agg(F.avg("retention_rate").alias("retention_rate"))


# --- legacy metrics -----------------------------------------------------------------------


def typed(raw: DataFrame, decimals: DataFrame | None = None) -> DataFrame:
    """Text columns as numbers; amounts scaled by the output asset's decimals if given."""
    numbers = [c for c in raw.columns if c.endswith(("_timestamp", "_ttl", "_epoch"))]
    rows = raw.withColumns({c: lossy_long(c) for c in numbers})
    amounts = [c for c in raw.columns if c.endswith("_amount")]
    if decimals is None:
        return rows.withColumns({c: lossy_double(c) for c in amounts})
    rows = lookup(
        rows, decimals, {"origin_output_asset": "token_address"}, {"decimals": "__decimals"}, ignore_case=["origin_output_asset"]
    )
    return rows.withColumns({c: scaled(c, F.col("__decimals")) for c in amounts}).drop("__decimals")


def _grouped(rows: DataFrame, grain: str, from_date: str | None, to_date: str | None, ts: str = "origin_timestamp"):
    rows = _between(rows.withColumn("__ts", F.timestamp_seconds(ts)), from_date, to_date, "__ts")
    return rows.groupBy(*([F.date_trunc("day", "__ts").alias("day")] if grain == "day" else []))


def _by_mm() -> Column:
    return (F.col("origin_ttl") > 0) & (F.col("hub_status") == "DISPATCHED")


def _took() -> Column:
    return F.col("settlement_timestamp") - F.col("origin_timestamp")


def _settled_share(g) -> DataFrame:
    done = F.count_if(F.col("settlement_status") == "SETTLED")
    return g.agg(
        F.count("id").alias("total_intent_count"), done.alias("settled_count"),
        percent(done, F.count("id"), None).alias("prct_of_settled_count"),
    )


def invoice_1h_rate(intents: DataFrame, grain: str = "day", from_date=None, to_date=None) -> DataFrame:
    """Metric 2: mean of the hourly mean time in system, and the share within an hour."""
    rows = _between(intents.withColumn("__ts", F.timestamp_seconds("settlement_timestamp")), from_date, to_date, "__ts")
    hours = rows.groupBy(F.date_trunc("hour", "__ts").alias("hour")).agg(
        F.avg(_took()).alias("t"), F.count_if(_took() <= 3600).alias("within"), F.count("id").alias("n")
    )
    return hours.groupBy(*([F.date_trunc("day", "hour").alias("day")] if grain == "day" else [])).agg(
        (F.avg("t") / 3600).alias("avg_time_in_system_hours"),
        F.sum("n").alias("total_count_of_invoices"),
        F.sum("within").alias("count_of_invoices_within_1h"),
        percent(F.sum("within"), F.sum("n"), None).alias("retention_rate"),
    )


def _netting_rate(g) -> DataFrame:
    done = F.col("settlement_status") == "SETTLED"
    return g.agg(
        percent(F.count_if(done & (_took() <= 3600)), F.count("id")).alias("netting_rate_1h_percentage"),
        percent(F.count_if(done & (_took() <= 86400)), F.count("id")).alias("netting_rate_24h_percentage"),
    )


def _invoice_rate(g) -> DataFrame:
    queued = F.col("hub_invoice_enqueued_timestamp") - F.col("origin_timestamp")
    return g.agg(
        percent(F.count_if(_by_mm() & (queued <= 21600)), F.count_if(_by_mm())).alias("settlement_rate_6h_percentage"),
        percent(F.count_if(_by_mm() & (queued <= 86400)), F.count_if(_by_mm())).alias("settlement_rate_24h_percentage"),
    )


def _mm_apy(g) -> DataFrame:
    fee = F.sum(F.abs(F.col("origin_amount") - F.col("hub_invoice_amount")))
    gas = F.sum(lossy_double("origin_gas_limit") * lossy_double("origin_gas_price"))
    volume = F.sum("origin_amount")
    return g.agg(volume.alias("volume_by_market_maker"), (ratio(fee - gas, volume) * 365 * 100).alias("apy"))


def _settlement_time(g) -> DataFrame:
    hours = _took() / 3600.0
    return g.agg(
        F.avg(hours).alias("overall_avg_settlement_time"),
        F.avg(F.when(F.col("origin_ttl") > 0, hours)).alias("mm_avg_settlement_time"),
        F.avg(F.when(F.col("origin_ttl") == 0, hours)).alias("netting_avg_settlement_time"),
    )


def _clearing(g) -> DataFrame:
    amount, ttl = F.col("origin_amount"), F.col("origin_ttl")
    return g.agg(
        F.sum(F.when(ttl == 0, amount).otherwise(0.0)).alias("netted_volume"),
        F.sum(F.when(ttl > 0, amount).otherwise(0.0)).alias("market_maker_volume"),
    )


def _rebalancing(g) -> DataFrame:
    discount = F.abs(F.col("origin_amount") - F.col("settlement_amount"))
    fee = F.abs(F.col("origin_amount") / 100 * FEE_SHARE)
    return g.agg(
        F.sum(discount).alias("discount"), F.sum(fee).alias("protocol_fee"), F.sum(fee + discount).alias("rebalancing_fee")
    )


_IS_SETTLED = "settlement_status = 'SETTLED'"

# metric number -> (table it reads, row filter or None, aggregation of the grouped rows)
LEGACY_METRICS: dict[int, tuple[str, Callable[[], Column] | None, Callable]] = {
    1: ("intents", None, _settled_share),
    3: (
        "invoices", lambda: F.col("hub_status").isin(*SETTLED),
        lambda g: g.agg(F.round(F.avg(F.col("hub_settlement_epoch") - F.col("hub_invoice_entry_epoch")), 0).alias("discount_epoch")),
    ),
    4: ("invoices", _by_mm, lambda g: g.agg(F.sum("origin_amount").alias("volume_by_market_maker"))),
    5: (
        "invoices", _by_mm,
        lambda g: g.agg(F.avg(F.abs(F.col("origin_amount") - F.col("hub_invoice_amount"))).alias("discount_value")),
    ),
    6: ("invoices", _by_mm, _mm_apy),
    7: ("intents", lambda: F.expr(_IS_SETTLED), _clearing),
    8: ("intents", None, _netting_rate),
    9: ("intents", lambda: F.expr(_IS_SETTLED), _rebalancing),
    10: ("invoices", None, _invoice_rate),
    11: (
        "intents", lambda: F.expr(_IS_SETTLED),
        lambda g: g.agg(F.sum(F.col("origin_amount") / 100 * FEE_SHARE).alias("protocol_fee")),
    ),
    12: ("intents", lambda: F.expr(_IS_SETTLED), _settlement_time),
    14: ("intents", lambda: F.expr(_IS_SETTLED), lambda g: g.agg(F.avg("origin_amount").alias("avg_intent_size"))),
    15: ("intents", None, lambda g: g.agg(F.count("id").alias("total_intents"))),
}


def legacy_metric(
    number: int, intents: DataFrame, invoices: DataFrame, grain: str = "day", from_date: str | None = None, to_date: str | None = None,
) -> DataFrame:
    """Metric 1-15 per day, or one row for a date range. Tables as given by ``typed``.

    Metric 13 is ``wallet_retention``; percentages are true, not integer, divisions.
    """
    if number == 2:
        return invoice_1h_rate(intents, grain, from_date, to_date)
    if number == 13:
        return wallet_retention(intents, "origin_initiator", "origin_timestamp")
    table, keep, fn = LEGACY_METRICS[number]
    rows = intents if table == "intents" else invoices
    if keep is not None:
        rows = rows.where(keep())
    return fn(_grouped(rows, grain, from_date, to_date))


def listed_fees_daily(intents: DataFrame, tokens: DataFrame) -> DataFrame:
    """Discount and protocol fee per day, the fee from the token's JSON list of rates."""
    rates = tokens.select(F.col("id").alias("settlement_asset"), F.explode(F.from_json("fee_amounts", "array<string>")).alias("rate"))
    rows = intents.where(_IS_SETTLED).withColumn("day", F.date_trunc("day", F.timestamp_seconds("origin_timestamp")))
    fees = rows.join(rates, "settlement_asset").groupBy("day").agg(
        F.sum(F.col("origin_amount") / 100 * lossy_double("rate")).alias("protocol_fee")
    )
    days = rows.groupBy("day").agg(F.sum(F.col("origin_amount") - F.col("settlement_amount")).alias("discount"))
    return days.join(fees, "day", "left")


# --- messages, revenue and profit ------------------------------------------------------------


def message_costs(messages: DataFrame, intents: DataFrame, invoices: DataFrame) -> DataFrame:
    """Each intent's even share of the gas and quote of its two messages.

    Messages are split into one row per intent and filtered by type before the joins.
    ``intents`` and ``invoices`` are staged.
    """
    count = F.size("intent_ids")
    rows = messages.select(
        "type", "message_status", "origin_domain", "destination_domain", count.alias("intent_count"),
        (lossy_double("gas_price") * lossy_double("gas_limit") / count / 1e18).alias("gas"),
        (lossy_double("quote") / count / 1e18).alias("quote"),
        F.explode("intent_ids").alias("id"),
    )

    def side(kind: str, name: str) -> DataFrame:
        token = F.when(lossy_long("origin_domain") == 56, "BNB").otherwise("ETH")
        return rows.where(F.col("type") == kind).select(
            "id",
            F.col("message_status").alias(f"{name}_message_status"),
            token.alias(f"{name}_gas_token_symbol"),
            F.col("intent_count").alias(f"{name}_message_intent_count"),
            F.col("gas").alias(f"{name}_message_gas_amount_per_intent"),
            F.col("quote").alias(f"{name}_message_quote_per_intent"),
        )

    kept = intents.select(
        "id", "status", "hub_status", "origin_timestamp", "settlement_timestamp", "from_chain_id", "to_chain_id",
        "from_asset_symbol", "to_asset_symbol", F.col("from_asset_amount").alias("origin_amount"),
        F.col("to_asset_amount").alias("settlement_amount"),
    )
    return (
        kept.join(invoices.select("id", "hub_invoice_amount"), "id", "left")
        .join(side("INTENT", "intent"), "id")
        .join(side("SETTLEMENT", "settlement"), "id")
    )


def intent_profit(costs: DataFrame, prices: DataFrame, chains: DataFrame) -> DataFrame:
    """Revenue (1 bp), message costs and profit per intent, at the hour's prices.

    ``prices``: symbol, date, price; rows without any needed price are left out.
    """
    prices = prices.select("symbol", F.date_trunc("hour", "date").alias("date"), "price")
    gas_token = {"WETH": "ETH", "BNB": "BNB"}
    gas = prices.where(F.col("symbol").isin(*gas_token)).withColumn("symbol", mapped("symbol", gas_token))
    rows = price_roles(costs, prices, {"price_for_amounts": ("from_asset_symbol", "origin_timestamp")})
    for name in ("intent", "settlement"):
        rows = price_roles(rows, gas, {f"price_for_{name}_gas": (f"{name}_gas_token_symbol", "origin_timestamp")})
    rows = rows.dropna(subset=["price_for_amounts", "price_for_intent_gas", "price_for_settlement_gas"])
    rows = lookup_roles(rows, chains, "chain_id", "name", {"from_chain_id": "from_chain_name", "to_chain_id": "to_chain_name"})
    price = F.col("price_for_amounts")
    rows = rows.withColumns(
        {
            "origin_amount_usd": price * F.col("origin_amount"),
            "hub_invoice_amount_usd": price * F.col("hub_invoice_amount"),
            "settlement_amount_usd": price * F.col("settlement_amount"),
            **{f"{n}_message_cost_usd": price * F.col(f"{n}_message_quote_per_intent") for n in ("intent", "settlement")},
            **{
                f"{n}_message_gas_amount_usd": F.col(f"price_for_{n}_gas") * F.col(f"{n}_message_gas_amount_per_intent")
                for n in ("intent", "settlement")
            },
        }
    )
    revenue = F.when(F.col("hub_status") == UNSUPPORTED, 0.0).otherwise(F.col("origin_amount_usd") * FEE_SHARE)
    cost = (
        F.col("intent_message_cost_usd") + F.col("settlement_message_cost_usd")
        + F.col("intent_message_gas_amount_usd") + F.col("settlement_message_gas_amount_usd")
    )
    return rows.withColumns({"revenue_usd": revenue, "total_cost_usd": cost}).withColumns(
        {
            "market_maker_discount_usd": F.col("hub_invoice_amount_usd") - F.col("settlement_amount_usd"),
            "total_profit_usd": F.col("revenue_usd") - F.col("total_cost_usd"),
        }
    )


def profit_by_route(profit: DataFrame) -> DataFrame:
    return profit.groupBy("from_chain_name", "to_chain_name", "from_asset_symbol", "to_asset_symbol").agg(
        F.sum("revenue_usd").alias("total_revenue_usd"),
        F.sum("total_cost_usd").alias("total_cost_usd"),
        F.sum("total_profit_usd").alias("total_profit_usd"),
    )


# --- invoices ---------------------------------------------------------------------------------


def invoice_details(intents: DataFrame, invoices: DataFrame) -> DataFrame:
    held = invoices.select(
        "id", "hub_settlement_epoch", "hub_invoice_entry_epoch", "hub_invoice_enqueued_timestamp", "hub_invoice_amount",
        F.col("hub_status").alias("invoice_hub_status"),
    )
    rows = intents.where(F.col("hub_status") != UNSUPPORTED).join(held, "id")
    return rows.select(
        "id", "status", "hub_status", "invoice_hub_status", "origin_initiator", "from_chain_id", "from_asset_symbol",
        "to_chain_id", "to_asset_symbol", "origin_timestamp", "hub_added_timestamp", "hub_settlement_enqueued_timestamp",
        "hub_settlement_epoch", "hub_invoice_entry_epoch", "hub_invoice_enqueued_timestamp",
        F.col("from_asset_amount").alias("origin_amount"), F.col("to_asset_amount").alias("settlement_amount"),
        "hub_invoice_amount", "hub_settlement_amount",
        (F.col("hub_invoice_amount") - F.col("to_asset_amount")).alias("discounts_by_mm"),
    )


def ideal_discounts(details: DataFrame, ids: Sequence[str] | None = None, hub_status: str = "INVOICED") -> DataFrame:
    """Discount of invoices still open (or any given status), optionally of given ids."""
    rows = details.where(F.col("invoice_hub_status") == hub_status)
    return rows if ids is None else rows.where(F.col("id").isin(*ids))


def active_invoices(
    details: DataFrame, live: DataFrame, chains: DataFrame, prices: DataFrame, as_of: str, newer_than: float | None = None,
    older_than: float | None = None,
) -> DataFrame:
    """Invoices on the live list (intent_id, owner, discount_bps, destinations), named and priced.

    ``newer_than`` / ``older_than`` hours filter on the time the hub added the intent.
    """
    listed = live.select(
        F.col("intent_id").alias("id"), "owner", "discount_bps", lossy_long(F.get("destinations", F.lit(0))).alias("to_chain_id")
    )
    rows = details.drop("to_chain_id", "to_asset_symbol").join(listed, "id")
    rows = rows.withColumn("to_asset_symbol", F.col("from_asset_symbol"))
    rows = lookup_roles(rows, chains, "chain_id", "name", {"from_chain_id": "from_chain_name", "to_chain_id": "to_chain_name"})
    rows = lookup_roles(
        rows, prices, "symbol", "price", {"from_asset_symbol": "from_asset_price", "to_asset_symbol": "to_asset_price"}
    )
    added = F.col("hub_added_timestamp")

    def ago(hours: float) -> Column:
        return F.lit(as_of).cast("timestamp") - F.make_dt_interval(secs=F.lit(hours * 3600))

    if newer_than is not None:
        rows = rows.where(added >= ago(newer_than))
    if older_than is not None:
        rows = rows.where(added < ago(older_than))
    return rows


# --- dashboard frames ---------------------------------------------------------------------------

METRIC_KEYS = ["day", "from_chain_id", "from_asset_symbol", "to_chain_id", "to_asset_symbol"]
USD_METRICS = (
    "volume_settled_by_mm", "discounts_by_mm", "avg_discounts_by_mm", "rewards_for_invoices", "avg_rewards_by_invoices",
    "netting_volume", "clearing_volume", "protocol_revenue", "rebalancing_fee", "avg_intent_size",
)


def merged_metrics(*frames: DataFrame) -> DataFrame:
    """Metric tables of one grain joined in full on day and route."""
    out = frames[0]
    for df in frames[1:]:
        out = full_on(out, df.drop(*[c for c in df.columns if c in out.columns and c not in METRIC_KEYS]), METRIC_KEYS)
    return out


def metrics_usd(metrics: DataFrame, chains: DataFrame, daily_prices: DataFrame) -> DataFrame:
    """Chain names, the day's price and USD amounts; clearing volume is netted plus settled."""
    rows = lookup_roles(metrics, chains, "chain_id", "name", {"from_chain_id": "from_chain_name", "to_chain_id": "to_chain_name"})
    rows = price_roles(rows, daily_prices, {"from_asset_price": ("from_asset_symbol", "day")}, unit="day")
    rows = rows.withColumns({f"{c}_usd": F.col(c) * F.col("from_asset_price") for c in USD_METRICS})
    zero = F.lit(0.0)
    cleared = F.coalesce("netting_volume_usd", zero) + F.coalesce("volume_settled_by_mm_usd", zero)
    return rows.withColumn("clearing_volume_usd", cleared).drop(*USD_METRICS)


def trend(df: DataFrame, metric: str, how: str = "sum") -> DataFrame:
    fn = {"sum": F.sum, "avg": F.avg}[how]
    return df.groupBy("day").agg(fn(metric).alias(metric))


def metric_column(okrs: DataFrame, name: str) -> DataFrame:
    return okrs.select("day", name)


def price_view(prices: DataFrame, unit: str, symbols: Sequence[str] | None = None) -> DataFrame:
    """Average price per symbol and hour or day."""
    rows = prices if symbols is None else prices.where(F.col("symbol").isin(*symbols))
    return rows.groupBy("symbol", F.date_trunc(unit, "date").alias("date")).agg(F.avg("average_price").alias("price"))


def chain_names(chains: DataFrame, ids: Sequence[int], extra_name: str) -> DataFrame:
    """Names of the given chains plus the one the registry lacks."""
    rows = chains.where(F.col("chain_id").isin(*ids)).select("chain_id", "name").distinct()
    extra = chains.sparkSession.range(1).select(F.lit(EXTRA_CHAIN_ID).cast("bigint").alias("chain_id"), F.lit(extra_name).alias("name"))
    return rows.unionByName(extra)
