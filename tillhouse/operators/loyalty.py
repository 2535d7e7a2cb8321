"""Loyalty programme marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import divide, percent, rounded
from tillhouse.operators.ranking import in_tile, tile_ends
from tillhouse.plans.registry import Params, model

CENTS = "decimal(18,2)"


@model("M-25", "stg_pos_loyalty_members", "stg_pos_loyalty_point_transactions", "stg_pos_transactions")
def mart_loyalty_cohort(p: Params, members: DataFrame, points: DataFrame, transactions: DataFrame) -> DataFrame:
    """Members with spend and points, and their tier's averages.

    Receipts and point events meet on the member alone, so each total is multiplied by the number
    of rows on the other side. That factor is applied to per-member sums; no pairs are built.
    """
    spend = (
        transactions.filter("member_id IS NOT NULL")
        .groupBy(F.col("member_id").alias("_t_member"))
        .agg(
            F.count("*").alias("t_rows"),
            F.count("transaction_id").alias("t_count"),
            F.sum("total").alias("t_total"),
            F.count("total").alias("t_priced"),
            F.min("transaction_date").alias("first_purchase_date"),
            F.max("transaction_date").alias("last_purchase_date"),
        )
    )
    earned = points.groupBy(F.col("member_id").alias("_p_member")).agg(
        F.count("*").alias("p_rows"),
        F.sum("points_earned").alias("p_earned"),
        F.count_if("tier_changed").alias("p_upgrades"),
    )
    t_weight, p_weight = F.greatest("p_rows", F.lit(1)), F.greatest("t_rows", F.lit(1))
    stats = (
        members.join(spend, F.col("member_id") == F.col("_t_member"), "left")
        .join(earned, F.col("member_id") == F.col("_p_member"), "left")
        .select(
            "member_id",
            "first_name",
            "last_name",
            "email",
            F.col("tier").alias("loyalty_tier"),
            "points_balance",
            "signup_date",
            F.coalesce("t_count", F.lit(0)).alias("total_transactions"),
            (F.col("t_total") * t_weight).cast(CENTS).alias("total_spend"),
            rounded(divide("t_total", "t_priced"), 2).cast(CENTS).alias("avg_transaction_value"),
            "first_purchase_date",
            "last_purchase_date",
            (F.col("p_earned") * p_weight).alias("lifetime_points_earned"),
            F.coalesce(F.col("p_upgrades") * p_weight, F.lit(0)).alias("tier_upgrades"),
        )
    )
    tiers = stats.groupBy(F.col("loyalty_tier").alias("_tier")).agg(
        F.count("*").alias("tier_total_members"),
        rounded(divide(F.sum("total_spend"), F.count("total_spend")), 2).cast(CENTS).alias("tier_avg_spend"),
    )
    return stats.join(tiers, F.col("loyalty_tier") == F.col("_tier"), "left").drop("_tier")


def _snapshot_date(events: DataFrame):
    return events.agg(F.max("activity_date")).scalar()


@model("M-26", "stg_pos_loyalty_members", "int_loyalty_enriched")
def mart_loyalty_engagement(p: Params, members: DataFrame, events: DataFrame) -> DataFrame:
    """One row per tier and an 'ALL' row, both from a single rollup over members.

    A seed row that counts for nothing keeps the 'ALL' row in a programme without members.
    """
    activity = events.groupBy(F.col("member_id").alias("_member")).agg(
        F.max("activity_date").alias("last_activity_date"),
        F.sum("points_earned").alias("earned"),
        F.sum("points_redeemed").alias("redeemed"),
        F.count_if("tier_changed").alias("upgrades"),
    )
    balance = F.col("points_balance")
    recent = F.col("last_activity_date") >= F.date_sub(_snapshot_date(events), p.active_days)
    seed = members.sparkSession.range(1).select(F.lit(0).alias("member"))
    rolled = (
        members.select(F.lit(1).alias("member"), "member_id", "tier", "points_balance")
        .unionByName(seed, allowMissingColumns=True)
        .join(activity, F.col("member_id") == F.col("_member"), "left")
        .rollup("tier")
        .agg(
            F.grouping_id().alias("level"),
            F.sum("member").alias("members"),
            F.count_if(recent).alias("active"),
            F.sum("earned").alias("earned"),
            F.sum("redeemed").alias("redeemed"),
            F.sum("upgrades").alias("upgrades"),
            F.sum("points_balance").alias("balance"),
            F.sum(F.when(balance > 0, balance)).alias("liability"),
        )
        .filter("level = 1 OR members > 0")
    )
    whole = F.col("level") == 1
    redeemed = F.coalesce("redeemed", F.lit(0))
    return rolled.select(
        F.when(whole, "ALL").otherwise(F.col("tier")).alias("current_tier"),
        F.when(~whole, F.col("members")).alias("member_count"),
        F.when(whole, percent("active", "members", 1)).alias("active_rate_pct"),
        F.when(whole, percent(redeemed, "earned", 1)).alias("redemption_rate_pct"),
        F.when(whole, F.coalesce("liability", F.lit(0))).otherwise(F.col("balance")).alias("points_liability"),
        F.when(whole, F.coalesce("upgrades", F.lit(0))).alias("tier_upgrades"),
        F.when(whole, F.col("members")).alias("total_members"),
    )


@model("M-27", "stg_pos_loyalty_members", "int_loyalty_enriched", "stg_pos_transactions")
def mart_loyalty_rfm(p: Params, members: DataFrame, events: DataFrame, transactions: DataFrame) -> DataFrame:
    """Recency bands, frequency and monetary quintiles, segment. Quintile ties are broken by member id."""
    activity = (
        events.groupBy(F.col("member_id").alias("_a_member"), "activity_date")
        .agg(F.sum("points_earned").alias("earned"), F.sum("points_redeemed").alias("redeemed"))
        .groupBy("_a_member")
        .agg(
            F.max("activity_date").alias("last_activity_date"),
            F.count("activity_date").alias("_days"),
            F.sum("earned").alias("_earned"),
            F.sum("redeemed").alias("_redeemed"),
        )
    )
    spend = (
        transactions.filter("member_id IS NOT NULL")
        .groupBy(F.col("member_id").alias("_t_member"))
        .agg(F.count("transaction_id").alias("_frequency"), F.sum("total").alias("_monetary"))
    )
    zero = F.lit(0)
    idle = F.datediff("snapshot_date", "last_activity_date")
    recency = (
        F.when(idle <= 30, 5).when(idle <= 90, 4).when(idle <= 180, 3).when(idle <= 365, 2).otherwise(1)
    )
    base = (
        members.select("member_id", "tier", "points_balance", "signup_date")
        .join(activity, F.col("member_id") == F.col("_a_member"), "left")
        .join(spend, F.col("member_id") == F.col("_t_member"), "left")
        .withColumn("snapshot_date", _snapshot_date(events))
        .select(
            "member_id",
            "tier",
            "points_balance",
            "signup_date",
            "last_activity_date",
            "snapshot_date",
            idle.alias("recency_days"),
            F.coalesce("_days", zero).alias("active_days"),
            F.coalesce("_frequency", zero).alias("frequency"),
            F.coalesce("_monetary", zero).cast(CENTS).alias("monetary"),
            F.coalesce("_earned", zero).alias("lifetime_points_earned"),
            F.coalesce("_redeemed", zero).alias("lifetime_points_redeemed"),
            recency.alias("recency_score"),
            F.coalesce("_monetary", zero).cast("decimal(28,4)").alias("_spend"),
        )
    )
    frequency = tile_ends(base, 5, "frequency", "member_id").scalar()
    monetary = tile_ends(base, 5, "_spend", "member_id").scalar()
    scored = in_tile(base, frequency, "frequency", "member_id", "frequency_score")
    scored = in_tile(scored, monetary, "_spend", "member_id", "monetary_score").drop("_spend")
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 4) & (f >= 3), "Loyal")
        .when((r >= 3) & (f <= 2), "At Risk")
        .when(r <= 2, "Hibernating")
        .when((f == 1) & (r >= 4), "New")
        .otherwise("Regular")
    )
    return scored.withColumn("rfm_segment", segment)
