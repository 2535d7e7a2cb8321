"""The 27 source tables: key, load strategy, watermark and columns.

Columns are text in the raw layer; staging gives them their types.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

EXTRACTED_AT = "_sdc_extracted_at"
BATCHED_AT = "_sdc_batched_at"
DELETED_AT = "_sdc_deleted_at"
METADATA_COLUMNS = (EXTRACTED_AT, BATCHED_AT, DELETED_AT)


@dataclass(frozen=True)
class RawTable:
    name: str
    key: str
    columns: tuple[str, ...]
    watermark: str | None = None

    @property
    def schema_name(self) -> str:
        return self.name.split(".")[0]

    @property
    def table_name(self) -> str:
        return self.name.split(".")[1]

    @property
    def incremental(self) -> bool:
        return self.watermark is not None

    def struct(self, with_metadata: bool = True) -> T.StructType:
        names = self.columns + (METADATA_COLUMNS if with_metadata else ())
        return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Schema.table | key | watermark (incremental tables only) | columns
_DEFINITIONS = """
raw_hr.locations | location_id | | location_id name address city state zip phone opened_date location_type store_sqft num_aisles is_active
raw_hr.employees | employee_id | | employee_id location_id first_name last_name email hire_date termination_date department job_title hourly_rate status
raw_hr.schedules | schedule_id | | schedule_id location_id employee_id scheduled_date department shift_start shift_end status created_at
raw_pos.departments | department_id | | department_id name code is_active
raw_pos.products | product_id | | product_id sku upc name brand department category subcategory unit_size unit_of_measure cost current_price is_organic is_local is_active
raw_pos.price_history | price_history_id | | price_history_id product_name old_price new_price changed_at
raw_pos.coupons | coupon_id | | coupon_id code description coupon_type discount_value min_purchase department max_uses uses_count valid_from valid_until is_active
raw_pos.combo_deals | deal_id | | deal_id name description deal_type trigger_qty trigger_department deal_price valid_from valid_until
raw_pos.loyalty_members | member_id | | member_id first_name last_name email signup_date points_balance tier
raw_pos.loyalty_point_transactions | pt_id | created_at | pt_id member_id transaction_id points_earned points_redeemed reason balance_after created_at
raw_pos.transactions | transaction_id | transaction_dt | transaction_id location_id employee_id member_id transaction_dt subtotal coupon_savings deal_savings tax total payment_method scenario_tag
raw_pos.transaction_items | item_id | transaction_dt | item_id transaction_id product_id product_name category location_id quantity unit_price discount line_total transaction_dt
raw_timeclock.events | event_id | event_dt | event_id employee_id location_id event_type event_dt notes
raw_ordering.store_orders | order_id | | order_id store_location_id warehouse_location_id created_by order_dt requested_delivery_dt approved_by approved_dt status notes
raw_ordering.store_order_items | item_id | | item_id order_id product_id quantity_requested quantity_approved
raw_fulfillment.orders | fulfillment_id | | fulfillment_id store_order_id warehouse_location_id assigned_to assigned_to_name status started_at completed_at created_at
raw_fulfillment.items | item_id | | item_id fulfillment_id product_id quantity_requested quantity_picked pick_status
raw_transport.trucks | truck_id | | truck_id license_plate make model year capacity_pallets is_active
raw_transport.loads | load_id | | load_id truck_id driver_id warehouse_location_id destination_location_id departed_at arrived_at status license_plate driver from_warehouse to_store
raw_transport.load_items | item_id | | item_id load_id fulfillment_id store_order_id
raw_inv.products | inv_product_id | | inv_product_id product_id reorder_point reorder_qty unit_of_measure supplier_name lead_time_days
raw_inv.stock_levels | stock_id | | stock_id product_id product_name category location_id quantity_on_hand quantity_reserved reorder_point reorder_qty last_updated
raw_inv.receipts | receipt_id | received_dt | receipt_id location_id received_dt supplier_name po_number total_cost line_items
raw_inv.receipt_items | receipt_item_id | received_dt | receipt_item_id receipt_id product_id product_name category quantity unit_cost line_total received_dt
raw_inv.shrinkage_events | shrinkage_id | recorded_at | shrinkage_id product_id location_id recorded_at reason quantity estimated_cost
raw_pricing.weekly_ads | ad_id | | ad_id ad_name start_date end_date created_at
raw_pricing.ad_items | ad_item_id | | ad_item_id ad_id product_id promoted_price discount_pct created_at
"""


def _parse(line: str) -> RawTable:
    name, key, watermark, columns = (part.strip() for part in line.split("|"))
    return RawTable(name, key, tuple(columns.split()), watermark or None)


RAW_TABLES: dict[str, RawTable] = {
    table.name: table for table in map(_parse, _DEFINITIONS.strip().splitlines())
}
