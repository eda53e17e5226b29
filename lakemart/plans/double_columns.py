"""Result columns of each query's SQL that are DECIMAL (written by tools/double_columns.py)."""

DOUBLE_COLUMNS: dict[str, list[str]] = {
    "above_average_parts": ["price"],
    "assign_keys": ["price"],
    "big_spenders": ["total_revenue"],
    "bronze_csv_roundtrip": ["order_total"],
    "category_mom_delta": ["total_sales", "prev_sales", "sales_delta"],
    "category_running": ["total_sales", "running_sales"],
    "completeness": ["completeness_pct"],
    "conform_orders": ["order_total"],
    "conversation_roles": ["pct"],
    "conversion_rate": ["conversion_rate_pct"],
    "corpus_text_lengths": ["avg_len"],
    "customer_spend": ["total_spend"],
    "delivery_performance": ["avg_days_vs_estimate", "on_time_pct"],
    "domain_check": ["pct"],
    "duplication_rate": ["duplicate_pct"],
    "duplication_rate_by_lang": ["duplicate_pct"],
    "duplication_rate_events": ["duplicate_pct"],
    "duration_hours": ["min_hours", "max_hours", "avg_hours"],
    "duration_stats": ["avg_days"],
    "fill_defaults": ["revenue"],
    "filtered_products": ["price"],
    "high_value_deals": ["total_value"],
    "kpi_snapshot": ["pct_delivered", "aov"],
    "latest_line_per_key": ["price"],
    "lead_metrics": ["avg_deal_value", "conversion_rate_pct"],
    "line_rolling_sum": ["revenue_500"],
    "line_running_total": ["running_revenue"],
    "load_fact": ["total_amount"],
    "monthly_by_country": ["total_sales"],
    "monthly_sales_by_category": ["total_sales"],
    "null_report": ["null_pct"],
    "on_time_report": ["pct"],
    "order_details": ["unit_price", "total_item_price", "payment_amount"],
    "order_item_context": ["price", "freight"],
    "order_lines": ["unit_price", "line_total"],
    "order_revenue": ["revenue"],
    "order_totals": ["order_total"],
    "payment_bucket": ["payment_value"],
    "payment_mix": ["total_value"],
    "per_key_cardinality": ["avg_per_key"],
    "price_band": ["price"],
    "repeat_rate": ["repeat_rate"],
    "revenue_by_category": ["revenue"],
    "revenue_by_month": ["revenue"],
    "revenue_by_state": ["revenue"],
    "revenue_by_state_items": ["revenue"],
    "revenue_mom_delta": ["revenue", "prev_revenue", "revenue_delta"],
    "revenue_rolling_3mo": ["revenue", "rolling_3mo"],
    "revenue_rolling_calendar": ["revenue", "rolling_3mo"],
    "revenue_running": ["revenue", "running_revenue"],
    "revenue_ytd": ["revenue", "ytd_revenue"],
    "sales_by_category_star": ["total_sales"],
    "spend_rank": ["total_spend"],
    "spend_row_number": ["total_spend"],
    "stage_events": ["passengers"],
    "status_share": ["pct"],
    "string_lengths": ["avg_len"],
    "top_customers": ["total_spend"],
    "top_customers_star": ["total_sales"],
    "top_items_by_price": ["price", "freight"],
    "top_products_by_revenue": ["revenue"],
    "top_stations": ["total_passengers", "avg_passengers_per_event"],
    "total_consistency": ["max_abs_diff"],
    "volume_vs_expected": ["expected", "deviation_pct"],
    "within_days": ["passengers"],
}
