"""Output schema of each query: column and type, in order (decimals as double, ``ts``: a timestamp without zone)."""

_COLUMNS = {
    "a5_multi_count_distinct": "order_id string, items bigint, distinct_products bigint, distinct_sellers bigint",
    "d1_unique": "test_name string, value string, n_records bigint",
    "d2_not_null": "test_name string, null_rows bigint",
    "d3_accepted_values": "test_name string, value string, n_records bigint",
    "d4_relationships": "test_name string, value string, n_records bigint",
    "d5_unique_combination": "test_name string, value string, n_records bigint",
    "d6_quality_suite": "test_name string, model string, kind string, column_name string, failures bigint, status string",
    "f1_high_water_strict":
        "order_id string, order_item_id string, product_id string, seller_id string, price string, freight_value string, _loaded_at ts, "
        "shipping_limit_date string, _source_file string, _source_system string, _load_date date, _batch_id string",
    "f2_high_water_floor":
        "order_key bigint, part_key bigint, supplier_key bigint, line_number int, quantity double, extended_price double, discount double, "
        "tax double, return_flag string, line_status string, ship_date date, commit_date date, receipt_date date, ship_instructions string, "
        "ship_mode string, _loaded_at ts",
    "f3_lookback_window":
        "order_key bigint, customer_key bigint, order_status string, total_price double, order_date date, order_priority string, clerk "
        "string, ship_priority int, _loaded_at ts",
    "h5_scd2_hard_deletes":
        "customer_key bigint, customer_name string, customer_address string, nation_key int, customer_phone string, account_balance double, "
        "market_segment string, _loaded_at ts, scd_id string, updated_at ts, valid_from ts, valid_to ts",
    "j1_anti_join":
        "order_key bigint, customer_key bigint, order_status string, total_price double, order_date date, order_priority string, clerk "
        "string, ship_priority int, _loaded_at ts",
    "j2_anti_join_composite":
        "order_key bigint, line_number int, part_key bigint, supplier_key bigint, quantity double, extended_price double, discount double, "
        "tax double, return_flag string, line_status string, ship_date date, commit_date date, receipt_date date, ship_instructions string, "
        "ship_mode string, _loaded_at ts",
    "l10_durations": "event_id bigint, dag_id string, model_name string, duration_seconds double",
    "l1_run_rollup": "run_id bigint, layer string, models_total bigint, models_success bigint, models_error bigint, models_skipped bigint, status string",
    "l2_flatten_results":
        "result_id bigint, run_id bigint, layer string, model_name string, resource_type string, status string, execution_time_seconds "
        "double, rows_affected bigint, error_message string",
    "l3_infer_layer": "event_id bigint, model_name string, layer string",
    "l4_base_model_name": "event_id bigint, task_id string, model_name string",
    "l5_last_attempt_state": "layer string, last_run_id bigint, state string, next_action string",
    "l6_rows_written": "event_id bigint, model_name string, rows_affected bigint",
    "l7_cycle_state": "dag_id string, model_name string, layer string, status string, updated_at ts",
    "l8_pending": "dag_id string, task_id string",
    "l9_clear_dag": "dag_id string, model_name string, layer string, status string, updated_at ts",
    "m01_stg_customers":
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string, "
        "customer_region string, _source_file string, _source_system string, _loaded_at ts, _load_date date, _batch_id string",
    "m02_stg_order_items":
        "order_id string, order_item_id double, product_id string, seller_id string, shipping_limit_date ts, price double, freight_value "
        "double, total_item_value double, _source_file string, _source_system string, _loaded_at ts, _load_date date, _batch_id string",
    "m03_stg_orders":
        "order_id string, customer_id string, order_status string, order_purchase_timestamp ts, order_approved_at ts, "
        "order_delivered_carrier_date ts, order_delivered_customer_date ts, order_estimated_delivery_date ts, actual_delivery_days int, "
        "estimated_delivery_days int, is_late_delivery boolean, _source_file string, _source_system string, _loaded_at ts, _load_date date, "
        "_batch_id string",
    "m04_stg_payments":
        "order_id string, payment_sequential double, payment_type string, payment_installments double, payment_value double, is_credit_card "
        "boolean, is_installment boolean, _source_file string, _source_system string, _loaded_at ts, _load_date date, _batch_id string",
    "m05_stg_products":
        "product_id string, product_category_name string, product_name_length double, product_description_length double, product_photos_qty "
        "double, product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double, weight_class string, "
        "_source_file string, _source_system string, _loaded_at ts, _load_date date, _batch_id string",
    "m06_dim_customer":
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string, "
        "customer_region string, _loaded_at ts",
    "m07_dim_product":
        "product_id string, product_category_name string, product_photos_qty double, product_weight_g double, product_length_cm double, "
        "product_height_cm double, product_width_cm double, weight_class string, _loaded_at ts",
    "m08_dim_date":
        "date_id date, year int, month_num int, month_name string, quarter int, week_num int, day_of_week int, day_name string, is_weekend "
        "boolean, first_day_of_month date, first_day_of_quarter date",
    "m09_fct_orders":
        "order_id string, customer_id string, order_status string, order_purchase_timestamp ts, order_approved_at ts, "
        "order_delivered_carrier_date ts, order_delivered_customer_date ts, order_estimated_delivery_date ts, actual_delivery_days int, "
        "estimated_delivery_days int, is_late_delivery boolean, item_count bigint, total_items_price double, total_freight_value double, "
        "total_order_value double, distinct_products bigint, distinct_sellers bigint, total_payment_value double, max_installments double, "
        "payment_type_count bigint, has_credit_card int, order_date date, order_month ts, order_year int, order_month_num int, _loaded_at "
        "ts",
    "m10_mart_revenue_kpis":
        "order_year int, order_month_num int, month_name string, customer_state string, customer_region string, product_category_name "
        "string, total_orders bigint, unique_customers bigint, total_revenue double, avg_order_value double, total_freight double, "
        "freight_pct_of_revenue double, avg_delivery_days double, late_deliveries bigint, late_delivery_pct double",
    "m11_bronze_customer":
        "customer_key bigint, customer_name string, customer_address string, nation_key int, customer_phone string, account_balance double, "
        "market_segment string, customer_comment string, _loaded_at ts",
    "m12_bronze_lineitem":
        "order_key bigint, part_key bigint, supplier_key bigint, line_number int, quantity double, extended_price double, discount double, "
        "tax double, return_flag string, line_status string, ship_date date, commit_date date, receipt_date date, ship_instructions string, "
        "ship_mode string, _loaded_at ts",
    "m13_bronze_nation": "nation_key int, nation_name string, region_key int, _loaded_at ts",
    "m14_bronze_orders":
        "order_key bigint, customer_key bigint, order_status string, total_price double, order_date date, order_priority string, clerk "
        "string, ship_priority int, _loaded_at ts",
    "m15_bronze_part":
        "part_key bigint, part_name string, manufacturer string, brand string, part_type string, part_size int, container string, "
        "retail_price double, _loaded_at ts",
    "m16_bronze_partsupp": "part_key bigint, supplier_key bigint, available_qty int, supply_cost double, _loaded_at ts",
    "m17_bronze_region": "region_key int, region_name string, _loaded_at ts",
    "m18_bronze_supplier":
        "supplier_key bigint, supplier_name string, supplier_address string, nation_key int, supplier_phone string, account_balance double, "
        "_loaded_at ts",
    "m19_silver_customer":
        "customer_key bigint, customer_name string, customer_address string, nation_key int, customer_phone string, account_balance double, "
        "market_segment string, _loaded_at ts",
    "m20_silver_lineitem":
        "order_key bigint, line_number int, part_key bigint, supplier_key bigint, quantity double, extended_price double, discount double, "
        "tax double, return_flag string, line_status string, ship_date date, commit_date date, receipt_date date, ship_instructions string, "
        "ship_mode string, net_revenue double, gross_revenue double, days_late int, _loaded_at ts",
    "m21_silver_nation_region": "nation_key int, nation_name string, region_key int, region_name string, _loaded_at ts",
    "m22_silver_orders":
        "order_key bigint, customer_key bigint, order_status string, total_price double, order_date date, order_priority string, clerk "
        "string, ship_priority int, order_year int, order_month int, _loaded_at ts",
    "m23_silver_part":
        "part_key bigint, part_name string, manufacturer string, brand string, part_type string, part_size int, container string, "
        "retail_price double, _loaded_at ts",
    "m24_silver_partsupp": "part_key bigint, supplier_key bigint, available_qty int, supply_cost double, _loaded_at ts",
    "m25_silver_supplier":
        "supplier_key bigint, supplier_name string, supplier_address string, nation_key int, supplier_phone string, account_balance double, "
        "_loaded_at ts",
    "m26_snapshot_customer":
        "customer_key bigint, customer_name string, customer_address string, nation_key int, customer_phone string, account_balance double, "
        "market_segment string, _loaded_at ts, scd_id string, updated_at ts, valid_from ts, valid_to ts",
    "m27_snapshot_supplier":
        "supplier_key bigint, supplier_name string, supplier_address string, nation_key int, supplier_phone string, account_balance double, "
        "_loaded_at ts, scd_id string, updated_at ts, valid_from ts, valid_to ts",
    "m28_snapshot_orders":
        "order_id string, customer_id string, order_status string, order_purchase_timestamp ts, order_approved_at ts, "
        "order_delivered_carrier_date ts, order_delivered_customer_date ts, order_estimated_delivery_date ts, actual_delivery_days int, "
        "is_late_delivery boolean, total_payment_value double, total_order_value double, order_date date, order_year int, order_month_num "
        "int, _loaded_at ts, scd_id string, updated_at ts, valid_from ts, valid_to ts",
    "m29_dim_customer":
        "customer_sk string, customer_key bigint, customer_name string, customer_address string, customer_phone string, account_balance "
        "double, market_segment string, nation_name string, region_name string, effective_from ts, effective_to ts, is_current boolean",
    "m30_dim_supplier":
        "supplier_sk string, supplier_key bigint, supplier_name string, supplier_address string, supplier_phone string, account_balance "
        "double, nation_name string, region_name string, effective_from ts, effective_to ts, is_current boolean",
    "m31_dim_part":
        "part_key bigint, part_name string, manufacturer string, brand string, part_type string, part_size int, container string, "
        "retail_price double, avg_supply_cost double, total_available_qty bigint",
    "m32_dim_date": "date_key date, year int, quarter int, month int, month_name string, day int, day_name string, week_of_year int",
    "m33_fact_lineitem":
        "order_key bigint, line_number int, part_key bigint, supplier_key bigint, customer_key bigint, ship_date date, commit_date date, "
        "receipt_date date, order_date date, quantity double, extended_price double, discount double, tax double, net_revenue double, "
        "gross_revenue double, return_flag string, line_status string, ship_mode string, days_late int, order_status string, order_priority "
        "string, _loaded_at ts",
    "m34_fact_orders":
        "order_key bigint, customer_key bigint, order_date date, order_status string, order_priority string, line_item_count bigint, "
        "total_quantity double, total_net_revenue double, total_gross_revenue double, avg_discount double, last_receipt_date date",
    "m35_mart_sales_summary":
        "year int, quarter int, region_name string, nation_name string, market_segment string, order_count bigint, total_quantity double, "
        "net_revenue double, gross_revenue double, tax_collected double",
    "m36_mart_supplier_performance":
        "supplier_key bigint, supplier_name string, nation_name string, region_name string, lines_shipped bigint, net_revenue double, "
        "avg_days_late double, late_shipment_count bigint, late_shipment_pct double",
    "m37_mart_customer_segment":
        "market_segment string, region_name string, nation_name string, order_count bigint, net_revenue double, avg_order_value double, "
        "first_order_date date, last_order_date date",
    "s6_merge_single_key":
        "customer_key bigint, customer_name string, customer_address string, nation_key int, customer_phone string, account_balance double, "
        "market_segment string, _loaded_at ts",
    "s7_merge_composite_key":
        "order_key bigint, line_number int, part_key bigint, supplier_key bigint, quantity double, extended_price double, discount double, "
        "tax double, return_flag string, line_status string, ship_date date, commit_date date, receipt_date date, ship_instructions string, "
        "ship_mode string, _loaded_at ts",
    "s8_schema_sync":
        "part_key bigint, part_name string, manufacturer string, brand string, part_type string, part_size int, retail_price double, "
        "_loaded_at ts, size_band string",
    "s9_clustered_layout": "table_name string, ship_month string, rows bigint, mixed_files bigint",
    "w1_dedup_latest":
        "customer_key bigint, customer_name string, customer_address string, nation_key int, customer_phone string, account_balance double, "
        "market_segment string, _loaded_at ts",
    "w2_dedup_composite":
        "order_key bigint, part_key bigint, supplier_key bigint, line_number int, quantity double, extended_price double, discount double, "
        "tax double, return_flag string, line_status string, ship_date date, commit_date date, receipt_date date, ship_instructions string, "
        "ship_mode string, _loaded_at ts",
    "x10_boolean_flags": "order_id string, payment_sequential string, is_credit_card boolean, is_installment boolean",
    "x13_round_money": "order_key bigint, line_number int, part_key bigint, supplier_key bigint, _loaded_at ts, net_revenue double, gross_revenue double",
    "x16_x17_date_parts":
        "order_id string, order_date date, order_month ts, first_day_of_quarter date, order_year int, order_month_num int, day_of_week int, "
        "week_num int",
    "x18_x19_calendar_names": "order_key bigint, year int, quarter int, month int, month_name string, day int, day_name string, week_of_year int",
    "x1_trim_upper_lower": "order_id string, trimmed string, upper_status string, lower_status string",
    "x20_date_add": "order_key bigint, plus_3 date, minus_3 date",
    "x22_surrogate_key": "customer_key bigint, customer_sk string, key_nation_sk string",
    "x24_predicates":
        "order_key bigint, line_number int, part_key bigint, supplier_key bigint, _loaded_at ts, discount_ok boolean, flag_ok boolean, "
        "shipped boolean, receipt_ok boolean, not_air boolean",
    "x3_initcap": "customer_id string, customer_city string",
    "x4_try_number": "product_id string, product_weight_g double, product_name_lenght double, product_photos_qty double, product_length_cm double",
    "x5_try_decimal":
        "order_id string, order_item_id string, product_id string, seller_id string, _loaded_at ts, price double, freight_value double, "
        "total_item_value double",
    "x7_day_diff": "order_id string, purchased ts, delivered ts, actual_delivery_days int, estimated_delivery_days int, is_late_delivery boolean",
    "x8_simple_case": "customer_id string, customer_state string, customer_region string",
    "x9_searched_case": "product_id string, product_weight_g double, weight_class string",
    "h_scd2_new_column":
        "customer_key bigint, customer_name string, customer_address string, nation_key int, customer_phone string, account_balance double, "
        "_loaded_at ts, tier string, market_segment string, scd_id string, updated_at ts, valid_from ts, valid_to ts",
}
_COLUMNS["s4_view_sink"] = _COLUMNS["m19_silver_customer"]
SPECS = {query: [tuple(c.split(" ")) for c in columns.split(", ")] for query, columns in _COLUMNS.items()}
