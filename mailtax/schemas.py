"""Logical tables: column types, keys and declared constraints.

Every job takes a mapping ``{table name: DataFrame}`` that follows these schemas. GUIDs are lower-case
strings. Two outputs use a 128-bit string id where a numbered key would be the obvious choice
(``delivery_point_id``, ``category_detail_id``): a 64-bit hash starts to collide at a few billion rows and a
running number cannot be repeated on a rerun.
"""

from __future__ import annotations

from pyspark.sql import types as T

_AUDIT = "user_added string, date_added timestamp_ntz, is_active boolean"

SCHEMAS: dict[str, str] = {
    # invoice side
    "sessions": "session_key bigint, session_id string, client_configuration_key bigint",
    "invoices": (
        "invoice_key bigint, session_key bigint, client_configuration_key bigint, "
        "invoice_billing_date timestamp_ntz, date_added timestamp_ntz, user_added string, "
        "date_edited timestamp_ntz, is_active boolean"
    ),
    "invoice_line_items": (
        "invoice_line_item_key bigint, invoice_key bigint, line_item_key bigint, vendor_item_key bigint, "
        "group_key string, quantity bigint, rate decimal(19,4), extended_amount decimal(19,4)"
    ),
    "line_items": (
        "line_item_key bigint, line_item_name string, line_item_description string, module string, "
        "sales_tax_code_key bigint, tax_category string, use_customer_tax_address boolean, "
        "is_exportable boolean, vendor_item_key bigint"
    ),
    "sales_tax_codes": "sales_tax_code_key bigint, tax_code string",
    "sales_tax_batch_statuses": "status_key bigint, status_id string",
    "vendor_items": "vendor_item_key bigint, vendor_item_name string",
    # clients
    "clients": "client_key bigint",
    "client_configurations": (
        "client_configuration_key bigint, client_configuration_id string, client_key bigint, "
        "client_configuration_name string, account_code string, taxable_city string, taxable_state string, "
        "taxable_postal_code string"
    ),
    "customers": "customer_id bigint, account string",
    "host_client_configs": "client_configuration_id string",
    "file_stream_configs": "client_configuration_id string, file_stream_config_id string",
    "file_streams": "file_stream_config_id string, date_added timestamp_ntz, is_active boolean",
    # activities and rates
    "activities": (
        "invoice_line_item_key bigint, category_key bigint, client_line_item_key bigint, "
        "rate_model_key bigint, rate_key bigint, include_in_sales_tax_batch boolean"
    ),
    "rate_models": "rate_model_key bigint, price decimal(19,4)",
    "rates": "rate_key bigint, rate_type_key int",
    "client_line_items": "client_line_item_key bigint, line_item_key bigint",
    "activity_batches": (
        "activity_batch_key bigint, activity_batch_id string, user_added string, is_native_batch boolean"
    ),
    "activity_categories": (
        "category_key bigint, activity_batch_key bigint, category_type_key bigint, batch_total bigint, "
        "total_suppressed bigint, total_updated bigint, total_returned bigint"
    ),
    "activity_category_types": "category_type_key bigint, category_type_id string, category_type_name string",
    # mail pieces
    "details": (
        "detail_key bigint, detail_id string, category_key bigint, transaction_guid string, "
        "data_stream_detail_id string, return_detail_id string"
    ),
    "host1_pieces": (
        "data_stream_detail_id string, city string, state string, zip string, country string, "
        "is_foreign boolean, is_force_mailed boolean, is_active boolean"
    ),
    "host2_pieces": (
        "data_stream_detail_id string, city string, state string, zip string, page_count int, "
        "paper_page_count int, is_force_mailed boolean, is_foreign boolean"
    ),
    "return_details": "return_detail_id string, return_reason_id string",
    "return_reasons": "return_reason_id string, is_returned boolean, is_updated boolean",
    # transactions
    "transaction_types": "transaction_type_id bigint, transaction_type_guid string",
    "transactions": (
        "transaction_id bigint, transaction_guid string, transaction_type_id bigint, "
        "transaction_status_id int, customer_id bigint, location_id int, customer_lob_id bigint, "
        "upload_id bigint, job_id bigint, material_id bigint, billing_group string, "
        "transaction_date timestamp_ntz, quantity bigint, page_group string, user_added string, "
        "date_added timestamp_ntz, user_edited string, date_edited timestamp_ntz, is_active boolean, "
        "billing_group_id bigint, data_job_id bigint"
    ),
    "delivery_points": (
        "delivery_point_id string, transaction_id bigint, transaction_guid string, city string, "
        "state_region string, postal_code string, country_code string, destination_code string, "
        "quantity bigint, " + _AUDIT
    ),
    "taxable_line_items": (
        "invoice_line_item_key bigint, session_key bigint, transaction_guid string, host_system_id int, "
        "ignore boolean"
    ),
    # outputs
    "sales_tax_batches": (
        "sales_tax_batch_key bigint, sales_tax_batch_id string, session_key bigint, "
        "invoice_line_item_key bigint, status_key bigint, group_key string, line_item_key bigint, "
        "tax_code string, tax_category string, " + _AUDIT
    ),
    "sales_tax_batch_details": (
        "sales_tax_batch_detail_id string, sales_tax_batch_key bigint, session_key bigint, quantity bigint, rate decimal(38,6), "
        "city string, region string, zip string, is_foreign boolean, should_export boolean, " + _AUDIT
    ),
    "category_detail_links": (
        "category_detail_id string, transaction_guid string, session_key bigint, "
        "invoice_line_item_key bigint, line_item_key bigint, module string, host_system_id int, "
        "detail_key bigint"
    ),
    "session_line_links": (
        "session_line_id string, session_key bigint, invoice_line_item_key bigint, line_item_key bigint, "
        "host_system_id int, transaction_guid string"
    ),
    "invoice_warnings": (
        "invoice_warning_id string, session_key bigint, line_item_key bigint, message string, "
        "group_key string, line_header_key bigint, is_resolved boolean, date_resolved timestamp_ntz, "
        "resolution string, user_added string, date_added timestamp_ntz, user_edited string, "
        "date_edited timestamp_ntz, is_active boolean"
    ),
    "run_audit": (
        "run_id string, session_key bigint, session_id string, return_code int, return_message string, "
        "as_of timestamp_ntz, published_at timestamp_ntz"
    ),
    "zero_quantity_warnings": "sales_tax_batch_key bigint, session_key bigint, message string, " + _AUDIT,
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


def columns(table: str) -> list[str]:
    return schema(table).fieldNames()


# Declared constraints of the two link tables: (child table, column, parent table, parent column).
PRIMARY_KEYS = {
    "category_detail_links": "category_detail_id",
    "session_line_links": "session_line_id",
}
FOREIGN_KEYS = [
    ("category_detail_links", "detail_key", "details", "detail_key"),
    ("category_detail_links", "session_key", "sessions", "session_key"),
    ("category_detail_links", "invoice_line_item_key", "invoice_line_items", "invoice_line_item_key"),
    ("category_detail_links", "line_item_key", "line_items", "line_item_key"),
    ("session_line_links", "session_key", "sessions", "session_key"),
    ("session_line_links", "invoice_line_item_key", "invoice_line_items", "invoice_line_item_key"),
    ("session_line_links", "line_item_key", "line_items", "line_item_key"),
]
NOT_NULL = {
    "category_detail_links": [
        "category_detail_id", "transaction_guid", "session_key", "invoice_line_item_key", "line_item_key",
        "host_system_id", "detail_key",
    ],
    "session_line_links": [
        "session_line_id", "session_key", "invoice_line_item_key", "line_item_key", "host_system_id",
    ],
}
DEFAULTS = {
    "category_detail_links": {"host_system_id": 0},
    "session_line_links": {"host_system_id": 0},
}
