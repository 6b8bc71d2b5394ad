"""Table schemas, enumerations, ledger texts and integrity rules."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DECIMAL(3,2)": T.DecimalType(3, 2),
    "DECIMAL(10,2)": T.DecimalType(10, 2),
}


def _schema(*fields: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Column names and types of the data model.
SCHEMAS: dict[str, T.StructType] = {
    "categories": _schema(
        ("category_id", "BIGINT"), ("category_name", "STRING"), ("description", "STRING")
    ),
    "suppliers": _schema(
        ("supplier_id", "BIGINT"), ("supplier_name", "STRING"), ("contact_name", "STRING"),
        ("email", "STRING"), ("phone", "STRING"), ("address", "STRING"),
        ("performance_rating", "DECIMAL(3,2)"),
    ),
    "products": _schema(
        ("product_id", "BIGINT"), ("sku", "STRING"), ("product_name", "STRING"),
        ("category_id", "BIGINT"), ("supplier_id", "BIGINT"), ("cost_price", "DECIMAL(10,2)"),
        ("sale_price", "DECIMAL(10,2)"), ("reorder_level", "INT"), ("created_at", "TIMESTAMP_NTZ"),
    ),
    "customers": _schema(
        ("customer_id", "BIGINT"), ("first_name", "STRING"), ("last_name", "STRING"),
        ("email", "STRING"), ("phone", "STRING"), ("address", "STRING"),
        ("membership_tier", "STRING"), ("created_at", "TIMESTAMP_NTZ"),
    ),
    "employees": _schema(
        ("employee_id", "BIGINT"), ("first_name", "STRING"), ("last_name", "STRING"),
        ("email", "STRING"), ("role", "STRING"), ("status", "STRING"), ("hire_date", "DATE"),
    ),
    "warehouse_locations": _schema(
        ("location_id", "BIGINT"), ("zone", "STRING"), ("aisle", "INT"), ("shelf", "INT"),
        ("bin", "INT"), ("max_capacity", "BIGINT"), ("current_capacity", "BIGINT"),
    ),
    "inventory": _schema(
        ("inventory_id", "BIGINT"), ("product_id", "BIGINT"), ("location_id", "BIGINT"),
        ("quantity_on_hand", "BIGINT"), ("quantity_reserved", "BIGINT"),
        ("quantity_allocated", "BIGINT"), ("last_updated", "TIMESTAMP_NTZ"),
    ),
    "orders": _schema(
        ("order_id", "BIGINT"), ("customer_id", "BIGINT"), ("status", "STRING"),
        ("order_date", "TIMESTAMP_NTZ"), ("total_amount", "DECIMAL(10,2)"),
        ("picking_employee_id", "BIGINT"), ("packing_employee_id", "BIGINT"),
        ("updated_at", "TIMESTAMP_NTZ"),
    ),
    "order_items": _schema(
        ("order_item_id", "BIGINT"), ("order_id", "BIGINT"), ("product_id", "BIGINT"),
        ("quantity", "BIGINT"), ("unit_price", "DECIMAL(10,2)"), ("item_status", "STRING"),
    ),
    "shipments": _schema(
        ("shipment_id", "BIGINT"), ("order_id", "BIGINT"), ("tracking_number", "STRING"),
        ("carrier", "STRING"), ("shipping_cost", "DECIMAL(10,2)"),
        ("ship_date", "TIMESTAMP_NTZ"), ("delivery_date", "TIMESTAMP_NTZ"), ("status", "STRING"),
    ),
    "returns": _schema(
        ("return_id", "BIGINT"), ("order_id", "BIGINT"), ("product_id", "BIGINT"), ("quantity", "BIGINT"),
        ("return_reason", "STRING"), ("return_date", "TIMESTAMP_NTZ"),
        ("refund_amount", "DECIMAL(10,2)"), ("status", "STRING"),
    ),
    "transactions": _schema(
        ("transaction_id", "BIGINT"), ("transaction_type", "STRING"), ("product_id", "BIGINT"),
        ("location_id", "BIGINT"), ("quantity", "BIGINT"), ("employee_id", "BIGINT"),
        ("reference_id", "STRING"), ("transaction_date", "TIMESTAMP_NTZ"), ("notes", "STRING"),
    ),
}

# Enumerations in declaration order, which is also their sort order.
ENUMS: dict[tuple[str, str], list[str]] = {
    ("customers", "membership_tier"): ["Standard", "Silver", "Gold", "Platinum"],
    ("employees", "role"): ["Receiver", "Inspector", "Picker", "Packer", "Manager"],
    ("employees", "status"): ["Active", "Inactive"],
    ("orders", "status"): [
        "Pending", "Picking", "Packed", "Shipped", "Delivered", "Cancelled", "Returned",
    ],
    ("order_items", "item_status"): [
        "Pending", "Reserved", "Picked", "Packed", "Shipped", "Cancelled",
    ],
    ("shipments", "status"): ["In Transit", "Delivered", "Failed"],
    ("returns", "status"): ["Pending", "Approved", "Rejected"],
    ("transactions", "transaction_type"): [
        "RECEIVING", "QUALITY_FAIL", "PUT_AWAY", "RESERVATION", "PICKING", "PACKING",
        "SHIPPING", "DELIVERY", "RETURN_INSPECTED", "STOCK_ADJUSTMENT",
    ],
}

# Texts the ledger rows carry.
NOTES = {
    "qa_fail": "QA inspection failed: Items damaged or incorrect specifications",
    "qa_pass": "QA inspection passed, ready for put-away",
    "put_away": "Auto allocated via stored procedure",
    "no_room": "Rejected put-away: Warehouse full capacity",
    "reserve": "Inventory reserved for order",
    "pick": "Items picked from storage location",
    "pack": "Items packaged in shipping cartons",
    "deliver": "Successfully delivered to customer",
    "restock": "Returned items restocked",
    "scrap": "Defective or damaged customer return scrapped",
    "moved_from": "Moved from location ",
}
MOVE_REFERENCE = "INTERNAL_MOVE"
SCRAP_REASONS = ["Damaged", "Defective"]

LEDGER_COLUMNS = [
    "transaction_type", "product_id", "location_id", "quantity", "employee_id",
    "reference_id", "notes",
]

# Integrity rules. Rules on columns a table does not carry are skipped.
PRIMARY_KEYS = {
    "categories": ["category_id"],
    "suppliers": ["supplier_id"],
    "products": ["product_id"],
    "customers": ["customer_id"],
    "employees": ["employee_id"],
    "warehouse_locations": ["location_id"],
    "inventory": ["inventory_id"],
    "orders": ["order_id"],
    "order_items": ["order_item_id"],
    "shipments": ["shipment_id"],
    "returns": ["return_id"],
    "transactions": ["transaction_id"],
}
UNIQUE = {
    "categories": [["category_name"]],
    "suppliers": [["email"]],
    "products": [["sku"]],
    "customers": [["email"]],
    "employees": [["email"]],
    "warehouse_locations": [["zone", "aisle", "shelf", "bin"]],
    "inventory": [["product_id", "location_id"]],
    "shipments": [["order_id"], ["tracking_number"]],
}
NOT_NULL = {
    "categories": ["category_name"],
    "suppliers": ["supplier_name", "email"],
    "products": ["sku", "product_name", "cost_price", "sale_price"],
    "customers": ["first_name", "last_name", "email"],
    "employees": ["first_name", "last_name", "email", "role", "hire_date"],
    "warehouse_locations": ["zone", "aisle", "shelf", "bin", "max_capacity"],
    "inventory": [
        "product_id", "location_id", "quantity_on_hand", "quantity_reserved", "quantity_allocated",
    ],
    "orders": ["total_amount"],
    "order_items": ["order_id", "product_id", "quantity", "unit_price"],
    "shipments": ["order_id", "tracking_number", "carrier", "shipping_cost"],
    "returns": ["order_id", "product_id", "quantity", "return_reason", "refund_amount"],
    "transactions": ["transaction_type", "quantity"],
}
# (column, condition that must hold where the column is not null)
CHECKS = {
    "suppliers": [("performance_rating", "performance_rating BETWEEN 0 AND 5")],
    "products": [
        ("cost_price", "cost_price >= 0"), ("sale_price", "sale_price >= 0"),
        ("reorder_level", "reorder_level >= 0"),
    ],
    "warehouse_locations": [
        ("max_capacity", "max_capacity > 0"), ("current_capacity", "current_capacity >= 0"),
    ],
    "inventory": [
        ("quantity_on_hand", "quantity_on_hand >= 0"),
        ("quantity_reserved", "quantity_reserved >= 0"),
        ("quantity_allocated", "quantity_allocated >= 0"),
    ],
    "orders": [("total_amount", "total_amount >= 0")],
    "order_items": [("quantity", "quantity > 0"), ("unit_price", "unit_price >= 0")],
    "shipments": [("shipping_cost", "shipping_cost >= 0")],
    "returns": [("quantity", "quantity > 0"), ("refund_amount", "refund_amount >= 0")],
}
FOREIGN_KEYS = {
    "products": [("category_id", "categories"), ("supplier_id", "suppliers")],
    "inventory": [("product_id", "products"), ("location_id", "warehouse_locations")],
    "orders": [
        ("customer_id", "customers"), ("picking_employee_id", "employees"),
        ("packing_employee_id", "employees"),
    ],
    "order_items": [("order_id", "orders"), ("product_id", "products")],
    "shipments": [("order_id", "orders")],
    "returns": [("order_id", "orders"), ("product_id", "products")],
    "transactions": [
        ("product_id", "products"), ("location_id", "warehouse_locations"),
        ("employee_id", "employees"),
    ],
}
