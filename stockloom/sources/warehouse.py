"""Warehouse tables derived from the driver's order tables.

The derivations are SQL texts that run unchanged in Spark and in other engines, so a check
in another engine can start from the same rows. Names ending in ``_`` or starting with
``wh_`` avoid a clash with the driver's own tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from stockloom.session import scratch_path

# Schemas of the driver's tables, so that no file is read to learn them.
DRIVER_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
}

# name -> (tables it reads, SQL). Some products and customers are added under new, negative
# numbers, which have neither stock nor orders.
DERIVED: dict[str, tuple[list[str], str]] = {
    "categories": (["part"], """
        SELECT DISTINCT CAST(substring(p_brand, 7) AS INT) AS category_id,
               p_brand AS category_name
        FROM part"""),
    "suppliers": (["supplier"], """
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
               CAST((300 + (s_suppkey * 37) % 201) * 0.01 AS DECIMAL(3,2)) AS performance_rating
        FROM supplier"""),
    "products": (["part"], """
        SELECT p_partkey AS product_id, concat('PROD-', p_partkey) AS sku,
               p_name AS product_name, CAST(substring(p_brand, 7) AS INT) AS category_id,
               p_partkey % 13 AS supplier_id,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.70 AS DECIMAL(10,2)) AS cost_price,
               CAST(p_retailprice AS DECIMAL(10,2)) AS sale_price,
               CASE p_size % 4 WHEN 0 THEN 10 WHEN 1 THEN 15 WHEN 2 THEN 20 ELSE 30 END
                   AS reorder_level
        FROM (SELECT p_partkey, p_name, p_brand, p_retailprice, p_size FROM part
              UNION ALL
              SELECT -1 - p_partkey, concat(p_name, ' new'), p_brand, p_retailprice, p_size
              FROM part WHERE p_partkey % 20 = 0) p"""),
    "customers": (["customer"], """
        SELECT c_custkey AS customer_id, c_name AS customer_name,
               CASE c_custkey % 4 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Silver'
                    WHEN 2 THEN 'Gold' ELSE 'Platinum' END AS membership_tier
        FROM (SELECT c_custkey, c_name FROM customer
              UNION ALL
              SELECT -1 - c_custkey, concat(c_name, ' new') FROM customer
              WHERE c_custkey % 50 = 0) c"""),
    "employees": (["nation"], """
        SELECT n_nationkey AS employee_id, n_name AS first_name,
               concat('R', n_regionkey) AS last_name,
               CASE n_nationkey % 5 WHEN 0 THEN 'Receiver' WHEN 1 THEN 'Inspector'
                    WHEN 2 THEN 'Picker' WHEN 3 THEN 'Packer' ELSE 'Manager' END AS role,
               CASE WHEN n_nationkey % 11 = 10 THEN 'Inactive' ELSE 'Active' END AS status
        FROM nation"""),
    "wh_orders0": (["orders"], """
        SELECT *, CASE o_orderkey % 7 WHEN 0 THEN 'Pending' WHEN 1 THEN 'Picking'
                       WHEN 2 THEN 'Packed' WHEN 3 THEN 'Shipped' WHEN 4 THEN 'Delivered'
                       WHEN 5 THEN 'Cancelled' ELSE 'Returned' END AS status
        FROM orders"""),
    "wh_orders": (["wh_orders0"], """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, status,
               o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS order_date,
               CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
               CASE WHEN status <> 'Pending' THEN o_orderkey % 25 END AS picking_employee_id,
               CASE WHEN status NOT IN ('Pending', 'Picking') THEN (o_orderkey * 3) % 25 END
                   AS packing_employee_id
        FROM wh_orders0"""),
    "order_items": (["lineitem", "wh_orders"], """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS INT) AS quantity,
               CASE WHEN l_tax = 0 THEN NULL
                    ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.01 AS DECIMAL(10,2)) END
                   AS unit_price,
               CASE o.status WHEN 'Picking' THEN 'Reserved' WHEN 'Packed' THEN 'Packed'
                    WHEN 'Pending' THEN 'Pending' WHEN 'Cancelled' THEN 'Cancelled'
                    ELSE 'Shipped' END AS item_status
        FROM lineitem JOIN wh_orders o ON l_orderkey = o.order_id"""),
    "inventory": (["lineitem"], """
        SELECT l_partkey AS product_id, l_suppkey AS location_id,
               CAST(SUM(CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_quantity AS INT) ELSE 0 END)
                    AS INT) AS quantity_on_hand,
               CAST(SUM(CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS INT) ELSE 0 END)
                    AS INT) AS quantity_reserved,
               0 AS quantity_allocated
        FROM lineitem
        GROUP BY l_partkey, l_suppkey"""),
    "warehouse_locations": (["supplier", "inventory"], """
        SELECT s.s_suppkey AS location_id,
               concat('Zone ', substring('ABCDE', CAST(s.s_suppkey % 5 AS INT) + 1, 1)) AS zone,
               CAST(floor(s.s_suppkey / 5) AS INT) % 4 + 1 AS aisle,
               CAST(floor(s.s_suppkey / 20) AS INT) % 5 + 1 AS shelf,
               CAST(s.s_suppkey AS INT) AS bin,
               CASE s.s_suppkey % 4 WHEN 0 THEN 4000 WHEN 1 THEN 8000 WHEN 2 THEN 16000
                    ELSE 40000 END AS max_capacity,
               CAST(COALESCE(i.occ, 0) AS INT) AS current_capacity
        FROM supplier s
        LEFT JOIN (SELECT location_id,
                          SUM(quantity_on_hand + quantity_allocated + quantity_reserved) AS occ
                   FROM inventory GROUP BY location_id) i
               ON s.s_suppkey = i.location_id"""),
    "shipments": (["wh_orders"], """
        SELECT order_id AS shipment_id, order_id,
               CASE order_id % 4 WHEN 0 THEN 'FedEx' WHEN 1 THEN 'UPS' WHEN 2 THEN 'DHL'
                    ELSE 'USPS' END AS carrier,
               CAST(5 + (order_id * 17) % 4000 * 0.01 AS DECIMAL(10,2)) AS shipping_cost,
               order_date + INTERVAL '1' MINUTE * CAST((order_id * 37) % 2400 AS INT)
                   AS ship_date,
               CASE WHEN status IN ('Delivered', 'Returned')
                    THEN order_date + INTERVAL '1' MINUTE
                         * CAST((order_id * 37) % 2400 + 1440 + (order_id * 101) % 5760 AS INT)
                    END AS delivery_date,
               CASE WHEN status IN ('Delivered', 'Returned') THEN 'Delivered'
                    ELSE 'In Transit' END AS status
        FROM wh_orders
        WHERE status IN ('Shipped', 'Delivered', 'Returned')"""),
    "returns_": (["order_items", "wh_orders", "products"], """
        SELECT oi.order_id, oi.product_id, oi.quantity,
               CASE oi.order_id % 5 WHEN 0 THEN 'Damaged' WHEN 1 THEN 'Defective'
                    WHEN 2 THEN 'Incorrect Item' WHEN 3 THEN 'Not as Described'
                    ELSE 'Buyer Remorse' END AS return_reason,
               CAST(oi.quantity * p.sale_price AS DECIMAL(10,2)) AS refund_amount
        FROM order_items oi
        JOIN wh_orders o ON oi.order_id = o.order_id
        JOIN products p ON oi.product_id = p.product_id
        WHERE o.status = 'Returned' AND oi.quantity % 3 = 0"""),
    "transactions": (["inventory", "products", "order_items", "returns_"], """
        SELECT 'RECEIVING' AS transaction_type, i.product_id,
               CAST(NULL AS BIGINT) AS location_id, i.quantity_on_hand AS quantity,
               CAST(i.product_id % 25 AS INT) AS employee_id,
               concat('RECV-SUPP-', p.supplier_id, '-', 1000 + i.product_id % 9000)
                   AS reference_id
        FROM inventory i JOIN products p ON i.product_id = p.product_id
        WHERE i.location_id % 10 <> 9 AND i.quantity_on_hand > 0
        UNION ALL
        SELECT 'QUALITY_FAIL', i.product_id, CAST(NULL AS BIGINT), i.quantity_on_hand,
               CAST(i.product_id % 25 AS INT),
               concat('RECV-SUPP-', p.supplier_id, '-', 1000 + i.product_id % 9000)
        FROM inventory i JOIN products p ON i.product_id = p.product_id
        WHERE i.location_id % 10 = 9 AND i.quantity_on_hand > 0
        UNION ALL
        SELECT 'PUT_AWAY', product_id, location_id, quantity_on_hand,
               CAST(product_id % 25 AS INT), 'PUT'
        FROM inventory WHERE quantity_on_hand > 0
        UNION ALL
        SELECT 'RESERVATION', product_id, location_id, quantity_reserved,
               CAST(NULL AS INT), 'RES'
        FROM inventory WHERE quantity_reserved > 0
        UNION ALL
        SELECT 'SHIPPING', oi.product_id, CAST(NULL AS BIGINT), oi.quantity,
               CAST(NULL AS INT), concat('ORDER-', oi.order_id)
        FROM order_items oi WHERE item_status = 'Shipped'
        UNION ALL
        SELECT 'RETURN_INSPECTED', product_id, CAST(NULL AS BIGINT), quantity,
               CAST(NULL AS INT), concat('ORDER-', order_id)
        FROM returns_"""),
}


def needed(names: list[str]) -> list[str]:
    """Derived tables to define for ``names``, each after those it reads."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in DERIVED and name not in order:
            for source in DERIVED[name][0]:
                visit(source)
            order.append(name)

    for name in names:
        visit(name)
    return order


def ctes(names: list[str]) -> str:
    """``name AS (...), ...`` for the tables and all they read."""
    return ",\n".join(f"{name} AS ({DERIVED[name][1]})" for name in needed(names))


class Warehouse:
    """Derived tables of one data folder as lazy DataFrames: ``Warehouse(spark, d).products``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._read: dict[str, DataFrame] = {}
        self._stored: set[str] = set()

    def driver(self, name: str) -> DataFrame:
        if name not in self._read:
            reader = self.spark.read.schema(DRIVER_SCHEMAS[name])
            self._read[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DERIVED:
            raise AttributeError(name)
        # Tables that already exist here stand for their derivation.
        reads = DERIVED[name][0]
        frames = {s: getattr(self, s) if s in DERIVED else self.driver(s) for s in reads}
        text = re.sub(rf"\b(FROM|JOIN) ({'|'.join(reads)})\b", r"\1 {\2}", DERIVED[name][1])
        table = self.spark.sql(text, **frames)
        self.__dict__[name] = table
        return table

    def store(self, *names: str) -> Warehouse:
        """Write the named tables to the shared folder and read them from there on.

        For queries that read most tables many times: the derivations run once. What is
        already stored stays.
        """
        for name in sorted(set(names) - self._stored, key=needed(list(names)).index):
            self._stored.add(name)
            table = getattr(self, name)
            path = scratch_path(self.spark, name)
            table.write.parquet(path)
            self.__dict__[name] = self.spark.read.schema(table.schema).parquet(path)
        return self
