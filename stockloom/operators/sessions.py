"""Work sessions of employees, read off the times of their orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions.scalars import ratio


def work_sessions(orders: DataFrame, employee: str, gap_minutes: int = 120, tail_minutes: int = 15) -> DataFrame:
    """(employee_id, orders, sessions, worked_minutes, orders_per_hour) per employee.

    A session goes on while the next order comes within ``gap_minutes``; it lasts from its first
    order to its last and ``tail_minutes`` on. Orders without the employee or a time are left out.

    Orders are first reduced to one row per employee and minute inside the map tasks. What is put in
    order per employee is thus bounded by the minutes of the time that the table spans, whatever
    share of the orders one employee has.
    """
    minutes = (
        orders.filter(F.col(employee).isNotNull() & F.col("order_date").isNotNull())
        .groupBy(F.col(employee).alias("employee_id"), F.date_trunc("minute", "order_date").alias("minute"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    before = F.lag("minute").over(Window.partitionBy("employee_id").orderBy("minute"))
    step = (F.unix_seconds(F.col("minute").cast("timestamp")) - F.unix_seconds(before.cast("timestamp"))) / 60
    goes_on = F.coalesce(F.col("step") <= gap_minutes, F.lit(False))
    return (
        minutes.withColumn("step", step.cast("bigint"))
        .groupBy("employee_id")
        .agg(
            F.sum("orders").alias("orders"),
            F.count_if(~goes_on).alias("sessions"),
            (F.coalesce(F.sum(F.when(goes_on, F.col("step"))), F.lit(0))
             + tail_minutes * F.count_if(~goes_on)).alias("worked_minutes"),
        )
        .withColumn("orders_per_hour", ratio(F.col("orders") * 60, "worked_minutes"))
    )
