"""Column expressions shared by the operators. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockloom.schema import ENUMS


def ratio(part, whole) -> Column:
    """part / whole as a double; NULL where the divisor is 0 or NULL."""
    return F.try_divide(_col(part).cast("double"), _col(whole).cast("double"))


def pct(part, whole) -> Column:
    return F.round(ratio(part, whole) * 100, 2)


def usage_pct() -> Column:
    """Occupancy of one bin in percent, exact to 12 digits: a mean of it does not depend on
    the order in which the bins are added up."""
    return (ratio("current_capacity", "max_capacity") * 100).cast("decimal(20,12)")


def or_zero(value) -> Column:
    return F.coalesce(_col(value), F.lit(0))


def seconds_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def whole_units(unit: str, start, end) -> Column:
    """Complete units between two timestamps, cut toward zero."""
    return F.timestamp_diff(unit, _col(start), _col(end))


def month_of(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def enum_rank(table: str, column: str, value=None) -> Column:
    """Position of an enumeration value in its declaration, for sorting."""
    values = F.array(*[F.lit(v) for v in ENUMS[(table, column)]])
    return F.array_position(values, _col(value if value is not None else column))


def full_name(first="first_name", last="last_name") -> Column:
    return F.concat(_col(first), F.lit(" "), _col(last))


def customer_name(columns: list[str]) -> Column:
    """Name of a customer, stored either whole or as first and last name."""
    return F.col("customer_name") if "customer_name" in columns else full_name()


def location_label(zone="zone", aisle="aisle", shelf="shelf", bin_="bin") -> Column:
    """For example ``Zone A-A2S3B1``."""
    return F.concat(
        _col(zone), F.lit("-A"), _col(aisle).cast("string"), F.lit("S"),
        _col(shelf).cast("string"), F.lit("B"), _col(bin_).cast("string"),
    )


def available() -> Column:
    return F.col("quantity_on_hand") - F.col("quantity_reserved")


def occupancy() -> Column:
    return F.col("quantity_on_hand") + F.col("quantity_allocated") + F.col("quantity_reserved")


def order_reference(order_id="order_id") -> Column:
    return F.concat(F.lit("ORDER-"), _col(order_id).cast("string"))


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
