"""Row-level money formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# Share of a receivable balance per age band.
AGING_SHARES = {
    "ar_aging_current": "0.55",
    "ar_aging_30": "0.25",
    "ar_aging_60": "0.12",
    "ar_aging_90plus": "0.08",
}


def net_amount(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """Quantity times price after discount, in cents."""
    kept = F.lit(1).cast("decimal(8,4)") - discount.cast("decimal(8,4)")
    gross = (quantity.cast("decimal(10,0)") * unit_price.cast(MONEY)).cast("decimal(24,2)")
    return (gross * kept).cast(MONEY)


def monthly_interest(balance: Column, yearly_rate: Column) -> Column:
    """One month of simple interest."""
    accrued = balance.cast(MONEY) * yearly_rate.cast("decimal(8,6)")
    return (accrued / F.lit(12).cast("decimal(2,0)")).cast(MONEY)


def average_rate(spot: Column, budget: Column) -> Column:
    total = spot.cast("decimal(12,6)") + budget.cast("decimal(12,6)")
    return (total / F.lit(2).cast("decimal(1,0)")).cast("decimal(12,6)")


def receivable_aging(balance: Column) -> dict[str, Column]:
    """Age-band columns of a receivable balance."""
    return {
        name: (balance.cast(MONEY) * F.lit(share).cast("decimal(2,2)")).cast(MONEY)
        for name, share in AGING_SHARES.items()
    }


def inventory_turns(monthly_cogs: Column, inventory: Column) -> Column:
    """Yearly turns; 0 when there is no inventory."""
    turns = F.try_divide(monthly_cogs.cast("double"), inventory.cast("double")) * 12
    return F.when(inventory != 0, turns).otherwise(F.lit(0.0))


def remaining_spend(approved: Column, spent: Column) -> Column:
    return (approved.cast(MONEY) - spent.cast(MONEY)).cast(MONEY)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))
