"""Business rules as column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from finmarts.functions.numeric import MONEY, flag, percent

# Display labels.
PL_GROUP_LABELS = {
    "revenue": "Выручка",
    "cogs": "Себестоимость",
    "opex": "Операционные расходы",
    "other": "Прочие доходы/расходы",
    "tax": "Налоги",
}
BS_GROUP_LABELS = {
    "current_assets": "Оборотные активы",
    "noncurrent_assets": "Внеоборотные активы",
    "current_liabilities": "Краткосрочные обязательства",
    "noncurrent_liabilities": "Долгосрочные обязательства",
    "equity": "Капитал",
}
SEGMENT_LABELS = {"A": "Крупный", "B": "Средний", "C": "Мелкий"}

# Bucket names of the aging report.
AGING_BUCKETS = ["Current", "1-30d", "31-60d", "61-90d", "90d+"]


def code(value: str) -> Column:
    """Trimmed and lower-cased code."""
    return F.lower(F.trim(F.col(value)))


def text(value: str) -> Column:
    return F.trim(F.col(value))


def group_code(value: str) -> Column:
    """Statement group in its canonical spelling: lower case, ``noncurrent_*``."""
    return F.regexp_replace(code(value), "^non_current_", "noncurrent_")


def day(value: str) -> Column:
    """A date; blank or malformed text becomes null instead of failing the job."""
    return F.col(value).try_cast("date")


def label(value: Column, names: dict[str, str]) -> Column:
    """Display label of a code; the code itself where no label is defined."""
    result = value
    for key, shown in reversed(names.items()):
        result = F.when(value == key, shown).otherwise(result)
    return result


def account_path(statement: str, *groups: str) -> Column:
    """Statement and the first group that is not blank, else 'Other'."""
    filled = [F.nullif(F.trim(F.col(g)), F.lit("")) for g in groups]
    return F.concat(F.col(statement), F.lit(" / "), F.coalesce(*filled, F.lit("Other")))


def fiscal_year_end(start_month: Column) -> Column:
    return F.when(start_month == 1, 12).otherwise(start_month - 1)


def tenure_group(days: Column) -> Column:
    return (
        F.when(days < 365, "<1yr").when(days < 1095, "1-3yr").when(days < 1825, "3-5yr").otherwise("5+yr")
    )


def margin_percent(price: Column, cost: Column) -> Column:
    return percent(price - cost, price)


def margin_group(margin: Column) -> Column:
    return F.when(margin >= 25, "high").when(margin >= 15, "mid").otherwise("low")


def price_with_vat(price: Column, rate: Column) -> Column:
    return F.round(price * (rate.cast("decimal(5,4)") + 1), 2).cast(MONEY)


def aging_bucket(days_overdue: Column) -> Column:
    current, to_30, to_60, to_90, beyond = AGING_BUCKETS
    return (
        F.when(days_overdue.between(1, 30), to_30)
        .when(days_overdue.between(31, 60), to_60)
        .when(days_overdue.between(61, 90), to_90)
        .when(days_overdue > 90, beyond)
        .otherwise(current)
    )


def risk_level(bucket: Column) -> Column:
    current, to_30, to_60, to_90, beyond = AGING_BUCKETS
    return (
        F.when(bucket == current, "low")
        .when(bucket.isin(to_30, to_60), "medium")
        .when(bucket.isin(to_90, beyond), "high")
        .otherwise("unknown")
    )


def is_overdue(days_overdue: Column, outstanding: Column) -> Column:
    return flag((days_overdue > 0) & (outstanding > 0))


def signed_amount(amount: Column, sign: Column) -> Column:
    """Amount in statement direction; null where the account carries no sign."""
    return (amount * sign).cast(MONEY)


def balance_amount(amount: Column, normal_balance: Column) -> Column:
    """Debit-normal accounts count up, all others down."""
    return F.when(normal_balance == "debit", amount).otherwise(-amount)


def on_time(delay_days: Column, delivered: Column) -> Column:
    """1 or 0 for a delivered order, null while it is not delivered."""
    return F.when(delivered.isNotNull(), flag(delay_days <= 0))
