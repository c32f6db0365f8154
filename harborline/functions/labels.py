"""Status labels, sentences and amount formats for cash figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording and thresholds of status, guidance and explanation texts.
GUIDANCE = {
    "Shortage": "Replenishment may be required",
    "Surplus": "Possible excess idle cash",
    "Balanced": "No major cash gap expected",
}
SURPLUS_RATIO = 1.1
SPIKE_RATIO = 1.2
SALARY_DAY = "Salary day spike anticipated."
MONTH_START = "Start of month typically sees higher transaction volume."
MONTH_END = "End of month patterns indicate elevated cash movement."
WEEKEND = "Weekend trend detected; typically lower activity."
FRIDAY = "Friday peak activity expected."
HIGH_WITHDRAWALS = "Withdrawals projected 20%+ above recent average."
HIGH_DEPOSITS = "Deposits projected 20%+ above recent average."
NOTHING_SPECIAL = "Aligns with recent historical trends and rolling averages."


def status_label(withdrawals: Column, deposits: Column) -> Column:
    return (
        F.when(withdrawals > deposits, "Shortage")
        .when(deposits > withdrawals * SURPLUS_RATIO, "Surplus")
        .otherwise("Balanced")
    )


def guidance_text(status: Column) -> Column:
    text = F.lit("Unknown")
    for name, sentence in GUIDANCE.items():
        text = F.when(status == name, sentence).otherwise(text)
    return text


def forecast_explanation(
    salary_day: Column,
    month_start: Column,
    month_end: Column,
    weekday: Column,
    withdrawals: Column,
    deposits: Column,
    mean_withdrawals: Column,
    mean_deposits: Column,
) -> Column:
    """Up to three sentences: calendar event, weekday (Monday = 0), distance from the recent mean."""
    event = F.when(salary_day, SALARY_DAY).when(month_start, MONTH_START).when(month_end, MONTH_END)
    day = F.when(weekday >= 5, WEEKEND).when(weekday == 4, FRIDAY)
    level = F.when(
        (mean_withdrawals > 0) & (withdrawals > mean_withdrawals * SPIKE_RATIO), HIGH_WITHDRAWALS
    ).when((mean_deposits > 0) & (deposits > mean_deposits * SPIKE_RATIO), HIGH_DEPOSITS)
    sentences = F.concat_ws(" ", event, day, level)
    return F.when(sentences == "", NOTHING_SPECIAL).otherwise(sentences)


def _fixed(value: Column, digits: int, suffix: str = "", grouped: bool = False) -> Column:
    """Fixed decimals, rounding the exact binary value half to even, with a suffix."""
    pattern = ("#,##0" if grouped else "0") + ("." + "0" * digits if digits else "")
    text = F.call_function("format_number", value, F.lit(pattern))
    return F.concat(text, F.lit(suffix)) if suffix else text


def short_amount(value: Column) -> Column:
    """53.6M, 850K, -4.4M; a dash for null."""
    size = F.abs(value)
    body = (
        F.when(size >= 1e9, _fixed(size / 1e9, 1, "B"))
        .when(size >= 1e6, _fixed(size / 1e6, 1, "M"))
        .when(size >= 1e3, _fixed(size / 1e3, 0, "K"))
        .otherwise(_fixed(size, 0, grouped=True))
    )
    return F.when(value.isNull(), "—").otherwise(F.concat(F.when(value < 0, "-").otherwise(""), body))


def metric_amount(value: Column) -> Column:
    """Two decimals with B, M or K; N/A for null."""
    size = F.abs(value)
    body = (
        F.when(size >= 1e9, _fixed(value / 1e9, 2, "B"))
        .when(size >= 1e6, _fixed(value / 1e6, 2, "M"))
        .when(size >= 1e3, _fixed(value / 1e3, 2, "K"))
        .otherwise(_fixed(value, 2))
    )
    return F.when(value.isNull(), "N/A").otherwise(body)


def currency_amount(value: Column, currency: str = "PKR", short: bool = True) -> Column:
    """Currency code before the short or the whole amount."""
    whole = F.concat(F.when(value < 0, "-").otherwise(""), F.lit(f"{currency} "), _fixed(F.abs(value), 0, grouped=True))
    brief = F.concat(F.when(value < 0, "-").otherwise(""), F.lit(f"{currency} "), short_amount(F.abs(value)))
    return F.when(value.isNull(), "—").otherwise(brief if short else whole)


def reserve(requirement: Column, buffer: float) -> Column:
    return requirement * (1 + buffer)
