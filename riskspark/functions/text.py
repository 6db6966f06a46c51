"""Wording: display names, per-feature sentences, anomaly reasons, masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspark.functions.numeric import fixed

# Display names of the model features.
DISPLAY_NAMES = {
    "amt": "Transaction Amount",
    "amt_to_user_avg_ratio": "Cardholder Spending Ratio",
    "amt_to_cat_median_ratio": "Category Spend Multiplier",
    "haversine_distance_km": "Terminal Geolocation Distance",
    "trans_velocity_1h": "1-Hour Transaction Velocity",
    "trans_velocity_24h": "24-Hour Transaction Velocity",
    "is_night_transaction": "Late Night / Off-Hours Timing",
    "hour": "Transaction Hour",
    "day_of_week": "Day of Week",
    "customer_age": "Cardholder Age",
    "category_fraud_rate": "Merchant Category Historical Risk",
}

# Sentence per feature when it raises risk and when it does not.
# {v1} and {v2} are the value with 1 or 2 decimals, {vi} its whole part, {p2} its percentage.
RAISING, PROTECTIVE = "elevated fraud risk", "reduced risk (protective)"
SENTENCES = {
    "amt": (
        "High transaction amount (${v2}) significantly elevated fraud risk.",
        "Standard transaction amount (${v2}) reduced risk (protective).",
    ),
    "amt_to_user_avg_ratio": (
        "Order value is {v1}x higher than this customer's historical average spend (elevated fraud risk).",
        "Spending aligns with customer's typical purchase history ({v1}x average, reduced risk (protective)).",
    ),
    "amt_to_cat_median_ratio": (
        "Amount is {v1}x the median ticket size for this merchant sector (elevated fraud risk).",
        "Ticket size is typical for this merchant category ({v1}x median, reduced risk (protective)).",
    ),
    "haversine_distance_km": (
        "Terminal location is {v1} km away from cardholder's home address (elevated fraud risk).",
        "Terminal is within normal local proximity ({v1} km from home, reduced risk (protective)).",
    ),
    "trans_velocity_1h": (
        "Card velocity spike: {vi} authorization(s) within the last hour (elevated fraud risk).",
        "Normal velocity: no rapid authorization bursts detected (reduced risk (protective)).",
    ),
    "trans_velocity_24h": (
        "Elevated 24-hour volume: {vi} transactions in 24 hours (elevated fraud risk).",
        "Routine daily transaction volume (reduced risk (protective)).",
    ),
    "category_fraud_rate": (
        "Merchant sector has elevated historical dispute rate ({p2}%, elevated fraud risk).",
        "Merchant operates in a historically low-risk sector ({p2}% dispute rate, reduced risk (protective)).",
    ),
}
NIGHT_RAISING = "Transaction authorized during high-risk off-hours (midnight to 5 AM, elevated fraud risk)."
NIGHT_OTHER = "Transaction initiated during standard daytime business hours ({d})."


def _fill(template: str, value: Column) -> Column:
    """Template to Column: literal pieces joined with the formatted value."""
    forms = {
        "{v1}": fixed(value, 1),
        "{v2}": fixed(value, 2),
        "{vi}": value.cast("bigint").cast("string"),
        "{p2}": fixed(value * 100.0, 2),
    }
    for mark, text in forms.items():
        if mark in template:
            before, after = template.split(mark)
            return F.concat(F.lit(before), text, F.lit(after))
    return F.lit(template)


def display_name(feature: Column) -> Column:
    """Readable name; unknown features fall back to title case."""
    names = F.create_map(*[F.lit(x) for pair in DISPLAY_NAMES.items() for x in pair])
    return F.coalesce(F.element_at(names, feature), F.initcap(F.replace(feature, F.lit("_"), F.lit(" "))))


def feature_sentence(feature: Column, value: Column, contribution: Column) -> Column:
    """One sentence on how a feature value moved the risk of a row."""
    raising = contribution > 0
    direction = F.when(raising, F.lit(RAISING)).otherwise(F.lit(PROTECTIVE))
    night = F.when(
        (value.cast("int") == 1) & raising, F.lit(NIGHT_RAISING)
    ).otherwise(F.replace(F.lit(NIGHT_OTHER), F.lit("{d}"), direction))
    out = F.when(feature == "is_night_transaction", night)
    for name, (up, down) in SENTENCES.items():
        out = out.when(feature == name, F.when(raising, _fill(up, value)).otherwise(_fill(down, value)))
    return out.otherwise(
        F.concat(display_name(feature), F.lit(" = "), fixed(value, 2), F.lit(" ("), direction, F.lit(")."))
    )


# Anomaly reasons.
SEVERE_DRIVEN = "Unsupervised Isolation Forest detected severe behavioral outlier driven by: "
SEVERE_PLAIN = (
    "Unsupervised Isolation Forest detected a multi-dimensional statistical deviation "
    "from typical human spending baselines."
)
MILD = (
    "Transaction exhibits mild variance from standard behavioral boundaries, "
    "but remains within plausible consumer habits."
)
JUMP, SURGE, LARGE, LATE = "large geographical jump (", "atypical spending surge (", "abnormally large order value ($", "late-night authorization"
ROUTINE = "Transaction patterns are fully consistent with typical, routine human spending behavior."


def anomaly_reason(score: Column, distance: Column, user_ratio: Column, amt: Column, night: Column) -> Column:
    """Why the anomaly score is what it is: drivers from 70, mild from 40, routine below."""
    drivers = F.concat_ws(
        ", ",
        F.when(distance > 300, F.concat(F.lit(JUMP), fixed(distance, 0), F.lit(" km)"))),
        F.when(
            user_ratio > 3.0,
            F.concat(F.lit(SURGE), fixed(user_ratio, 1), F.lit("x user average)")),
        ),
        F.when(amt > 500, F.concat(F.lit(LARGE), fixed(amt, 2), F.lit(")"))),
        F.when(night == 1, F.lit(LATE)),
    )
    severe = F.when(drivers != "", F.concat(F.lit(SEVERE_DRIVEN), drivers, F.lit("."))).otherwise(F.lit(SEVERE_PLAIN))
    return F.when(score >= 70.0, severe).when(score >= 40.0, F.lit(MILD)).otherwise(F.lit(ROUTINE))


def mask_card(card: Column) -> Column:
    """Only the last four digits survive."""
    return F.concat(F.lit("**** **** **** "), F.right(card.cast("string"), F.lit(4)))


def money_text(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def percent_text(c: Column) -> Column:
    return F.concat(fixed(c * 100.0, 1), F.lit("%"))
