"""Code tables, buckets and bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Lead status codes.
LEAD_STATUS = {
    "0": "OPENED",
    "1": "FOLLOWUP",
    "2": "APPOINTMENT_BOOKED",
    "3": "CANCELLED",
    "4": "REJECTED",
    "5": "INCOMPLETE",
    "6": "CLOSED",
    "7": "APPOINTMENT_CONFIRMED",
}

# Consultation status codes, one table per report family.
CONSULTATION_STATUS = {
    "0": "OPEN",
    "1": "BOOKED",
    "2": "CONFIRMED",
    "3": "DONE",
    "4": "CANCELLED",
    "5": "OPEN",
}
CONSULTATION_STATUS_LIVE = {
    **CONSULTATION_STATUS,
    "6": "PATIENT_HAS_REACHED",
    "7": "ONLINE_CONSULTATION_STARTED",
}
CONSULTATION_STATUS_WEEKLY = {**CONSULTATION_STATUS, "6": "CONFIRMED", "7": "CONFIRMED"}

# City names that are shown under a code.
CITY_CODES = {"Chandigarh": "CHD", "Bangalore": "BLR"}
CITY_CODES_5 = {**CITY_CODES, "Jaipur": "JPR", "NCR": "NCR", "Hyderabad": "HYD"}

# Payment mode to its column class; any other mode is Other.
PAY_MODE_CLASS = {
    "RAZOR_PAY": "Razorpay",
    "RAZOR_PAY_UPI_PAID": "Razorpay",
    "UPI": "UPI",
    "GOOGLE_PAY": "UPI",
    "INSURANCE": "Insurance",
    "CASH": "Cash",
    "KTKSWIPE": "KTKSWIPE",
}
PAY_MODE_CLASSES = ("Razorpay", "UPI", "Other", "Insurance", "Cash", "KTKSWIPE")
SERVICES = ("Online Consultation", "Consultation", "Diagnostics", "Loyalty", "IPD")

# Marketing channel to its bucket.
CHANNEL_BUCKET = {
    "Google Base Broad Match Core Campaign": "High",
    "Not Tracked": "Medium",
    "Google-Search-Ads": "Low",
    "1011 Google": "High",
    "Google Diagnostics": "Medium",
    "2021 Google": "High",
    "2010 Google": "Medium",
    "Google Base Campaign": "Low",
    "1010 Google": "High",
    "1110 Google": "High",
    "2021 Whatsapp-main": "All Other(Whatsapp, Website, Video)",
    "4011 Google": "High",
    "Offline": "Medium",
    "1012 Google": "Medium",
    "1010 Whatsapp-price": "All Other(Whatsapp, Website, Video)",
    "1411 WebsiteSubmit": "All Other(Whatsapp, Website, Video)",
    "Website Submit": "All Other(Whatsapp, Website, Video)",
    "1311 Whatsapp-main": "All Other(Whatsapp, Website, Video)",
    "Google Ads": "Medium",
    "1311 WebsiteSubmit": "All Other(Whatsapp, Website, Video)",
    "1013 Google": "Low",
    "Default Google": "Medium",
    "1013 Whatsapp-other": "All Other(Whatsapp, Website, Video)",
    "1410 Google": "Low",
    "2021 Whatsapp-price": "All Other(Whatsapp, Website, Video)",
    "1011 WebsiteSubmit": "All Other(Whatsapp, Website, Video)",
    "1011 Whatsapp-main": "All Other(Whatsapp, Website, Video)",
    "1411 Whatsapp-price": "All Other(Whatsapp, Website, Video)",
    "Default Whatsapp-other": "All Other(Whatsapp, Website, Video)",
    "1011 Whatsapp-price": "All Other(Whatsapp, Website, Video)",
    "2010 Whatsapp-main": "All Other(Whatsapp, Website, Video)",
    "1411 Google": "High",
    "Default Whatsapp-main": "All Other(Whatsapp, Website, Video)",
    "1411 Whatsapp-main": "All Other(Whatsapp, Website, Video)",
    "Dr. exp": "Medium",
    "1013 Whatsapp-main": "All Other(Whatsapp, Website, Video)",
    "2011 Whatsapp-main": "All Other(Whatsapp, Website, Video)",
    "1013 WebsiteSubmit": "All Other(Whatsapp, Website, Video)",
    "2011 Whatsapp-price": "All Other(Whatsapp, Website, Video)",
    "3010 Google": "Low",
    "Default Whatsapp-price": "All Other(Whatsapp, Website, Video)",
    "1010 WebsiteSubmit": "All Other(Whatsapp, Website, Video)",
    "Facebook Form": "Facebook Form",
    "1410 WebsiteSubmit": "All Other(Whatsapp, Website, Video)",
    "Newspaper TV": "All Other(Whatsapp, Website, Video)",
    "202 whatsapp": "All Other(Whatsapp, Website, Video)",
    "Facebook Videos": "All Other(Whatsapp, Website, Video)",
    "1011 Website Submit": "All Other(Whatsapp, Website, Video)",
    "1011 Whatsapp-other": "All Other(Whatsapp, Website, Video)",
    "Website Direct": "All Other(Whatsapp, Website, Video)",
    "2021 Website Submit": "All Other(Whatsapp, Website, Video)",
    "1010 Website Submit": "All Other(Whatsapp, Website, Video)",
    "1411 Website Submit": "All Other(Whatsapp, Website, Video)",
}
NO_CHANNEL = "No Channel Info"

# Age labels by their upper bound in seconds.
AGE_BUCKETS = (
    (600, "less than 10_Mins"),
    (1800, "10 - 30_Mins"),
    (3600, "30 - 60_Mins"),
    (7200, "1 - 2_hours"),
    (36000, "2 - 10_hours"),
)
OLDEST = "more than 10_hours"

CARD_LABEL = "Privilege Card"


def map_value(key: Column, table: Mapping, default: str | None = None) -> Column:
    """Value of key in a small table written in the code, else the default."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(pairs, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def code_to_label(code: Column, table: Mapping[str, str], default: str = "NA", missing: str | None = None) -> Column:
    """Label of a status code; an unknown code gets the default, no code gets missing."""
    absent = code.isNull() | (code == "")
    return F.when(absent, F.lit(missing).cast("string")).otherwise(map_value(code, table, default))


def code_to_label_strict(code: Column, table: Mapping[str, str], missing: str | None = None) -> Column:
    """As code_to_label, but an unknown code stops the query."""
    absent = code.isNull() | (code == "")
    unknown = F.raise_error(F.concat(F.lit("unknown code: "), code)).cast("string")
    return F.when(absent, F.lit(missing).cast("string")).otherwise(F.coalesce(map_value(code, table), unknown))


def city_code(
    city: Column, *fallbacks: Column, codes: Mapping[str, str] = CITY_CODES, default: str = "No City"
) -> Column:
    """Code of the first city known, the city itself if it has none, else the default."""
    known = F.coalesce(city, *fallbacks)
    return F.coalesce(map_value(known, codes), known, F.lit(default))


def fee_bucket(
    fee: Column,
    mode: Column,
    has_card: Column,
    wallet_mode: str,
    width: int = 100,
    steps: int = 4,
) -> Column:
    """Fee band. A zero fee is named by what paid for it; a missing fee has no band."""
    zero = F.when(mode == wallet_mode, F.lit(wallet_mode)).when(has_card, F.lit(CARD_LABEL)).otherwise(F.lit("0"))
    out = F.when(fee == 0, zero)
    for label, top in zip(fee_labels(width, steps), range(width, width * (steps + 1), width)):
        out = out.when((fee > top - width) & (fee <= top), F.lit(label))
    return out.when(fee > width * steps, F.lit(f">{width * steps}"))


def fee_labels(width: int = 100, steps: int = 4) -> list[str]:
    return [f"{low + 1}-{low + width}" for low in range(0, width * steps, width)]


def fee_bucket_labels(wallet_mode: str, width: int = 100, steps: int = 4) -> list[str]:
    """Every band in report order."""
    return ["0", *fee_labels(width, steps), f">{width * steps}", wallet_mode, CARD_LABEL]


def age_bucket(seconds: Column) -> Column:
    out = None
    for bound, label in AGE_BUCKETS:
        test = seconds <= bound
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.when(seconds.isNotNull(), OLDEST)


def threshold_band(pct: Column, base: Column, low: float = 50, high: float = 70) -> Column:
    """red under low, pale under high, none above; a zero is red only if it has a base."""
    zero = F.when(base > 0, "red").otherwise("none")
    return F.when(pct == 0, zero).when(pct < low, "red").when(pct < high, "pale").otherwise("none")


def route(city: Column, listed: Sequence[str], catch_all: str | None = None) -> Column:
    """The city if listed, else the catch-all (NULL without one)."""
    return F.when(city.isin(*listed), city).otherwise(F.lit(catch_all).cast("string"))
