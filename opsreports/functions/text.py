"""Text, contact and JSON cleaners."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Texts that stand for "nothing here".
BLANKS = ("", "null", "{}")


def blank_to_null(text: Column) -> Column:
    return F.when(~text.isin(*BLANKS), text)


def phone_local(number: Column) -> Column:
    """Drop a country prefix of one to four characters; other lengths stay."""
    return F.when(F.length(number).between(11, 14), F.right(number, F.lit(10))).otherwise(number)


def is_outbound(sender: Column, domain: str, system_senders: Iterable[str] = ()) -> Column:
    named = [name for name in system_senders if name != ""]
    own = sender.contains(domain) | (sender == "")
    if named:
        own = own | sender.isin(*named)
    return sender.isNull() | own


def message_direction(sender: Column, domain: str, system_senders: Iterable[str] = ()) -> Column:
    return F.when(is_outbound(sender, domain, system_senders), F.lit("OUTBOUND")).otherwise(F.lit("INBOUND"))


def message_customer_number(
    sender: Column, recipient: Column, domain: str, system_senders: Iterable[str] = ()
) -> Column:
    """The customer's side of a message, without its country prefix."""
    outbound = is_outbound(sender, domain, system_senders)
    return phone_local(F.when(outbound, recipient).otherwise(sender))


def call_customer_number(direction: Column, caller: Column, callee: Column) -> Column:
    return phone_local(F.when(direction == "inbound", caller).otherwise(callee))


def call_agent_number(direction: Column, caller: Column, callee: Column) -> Column:
    return phone_local(F.when(direction == "inbound", callee).otherwise(caller))


def name_from_email(email: Column) -> Column:
    """Mailbox name with only its first letter in upper case.

    The name is the whole text if there is no ``@``, so both branches and the condition hold it: Spark cuts it once a row.
    """
    name = F.substring_index(email, "@", 1)
    capital = F.concat(F.upper(F.left(name, F.lit(1))), F.lower(F.substring(name, 2, 2**31 - 1)))
    return F.when(F.octet_length(name) < F.octet_length(email), capital).otherwise(name)


def flatten_comment(comment: Column) -> Column:
    """Line breaks, real or spelled out, become commas; blank becomes ``''``."""
    breaks = F.replace(comment, F.lit("\n"), F.lit(","))
    spelled = F.replace(breaks, F.lit("\\n"), F.lit(","))
    return F.when(blank_to_null(comment).isNull(), F.lit("")).otherwise(spelled)


def first_clause(text: Column) -> Column:
    """Text before its first comma; missing becomes ``''``."""
    return F.coalesce(F.substring_index(text, ",", 1), F.lit(""))


def day_with_suffix(day: Column) -> Column:
    suffix = (
        F.when(day.between(4, 20) | day.between(24, 30), "th")
        .when(day % 10 == 1, "st")
        .when(day % 10 == 2, "nd")
        .otherwise("rd")
    )
    return F.concat(day.cast("string"), suffix)


def json_text(document: Column, field: str) -> Column:
    """One top-level JSON field as text; a missing field or document is ``''``."""
    return F.coalesce(F.get_json_object(blank_to_null(document), f"$.{field}"), F.lit(""))


def variant_text(document: Column, field: str) -> Column:
    """As ``json_text``, from a document that ``try_parse_json`` has parsed once for all its fields."""
    return F.coalesce(F.try_variant_get(document, f"$.{field}", "string"), F.lit(""))


def outcome_comment(document: Column) -> Column:
    """The comments of a surgery outcome below their heading."""
    comment = F.get_json_object(document, "$.comments")
    return F.concat(
        F.lit("\n Surgery Comments: \n"), F.coalesce(F.concat(comment, F.lit(" \n")), F.lit(""))
    )


def response_stage(times_json: Column, response: Column) -> Column:
    """Stage of a feedback call by the number of attempts made and the answer."""
    attempts = F.json_array_length(times_json)
    waiting = (
        F.when(attempts == 1, "1st stage")
        .when(attempts == 2, "2nd stage")
        .otherwise("Patient_eligible_for_calling")
    )
    answered = attempts.between(1, 3) & (response == "true")
    return F.when(answered, F.lit("Patient_Responded")).otherwise(waiting)


def record_url(base: str, patient_id: Column, case_id: Column) -> Column:
    """Link to a case page, ``''`` where an id is missing."""
    link = F.concat(
        F.lit(base.rstrip("/") + "/patient/"), patient_id.cast("string"), F.lit("/case/"), case_id.cast("string")
    )
    return F.coalesce(link, F.lit(""))
