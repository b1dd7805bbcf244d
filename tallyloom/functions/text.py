"""Text rules as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.specs import PhoneRule


def phone_e164(col: Column, rule: PhoneRule) -> Column:
    """Phone without any (Unicode) white space in international form, or null."""
    digits = F.regexp_replace(col, r"(?U)\s+", "")
    kept = F.concat(F.lit(rule.prefix), F.substr(digits, F.lit(rule.start)))
    return F.when(digits.rlike(rule.pattern), kept)


def map_value(col: Column, mapping: dict[str, str]) -> Column:
    """Exact lookup in a short fixed mapping; null for any other value."""
    result = F.lit(None).cast("string")
    for key, value in mapping.items():
        result = F.when(col == key, F.lit(value)).otherwise(result)
    return result


def in_domain(col: Column, values: list[str]) -> Column:
    return F.coalesce(col.isin(values), F.lit(False))


def transliterate(col: Column, mapping: dict[str, str]) -> Column:
    """Replace each word found in ``mapping``; keep the other words."""
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    words = F.split(F.trim(F.regexp_replace(col, r"(?U)\s+", " ")), " ")
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w)), " ")


Rule = tuple[Column, str, Column]  # (condition of failure, stable reason code, message)


def first_failure(rules: list[Rule]) -> Column:
    """Code of the first rule whose condition holds, else null."""
    found = None
    for failed, code, _ in rules:
        found = F.when(failed, code) if found is None else found.when(failed, code)
    return found


def failure_message(code: Column, rules: list[Rule]) -> Column:
    """Message of the rule with the given code, else null."""
    found = None
    for _, known, message in rules:
        match = code == known
        found = F.when(match, message) if found is None else found.when(match, message)
    return found
