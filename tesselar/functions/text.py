"""Patterns on response texts and network addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The log-file pattern and the success phrase of the load generator.
LOG_NAME = r"test\.\d{1,}\.log"
SUCCESS_PHRASE = "return to the homepage"

IPV4 = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}"
HEXTET = "[0-9A-Fa-f]{1,4}"
HEXTETS = f"{HEXTET}(:{HEXTET})*"
IPV6_FULL = rf"\A({HEXTET}:){{7}}{HEXTET}\z"
IPV6_SHORT = rf"\A({HEXTETS})?::({HEXTETS})?\z"


def log_name(text: Column) -> Column:
    """First log-file name in the text, empty when there is none."""
    return F.regexp_extract(text, f"({LOG_NAME})", 1)


def is_ipv4(address: Column) -> Column:
    return address.rlike(rf"\A{IPV4}\z")


def is_ipv6(address: Column) -> Column:
    """IPv6 literal without a scope; a dotted tail counts as two groups."""
    groups_only = F.regexp_replace(address, rf":{IPV4}\z", ":0:0")
    groups = F.size(F.filter(F.split(groups_only, ":"), lambda group: group != ""))
    return groups_only.rlike(IPV6_FULL) | (groups_only.rlike(IPV6_SHORT) & (groups <= 7))


def is_address(address: Column) -> Column:
    return F.coalesce(is_ipv4(address) | is_ipv6(address), F.lit(False))
