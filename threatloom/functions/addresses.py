"""IP address text: canonical form, and the seed address of an indicator record."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatloom.functions.scalars import first_where, json_string, json_text, strip

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"


@F.pandas_udf(T.StringType())
def _ipv6_text(values: pd.Series) -> pd.Series:
    def canonical(text):
        try:
            return str(ipaddress.IPv6Address(text))
        except ValueError:
            return None

    return values.map(canonical, na_action="ignore").astype(object)


def normalize_ipv4(text: Column) -> Column:
    """Canonical IPv4 of ``a.b.c.d`` or ``a.b.c.d:anything``; null otherwise. Stays in the JVM."""
    clean = strip(text)
    bare = F.regexp_extract(clean, rf"^({_IPV4})\s*(?::[^:]*)?$", 1)
    return F.nullif(bare, F.lit(""))


def normalize_ip(text: Column) -> Column:
    """Canonical IPv4 or IPv6 text. Only values with two or more colons carry data to the Arrow function."""
    clean = strip(text)
    maybe_v6 = F.when(clean.rlike(":.*:"), clean)
    return F.coalesce(normalize_ipv4(text), _ipv6_text(maybe_v6))


def seed_ip(record: Column) -> Column:
    """First usable address among the address-bearing fields of an indicator record (VARIANT)."""
    kind = F.lower(F.coalesce(json_text(record, "$.ioc_type"), F.lit("")))
    own_ip = json_string(record, "$.ip")
    fields = ["ioc", "ioc_value", "ip", "host"]
    candidates = F.array(
        *[
            F.struct(
                json_string(record, f"$.{name}").alias("raw"),
                normalize_ip(json_string(record, f"$.{name}")).alias("ip"),
            )
            for name in fields
        ]
    )
    usable = lambda c: c["ip"].isNotNull() & (
        kind.contains("ip") | c["raw"].eqNullSafe(own_ip) | c["ip"].contains(".")
    )
    return first_where(candidates, usable)["ip"]
