"""IP address expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Textual shapes and the private blocks.
IPV4_SHAPE = r"^(?:0|[1-9]\d{0,2})(?:\.(?:0|[1-9]\d{0,2})){3}$"
IPV6_SHAPE = r"^(?=[^:]*:[^:]*:)[0-9A-Fa-f:]+(?:\d+(?:\.\d+){3})?$"
IPV6_PRIVATE = r"^[fF][cCdD][0-9A-Fa-f]{2}:"
IPV4_PRIVATE = (
    ("10.0.0.0", "10.255.255.255"),
    ("172.16.0.0", "172.31.255.255"),
    ("192.168.0.0", "192.168.255.255"),
)


def ipv4_number(text: str) -> int:
    a, b, c, d = (int(p) for p in text.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def ipv4_to_long(ip: Column) -> Column:
    """Dotted quad to BIGINT, NULL when it is not a valid IPv4 address."""
    parts = F.transform(F.split(ip, r"\."), lambda p: p.try_cast("long"))
    valid = ip.rlike(IPV4_SHAPE)
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc * 256 + p)
    return F.when(valid, F.when(F.forall(parts, lambda p: p <= 255), number))


def is_valid_ip(ip: Column) -> Column:
    return ipv4_to_long(ip).isNotNull() | ip.rlike(IPV6_SHAPE)


def is_private_ip(ip: Column) -> Column:
    """True in 10/8, 172.16/12, 192.168/16, fc00::/7; NULL for an invalid address."""
    n = ipv4_to_long(ip)
    v4 = reduce(
        lambda x, y: x | y,
        [n.between(ipv4_number(lo), ipv4_number(hi)) for lo, hi in IPV4_PRIVATE],
    )
    return F.when(n.isNotNull(), v4).when(ip.rlike(IPV6_SHAPE), ip.rlike(IPV6_PRIVATE))
