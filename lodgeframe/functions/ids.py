"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the DNS namespace of RFC 4122.
DNS_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5_dns(name: Column) -> Column:
    """Version-5 UUID of ``name`` in the DNS namespace: SHA-1, then version and variant nibbles."""
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE_HEX)), F.encode(name, "UTF-8")))
    variant_nibble = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant_nibble, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
