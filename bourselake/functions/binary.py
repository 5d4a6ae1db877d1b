"""Attachment bytes: the serialised-array envelope, and file types by their first bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: first bytes of the envelope; where its big-endian length and its payload begin (1-based)
ENVELOPE = "ACED0005757200025B42"
LENGTH_AT, PAYLOAD_AT = 24, 28

# fixed values: first bytes of file types
MAGIC = {"pdf": "25504446", "png": "89504E470D0A1A0A", "jpeg": "FFD8FF", "gif": "47494638", "bmp": "424D", "tiff": "49492A00"}


def _bytes(hexes: str) -> Column:
    return F.unhex(F.lit(hexes))


def payload_size(content: Column) -> Column:
    """The length that an envelope declares; null without an envelope."""
    enveloped = F.startswith(content, _bytes(ENVELOPE)) & (F.octet_length(content) >= PAYLOAD_AT - 1)
    return F.when(enveloped, F.conv(F.hex(F.substring(content, LENGTH_AT, 4)), 16, 10).cast("long"))


def unwrap_bytes(content: Column) -> Column:
    """The payload of an envelope, cut at its declared length; other content as it is."""
    declared = payload_size(content)
    size = F.least(declared, F.octet_length(content).cast("long")).cast("int")  # least() passes over nulls
    return F.when(declared.isNotNull(), F.substring(content, F.lit(PAYLOAD_AT), size)).otherwise(content)


def sniff_type(content: Column) -> Column:
    kind = F.when(F.lit(False), "")
    for name, head in MAGIC.items():
        kind = kind.when(F.startswith(content, _bytes(head)), name)
    kind = kind.when(F.startswith(content, _bytes("4D4D002A")), "tiff")
    kind = kind.when(F.startswith(content, _bytes("52494646")) & (F.substring(content, 9, 4) == _bytes("57454250")), "webp")
    return kind.otherwise("unsupported")
