"""Payload checksums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Checksum type names and the SHA-2 widths they stand for.
SHA2_BITS = {"SHA224": 224, "SHA256": 256, "SHA384": 384, "SHA512": 512}


def digest(content: Column, algo: str) -> Column:
    """Checksum of the payload, algorithm named by a literal."""
    name = algo.upper().replace("-", "")
    if name in SHA2_BITS:
        return F.sha2(content, SHA2_BITS[name])
    if name == "SHA1":
        return F.sha1(content)
    if name == "MD5":
        return F.md5(content)
    raise ValueError(f"unsupported checksum type: {algo}")


def digest_by(content: Column, checksum_type: Column) -> Column:
    """Checksum by the row's own type, null where the type is not supported."""
    name = F.replace(F.upper(checksum_type), F.lit("-"), F.lit(""))
    chain = F.when(name == "SHA1", F.sha1(content)).when(name == "MD5", F.md5(content))
    for algo, bits in SHA2_BITS.items():
        chain = chain.when(name == algo, F.sha2(content, bits))
    return chain
