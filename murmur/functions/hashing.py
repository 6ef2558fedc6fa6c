"""Hashes as native expressions: stable row ids (C12) and keyed pseudonyms (C11, HMAC-SHA256).

HMAC is built from `sha2` over binary concatenation: H((K^opad) || H((K^ipad) || m)). The two
padded keys are computed once on the driver from the secret and enter the plan as binary
literals, so hashing stays inside whole-stage codegen.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64   # SHA-256 block size in bytes


def _pads(secret: bytes) -> tuple[bytes, bytes]:
    if len(secret) > BLOCK:
        secret = hashlib.sha256(secret).digest()
    key = secret.ljust(BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_sha256(text: Column | str, secret: str | bytes) -> Column:
    """Hex HMAC-SHA256 of the UTF-8 bytes of `text` (NULL stays NULL)."""
    c = F.col(text) if isinstance(text, str) else text
    ipad, opad = _pads(secret.encode() if isinstance(secret, str) else secret)
    inner = F.unhex(F.sha2(F.concat(F.lit(ipad), F.encode(c, "UTF-8")), 256))
    return F.sha2(F.concat(F.lit(opad), inner), 256)


def make_id(*cols: Column | str, algo: str = "md5") -> Column:
    """Stable id from several parts joined by ':' (NULL parts become '')."""
    parts = F.concat_ws(":", *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols])
    if algo == "md5":
        return F.md5(parts)
    if algo == "sha1":
        return F.sha1(parts)
    return F.sha2(parts, 256)


def privacy_projection(df, author_cols=("author",), secret: str | bytes | None = None, drop: bool = False):
    """C11: the storage-side privacy rule as one projection. Author columns are replaced by their
    keyed pseudonym (or dropped when `drop` or no secret), and fields whose name starts with '_'
    (plugin-private values) are left out."""
    cols = []
    for c in df.columns:
        if c.startswith("_"):
            continue
        if c in author_cols:
            if drop or secret is None:
                continue
            cols.append(hmac_sha256(c, secret).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
