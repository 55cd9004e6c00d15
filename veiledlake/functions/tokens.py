"""Token expressions."""

from __future__ import annotations

import hashlib
import secrets

from pyspark.sql import Column
from pyspark.sql import functions as F

from veiledlake.functions.columns import is_blank

BLANKS = ("empty", "null")
_BLOCK = 64  # SHA-256 block size in bytes


def hmac_sha256(text: Column, key: bytes, prefix: str = "") -> Column:
    """HMAC-SHA-256 of a prefix and a text column as 64 hex digits, from built-in hashes."""
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    inner_pad = bytearray(b ^ 0x36 for b in key) + prefix.encode()
    outer_pad = bytearray(b ^ 0x5C for b in key)
    inner = F.sha2(F.concat(F.lit(inner_pad), text.cast("binary")), 256)
    return F.sha2(F.concat(F.lit(outer_pad), F.unhex(inner)), 256)


class KeyedTokens:
    """Tokens computed from a secret key: no lookup, no shuffle.

    The same type and value give the same token in every column, dataset and
    run that uses the key. The key must have at least 16 bytes: short
    identifiers could otherwise be guessed. It appears in query plans, so
    clusters should hide binary literals with ``spark.sql.redaction.string.regex``.
    """

    def __init__(self, key: bytes | str, blank: str = "empty") -> None:
        key = key.encode() if isinstance(key, str) else bytes(key)
        if len(key) < 16:
            raise ValueError("the token key needs at least 16 bytes")
        self._key = key
        self._blank = checked_blank(blank)

    def __repr__(self) -> str:
        return "KeyedTokens(key=<hidden>)"

    def column(self, col: Column, pii_type: str) -> Column:
        text = col.cast("string")
        token = hmac_sha256(text, self._key, pii_type + ":")
        return F.when(is_blank(col), blank_token(self._blank)).otherwise(token)


def checked_blank(blank: str) -> str:
    if blank not in BLANKS:
        raise ValueError(f"blank must be one of {BLANKS}")
    return blank


def blank_token(blank: str) -> Column:
    """What a null or empty value becomes: ``empty`` text, or ``null``."""
    return F.lit("" if blank == "empty" else None).cast("string")


def salted_token(value: Column) -> Column:
    """A fresh random token: SHA-256 over a random salt and the value.

    The salt joins a row-wise UUID with 32 random bytes of this call; neither
    is kept. The result changes each time it is computed, so write it before use.
    """
    return F.sha2(F.concat(F.lit(secrets.token_hex(32)), F.uuid(), value), 256)
