"""Compression and the encrypted line format.

Spark has no gzip function, so (in/de)flating is the one place where text
passes through Python, in Arrow batches; AES, hex and base64 stay in the JVM.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.BinaryType())
def gzip_bytes(text: pd.Series) -> pd.Series:
    return text.map(lambda s: None if s is None else gzip.compress(s.encode("utf-8"), mtime=0))


@F.pandas_udf(T.BinaryType())
def zlib_bytes(text: pd.Series) -> pd.Series:
    return text.map(lambda s: None if s is None else zlib.compress(s.encode("utf-8")))


def _inflated(data) -> str | None:
    # 32 + MAX_WBITS: the header says whether it is gzip or zlib
    try:
        return zlib.decompress(data, 32 + zlib.MAX_WBITS).decode("utf-8")
    except (zlib.error, UnicodeDecodeError, TypeError):
        return None


@F.pandas_udf(T.StringType())
def inflate_bytes(data: pd.Series) -> pd.Series:
    """gzip or zlib bytes to text; NULL where they are neither."""
    return data.map(_inflated)


@F.pandas_udf(T.StringType())
def inflate_first(candidates: pd.Series) -> pd.Series:
    """Text of the first candidate that inflates."""
    return candidates.map(
        lambda row: None if row is None else next((t for t in map(_inflated, row) if t is not None), None)
    )


def inflate_text(text: Column) -> Column:
    """Base64 of gzip/zlib text to plain text; anything else is given back as it is."""
    packed = F.when(text.rlike("^[A-Za-z0-9+/\\s]+=*$"), F.try_to_binary(text, F.lit("base64")))
    return F.coalesce(inflate_bytes(packed), text)


LONG_TEXT = 1000


def deflate_long(text: Column, longer_than: int = LONG_TEXT) -> Column:
    """Base64 of the zlib bytes for texts above the limit; shorter ones unchanged."""
    long_ = F.when(F.length(text) > longer_than, text)
    # base64() breaks lines every 76 characters
    return F.coalesce(F.translate(F.base64(zlib_bytes(long_)), "\r\n", ""), text)


def encrypt_line(text: Column, key: str) -> Column:
    """``hex(iv):hex(ciphertext)`` of the gzipped text; ``key`` is base64, the IV random."""
    sealed = F.hex(F.aes_encrypt(gzip_bytes(text), F.unbase64(F.lit(key)), F.lit("CBC"), F.lit("PKCS")))
    # named once: the IV is random, and an expression named twice may be computed twice
    return F.lower(F.regexp_replace(sealed, "^(.{32})", "$1:"))


def decrypt_line(line: Column, keys: Sequence[str]) -> Column:
    """Plain text by the first key whose decryption also inflates; NULL if none does.

    A wrong key can give valid padding by chance, so inflating decides.
    """
    sealed = F.when(
        line.rlike("^[0-9A-Fa-f]{32}:(?:[0-9A-Fa-f]{32})+$"), F.unhex(F.translate(line, ":", ""))
    )
    candidates = F.array(
        *(F.try_aes_decrypt(sealed, F.unbase64(F.lit(k)), F.lit("CBC"), F.lit("PKCS")) for k in keys)
    )
    return inflate_first(candidates)
