"""Portable surrogate keys.

The reference hashes business keys with its database's HASH().  We need
a key that (a) both Spark and DuckDB compute identically, (b) keeps
argument order and nulls significant, and (c) stays inside codegen.  Each
argument is written as its length, a colon and its text (a null as a bare
mark), so different argument lists never give the same text; the key is
taken from the md5 of that text.

Keys have 60 bits unless told otherwise: the first 15 hex digits, read as a
non-negative integer.  Of 10^10 such keys some 40 pairs are expected to be
equal; the 128-bit key, the whole md5 as 16 bytes, leaves that out at any
size in reach.  ``operators/key_audit.py`` reports the business
keys that do share a key.  Joins that must not depend on hash collisions use
business keys.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mark standing for NULL and the digits kept.
HK_NULL = "N"
HK_BITS = 60
#: Bits of the key that is the whole md5, as bytes; narrower ones are integers.
HK_WIDE = 128

#: A function from the columns of a business key to its surrogate key.
KeyFunction = Callable[..., Column]


def _checked(bits: int) -> int:
    if bits != HK_WIDE and not (0 < bits <= HK_BITS and bits % 4 == 0):
        raise ValueError(f"a key has {HK_WIDE} bits, or up to {HK_BITS} in steps of 4, not {bits}")
    return bits


def _text(c: Column | str) -> Column:
    if isinstance(c, str):      # one expression text instead of a dozen calls into the JVM
        t = f"CAST(`{c}` AS STRING)"
        return F.expr(f"coalesce(concat(CAST(length({t}) AS STRING), ':', {t}), '{HK_NULL}')")
    text = c.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(HK_NULL))


def canonical(*cols: Column | str) -> Column:
    """The text that is hashed: different argument lists have different texts."""
    return F.concat(*[_text(c) for c in cols])


def hk(*cols: Column | str, bits: int = HK_BITS) -> Column:
    """md5 key over ``cols`` (order and nulls significant): a long, or 16 bytes for 128 bits."""
    digest = F.md5(canonical(*cols))
    if _checked(bits) == HK_WIDE:
        return F.unhex(digest)
    return F.conv(F.substring(digest, 1, bits // 4), 16, 10).cast("bigint")


def key_function(bits: int = HK_BITS) -> KeyFunction:
    return partial(hk, bits=_checked(bits))


def canonical_sql_duckdb(*exprs: str) -> str:
    return " || ".join(f"coalesce(length(CAST({e} AS VARCHAR)) || ':' || CAST({e} AS VARCHAR), '{HK_NULL}')" for e in exprs)


def hk_sql_duckdb(*exprs: str, bits: int = HK_BITS) -> str:
    """The same key as a DuckDB SQL expression (used by the oracle)."""
    digest = f"md5({canonical_sql_duckdb(*exprs)})"
    if _checked(bits) == HK_WIDE:
        return f"unhex({digest})"
    return f"CAST(('0x' || substr({digest}, 1, {bits // 4})) AS BIGINT)"
