"""Pseudonyms and deterministic per-user sampling as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUCKET_MAX = float(0xFFFFFFFF)


def _require_salt(salt: str) -> None:
    if not salt:
        raise ValueError("salt must not be empty")


def _salted_digest(did: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{salt}:"), did), 256)


def hash_user_id(did: Column, salt: str) -> Column:
    """Salted SHA-256 hex digest. An empty or null id fails the job."""
    _require_salt(salt)
    missing = did.isNull() | (did == "")
    return F.when(missing, F.raise_error(F.lit("user id must not be empty"))).otherwise(
        _salted_digest(did, salt)
    )


def hash_target_id(did: Column, salt: str) -> Column:
    """Like hash_user_id, but an absent target stays null."""
    _require_salt(salt)
    return F.when(did != "", _salted_digest(did, salt))


def sample_bucket(user_id_hash: Column) -> Column:
    """First 32 bits of the digest scaled to [0, 1]."""
    prefix = F.conv(F.substring(user_id_hash, 1, 8), 16, 10)
    return prefix.cast("double") / F.lit(_BUCKET_MAX)


def is_sampled(user_id_hash: Column, rate: float) -> Column:
    """A user is wholly inside or wholly outside the sample."""
    if not 0.0 <= rate <= 1.0:
        raise ValueError("sampling rate must be between 0 and 1")
    return sample_bucket(user_id_hash) < F.lit(float(rate))


_DIGEST, _TEXT = bytearray(b"\x01"), bytearray(b"\x00")


def packed(name: Column) -> Column:
    """A pseudonym in half its bytes, for the way through a shuffle; any other text as it is.

    Different texts stay different, and null stays null.
    """
    is_digest = name.rlike(r"\A[0-9a-f]{64}\z")
    return F.when(is_digest, F.concat(F.lit(_DIGEST), F.unhex(name))).otherwise(
        F.concat(F.lit(_TEXT), name.cast("binary"))
    )


def unpacked(name: Column) -> Column:
    """The text that was packed."""
    kind, rest = F.substring(name, 1, 1), F.substring(name, 2, 2**31 - 1)
    return F.when(kind == F.lit(_DIGEST), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def with_packed(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: packed(F.col(n)) for n in names if n in rows.columns})


def with_unpacked(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: unpacked(F.col(n)) for n in names if n in rows.columns})
