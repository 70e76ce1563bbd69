"""Identifiers and stable hashes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_pad(number: Column, width: int) -> Column:
    """Left-pad with zeros to at least ``width``; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def envelope_id(project_id: Column) -> Column:
    return F.concat(F.lit("ENV-"), F.upper(F.substring(F.md5(project_id), 1, 12)))


def pair_key(source_a: Column, record_a: Column, source_b: Column, record_b: Column) -> Column:
    """Pair id from its content: no numbering pass and stable across runs."""
    text = F.concat_ws("|", source_a, record_a, source_b, record_b)
    return F.concat(F.lit("PAIR-"), F.upper(F.md5(text)))


_TEXT_MARK = bytes(17)  # a marked text is longer than a digest


def packed_id(pair_id: Column) -> Column:
    """A pair id as the 16 bytes of its digest; any other text as its bytes and a mark, so that no two ids are equal."""
    digest = F.unhex(F.substring(pair_id, 6, 32))
    return F.when(F.concat(F.lit("PAIR-"), F.hex(digest)) == pair_id, digest).otherwise(F.concat(pair_id.cast("binary"), F.lit(_TEXT_MARK)))


def unpacked_id(packed: Column) -> Column:
    """The pair id of ``packed_id``."""
    text = F.substring(packed, F.lit(1), F.length(packed) - len(_TEXT_MARK)).cast("string")
    return F.when(F.length(packed) <= 16, F.concat(F.lit("PAIR-"), F.hex(packed))).otherwise(text)


def shuffle_hash(c: Column, seed: int) -> Column:
    """Hex digest that orders rows as if shuffled with ``seed``."""
    return F.md5(F.concat(F.lit(f"{seed}|"), c.cast("string")))


def hash_int(c: Column, seed: int, modulus: int) -> Column:
    """Stable pseudo-random integer in [0, modulus)."""
    head = F.conv(F.substring(shuffle_hash(c, seed), 1, 7), 16, 10).cast("long")
    return head % F.lit(modulus)


def hash_mod(c: Column, seed: int, modulus: int) -> Column:
    """Like ``hash_int``, for moduli of up to 56 bits."""
    head = F.conv(F.substring(shuffle_hash(c, seed), 1, 14), 16, 10).cast("long")
    return head % F.lit(modulus)


def sha256_mod100(c: Column) -> Column:
    """SHA-256 of the text as one big integer, modulo 100.

    The digest is read as eight 32-bit digits; 2**32 mod 100 is 96.
    """
    digest = F.sha2(c.cast("string"), 256)
    rest = F.lit(0).cast("long")
    for i in range(8):
        digit = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
        rest = (rest * 96 + digit) % 100
    return rest


def is_sampled(c: Column, fraction: float) -> Column:
    """Deterministic sampler on the SHA-256 value; the cut is rounded half to even."""
    if fraction <= 0:
        return F.lit(False)
    if fraction >= 1:
        return F.lit(True)
    return sha256_mod100(c) < round(fraction * 100)
