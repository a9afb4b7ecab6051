"""Deterministic record ids as built-in expressions."""

from pyspark.sql import Column, functions as F

from basketstream.fixed_values import ID_NAMESPACE, UUID_PATTERN


def uuid5(name: Column, namespace: str = ID_NAMESPACE) -> Column:
    """Version-5 UUID text of ``name``: SHA-1 of namespace bytes and name bytes."""
    prefix = F.unhex(F.lit(namespace.replace("-", "")))
    digest = F.sha1(F.concat(prefix, F.encode(name, "UTF-8")))
    # The lambda gives the digest a name, so it is computed once and not per slice.
    return F.transform(F.array(digest), _uuid5_text)[0]


def _uuid5_text(digest: Column) -> Column:
    # The two high bits of the clock-sequence digit are fixed to binary 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def record_id(source_file: Column, row_number: Column) -> Column:
    """Id of a source row; null for a negative row number, which has no id."""
    name = F.concat(source_file, F.lit(":"), row_number.cast("string"))
    return F.when(row_number >= 0, uuid5(name))


def dead_letter_id(source_file: Column, row_number: Column) -> Column:
    name = F.concat(F.lit("dlq:"), source_file, F.lit(":"), row_number.cast("string"))
    return uuid5(name)


def is_uuid(value: Column) -> Column:
    """True for UUID text of any version and any letter case; null stays null."""
    return value.rlike(UUID_PATTERN)
