"""Row identity: content hashes and numeric ids."""

from pyspark.sql import functions as F


def canonical_body(columns):
    """JSON text of the columns in the given order. Fields that are NULL are left out."""
    return F.to_json(F.struct(*columns))


def content_id(columns, bits=512):
    """SHA-2 of the canonical body."""
    return F.sha2(canonical_body(columns), bits)


def stable_guid(content):
    """64-bit id that is the same in every run. Equal content has an equal id, and unequal
    content may collide, so the content id stays the key."""
    return F.xxhash64(content)


def dense_guid(minute, sequence):
    """Event minute followed by a nine-digit sequence number; NULL when it exceeds 64 bits."""
    return F.concat(minute, F.lpad(sequence.cast("string"), 9, "0")).try_cast("long")
