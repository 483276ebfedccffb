"""Object-key helpers used for lineage and archiving."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffix an encrypted drop carries and the cold-storage prefix.
ENCRYPTED_SUFFIX = ".pgp"
COLD_PREFIX = "s3://vendor-archive/2026/"


def basename_of(key: str) -> str:
    """Last path segment of an object key (plain Python, for scalar keys)."""
    return key.rstrip("/").split("/")[-1]


def decrypted_name(key: str) -> str:
    """Basename with the encryption suffix removed: what landing rows carry."""
    name = basename_of(key)
    return name[: -len(ENCRYPTED_SUFFIX)] if name.endswith(ENCRYPTED_SUFFIX) else name


def basename_col(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.element_at(F.split(c, "/"), -1)


def cold_path(c: Column | str, prefix: str = COLD_PREFIX) -> Column:
    """Archive location: ``prefix`` + basename of the processed file."""
    return F.concat(F.lit(prefix), basename_col(c))
