"""Role-based column masks.

A policy is a Column builder evaluated for a given role; ``apply_policies``
rewrites the listed columns in one projection and leaves the others as they
are, which is what a role-specific view exposes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Roles that see unmasked data.
PRIVILEGED_ROLES = ("LAB_ADMIN", "ACCOUNTADMIN")
MASK_TEXT = "***MASKED***"


def _privileged(role: str, privileged: Sequence[str]) -> Column:
    return F.lit(role).isin(list(privileged))


def mask_string(c, role: str, privileged: Sequence[str] = PRIVILEGED_ROLES) -> Column:
    """GOV-01 full mask unless the role is privileged."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(_privileged(role, privileged), c).otherwise(F.lit(MASK_TEXT))


def mask_date(c, role: str, privileged: Sequence[str] = PRIVILEGED_ROLES) -> Column:
    """GOV-02 date -> NULL unless privileged."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(_privileged(role, privileged), c).otherwise(F.lit(None).cast("date"))


def mask_name(c, role: str, privileged: Sequence[str] = PRIVILEGED_ROLES) -> Column:
    """GOV-03 first letter + '***' unless privileged (NULL stays NULL)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(_privileged(role, privileged), c).otherwise(F.concat(F.left(c, F.lit(1)), F.lit("***")))


POLICIES: dict[str, Callable[..., Column]] = {"string": mask_string, "date": mask_date, "name": mask_name}


def apply_policies(df: DataFrame, policies: Mapping[str, str], role: str) -> DataFrame:
    """GOV-04 apply {column: policy kind} for a role; unlisted columns unchanged."""
    return df.withColumns({c: POLICIES[kind](c, role).alias(c) for c, kind in policies.items()})


def assert_redacted_before(df: DataFrame, text_col: str, patterns: Sequence[str]) -> DataFrame:
    """GOV-05 rows whose text still matches a PII pattern (expected empty downstream of redaction)."""
    cond = None
    for p in patterns:
        m = F.col(text_col).rlike(p)
        cond = m if cond is None else cond | m
    return df.where(cond)
