"""Fixed table layouts of the privacy data model.

Every tabular column is a nullable string; dates, flags and numbers stay
strings, exactly as the upstream exports deliver them.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Customer export columns, in file order.
CUSTOMER_COLUMNS = [
    "id", "email", "created_at", "updated_at", "first_name", "last_name",
    "contact_number", "reference", "is_rewards_user", "has_sent_feedback",
    "has_opted_in", "level_up_id", "birthday", "has_sent_support",
    "rewards_started_at", "settings", "use_credit", "tracking_uuid",
]

# Columns blanked to '' in the de-identified copy.
PII_COLUMNS = ["email", "first_name", "last_name", "contact_number", "birthday"]

IDENTITY_COLUMNS = ["sourceSystemId", "uuid"]
DELETION_COLUMNS = ["email"]
AUDIT_COLUMNS = ["source", "source_id", "email", "created_at", "dtc"]


def _strings(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


CUSTOMERS = _strings(CUSTOMER_COLUMNS)
IDENTITY = _strings(IDENTITY_COLUMNS)
DELETIONS = _strings(DELETION_COLUMNS)
AUDIT = _strings(AUDIT_COLUMNS)
DEIDENTIFIED = _strings(CUSTOMER_COLUMNS + ["gid", "dtc"])
SECURED = DEIDENTIFIED
