"""Code tables of the conversion, kept as data.

Each table is an ordered list of rules ``(conditions, value)``; the first
rule whose conditions all hold wins (searched CASE semantics), otherwise the
default. ``conditions`` maps a role name to the tuple of accepted values.
``build`` turns a table into one ``when`` chain, so it stays a single
JVM-side expression inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the source system's codes for the converted
# data to mean the same thing. Listed in their original order.
# ---------------------------------------------------------------------------

# Fee plan id -> account type id (1 pay-as-you-go, 2 unlimited, 3 goal, 4 VIP).
FEE_PLAN_TYPE = [
    ({"fee_plan": (1, 5)}, 1),
    ({"fee_plan": (9, 2, 6)}, 2),
    ({"fee_plan": (7,)}, 3),
    ({"fee_plan": (3,)}, 4),
]
FEE_PLAN_TYPE_DEFAULT = 1

# Legacy account status -> account status and status change reason.
ACCOUNT_STATUS = [({"account_status": (6,)}, 40)]
ACCOUNT_STATUS_DEFAULT = 10
ACCOUNT_STATUS_REASON = [({"account_status": (6,)}, 44)]
ACCOUNT_STATUS_REASON_DEFAULT = 10

# Card status. Roles: card_status, active (1 when the card is the account's
# active card), block_reason (latest block reason, NULL read as 0).
CARD_STATUS = [
    ({"card_status": (1, 0), "active": (1,)}, 10),
    ({"card_status": (2,)}, 20),
    ({"card_status": (3,), "block_reason": (7,)}, 50),
    ({"card_status": (3,), "block_reason": (2,)}, 40),
    ({"card_status": (3,), "block_reason": (8,)}, 40),
    ({"card_status": (4,)}, 30),
    ({"card_status": (5,)}, 30),
]
CARD_STATUS_DEFAULT = 30

# Card issue reason. Roles: issuance_state, block_reason.
ISSUE_REASON = [
    ({"issuance_state": (1,)}, 1),
    ({"issuance_state": (3,)}, 2),
    ({"block_reason": (2,)}, 8),
    ({"block_reason": (8,)}, 6),
    ({"block_reason": (14,)}, 7),
    ({"block_reason": (1,)}, 5),
    ({"issuance_state": (2,)}, 2),
    ({"issuance_state": (0,)}, 2),
]
ISSUE_REASON_DEFAULT = 6

# Card status change reason. Roles: card_status, block_reason.
STATUS_REASON = [
    ({"card_status": (1, 0)}, 10),
    ({"card_status": (2,)}, 20),
    ({"card_status": (4,)}, 34),
    ({"card_status": (3,), "block_reason": (8,)}, 30),
    ({"card_status": (3,), "block_reason": (14,)}, 80),
    ({"card_status": (3,), "block_reason": (7,)}, 100),
    ({"card_status": (3,), "block_reason": (9,)}, 43),
    ({"card_status": (3,), "block_reason": (2,)}, 90),
    ({"card_status": (3,), "block_reason": (4,)}, 34),
    ({"card_status": (3,)}, 30),
]
STATUS_REASON_DEFAULT = 20

# Card request delivery type id -> text.
DELIVERY_TYPE = [({"delivery": (1,)}, "Standard"), ({"delivery": (2,)}, "Expedited")]
DELIVERY_TYPE_DEFAULT = "UNKNOWN"

# Placeholder card number when no PAN is on file.
MASKED_PAN = "410489XXXXXXXXXX"
# State id when the state text is not in the lookup.
UNKNOWN_STATE = 999
# Person-key and name values that mark test or dummy accounts.
SENTINEL_SSNS = ("999999999", "123456789")
SENTINEL_FIRST_NAME = "FIRST NAME"
# Approved application status; closed account status.
APPROVED_APPLICATION = 7
CLOSED_ACCOUNT_STATUS = 6
CLOSED_TARGET_STATUS = 40
# Mark used when a target is still empty.
EMPTY_MARK = "1900-01-01 00:00:00"
# Wall-clock zone of the legacy system.
LEGACY_ZONE = "America/New_York"

# ---------------------------------------------------------------------------


def build(rules, default, roles: dict[str, Column]) -> Column:
    """Searched CASE over ``rules``; ``roles`` binds role names to columns."""

    def cond(conditions: dict) -> Column:
        parts = [roles[name].isin(*values) for name, values in conditions.items()]
        # A NULL role value never matches (CASE treats unknown as false).
        return reduce(lambda a, b: a & b, parts)

    expr = None
    for conditions, value in rules:
        expr = (F.when(cond(conditions), F.lit(value)) if expr is None
                else expr.when(cond(conditions), F.lit(value)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def sql_case(rules, default, roles: dict[str, str]) -> str:
    """Same table as SQL text (used by the oracles)."""

    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    parts = []
    for conditions, value in rules:
        c = " AND ".join(
            f"{roles[name]} IN ({', '.join(lit(v) for v in values)})"
            for name, values in conditions.items())
        parts.append(f"WHEN {c} THEN {lit(value)}")
    return f"CASE {' '.join(parts)} ELSE {lit(default)} END"
