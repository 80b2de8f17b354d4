"""Enum spellings by index (fixed values; the order is that of the wire format)."""

ROLE = ("REGIONAL_OPERATOR", "REAL_ESTATE_INVESTOR", "REAL_ESTATE_DEVELOPER", "LAWYER", "LETTING_AGENT", "SPV_CONFIRMATION")
ACCESS_PERMISSION = ("COMPLIANT", "REVOKED")
REGION_STATUS = ("PROPOSING", "PASSED", "REJECTED")
VOTE = ("YES", "NO", "ABSTAIN")
LISTING_STATUS = ("PENDING_ASSETS", "LISTED", "SOLD_OUT", "LEGAL", "FINALIZED", "EXPIRED", "CANCELLED", "REFUNDING")
DOCUMENT_STATUS = ("PENDING", "APPROVED", "REJECTED")
ACTION_TYPE = ("CONFIG_INITIALIZED", "AUTHORITY_UPDATE_PROPOSED", "AUTHORITY_UPDATED", "ADMIN_ADDED", "ADMIN_REMOVED", "ROLE_ASSIGNED", "ROLE_REMOVED", "ROLE_RENOUNCED", "PERMISSION_UPDATED")
REMOVAL_KIND = {"ROLE_REMOVED": "REMOVED", "ROLE_RENOUNCED": "RENOUNCED"}
