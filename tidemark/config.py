"""Fixed values of the table layout.

These must stay as they are for tables written by earlier runs to be read
back correctly: the open-end date marks the current partition, the audit
columns are stored in this order, and the flag letters are the change codes.
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values: table layout -------------------------------------------
OPEN_END = _dt.date(9999, 12, 31)          # end_dt of a row that is still current
AUDIT_COLUMNS = ("audit_flag", "bgn_dt", "end_dt", "audit_inserted_ts")
PARTITION_COLUMN = "end_dt"
FINGERPRINT_COLUMN = "row_md5"

# --- fixed values: change flags -------------------------------------------
INSERTED = "I"
UPDATED = "U"
UNCHANGED = "Z"
DELETED = "D"

# --- fixed values: SCD type 2 (flag style) ---------------------------------
LATEST = 1          # flag of the version in force
EXPIRED = 0         # flag of a replaced version
SCD2_FLAG = "flag"
SCD2_EXPIRY = "expiry_date"

# --- fixed values: folders under <root>/<table>/ ---------------------------
PREP_DIR = "prep"
TARGET_DIR = "tgt"
STAGE_DIR = "temp"
BACKUP_DIR = "currbackup"
REJECT_DIR = "rejected"
RUNS_DIR = "runs"
VERSIONS_DIR = "versions"
BACKUPS_DIR = "backups"
