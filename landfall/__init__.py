"""Land, conform, key and incrementally load tables with Spark."""

from .contracts import Contract
from .functions.digest import KeyMaking, content_key
from .functions.names import key_name, qualified_name, staged_name
from .operators.audit import AUDIT_COLUMNS, stamp
from .operators.changes import first_per_key, new_rows
from .operators.clean import clean, clean_timestamps, settle_future
from .operators.conform import (
    ContractViolation,
    conform,
    null_unsupported,
    project,
    validate,
    violations,
    violations_frame,
)
from .operators.key_filter import KeyFilter
from .operators.keys import KeyMismatch, add_key, key_sample
from .operators.naming import NameCollision, clean_names
from .operators.snapshots import changed_rows, tally_both
from .operators.widening import wider_schema, wider_type
from .plans.discover import discover
from .plans.load import LoadResult, load_table, prepare, rekey
from .plans.run import last_success, load_all, totals
from .plans.spec import TableSpec, missing_tables, select_specs
from .sinks.targets import Target
from .sources.high_water import HighWater
from .sources.jdbc import Database, JdbcTable, Split
from .sources.tables import FrameSource, TableSource, empty_frame, landing_path

__all__ = [name for name in dir() if not name.startswith("_")]
