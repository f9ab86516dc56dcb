"""keelson: change-data replication as Spark plans.

"""

from .operators.apply import (apply_changes, bootstrap, delete,  # noqa: F401
                              insert_if_absent, upsert)
from .operators.batches import batch_summary, plan_batches  # noqa: F401
from .operators.changes import net_changes, tombstones  # noqa: F401
from .operators.rows import (check_duplicates, conform, require,  # noqa: F401
                             required_fields, typed_parse)
from .operators.unchanged import apply_with_unchanged  # noqa: F401
from .sinks.target import CatalogTarget, CsvTarget, FileTarget  # noqa: F401
from .sources.messages import decode_messages  # noqa: F401
from .sources.snapshot import copy_lines_to_rows as copy_text  # noqa: F401
from .sources.snapshot import read_snapshot as snapshot  # noqa: F401
from .streaming.messages import replicate_messages  # noqa: F401
from .streaming.replicate import replicate  # noqa: F401
