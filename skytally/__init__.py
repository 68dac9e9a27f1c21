"""skytally: cumulative on-time flight metrics as Spark DataFrame jobs."""

from .plans.batch import BatchResult, RunOptions, run_batch
from .session import checkpoint_root, make_session
from .sources.text_state import import_text_state
from .state import StateStore
from .streaming import start_incremental

__all__ = [
    "BatchResult",
    "RunOptions",
    "StateStore",
    "checkpoint_root",
    "import_text_state",
    "make_session",
    "run_batch",
    "start_incremental",
]
