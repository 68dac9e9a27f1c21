from .incremental import start_incremental

__all__ = ["start_incremental"]
