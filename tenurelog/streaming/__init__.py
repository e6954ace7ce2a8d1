from .upsert import merge_batch, refresh_history, stream_upsert

__all__ = ["merge_batch", "refresh_history", "stream_upsert"]
