from stellate.streaming.refresh import append_new_keys, refresh_once, start_refresh

__all__ = ["append_new_keys", "refresh_once", "start_refresh"]
