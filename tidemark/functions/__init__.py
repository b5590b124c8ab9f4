from tidemark.functions.versions import current_status, is_active, newest_first, oldest_first, same_key

__all__ = ["current_status", "is_active", "newest_first", "oldest_first", "same_key"]
