from tidemark.streaming.pickup import pick_up_new_files

__all__ = ["pick_up_new_files"]
