"""Tables written in the folder that the driver and all executors share."""

from ..scratch import Scratch, read_in_task, shared_dir

__all__ = ["Scratch", "read_in_task", "shared_dir"]
