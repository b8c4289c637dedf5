from tallyloom.sources.delimited import read_delimited, write_delimited
from tallyloom.sources.scratch import ensure_checkpoint_dir, scratch_path
from tallyloom.sources.tables import cars, dealt, table, trips

__all__ = [
    "cars",
    "dealt",
    "ensure_checkpoint_dir",
    "read_delimited",
    "scratch_path",
    "table",
    "trips",
    "write_delimited",
]
