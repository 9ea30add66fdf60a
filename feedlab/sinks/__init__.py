"""Where results go."""

from feedlab.sinks.files import write_csv, write_tsv
from feedlab.sinks.tables import (append_slices, create_slices_table, read_slices, write_log, write_slices,
                                  write_slices_table)

__all__ = ["append_slices", "create_slices_table", "read_slices", "write_csv", "write_log", "write_slices",
           "write_slices_table", "write_tsv"]
