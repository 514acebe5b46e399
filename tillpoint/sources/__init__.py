"""Reading, writing and binding the retail tables."""

from tillpoint.sources.binding import bind
from tillpoint.sources.files import load_table, read_table, read_tables, write_csv

__all__ = ["bind", "load_table", "read_table", "read_tables", "write_csv"]
