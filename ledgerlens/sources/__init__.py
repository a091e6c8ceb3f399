from .report_csv import read_report_csv, write_report_csv  # noqa: F401
from .tables import Tables, load_tables  # noqa: F401
