from .tables import load, events, table_path  # noqa: F401
from .rides import ride_events, fares  # noqa: F401
from .lines import parse_lines, render_lines, read_lines  # noqa: F401
