from . import geo, text, timecols  # noqa: F401
