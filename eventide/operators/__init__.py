from .scan import keyed_scan, running_count, sequence_number  # noqa: F401
