from .runner import drain  # noqa: F401
