from . import landing, progress, statistics  # noqa: F401
