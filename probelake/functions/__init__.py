from . import parsing, radius, scalars, times  # noqa: F401
