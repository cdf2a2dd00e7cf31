from . import audit, devices, quality, rates, sessions, slice_job  # noqa: F401
