from . import feeds, kafka, keyed, listing, lookups, slices  # noqa: F401
