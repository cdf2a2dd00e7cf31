from . import batches, files, jdbc, keyed, ledger  # noqa: F401
