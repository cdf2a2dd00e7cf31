from . import cells, compaction, enrich, kpi, lists, offsets, reports  # noqa: F401
