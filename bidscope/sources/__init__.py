"""Sources and sinks: table readers, the app-name mapping, the test fixture, report writers."""

from bidscope.sources.tables import FunnelSources, TableSource, day_window, load_sources, load_table

__all__ = ["FunnelSources", "TableSource", "day_window", "load_sources", "load_table"]
