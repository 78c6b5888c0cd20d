from .fixtures import raw_from_driver_tables, COUNTRY_BY_NATION_KEY
from .raw import (read_raw, type_raw, union_sources, route_sources, write_sources,
                  read_sources, SOURCES, source_rank_of)
from .sinks import write_clean, read_clean, write_forecast, write_star_jdbc

__all__ = [
    "raw_from_driver_tables", "COUNTRY_BY_NATION_KEY", "read_raw", "type_raw",
    "union_sources", "route_sources", "write_sources", "read_sources", "SOURCES",
    "source_rank_of", "write_clean", "read_clean", "write_forecast",
    "write_star_jdbc",
]
