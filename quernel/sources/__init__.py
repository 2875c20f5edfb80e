from quernel.sources.readers import (
    adjacency_lines,
    colour_rows,
    comments,
    file_label,
    literal_rows,
    load_table,
    observations,
    page_counts,
    page_lines,
    text_lines,
    tmax_series,
)
from quernel.sources.writers import (
    save_csv,
    save_json,
    save_lines,
    save_partitioned,
    save_routed,
    save_table,
    save_tabbed,
)

__all__ = [
    "adjacency_lines",
    "colour_rows",
    "comments",
    "file_label",
    "literal_rows",
    "load_table",
    "observations",
    "page_counts",
    "page_lines",
    "save_csv",
    "save_json",
    "save_lines",
    "save_partitioned",
    "save_routed",
    "save_table",
    "save_tabbed",
    "text_lines",
    "tmax_series",
]
