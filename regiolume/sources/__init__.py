from regiolume.sources.delimited import (
    lower_names,
    read_csv,
    read_delimited,
    read_named,
    read_tagged,
    rename_by_position,
    text_schema,
)
from regiolume.sources.layouts import Layout, read_layout
from regiolume.sources.lines import (
    header_rows,
    numbered_lines,
    parse_lines,
    read_below_titles,
    read_headed,
    read_header,
    read_tabs,
    report_blocks,
)
from regiolume.sources.sinks import read_report, write_csv, write_report
from regiolume.sources.tables import inline_lookup, read_table

__all__ = [
    "Layout", "header_rows", "inline_lookup", "lower_names", "numbered_lines", "parse_lines", "read_below_titles",
    "read_csv", "read_delimited", "read_headed", "read_header", "read_layout", "read_named", "read_report", "read_table", "read_tabs", "read_tagged",
    "rename_by_position", "report_blocks", "text_schema", "write_csv", "write_report",
]
