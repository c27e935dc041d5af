"""Readers and writers."""

from proxysift.sources.readers import ranked_labels, read_lines, read_ranked_domains, read_records
from proxysift.sources.sinks import load_model, publish, removed, save_model, write_table

__all__ = [
    "load_model", "publish", "ranked_labels", "read_lines", "read_ranked_domains", "read_records",
    "removed", "save_model", "write_table",
]
