"""Names of the on-disk layouts for saved ranks."""

from __future__ import annotations

CSV = "csv"  # one "page,rank" column, bzip2
URL = "by-url"  # CSV in domain=/protocol= directories
TEXT = "text"  # sorted ('page', rank) lines
LAYOUTS = (CSV, URL, TEXT)


def check_layout(layout: str) -> None:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")


def default_mode(layout: str) -> str:
    """Save mode of a layout unless another is asked for."""
    return "overwrite" if layout == URL else "error"
