"""The file formats that can be read and written."""

from __future__ import annotations

FORMATS = ("csv", "json", "parquet", "orc")


def checked_format(fmt: str) -> str:
    """Return the format name in lower case, or raise ValueError if it is not supported."""
    name = fmt.lower()
    if name not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}, use one of {', '.join(FORMATS)}")
    return name
