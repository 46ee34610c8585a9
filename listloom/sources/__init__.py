"""Where lists come from: configuration files, files and HTTP."""

from listloom.sources.config import enabled_sources, load_sources, sources_frame
from listloom.sources.lists import fetch, read_contents, read_files, read_lines, readable

__all__ = ["enabled_sources", "fetch", "load_sources", "read_contents", "read_files", "read_lines", "readable", "sources_frame"]
