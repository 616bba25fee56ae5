"""Input locations as configuration.

The reference keeps one path variable per input and builds the per-hospital
programming paths from a folder and file names. ``InputPaths`` holds the same
information; ``Tables.from_paths`` reads it with declared schemas.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Source:
    """One input: location, format and text options."""

    path: str
    fmt: str = "parquet"          # parquet | csv
    sep: str = ","
    encoding: str = "UTF-8"
    skip_lines: int = 0           # banner lines above the header (S1)

    def text_options(self) -> dict:
        return {"sep": self.sep, "encoding": self.encoding, "skip_lines": self.skip_lines}


@dataclass(frozen=True)
class InputPaths:
    """Every input of the analyses."""

    establishments: Source
    abbreviations: Source
    specialties: Source
    exit_reasons: Source
    open_list: Source
    closed_list: Source
    production: Source
    registry: Source
    referral_map: Source
    programming_folder: str = ""
    programming_files: dict[str, str] = field(default_factory=dict)   # hospital -> file name
    programming_format: str = "parquet"                               # parquet | csv (columns found by header)
    programming_sep: str = ","
    programming_encoding: str = "UTF-8"
    programming_skip_lines: int = 0
    programming_renames: dict[str, dict[int, str]] = field(default_factory=dict)  # hospital -> place -> name (D5)
    # sigte, portfolio, network_sites, specialty_subset, yield_table, projection, programmed_activities
    extras: dict[str, Source] = field(default_factory=dict)

    def programming_source(self) -> Source:
        """Format and text options of the hospitals' sheets."""
        return Source(self.programming_folder, self.programming_format, self.programming_sep, self.programming_encoding,
                      self.programming_skip_lines)

    def programming_paths(self) -> dict[str, str]:
        """``paste0(folder, '/X.xlsx')`` for every hospital."""
        return {site: os.path.join(self.programming_folder, name) for site, name in self.programming_files.items()}
