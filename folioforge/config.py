"""Layout and map constants, at 150 dots an inch."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Config:
    # Fixed values; max_column_gap_ink_fraction and max_spacing_cv are read by nothing.
    ink_threshold: int = 200
    max_ink_fraction: float = 0.005
    min_ink_for_content: int = 3
    max_column_gap_ink_fraction: float = 0.03
    min_vert_gap_px: int = 10
    min_horiz_gap_px: int = 5
    min_column_fraction: float = 0.25
    max_ink_density_ratio: float = 10.0
    max_bridge_density_fraction: float = 0.3
    footer_cluster_max_px: int = 150
    footer_first_gap_min_px: int = 15
    footer_content_gap_min_px: int = 15
    footer_extra_cluster_max_px: int = 35
    footer_extra_passes: int = 3
    footer_tiny_cluster_max_px: int = 5
    bottom_margin_padding_px: int = 3
    min_row_split_px: int = 20
    min_table_horiz_gaps: int = 10
    min_map_ink_fraction: float = 0.2
    max_map_horiz_gaps: int = 3
    max_map_vert_gaps: int = 1
    map_image_zone_fraction: float = 0.5
    map_canny_low_threshold: int = 20
    map_canny_high_threshold: int = 60
    hough_vote_fraction: float = 0.15
    min_peak_strength: float = 0.25
    peak_merge_window: int = 3
    hex_angle_tolerance: int = 8
    grid_angle_tolerance: int = 8
    min_hex_peak: float = 0.3
    min_grid_peak: float = 0.35
    max_spacing_cv: float = 0.35
    min_regular_lines: int = 4
    min_section_gap_factor: float = 2.0
    floor_threshold: int = 180
    full_page_illustration_fraction: float = 0.15
    illustration_ink_fraction: float = 0.15
    min_illustration_px: int = 80


DEFAULT = Config()
#: Names of modules whose rows stand further apart.
WIDE_ROWS = re.compile(r"(?i)B[1-4](?!\d).*\.pdf")


def config_for(name: str) -> Config:
    """The configuration that a file's name asks for."""
    return replace(DEFAULT, min_row_split_px=40) if WIDE_ROWS.fullmatch(name) else DEFAULT
