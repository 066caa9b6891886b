"""Sizes of burnt-in text and projections of a job, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The height that font sizes refer to, ink and top edge as multiples of the font size, and
# bytes of a second of 16 kHz mono audio.
SCRIPT_HEIGHT = 288
INK, TOP = 1.6, 1.8
AUDIO_BYTES = 32_000


def effective_px(size: Column, height: Column) -> Column:
    """Pixels of a font size on a frame of this height."""
    return size * height / SCRIPT_HEIGHT


def ink_px(font_px: Column) -> Column:
    return font_px * INK


def top_edge(height: Column, margin: Column, font_px: Column) -> Column:
    """Row where two lines of text begin."""
    return height - margin - font_px * TOP


def bar_height(height: Column, crop_height: Column, crop_y: Column) -> Column:
    """Height of the black bar under a crop."""
    return height - (crop_height + crop_y)


def projected_bytes(total_size: Column, duration: Column, out_time: Column) -> Column:
    """Final size of a file that has total_size bytes after out_time of duration; null before any output."""
    return F.when(out_time > 0, total_size * duration / out_time)


def wall_seconds(audio_seconds: Column, multiple: Column) -> Column:
    """Time for audio at a realtime multiple; null for none."""
    return F.when(multiple > 0, audio_seconds / multiple)


def audio_bytes(seconds: Column) -> Column:
    return seconds * AUDIO_BYTES
