"""Partition counts from bytes.

Parts grow with the data: at a fixed part size, map tasks times reduce tasks (the
blocks of a shuffle) would grow with its square.
"""

from __future__ import annotations

import math

MIN_BYTES = 128 << 20
#: Above these counts, parts (of a shuffle) and splits (of a scan) get larger instead of more.
MAX_PARTS, MAX_SPLITS = 25_000, 100_000


def part_bytes(total: int) -> int:
    """Bytes of one shuffle part: 128 MB, or what keeps 25,000 parts (4 GB at 100 TB; sorts and joins spill)."""
    return max(MIN_BYTES, math.ceil(total / MAX_PARTS))


def split_bytes(total: int, least: int = MIN_BYTES) -> int:
    """Bytes of one scan task: ``least``, or what keeps 100,000 tasks (1 GB at 100 TB)."""
    return max(least, math.ceil(total / MAX_SPLITS))


def partitions(total: int, cores: int) -> int:
    """Parts of a shuffle of ``total`` bytes, at least one per core."""
    return max(cores, math.ceil(total / part_bytes(total)))
