"""Union of same-shaped tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def consolidate(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name, duplicates kept.

    Frames are joined pairwise so that the plan is log2(n) deep: with hundreds of
    stores a left-deep chain would be re-analysed in full at every step.
    """
    if not frames:
        raise ValueError("nothing to consolidate")
    while len(frames) > 1:
        paired = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])]
        frames = paired + frames[len(paired) * 2 :]
    return frames[0]
