"""Settings of a screening run."""

from __future__ import annotations

import dataclasses
import hashlib
import json


@dataclasses.dataclass(frozen=True)
class ScreenConfig:
    """What a run depends on; all of it enters the fingerprint.

    short_limit: texts of at most so many code points are detected in one call, longer ones by chunks.
    """

    confidence: float = 0.7
    chunk_size: int = 100_000
    max_chunks: int = 20
    min_en_ratio: float = 0.9
    short_limit: int = 10_000
    min_chars: int = 10
    allowed: tuple[str, ...] = ("en",)
    code_detection: bool = False
    default_key: str | None = None
    split_mb: int = 512
    detector: str = "stopwords"

    def __post_init__(self) -> None:
        if not 0 <= self.confidence <= 1 or not 0 <= self.min_en_ratio <= 1:
            raise ValueError("confidence and min_en_ratio are shares between 0 and 1")
        if self.chunk_size < 1 or self.max_chunks < 1 or self.split_mb < 1 or self.short_limit < 0:
            raise ValueError("chunk_size, max_chunks and split_mb are positive, short_limit is not negative")
        if not self.allowed:
            raise ValueError("at least one language must be allowed")

    def fingerprint(self, files: list[tuple[str, str, int]]) -> str:
        """16 hexadecimal digits over the settings and (path, key, size) of every file."""
        text = json.dumps(dataclasses.asdict(self), sort_keys=True) + "".join(f"\n{p}:{k}:{s}" for p, k, s in sorted(files))
        return hashlib.sha256(text.encode()).hexdigest()[:16]
