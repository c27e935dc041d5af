"""Parameters of the two jobs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from proxysift import constants as C


@dataclass(frozen=True)
class JobParams:
    """One run of the log-ingest job."""

    parser: str
    in_format: str = "text"
    out_format: str = "parquet"
    in_path: str = ""
    out_path: str = ""
    save_mode: str = "error"
    in_options: Mapping[str, str] = field(default_factory=dict)
    out_options: Mapping[str, str] = field(default_factory=dict)
    zone: str = "EST"

    @property
    def invalid_path(self) -> str:
        return self.out_path.rstrip("/") + C.INVALID_SUFFIX


@dataclass(frozen=True)
class AnalysisParams:
    """One run of the topic-anomaly analysis."""

    topics: int = C.TOPIC_COUNT
    iterations: int = C.MAX_ITERATIONS
    alpha: float | None = C.ALPHA
    beta: float | None = C.BETA
    optimizer: str = "online"
    seed: int = 42
    own_domain: str = C.OWN_DOMAIN
    threshold: float = C.SCORE_THRESHOLD
    top: int | None = None
    model_path: str | None = None
    # Share of the corpus drawn per online iteration; about one document if not given.
    batch: float | None = None
