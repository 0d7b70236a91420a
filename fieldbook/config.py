"""Settings shared by the end-to-end job; one object instead of module globals."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class JobConfig:
    """Thresholds of a listing-style or patient-style job.

    ``compat`` switches off date promotion and imputation and matches the drop
    list against the raw column names, for comparison with older reports.
    """

    exclude_columns: tuple[str, ...] = ()
    fence: float = 1.5
    price_cap: float = 1000.0
    date_parse_rate: float = 0.5
    clusters: int = 5
    restarts: int = 10
    seed: int = 42
    alpha: float = 0.05
    top_pairs: int = 20
    compat: bool = False
    date_columns: tuple[str, ...] = ()
    date_formats: tuple[str, ...] = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "d-M-yyyy")
    # The column-name hints that mark a text column as a date candidate (fixed values).
    date_hints: tuple[str, ...] = field(
        default=("date", "time", "timestamp", "dt", "month", "year")
    )
