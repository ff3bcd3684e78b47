"""Parameters shared by the operators. Every date or threshold a rule needs lives here."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Config:
    """Warehouse and pricing parameters."""

    valuation_date: date = date(2025, 12, 31)
    observation_start: date = date(2020, 1, 1)
    spine_start: date = date(2019, 1, 1)
    spine_end: date = date(2026, 12, 31)
    large_loss_threshold: int = 200_000
    max_development_year: int = 5
    train_through_year: int = 2023
    min_training_exposure: float = 0.25
    underpriced_above: float = 1.1
    overpriced_below: float = 0.9


@dataclass(frozen=True)
class StreamConfig:
    """Event-time parameters of the claim stream; durations in seconds."""

    window_seconds: int = 3600
    allowed_lateness_seconds: int = 3600
    early_firing_seconds: int = 30
    input_path: str = ""
    output_path: str = ""
    version: str = "0.1.0"

    def __post_init__(self) -> None:
        if self.window_seconds <= 0:
            raise ValueError("window_seconds must be positive")
        if self.allowed_lateness_seconds < 0:
            raise ValueError("allowed_lateness_seconds must not be negative")
        if self.early_firing_seconds <= 0:
            raise ValueError("early_firing_seconds must be positive")

    def require_endpoints(self) -> "StreamConfig":
        """Raise ValueError unless both an input and an output are named."""
        if not self.input_path:
            raise ValueError("input_path is required")
        if not self.output_path:
            raise ValueError("output_path is required")
        return self

    @property
    def window(self) -> str:
        return f"{self.window_seconds} seconds"

    @property
    def lateness(self) -> str:
        return f"{self.allowed_lateness_seconds} seconds"
