"""Analysis policy: the thresholds and conventions every statistic reports under."""

from __future__ import annotations

from dataclasses import asdict, dataclass

VARIABLE_KINDS = ("continuous", "ordinal", "categorical", "binary")
NUMERIC_KINDS = ("continuous", "ordinal")
COUNTED_KINDS = ("categorical", "binary", "ordinal")


@dataclass(frozen=True)
class Policy:
    alpha: float = 0.05
    min_pair_n: int = 20
    min_group_n: int = 5
    suppress_below_n: int = 0
    percent_denominator: str = "valid"
    multiple_testing: str = "benjamini-hochberg"

    def __post_init__(self) -> None:
        if self.percent_denominator not in ("all", "valid"):
            raise ValueError(f"percent_denominator must be all or valid, not {self.percent_denominator!r}")
        if self.multiple_testing not in ("benjamini-hochberg", "none"):
            raise ValueError(f"unknown multiple_testing {self.multiple_testing!r}")

    def settings(self) -> dict[str, str]:
        return {name: str(value) for name, value in asdict(self).items()}
