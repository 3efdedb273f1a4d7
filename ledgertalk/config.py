"""Run parameters. Two profiles exist, ``n`` (default) and ``s``; they differ in
dedupe keys, texts, token estimate, sampling seeds and report outputs."""

from __future__ import annotations

from dataclasses import dataclass, replace

PROFILES = ("n", "s")


@dataclass(frozen=True)
class Recipe:
    profile: str = "n"
    max_products: int = 5000
    max_orders: int = 20000
    max_recs: int = 5000
    max_cancellations: int = 3000
    basket_cap: int = 50
    train_ratio: float = 0.90
    seed: int = 42
    recs_per_product: int = 5
    items_per_order: int = 12
    items_per_cancellation: int = 8

    def __post_init__(self):
        if self.profile not in PROFILES:
            raise ValueError(f"profile must be one of {PROFILES}, got {self.profile!r}")

    @classmethod
    def for_profile(cls, profile: str, **overrides) -> Recipe:
        base = cls(profile="s", basket_cap=30) if profile == "s" else cls(profile=profile)
        return replace(base, **overrides)

    # Sampling seeds (fixed values): the s profile has constants, n derives them from its seed.
    @property
    def order_seed(self) -> int:
        return 42 if self.profile == "s" else self.seed

    @property
    def rec_seed(self) -> int:
        return 7 if self.profile == "s" else self.seed + 1

    @property
    def cancel_seed(self) -> int:
        return 99 if self.profile == "s" else self.seed + 2
