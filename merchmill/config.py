"""Settings of one shop deployment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from datetime import date

from merchmill import values


@dataclass(frozen=True)
class ShopConfig:
    """Where tables live and which knobs a run uses.

    ``root`` and ``source_dir`` are any Hadoop file system URI. Tables are laid out as
    ``root/target/layer/table``; the landing zone is ``landing_root`` (``root/target/landing`` unset).
    """

    root: str
    source_dir: str = ""
    target: str = "dev"
    landing_root: str | None = None
    seed: int = values.DEFAULT_SEED
    daily_orders: int | None = values.DEFAULT_DAILY_ORDERS
    lookback_days: int = values.DEFAULT_LOOKBACK_DAYS
    #: grain of staged orders and facts: "order" keeps one row per order, "line" one per order and product
    grain: str = "order"
    #: partition width of the dated tables: "day" or "month"
    partition_by: str = "day"
    #: how orders enter the warehouse: "replace" the loaded partitions, or "append"
    load_mode: str = "replace"
    #: what a later build of the fact reads: the days of the look-back ("lookback"), or those of all loads that came
    #: since the last build, however old they are ("ledger")
    increment: str = "lookback"
    #: how many tables a step writes at the same time
    threads: int = 4
    #: source files whose quoted cells may hold line breaks; such a file is read by one task
    multiline_files: tuple[str, ...] = ()
    #: set aside what can't be read of the source files, with its place and a reason, instead of failing or NULL
    quarantine: bool = False
    source_files: dict[str, str] = field(default_factory=lambda: dict(values.SOURCE_FILES))

    def __post_init__(self):
        if self.grain not in ("order", "line"):
            raise ValueError(f"grain must be 'order' or 'line', not {self.grain!r}")
        if self.partition_by not in ("day", "month"):
            raise ValueError(f"partition_by must be 'day' or 'month', not {self.partition_by!r}")
        if self.load_mode not in ("replace", "append"):
            raise ValueError(f"load_mode must be 'replace' or 'append', not {self.load_mode!r}")
        if self.increment not in ("lookback", "ledger"):
            raise ValueError(f"increment must be 'lookback' or 'ledger', not {self.increment!r}")
        if self.threads < 1:
            raise ValueError("threads must be positive")
        if self.daily_orders is not None and self.daily_orders < 1:
            raise ValueError("daily_orders must be positive, or None for no limit")

    @classmethod
    def from_env(cls, **overrides) -> ShopConfig:
        """Read SHOP_ROOT, SHOP_SOURCE_DIR, SHOP_TARGET, SHOP_LANDING_ROOT and RANDOM_SEED."""
        found = {
            "root": os.getenv("SHOP_ROOT", "shop-data"),
            "source_dir": os.getenv("SHOP_SOURCE_DIR", ""),
            "target": os.getenv("SHOP_TARGET", "dev"),
            "landing_root": os.getenv("SHOP_LANDING_ROOT"),
            "seed": int(os.getenv("RANDOM_SEED", str(values.DEFAULT_SEED))),
        }
        return cls(**{**found, **overrides})

    @property
    def order_key(self) -> list[str]:
        return ["order_id"] if self.grain == "order" else ["order_id", "product_id"]

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.target}/{layer}/{table}"

    def landing_path(self, table: str, run_date: date) -> str:
        base = self.landing_root or f"{self.root.rstrip('/')}/{self.target}/landing"
        return f"{base.rstrip('/')}/{table}/date={run_date:%Y-%m-%d}"
