"""One frozen description of a run: column roles, split dates, rates and limits."""
from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class Columns:
    """Which column plays which role. ``row_id`` closes every ordering, so ties never float."""

    user: str = "userid"
    time: str = "time_stamp"
    ad: str = "adgroup_id"
    slot: str = "pid"
    day: str = "d"
    label: str = "clk"
    row_id: str = "event_id"
    category: str = "cate_id"
    price: str = "price"


@dataclass(frozen=True)
class Splits:
    """Closed date ranges; the burn-in day only feeds history and is never trained on."""

    burn_in: date = date(2017, 5, 6)
    train_start: date = date(2017, 5, 7)
    train_end: date = date(2017, 5, 11)
    val_start: date = date(2017, 5, 12)
    val_end: date = date(2017, 5, 12)
    test_start: date = date(2017, 5, 13)
    test_end: date = date(2017, 5, 13)


@dataclass(frozen=True)
class Config:
    columns: Columns = field(default_factory=Columns)
    splits: Splits = field(default_factory=Splits)

    # Columns besides the label that tell the outcome of a row.
    outcomes: tuple[str, ...] = ("nonclk",)

    utc_offset_hours: int = 8
    entities: tuple[str, ...] = ("cate_id", "campaign_id", "customer", "pid")
    entity_prior_weight: float = 200.0
    user_prior_weight: float = 20.0
    order_cap: int = 20
    rolling_hours: int = 6

    # Users with more rows than this are windowed in ranges of about as many rows.
    hot_user_rows: int = 1_000_000

    drop_threshold: float = 0.01
    impute_threshold: float = 0.05
    z_critical: float = 3.0
    max_abs_correlation: float = 0.95

    negative_rate: float = 0.10
    search_fraction: float = 0.20
    seed: int = 42
    folds: int = 3
    parallel_folds: int = 3

    # Layout of rows while a model is fitted. It depends on nothing else, so that draws and factor
    # starts, hence models, are functions of the rows; raise both for more rows than tasks can hold.
    train_partitions: int = 8
    als_blocks: int = 10

    als_rank: int = 32
    als_reg: float = 0.05
    als_alpha: float = 20.0
    als_iterations: int = 10
    top_k: int = 10

    # Names and order of the published feature columns.
    profile_columns: tuple[str, ...] = (
        "cms_segid", "cms_group_id", "final_gender_code", "age_level",
        "pvalue_level", "shopping_level", "occupation", "new_user_class_level",
    )
    categorical: tuple[str, ...] = (
        "pid", "day_part", "hour", "dow",
        "final_gender_code", "age_level", "pvalue_level", "shopping_level",
        "occupation", "new_user_class_level", "cms_group_id", "gap_bucket",
    )
    protected: tuple[str, ...] = ("final_gender_code", "age_level", "new_user_class_level")

    @property
    def history_features(self) -> tuple[str, ...]:
        return tuple(f"ctr_hist_{e}" for e in self.entities) + tuple(
            f"log_imp_hist_{e}" for e in self.entities)

    @property
    def measured_numeric(self) -> tuple[str, ...]:
        """Numeric features that are not 0/1 flags (fixed values: published names and order)."""
        return self.history_features + (
            "ctr_user_prev", "log_imp_prev", "order_capped", "log_gap", "ctr_6h",
            "log_price", "price_rel")

    @property
    def flags(self) -> tuple[str, ...]:
        return ("no_profile", "brand_known", "price_valid", "weekend")

    @property
    def numeric(self) -> tuple[str, ...]:
        return self.measured_numeric + self.flags

    @property
    def context_numeric(self) -> tuple[str, ...]:
        """Numeric features left once everything learnt from past clicks is taken out."""
        return ("order_capped", "log_gap", "log_price", "price_rel") + self.flags
