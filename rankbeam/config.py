"""Job configuration as plain dataclasses.

Column names are configurable by role; every operator reads names from
``Columns`` so the same plan runs on any log whose columns play those roles.
Defaults are the reference job's defaults (fixed values, see comments).
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

EVENT_ORDER = "event_order"
WATCH_RATIO = "watch_ratio"
LABEL = "label"
SPLIT = "split"
SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class Columns:
    user_id: str = "user_id"
    item_id: str = "item_id"
    timespent: str = "timespent"
    duration: str = "duration"
    author_id: str = "author_id"
    embedding: str = "embedding"
    # Feedback flags, impression context and static user columns.
    feedback: tuple[str, ...] = (
        "like", "dislike", "share", "bookmark", "click_on_author", "open_comments",
    )
    context: tuple[str, ...] = ("place", "platform", "agent")
    user_static: tuple[str, ...] = ("age", "gender", "geo")


@dataclass(frozen=True)
class Sources:
    # Case-insensitive patterns per category; the first match in
    # the order embeddings, interactions, users, items wins.
    patterns: tuple[tuple[str, str], ...] = (
        ("embeddings", "emb"),
        ("interactions", "week_"),
        ("users", "user"),
        ("items", "item"),
    )
    extensions: tuple[str, ...] = (".parquet", ".npz")
    max_shards: int | None = None
    use_embeddings: bool = True


@dataclass(frozen=True)
class Sample:
    user_fraction: float | None = None
    seed: int = 42


@dataclass(frozen=True)
class Cleaning:
    max_timespent_sec: float = 7200.0
    max_watch_ratio: float = 3.0
    min_user_interactions: int = 5
    min_item_interactions: int = 5


@dataclass(frozen=True)
class Label:
    # Graded relevance weights of the reference job.
    weights: tuple[tuple[str, float], ...] = (
        ("like", 2.0),
        ("share", 3.0),
        ("bookmark", 3.0),
        ("click_on_author", 1.0),
        ("open_comments", 1.0),
    )
    watch_ratio_threshold: float = 0.8
    watch_weight: float = 1.0
    dislike_zero: bool = True
    clip_max: float = 5.0


@dataclass(frozen=True)
class Features:
    use_embeddings: bool = True
    embedding_dim: int | None = 32
    profile_pos_label: float = 1.0


@dataclass(frozen=True)
class Split:
    train_frac: float = 0.8
    val_frac: float = 0.1


@dataclass(frozen=True)
class Eval:
    ks: tuple[int, ...] = (5, 10, 20)
    binary_threshold: float = 1.0
    # Metric that chooses the best iteration; None: NDCG at 10, or at the largest of ks.
    best_by: str | None = None


@dataclass(frozen=True)
class Model:
    # Trees, depth, learning rate and curve period of the reference job.
    max_iter: int = 2000
    max_depth: int = 8
    step_size: float = 0.05
    metric_period: int = 25
    subsampling_rate: float = 1.0
    seed: int = 42
    missing_value: float = -1.0e9
    # "lambdarank" (pairwise gradients weighted by NDCG, per user) or "pointwise" (squared error).
    loss: str = "lambdarank"
    # Stop after ``patience`` trees without a better val metric and end the model at the best one.
    early_stop: bool = True
    patience: int = 100
    # Pairs need one row among the first ``truncation`` of its list; lists have at most ``list_rows``.
    truncation: int = 20
    list_rows: int = 2000
    # Rows a leaf needs at least; trees between two written states of the scores.
    min_leaf_rows: int = 20
    trees_per_state: int = 50
    # Rows of the train split for quick runs (first whole groups); None: all.
    max_train_rows: int | None = None
    # The learner keeps a bin per value of a categorical column; wider columns are refused.
    max_categories: int = 10_000


@dataclass(frozen=True)
class Scale:
    """Size limits that decide between a broadcast and a shuffle join.

    A side is broadcast only when its counted rows are within
    ``broadcast_max_rows`` AND rows x estimated row width is within
    ``broadcast_max_bytes``. A broadcast passes through the driver and takes there
    up to seven times its estimated bytes (hash table and page grow by doubling).
    """

    broadcast_max_rows: int = 2_000_000
    broadcast_max_bytes: int = 8 * 1024 * 1024
    # Rows of a vector table (x embedding width) that may be broadcast.
    broadcast_max_vector_cells: int = 64_000_000
    # Rows of one key that a single task of a shuffle join holds; hotter keys are dealt over several.
    hot_key_rows: int = 1_000_000
    # O1: globally sort the interactions sink by event_order (one range
    # shuffle, as the reference's sorted output). False sorts each task's
    # rows only: no shuffle, files still sorted, coarser min/max pruning.
    sort_interactions_globally: bool = True


def _frozen(value):
    """JSON lists and objects as the tuples that the dataclasses hold."""
    if isinstance(value, dict):
        return tuple((k, _frozen(v)) for k, v in value.items())
    if isinstance(value, list):
        return tuple(_frozen(v) for v in value)
    return value


@dataclass(frozen=True)
class Config:
    columns: Columns = field(default_factory=Columns)
    sources: Sources = field(default_factory=Sources)
    sample: Sample = field(default_factory=Sample)
    cleaning: Cleaning = field(default_factory=Cleaning)
    label: Label = field(default_factory=Label)
    features: Features = field(default_factory=Features)
    split: Split = field(default_factory=Split)
    eval: Eval = field(default_factory=Eval)
    model: Model = field(default_factory=Model)
    scale: Scale = field(default_factory=Scale)

    @staticmethod
    def from_dict(values: dict) -> "Config":
        """A config from nested plain values, e.g. of a JSON file; unknown names fail."""
        cfg = Config()
        for section, entries in values.items():
            if not hasattr(cfg, section):
                raise ValueError(f"unknown config section: {section}")
            part = getattr(cfg, section)
            known = {f.name for f in fields(part)}
            unknown = set(entries) - known
            if unknown:
                raise ValueError(f"unknown settings in {section}: {sorted(unknown)}")
            cfg = replace(cfg, **{section: replace(part, **{k: _frozen(v) for k, v in entries.items()})})
        return cfg

    def with_cleaning(self, **kw) -> "Config":
        return replace(self, cleaning=replace(self.cleaning, **kw))

    def with_sample(self, **kw) -> "Config":
        return replace(self, sample=replace(self.sample, **kw))

    def with_model(self, **kw) -> "Config":
        return replace(self, model=replace(self.model, **kw))
