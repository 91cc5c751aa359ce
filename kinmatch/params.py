"""Parameters of a linkage run, with the production defaults."""

from __future__ import annotations

from dataclasses import dataclass

# The columns of the feature vector, in model order.
FEATURES = (
    "name_exact",
    "name_jaccard",
    "name_ratio",
    "name_token_sort",
    "name_token_set",
    "name_partial",
    "addr_exact",
    "addr_jaccard",
    "addr_ratio",
    "addr_token_set",
    "country_exact",
    "name_len_diff",
    "addr_len_diff",
    "common_name_tokens",
    "common_addr_tokens",
    "tfidf_cosine",
)

# The cut-offs tried when tuning.
THRESHOLDS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)


# The defaults below.
@dataclass(frozen=True)
class LinkParams:
    # candidate generation
    name_k: int = 18
    addr_k: int = 14
    exact_slack: int = 10  # list length is name_k + addr_k + exact_slack
    single_k: int = 20  # one-stream variant
    single_cap: int = 30
    addr_weight: float = 0.9
    analyzer: str = "word"  # "word" (unigrams and bigrams) or "char" (trigrams inside words)
    min_df: int = 2
    max_df: float = 0.1
    max_features: int | None = None  # terms of a corpus, the most frequent first; None: all
    rare_keep: int = 6
    fit_sample: int | None = None  # documents of a corpus that the fit sees; None: all
    # lists of a term longer than this are cut; a cell compares at most the product of the two
    cell_postings: int = 32_768
    cell_queries: int = 4_096
    slice_pairs: int = 1_000_000  # candidates of one query that are ranked in one task
    # training
    max_train: int = 24_000  # source-1 records that train_from_sources draws
    holdout: float = 0.2
    rounds: int = 300
    step: float = 0.06
    depth: int = 8
    min_leaf: int = 50
    bins: int = 255
    early_stop_share: float = 0.1
    patience: int = 30  # rounds without a smaller loss on the watched pairs
    seed: int = 42
    # inference
    threshold: float = 0.65
    rescore_threshold: float = 0.55

    @property
    def cap(self) -> int:
        return self.name_k + self.addr_k + self.exact_slack
