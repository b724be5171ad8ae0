"""Plain configuration objects (the reference reads the same knobs from .env)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CleanConfig:
    text_col: str = "narrative"          # raw text column of the corpus
    id_col: str = "doc_id"               # stable document identity
    min_token_len: int = 2
    extra_stopwords: tuple[str, ...] = ()
    expand_contractions: bool = True
    context_lemmas: bool = False         # forms of two words (left, building) by the words beside them


@dataclass(frozen=True)
class VectorizeConfig:
    max_features: int | None = 20000
    ngram_range: tuple[int, int] = (1, 2)
    min_df: int = 2
    binary: bool = False
    lowercase: bool = False
    strip_accents: str | None = None     # None | "ascii" | "unicode"
    # TF-IDF only
    sublinear_tf: bool = True
    norm: str | None = "l2"              # "l2" | "l1" | None
    use_idf: bool = True
    smooth_idf: bool = True


@dataclass(frozen=True)
class TopicConfig:
    n_topics: int = 10
    n_top_terms: int = 15
    n_iter: int = 20
    random_state: int = 42
    learning_method: str = "batch"       # LDA: "batch" | "online"
    learning_decay: float = 0.7
    normalize_doc_topics: bool = True    # LSA
    n_oversamples: int = 20              # LSA: columns of a Krylov block beyond n_topics
    svd_tol: float = 1e-5                # LSA: passes end once the residuals of all pairs, as a share of
                                         # the largest eigenvalue, are below this (values: its square)
    mini_batches: int = 8                # online LDA: lots that documents are dealt into, one update each a pass
    learning_offset: float = 10.0        # online LDA: delays the decay


@dataclass(frozen=True)
class PipelineConfig:
    clean: CleanConfig = field(default_factory=CleanConfig)
    vectorize: VectorizeConfig = field(default_factory=VectorizeConfig)
    topics: TopicConfig = field(default_factory=TopicConfig)
    # Column that is vectorized: the cleaned text (documented intent) or the
    # raw column ("narrative"), which is what the reference actually ran.
    vectorize_col: str = "narrative_clean"
    top_k_overview: int = 10
