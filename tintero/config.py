"""Parameters of the operators and jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from tintero import lexicon


@dataclass(frozen=True)
class TokenRules:
    """Which letter runs count as terms."""

    min_length: int = 4
    max_length: int = 24
    #: reject words spelled with one or two distinct letters ("jajaja")
    reject_two_letter_words: bool = True
    stop_words: frozenset[str] = lexicon.STOP_WORDS


@dataclass(frozen=True)
class WarehouseConfig:
    class_names: Sequence[str] = tuple(lexicon.REGION_NAMES)
    aliases: Mapping[int, Sequence[str]] = field(default_factory=lambda: lexicon.REGION_ALIASES)
    unknown_class: int = lexicon.UNKNOWN_REGION
    placeholders: Mapping[str, str] = field(default_factory=lambda: lexicon.PLACEHOLDERS)
    title_weight: int = 3
    id_type: str = "bigint"
    #: formats of publish dates that are tried after the ISO one; None elects one from all dates
    date_formats: tuple[str, ...] | None = None
    #: raise instead of only reporting when a validation fails
    fail_on_invalid: bool = False


@dataclass(frozen=True)
class AnalyticsConfig:
    top_k: int = 20
    min_global_count: int = 500
    min_regional_count: int = 200
    min_source_terms: int = 1000
    #: rows kept per region, 0 keeps all
    region_limit: int = 0
    include_unknown_region: bool = False
    unknown_region: int = lexicon.UNKNOWN_REGION
    peak_window: int = 7
    peak_factor: float = 1.8
    peak_min_delta: float = 50.0
    token_rules: TokenRules = TokenRules()
    #: do not count the words of the missing-text placeholders
    drop_placeholders: bool = False


@dataclass(frozen=True)
class ReportConfig:
    top_n: int = 15
    terms_per_region: int = 10
    regions: Sequence[str] = tuple(lexicon.REPORT_REGIONS)
