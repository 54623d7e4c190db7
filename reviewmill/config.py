"""Settings shared by every job.

All values can be overridden with ``dataclasses.replace``; nothing here is read
from the environment or from module globals at run time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# The text and label vocabulary the jobs must agree on.
POSITIVE, NEGATIVE, NEUTRAL = "positif", "negatif", "netral"
UNKNOWN_EMOJI = "deskripsi_emoji"
STATUS_OK = "Berhasil"
STATUS_BLANK = "Teks kosong, tidak diprediksi"
UNKNOWN_LABEL = "Unknown"
SPECIAL_TOKENS = (POSITIVE, NEGATIVE, NEUTRAL)
DISPLAY_LABELS = {0: "Negatif", 1: "Positif"}
CHART_LABEL_ORDER = ("Positif", "Negatif")
CONFIDENCE_LEVELS = ("Sangat Yakin", "Cukup Yakin", "Kurang Yakin")
WORK_MARKERS = ("TODO", "FIXME", "PLACEHOLDER")

# Small Indonesian lexicons.
NEGATIONS = ("tidak", "bukan", "belum", "jangan", "kurang", "tanpa")
LEET = {
    "0": ("o",), "1": ("i", "l"), "3": ("e",), "4": ("a",), "5": ("s",),
    "6": ("g",), "7": ("t",), "8": ("b",), "9": ("g",),
}

# Strings a CSV field may hold that mean "missing".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class ReviewConfig:
    text: str = "text"
    label: str = "sentiment"
    row_id: str = "row_id"
    labels: tuple[int, ...] = (0, 1)
    file_regex: str = r"^data\d+\.csv$"
    na_tokens: tuple[str, ...] = NA_TOKENS
    # vocabulary normalisation
    typo_threshold: float = 85
    repeat_threshold: float = 88
    leet_threshold: float = 88
    typo_length_ratio: float = 0.25
    candidate_length_ratio: float = 0.4
    typo_rank: int = 10
    min_token_length: int = 2
    # emoji scores
    emoji_positive: float = 0.05
    emoji_negative: float = -0.05
    # split and model
    test_size: float = 0.2
    seed: int = 42
    ngram_min: int = 1
    ngram_max: int = 2
    min_df: int = 2
    max_df: float = 0.95
    alpha: float = 1.0
    model_version: str = "1.0.0"
    # scoring
    confidence_high: float = 0.85
    confidence_medium: float = 0.65
    display: dict[int, str] = field(default_factory=lambda: dict(DISPLAY_LABELS))
    # charts
    histogram_bins: int = 40
    top_words: int = 20
