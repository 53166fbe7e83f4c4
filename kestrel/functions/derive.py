"""Derived features (guarded): each is added only when its inputs exist, otherwise a warning is kept.

All derivations are applied in one ``withColumns`` projection, written once and shared by training and scoring.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame

from kestrel.functions import columns as C

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Derivation:
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., Column]

    def column(self) -> Column:
        return self.build(*self.inputs)


def _lda(fn):
    return lambda *cols: fn(list(cols))


# The derived columns of the news-popularity job (names and input columns).
LDA_COLUMNS = ("LDA_00", "LDA_01", "LDA_02", "LDA_03", "LDA_04")
NEWS_DERIVATIONS: tuple[Derivation, ...] = (
    Derivation("feat_content_to_href_ratio", ("n_tokens_content", "num_hrefs"), C.guarded_ratio),
    Derivation("feat_content_to_img_ratio", ("n_tokens_content", "num_imgs"), C.guarded_ratio),
    Derivation("feat_kw_avg_spread", ("kw_avg_max", "kw_avg_min"), C.spread),
    Derivation("feat_global_sentiment_strength", ("global_subjectivity", "global_sentiment_polarity"), C.product),
    Derivation("feat_title_sentiment_strength", ("title_subjectivity", "title_sentiment_polarity"), C.product),
    Derivation("feat_lda_max_value", LDA_COLUMNS, _lda(C.row_max)),
    Derivation("feat_lda_std_dev", LDA_COLUMNS, _lda(C.row_std)),
)

# The same shapes over the planted fixture `art` (x1, x2 numeric with gaps, t0..t4 topic-like shares).
ART_T = ("t0", "t1", "t2", "t3", "t4")
ART_DERIVATIONS: tuple[Derivation, ...] = (
    Derivation("feat_x1_to_x2_ratio", ("x1", "x2"), C.guarded_ratio),
    Derivation("feat_x1_x2_spread", ("x1", "x2"), C.spread),
    Derivation("feat_t0_t1_product", ("t0", "t1"), C.product),
    Derivation("feat_t_max", ART_T, _lda(C.row_max)),
    Derivation("feat_t_std", ART_T, _lda(C.row_std)),
)


def derive(df: DataFrame, derivations: Sequence[Derivation]) -> tuple[DataFrame, list[str]]:
    """Add every derivation whose inputs are present; return the frame and the warnings for the rest."""
    present = set(df.columns)
    cols: dict[str, Column] = {}
    warnings: list[str] = []
    for d in derivations:
        missing = [c for c in d.inputs if c not in present]
        if missing:
            msg = f"columns for '{d.name}' not found: {', '.join(missing)}"
            warnings.append(msg)
            log.warning(msg)
        else:
            cols[d.name] = d.column()
    return (df.withColumns(cols) if cols else df), warnings


_REGISTRY = {"news": NEWS_DERIVATIONS, "art": ART_DERIVATIONS}


class FeatureDeriver(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage form of :func:`derive` for a named derivation set (persists by name)."""

    derivationSet = Param(Params._dummy(), "derivationSet", "name of the derivation set", TypeConverters.toString)

    @keyword_only
    def __init__(self, derivationSet: str = "news"):
        super().__init__()
        self._setDefault(derivationSet="news")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, _ = derive(dataset, _REGISTRY[self.getOrDefault(self.derivationSet)])
        return out
