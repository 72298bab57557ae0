"""User-supplied Python models applied on Arrow batches.

The reference calls hosted models row by row; here a user's model runs inside
the executors on Arrow record batches (``mapInPandas``: one model load per
task, vectorised over the batch) or per group (``applyInPandas``).  Spark still
partitions and shuffles the work; the function only sees its own batch/group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame


# characters that a model sees at once (or one row): what it makes of them is held beside the Arrow batch
SLICE_CHARS = 1 << 20


def _slices(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Runs of rows with about ``SLICE_CHARS`` characters; a longer row stands alone."""
    size = pd.Series(0, index=pdf.index, dtype="int64")
    for c in pdf.columns:
        if not pd.api.types.is_numeric_dtype(pdf[c]):
            size += pdf[c].map(lambda v: len(v) if hasattr(v, "__len__") else 0).fillna(0).astype("int64")
    slot = ((size.cumsum() - size) // SLICE_CHARS).to_numpy()
    first = [0, *((slot[1:] != slot[:-1]).nonzero()[0] + 1), len(pdf)]
    for a, b in zip(first[:-1], first[1:]):
        yield pdf.iloc[a:b].reset_index(drop=True)


def apply_text_model(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """UDF-04 row-wise model over batches: ``fn(batch_pdf) -> result_pdf`` (same row count).

    An Arrow batch has as many rows whatever their texts' lengths, so it's handed on in slices of
    ``SLICE_CHARS`` characters.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield from map(fn, _slices(b))
    return df.mapInPandas(run, schema)


def apply_per_group(df: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """UDF-05 one model per group (e.g. per forecast series) via ``applyInPandas``."""
    return df.groupBy(*keys).applyInPandas(fn, schema)


def text_stats(pdf: pd.DataFrame) -> pd.DataFrame:
    """A small example model: sentence count, mean word length and a readability-like score."""
    t = pdf["text"].fillna("")
    # a text's words are let go before the next text's are made
    counted = [(len(w), sum(map(len, w))) for w in (x.split() for x in t)]
    n_words = pd.Series([max(n, 1) for n, _ in counted], index=t.index, dtype="int64")
    mean_len = pd.Series([chars / max(n, 1) for n, chars in counted], index=t.index, dtype="float64")
    sentences = t.str.count(r"[.!?]").clip(lower=1)
    return pd.DataFrame({"doc_id": pdf["doc_id"], "sentences": sentences.astype("int64"),
                         "mean_word_len": mean_len.astype("float64"),
                         "words_per_sentence": (n_words / sentences).astype("float64")})


def linear_trend_forecast(h: int = 14):
    """FC-04 example per-series model: least-squares line on the day index, h days ahead."""
    import numpy as np

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        t0 = pd.Timestamp(pdf["ts"].min())
        x = (pd.to_datetime(pdf["ts"]) - t0).dt.days.to_numpy(dtype=float)
        y = pdf["y"].to_numpy(dtype=float)
        b, a = (np.polyfit(x, y, 1) if len(x) > 1 else (0.0, float(y.mean() if len(y) else 0.0)))
        last = pd.to_datetime(pdf["ts"]).max()
        fut = [last + pd.Timedelta(days=i) for i in range(1, h + 1)]
        xf = np.array([(f - t0).days for f in fut], dtype=float)
        out = pd.DataFrame({"ts": [f.date() for f in fut], "forecast": np.maximum(a + b * xf, 0.0)})
        for k in [c for c in pdf.columns if c not in ("ts", "y")]:
            out[k] = pdf[k].iloc[0]
        return out
    return fit
