"""Model steps: an interface, and stand-ins by rule.

No model weights are available here. A step takes any `BatchModel`; the stand-ins below only give its columns values
that can be checked, and are no models.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class BatchModel(Protocol):
    """schema: of what is predicted for an input, as DDL of columns; empty: the values for blank input."""

    schema: str
    empty: dict

    def predict(self, inputs: list) -> list[dict]: ...


def applied(rows: DataFrame, key: str, column: str, model: Callable[[], BatchModel]) -> DataFrame:
    """key and the model's columns for each row. The model is made once a task; a failing row gets nulls, not an error."""
    kind = rows.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, {model().schema}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = model()
        for frame in batches:
            values = frame[column].tolist()
            full = [i for i, v in enumerate(values) if v is not None and (not isinstance(v, str) or v.strip())]
            out: list[dict] = [dict(own.empty) for _ in values]
            try:
                found = own.predict([values[i] for i in full])
            except Exception:  # one bad input must not cost the batch: try them one by one
                found = [_alone(own, values[i]) for i in full]
            for i, x in zip(full, found):
                out[i] = x
            names = list(own.empty)
            yield pd.DataFrame({key: frame[key]} | {n: pd.Series([x[n] for x in out], index=frame.index, dtype=object) for n in names})

    return rows.select(key, column).mapInPandas(run, schema)


def _alone(model: BatchModel, value) -> dict:
    try:
        return model.predict([value])[0]
    except Exception:  # recorded as nulls
        return dict.fromkeys(model.empty)


class RuleClassifier:
    """Stand-in: the label by the length of the text."""

    schema, empty = "text_category string, text_confidence double", {"text_category": "Empty", "text_confidence": 1.0}

    def predict(self, inputs: list) -> list[dict]:
        return [{"text_category": "Content" if len(t) > 200 else "Other", "text_confidence": round(1 - 1 / (1 + len(t)), 4)} for t in inputs]


class RuleEntities:
    """Stand-in: runs of capitalised words."""

    schema = "per_entities array<string>, loc_entities array<string>, org_entities array<string>"
    empty = {"per_entities": [], "loc_entities": [], "org_entities": []}
    _NAME = re.compile(r"[A-Z][a-z]+(?: [A-Z][a-z]+)*")

    def predict(self, inputs: list) -> list[dict]:
        out = []
        for text in inputs:
            lists: dict = {"per_entities": [], "loc_entities": [], "org_entities": []}
            for name in self._NAME.findall(text):
                lists[list(lists)[zlib.crc32(name.encode()) % 3]].append(name)
            out.append(lists)
        return out


class RuleSubjects:
    """Stand-in: labels ranked by a hash of label and text; scores add up to 1."""

    schema, empty = "ranked_labels array<string>, scores array<double>", {"ranked_labels": [], "scores": []}

    def __init__(self, labels: tuple[str, ...] = ("politics", "trade", "weather", "sports")):
        self.labels = labels

    def predict(self, inputs: list) -> list[dict]:
        out = []
        for text in inputs:
            raw = np.exp([zlib.crc32(f"{label} {text}".encode()) / 2**32 for label in self.labels])
            order = np.argsort(-raw)
            out.append({"ranked_labels": [self.labels[i] for i in order], "scores": [round(float(raw[i] / raw.sum()), 4) for i in order]})
        return out


class HashEmbedding:
    """Stand-in: hashed bag of words of unit length."""

    schema, empty = "embedding array<float>", {"embedding": None}

    def __init__(self, size: int = 64):
        self.size = size

    def predict(self, inputs: list) -> list[dict]:
        out = []
        for text in inputs:
            v = np.zeros(self.size)
            for w in text.lower().split():
                v[zlib.crc32(w.encode()) % self.size] += 1
            out.append({"embedding": (v / max(np.linalg.norm(v), 1e-12)).astype(np.float32).tolist()})
        return out
