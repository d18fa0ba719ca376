"""Main-text extraction by a linear-chain conditional random field over DOM leaf blocks."""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm.common import table
from tierforge.llm.html_blocks import Block, Place, leaf_blocks
from tierforge.llm.labelled_pages import MARK, labelled_pages

def _bin(value: float, cuts: tuple[float, ...]) -> int:
    return sum(value > cut for cut in cuts)


@lru_cache(maxsize=50_000)
def _standing(place: Place) -> tuple[str, ...]:
    """Features of what stands above a block; the same for many blocks."""
    own = place.own or ("root",)
    out = [f"above:{t}" for t in place.above] + [f"name:{n}" for n in place.names]
    return (*out, f"own:{own[-1]}", f"own2:{'>'.join(own)}", f"depth:{min(place.depth, 8)}")


def block_features(block: Block, place: int, number: int) -> list[str]:
    text = block.text
    size = len(text)
    words = text.count(" ") + 1
    return [
        "bias",
        *_standing(block.place),
        f"words:{_bin(words, (1, 2, 4, 8, 16, 32, 64))}",
        f"links:{_bin(block.linked / size, (0, 0.2, 0.5, 0.9))}",
        f"stop:{text[-1] in '.!?:…'}",
        f"commas:{_bin(text.count(','), (0, 2, 5))}",
        f"sign:{'©' in text or '|' in text}",
        f"first:{place == 0}",
        f"last:{place == number - 1}",
    ]


class ChainModel(NamedTuple):
    """``weights``: difference of the scores of article and furniture by feature; ``steps``: to, from."""

    weights: dict[str, float]
    steps: np.ndarray

    def decode(self, features: list[list[str]]) -> list[bool]:
        """The labels of the best path, by Viterbi; ties go to furniture."""
        get, (stay, out), (enter, keep) = self.weights.get, self.steps[0].tolist(), self.steps[1].tolist()
        back, zero, one = [], 0.0, 0.0
        for number, block in enumerate(features):
            gain = 0.0
            for f in block:
                gain += get(f, 0.0)
            if number:
                zeros, ones = (zero + stay, one + out), (zero + enter, one + keep)
                back.append((zeros[1] > zeros[0], ones[1] > ones[0]))
                zero, one = max(zeros), max(ones) + gain
            else:
                one = gain
        label = one > zero
        path = [label]
        for choice in reversed(back):
            label = choice[label]
            path.append(label)
        return path[::-1] if features else []


def train_chain(pages: list[tuple[list[list[str]], list[int]]], *, rounds: int = 25, rate: float = 0.3, decay: float = 1e-4, seed: int = 3) -> ChainModel:
    """Maximises the conditional likelihood by adaptive gradient steps, page by page, with forward-backward."""
    index: dict[str, int] = {}
    coded = [
        ([np.array([index.setdefault(f, len(index)) for f in block]) for block in features], np.array(labels))
        for features, labels in pages
        if features
    ]
    w, squares = np.zeros(len(index)), np.full(len(index), 1e-3)
    steps, step_squares = np.zeros((2, 2)), np.full((2, 2), 1e-3)
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for number in order.permutation(len(coded)):
            blocks, labels = coded[number]
            emit = np.array([[0.0, w[b].sum()] for b in blocks])
            n = len(blocks)
            forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
            forward[0] = emit[0]
            for t in range(1, n):
                forward[t] = emit[t] + np.logaddexp(forward[t - 1, 0] + steps[0], forward[t - 1, 1] + steps[1])
            for t in range(n - 2, -1, -1):
                after = emit[t + 1] + backward[t + 1]
                backward[t] = np.logaddexp(steps[:, 0] + after[0], steps[:, 1] + after[1])
            total = np.logaddexp(*forward[-1])
            share = np.exp(forward[:, 1] + backward[:, 1] - total)
            slope = np.zeros((2, 2))
            if n > 1:
                pair = forward[:-1, :, None] + steps + (emit + backward)[1:, None, :] - total
                slope = np.bincount(2 * labels[:-1] + labels[1:], minlength=4).reshape(2, 2) - np.exp(pair).sum(axis=0)
            for block, gap in zip(blocks, labels - share, strict=True):
                g = gap - decay * w[block]
                squares[block] += g * g
                w[block] += rate * g / np.sqrt(squares[block])
            step_squares += slope**2
            steps += rate * slope / np.sqrt(step_squares)
    return ChainModel({f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-6}, steps.T)


def _labelled(html: str) -> tuple[list[list[str]], list[int]]:
    blocks = leaf_blocks(html)
    labels = [int(MARK in b.text) for b in blocks]
    blocks = [b._replace(text=b.text.replace(MARK, "")) for b in blocks]
    return [block_features(b, i, len(blocks)) for i, b in enumerate(blocks)], labels


@lru_cache(maxsize=2)
def page_model(pages: int = 400) -> ChainModel:
    """Trained on ``pages`` generated pages; takes a few seconds on the driver."""
    return train_chain([_labelled(html) for html in labelled_pages(pages)])


def main_text(model: ChainModel, html: str | None) -> str:
    blocks = leaf_blocks(html or "")
    kept = model.decode([block_features(b, i, len(blocks)) for i, b in enumerate(blocks)])
    return "\n\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def extracted(spark: SparkSession, html: str | Column, model: ChainModel | None = None) -> Column:
    """The main text of each whole page, empty if there is none; null counts as an empty page.

    Blocks are joined by an empty line, in page order. Broken markup never fails: what is not a tag is text.
    """
    shared = spark.sparkContext.broadcast(model or page_model())

    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(shared.value, page) for page in pages], dtype=object)

    return extract(html)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", extracted(spark, "html").alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))
