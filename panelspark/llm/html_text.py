"""Main text of web pages: boosted trees over DOM nodes, decoded over the tree.

Every block node gets a chance of holding main text from its subtree's density,
its attribute words, its depth and its place among its siblings. The decoding
chooses for each subtree whether it is dropped whole or kept open, by the sum of
log chances, so no dropped node has a kept descendant.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import boosting, html_nodes
from panelspark.llm.html_pages import MARK, made_pages

#: Made pages on which the trees are trained.
TRAINING_PAGES = 1200
#: Pages whose nodes are judged together.
BATCH = 200


def _training(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    pages, labels, used = [], [], []
    for text in made_pages(count, seed):
        p = html_nodes.parse(text)
        own = np.array([MARK in t for t in p.text])
        p.text = [t.replace(MARK, "").strip() for t in p.text]
        for x, mark in ((labels, own), (used, np.array([bool(t) for t in p.text]))):
            total = np.concatenate(([0], np.cumsum(mark)))
            x.append(total[np.array(p.end)] > total[:-1])
        pages.append(p)
    keep = np.concatenate(used)
    return html_nodes.features(pages)[keep], np.concatenate(labels)[keep].astype(float)


@cache
def trained(count: int = TRAINING_PAGES, seed: int = 11) -> boosting.Model:
    x, y = _training(count, seed)
    return boosting.fit(x, y, trees=160, depth=4, rate=0.25, share=0.3)


def decode(p: html_nodes.Page, margin: np.ndarray) -> list[bool]:
    """Which nodes are kept: the best choice in which every ancestor of a kept node is kept. The root is kept."""
    n = len(p.tag)
    keep = np.logaddexp(0, -margin) * -1.0
    drop = np.logaddexp(0, margin) * -1.0
    keep, drop = keep.tolist(), drop.tolist()
    parent = p.parent
    best: list[bool] = [True] * n
    for i in range(n - 1, -1, -1):
        best[i] = keep[i] >= drop[i]
        q = parent[i]
        if q >= 0:
            keep[q] += keep[i] if best[i] else drop[i]
            drop[q] += drop[i]
    for i in range(n):
        q = parent[i]
        best[i] = True if q < 0 else best[i] and best[q]
    return best


def main_texts(htmls: list[str | None], model: boosting.Model) -> list[str]:
    out = []
    for at in range(0, len(htmls), BATCH):
        pages = [html_nodes.parse(h or "") for h in htmls[at : at + BATCH]]
        if not any(p.tag for p in pages):
            out += [""] * len(pages)
            continue
        margin = model.margin(html_nodes.features(pages))
        done = 0
        for p in pages:
            kept = decode(p, margin[done : done + len(p.tag)])
            done += len(p.tag)
            out.append("\n".join(t for t, k, h in zip(p.text, kept, p.hidden, strict=True) if t and k and not h))
    return out


def _extract(batches: Iterator[pa.RecordBatch], model: boosting.Model) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        at = whole.schema.get_field_index("_html")
        for start in range(0, whole.num_rows, BATCH):
            batch = whole.slice(start, BATCH)
            texts = main_texts(batch.column(at).to_pylist(), model)
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for n in batch.schema.names if n != "_html"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Per row: id, the columns in `keep`, text and n_chars (code points).

    NULL, empty and textless pages give an empty text; broken markup is read as
    browsers read the common cases; repeated rows are each extracted; an empty
    table gives an empty result. Kept columns named text or n_chars are not
    allowed. Rows are handled where they are read; the trees are a few kilobytes.
    """
    clash = {"text", "n_chars", "_html"} & set(keep)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} before extracting")
    shared = pages.sparkSession.sparkContext.broadcast(trained())
    names = list(dict.fromkeys([id_col, *keep]))
    base = pages.select(*names, F.col(html_col).alias("_html"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    return base.mapInArrow(lambda b: _extract(b, shared.value), f"{fields}, text string, n_chars bigint")
