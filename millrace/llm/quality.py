"""Quality by co-training of two views of a document.

The text view sees what the text looks like (characters, repetition, shouting, symbols); the page view sees the
record around it (source, language, length). Each is a logistic model. For some rounds each model names
the unlabelled documents it is surest about, and these pseudo-labels train the other one. At the end both are calibrated on
labelled documents that neither was fitted to, and their log odds are added, the prior counted once.

All unlabelled documents take part, however many there are. Their views are written once. The page view has
``CELLS`` different values, so the page model is fitted to counts by cell; the text model takes Newton steps whose gradient
and curvature Spark sums over the documents. Pseudo-labels together weigh as much as a share of the labelled rows, at any size of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C
from millrace.llm.words import Words, slices
from millrace.workspace import settle


@dataclass(frozen=True)
class Settings:
    #: Bound on the labelled rows used for fitting.
    labelled_rows: int = 20_000
    rounds: int = 3
    #: Pseudo-labels of a round: about this share of the unlabelled documents for each class, and only from this certainty on.
    share: float = 0.1
    certainty: float = 0.97
    #: Weight of all pseudo-labels together, for one labelled row used for fitting.
    trust: float = 0.25
    penalty: float = 1.0
    steps: int = 3  # Newton steps of the text model in a round


# --- views ---------------------------------------------------------------------------------------

#: Byte classes: every ASCII punctuation mark, upper, lower, digit, blank, line end, control, beyond ASCII.
_CLASS = np.zeros(256, np.uint8)
for _b in range(256):
    _CLASS[_b] = 0 if 97 <= _b <= 122 else 1 if 65 <= _b <= 90 else 2 if 48 <= _b <= 57 else 3 if _b == 32 else 4 if _b == 10 else 5 if _b < 32 or _b == 127 else 6
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
for _i, _b in enumerate(_MARKS):
    _CLASS[_b] = 7 + _i
_CLASSES = 7 + len(_MARKS)
TEXT_INPUTS = _CLASSES + 8
_SLICE = 1 << 20  # bytes of text whose arrays are held at once; a longer text is held alone


def text_view(texts: pa.Array) -> np.ndarray:
    """A row of numbers for each whole text; zeros for an empty one."""
    words = Words(texts, lower=False)
    docs = len(words.bounds) - 1
    kinds = _CLASS[words.data]
    counts = np.zeros((docs, _CLASSES))
    for doc, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
        counts[doc] = np.bincount(kinds[a:b], minlength=_CLASSES)
    size = np.maximum(counts.sum(axis=1), 1)
    out = np.zeros((docs, TEXT_INPUTS))
    out[:, :_CLASSES] = np.sqrt(counts / size[:, None])
    if not len(words):
        return out

    hashes, n = words.hashes(), np.diff(words.first)
    doc = np.repeat(np.arange(docs), n)
    many = np.maximum(n, 1)
    per_doc = lambda flag: np.bincount(doc, flag, docs) / many
    up = np.concatenate([[0], np.cumsum(kinds == 1, dtype=np.int32)])
    low = np.concatenate([[0], np.cumsum((kinds == 0) | (kinds == 6), dtype=np.int32)])
    mark = kinds >= 7
    lengths = words.ends - words.starts
    ups, lows = up[words.ends] - up[words.starts], low[words.ends] - low[words.starts]
    same = np.append(False, (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1]))
    order = np.lexsort((hashes, doc))
    new = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1]))
    distinct = np.bincount(doc[order], new, docs)
    trailing = mark[words.ends - 1] & (lengths > 2) & mark[np.maximum(words.ends - 2, 0)]
    out[:, _CLASSES:] = np.column_stack([
        per_doc(same), np.sqrt(per_doc(trailing)), np.sqrt(per_doc((ups > 1) & (lows == 0))), np.sqrt(per_doc((ups + lows) == 0)),
        distinct / many, distinct / np.sqrt(many) / 10, np.log1p(n) / 10, per_doc(lengths) / 10,
    ])
    return out


PAGE_INPUTS = 64 + 16 + 16
CELLS = 64 * 16 * 16


def page_cells(sources: list, langs: list, sizes: list) -> np.ndarray:
    """Hashed source and language, and the length by powers of two, as one number; nulls are values of their own."""
    cell = lambda s, l, n: (zlib.crc32(repr(s).encode()) % 64) << 8 | (zlib.crc32(repr(l).encode()) % 16) << 4 | min(15, int(max(n or 0, 0)).bit_length())  # noqa: E741, E731
    return np.array([cell(*row) for row in zip(sources, langs, sizes)], np.int64)


def page_view(cells: np.ndarray) -> np.ndarray:
    """The three parts of each cell as ones among zeros."""
    out, row = np.zeros((len(cells), PAGE_INPUTS)), np.arange(len(cells))
    out[row, cells >> 8] = out[row, 64 + (cells >> 4 & 15)] = out[row, 80 + (cells & 15)] = 1
    return out


# --- models --------------------------------------------------------------------------------------


def _odds(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class View:
    """Standardised inputs, a logistic model, and the line that calibrates its log odds."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.inputs(x) @ self.weights[1:] + self.weights[0]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.raw(x) + self.offset, -12, 12)


def slopes(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Curvature and gradient of the weighted log likelihood, and the loss; ``x`` has a first column of ones."""
    z = x @ w
    p = _odds(z)
    loss = float((weight * (np.logaddexp(0, z) - y * z)).sum())
    return (x * (weight * p * (1 - p))[:, None]).T @ x, x.T @ (weight * (y - p)), loss


def climb(of: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, float]], w: np.ndarray, penalty: float, steps: int) -> np.ndarray:
    """The best weights of some penalised Newton steps (the first weight is not penalised).

    ``of`` gives curvature, gradient and loss at weights. A step that does not lower the penalised loss is halved, so that saturated
    rows cannot throw the weights to the other side.
    """
    ridge = np.full(len(w), penalty)
    ridge[0] = 1e-6
    best, least, step = w, np.inf, np.zeros(len(w))
    for _ in range(steps):
        curve, gradient, loss = of(w)
        loss += 0.5 * float((ridge * w * w).sum())
        if not loss <= least:
            step = step / 2
        else:
            best, least = w, loss
            step = np.linalg.solve(curve + np.diag(ridge + 1e-9), gradient - ridge * w)
            if np.abs(step).max() < 1e-6:
                break
            step = np.clip(step, -3, 3)
        w = best + step
    return best


def ones(x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), x])


def newton(x: np.ndarray, y: np.ndarray, penalty: float, weight: np.ndarray | None = None, steps: int = 60) -> np.ndarray:
    """Penalised logistic regression."""
    x, weight = ones(x), np.ones(len(x)) if weight is None else weight
    return climb(lambda w: slopes(x, y, weight, w), np.zeros(x.shape[1]), penalty, steps)


def fit_view(x: np.ndarray, y: np.ndarray, penalty: float) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    view = View(mean, scale, np.zeros(0))
    return replace(view, weights=newton(view.inputs(x), y, penalty))


def calibrated(view: View, x: np.ndarray, y: np.ndarray) -> View:
    """The view with the line that fits its log odds to rows it has not seen; as it is if these are of one class."""
    if len(set(y.tolist())) < 2:
        return view
    offset, slope = newton(view.raw(x)[:, None], y, 0.1)
    return replace(view, offset=offset, slope=max(slope, 0.0))


@dataclass
class CoTrained:
    text: View | None
    page: View | None
    prior: float

    @property
    def fitted(self) -> bool:
        """Whether any view tells documents apart; if not, all have the same score and it says nothing of any of them."""
        return self.text is not None and (self.text.slope > 0 or self.page.slope > 0)

    def score(self, texts: np.ndarray, pages: np.ndarray) -> np.ndarray:
        if self.text is None:
            return np.full(len(texts), _odds(np.array(self.prior)))
        return _odds(self.text.logit(texts) + self.page.logit(pages) - self.prior)


def surest(counts: np.ndarray, logits: np.ndarray, settings: Settings) -> np.ndarray:
    """Which values a model names: 1 or 0 where it is sure enough, from the surest on until the share is reached, -1 elsewhere.

    ``counts`` says how many unlabelled documents have each of the ``logits``.
    """
    out = np.full(len(logits), -1)
    line, most = np.log(settings.certainty / (1 - settings.certainty)), settings.share * counts.sum()
    for name, sure in ((1, logits), (0, -logits)):
        order = np.argsort(-sure, kind="stable")
        before = np.cumsum(counts[order]) - counts[order]
        out[order[(sure[order] >= line) & (before < most)]] = name
    return out


def co_train(text: np.ndarray, cells: np.ndarray, y: np.ndarray, pool: Pool, settings: Settings) -> CoTrained:
    """Every fourth labelled row of a class only calibrates; the others and the pseudo-labels fit.

    With fewer than four rows of a class nothing is calibrated, and all rows of that class fit.
    """
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return CoTrained(None, None, float(np.log(share / (1 - share))))
    check = np.where(y == 1, np.cumsum(y == 1), np.cumsum(y != 1)) % 4 == 0
    share = float(y[check if len(set(y[check].tolist())) == 2 else ~check].mean().clip(0.01, 0.99))
    prior = float(np.log(share / (1 - share)))
    page, fit = page_view(cells), ~check
    every_cell = page_view(np.arange(CELLS))
    text_model = calibrated(fit_view(text[fit], y[fit], settings.penalty), text[check], y[check])
    page_model = calibrated(fit_view(page[fit], y[fit], settings.penalty), page[check], y[check])
    lent = settings.trust * fit.sum()
    for _ in range(settings.rounds):
        # each names what it is sure of before either is fitted again
        bins = surest(pool.by_logit(text_model), LOGITS, settings)
        named = pool.by_cell(text_model, bins)
        by_cell = surest(pool.cells(), page_model.logit(every_cell), settings)
        taken = float(pool.cells()[by_cell >= 0].sum())

        count = named.sum()
        if count:
            x = np.vstack([page[fit], every_cell, every_cell])
            target = np.concatenate([y[fit], np.zeros(CELLS), np.ones(CELLS)])
            weight = np.concatenate([np.ones(fit.sum()), *(named * min(1.0, lent / count))])
            held = weight > 0
            page_model = replace(page_model, weights=newton(page_model.inputs(x[held]), target[held], settings.penalty, weight[held]))
        if taken:
            x, trust, model = ones(text_model.inputs(text[fit])), min(1.0, lent / taken), text_model

            def both(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
                own, of_pool = slopes(x, y[fit], np.ones(len(x)), w), pool.slopes(replace(model, weights=w), by_cell)  # noqa: B023
                return tuple(a + trust * b for a, b in zip(own, of_pool))  # noqa: B023

            text_model = replace(text_model, weights=climb(both, text_model.weights, settings.penalty, settings.steps + 1))
        text_model, page_model = calibrated(text_model, text[check], y[check]), calibrated(page_model, page[check], y[check])
    return CoTrained(text_model, page_model, prior)


# --- Spark ---------------------------------------------------------------------------------------


def _page_columns(docs: DataFrame) -> list[Column]:
    """source, lang and n_chars, null where the table has no such column."""
    kinds = {"source": "string", "lang": "string", "n_chars": "long"}
    return [(F.col(c) if c in docs.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]


def _viewed(rows: DataFrame) -> DataFrame:
    """y, text_view, cell of every row."""

    def views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body", _SLICE):
                meta = [part.column(c).to_pylist() for c in ("source", "lang", "n_chars")]
                text = text_view(part.column("body")).astype(np.float32)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(text) + 1, dtype=np.int32) * TEXT_INPUTS), pa.array(text.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), flat, pa.array(page_cells(*meta).astype(np.int32))], ["id", "y", "text_view", "cell"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(views, f"id {kind}, y double, text_view array<float>, cell int")


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().astype(float).reshape(-1, TEXT_INPUTS)


#: Log odds by which documents are counted: hundredths between the limits of a view.
LOGITS = np.arange(-1200, 1201) / 100


def _place(logits: np.ndarray) -> np.ndarray:
    return np.round(logits * 100).astype(int) + 1200


class Pool:
    """What co-training asks of all unlabelled documents, given as a written table of views."""

    def __init__(self, views: DataFrame):
        self.views = views
        self._cells: np.ndarray | None = None

    def _summed(self, width: int, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum of ``of(text inputs, cells)``, an array of ``width`` numbers, over all documents; added up by Spark."""

        def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width)
            for batch in batches:
                total += of(_matrix(batch.column("text_view")), batch.column("cell").to_numpy())
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["place", "value"])

        found = self.views.select("text_view", "cell").mapInArrow(compute, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
        out = np.zeros(width)
        for r in found.collect():  # at most ``width`` rows
            out[r["place"]] = r["value"]
        return out

    def cells(self) -> np.ndarray:
        """Documents of each cell."""
        if self._cells is None:
            self._cells = np.zeros(CELLS)
            for r in self.views.groupBy("cell").count().collect():
                self._cells[r["cell"]] = r["count"]
        return self._cells

    def by_logit(self, view: View) -> np.ndarray:
        """Documents by the log odds that a text view gives them."""
        return self._summed(len(LOGITS), lambda x, _: np.bincount(_place(view.logit(x)), minlength=len(LOGITS)))

    def by_cell(self, view: View, named: np.ndarray) -> np.ndarray:
        """How many documents of each cell the text view names bad (first row) and good, by what it says of their log odds."""
        def count(x: np.ndarray, cells: np.ndarray) -> np.ndarray:
            name = named[_place(view.logit(x))]
            return np.bincount((name * CELLS + cells)[name >= 0], minlength=2 * CELLS)

        return self._summed(2 * CELLS, count).reshape(2, CELLS)

    def slopes(self, view: View, by_cell: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Curvature, gradient and loss of the text view over the documents whose cell is named."""
        n = len(view.weights)

        def add(x: np.ndarray, cells: np.ndarray) -> np.ndarray:
            name = by_cell[cells]
            x = ones(view.inputs(x[name >= 0]))
            return np.concatenate([np.ravel(part) for part in slopes(x, name[name >= 0], np.ones(len(x)), view.weights)])

        whole = self._summed(n * n + n + 1, add)
        return whole[: n * n].reshape(n, n), whole[n * n : -1], float(whole[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> CoTrained:
    """Co-train on at most ``labelled_rows`` labelled documents and on all others without their labels.

    The labelled ones are picked by a hash of the identifier. Null labels are left out; labels that differ for an
    identifier are averaged and rounded. Without labels of both classes no view is fitted, and every document gets the share of good ones.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("mr_id")).agg(F.round(F.avg(F.col(label).cast("double"))).alias("y"))
    known = known.orderBy(F.xxhash64("mr_id"), "mr_id").limit(settings.labelled_rows)
    texts = docs.select(F.col(id_column).alias("id"), C.whole(F.col(text_column)).alias("body"), *_page_columns(docs))
    # the broadcast side has at most labelled_rows pairs of numbers
    marked = texts.join(F.broadcast(known), F.col("id") == F.col("mr_id"), "left")
    views = settle(_viewed(marked.select("id", "y", "body", "source", "lang", "n_chars")), "quality-views")
    # repeated rows could make more of them: the limit holds all the same
    rows = views.filter("y is not null").limit(2 * settings.labelled_rows).toArrow().combine_chunks()
    names = [repr(i) for i in rows.column("id").to_pylist()]
    text = _matrix(rows.column("text_view")) if len(rows) else np.zeros((0, TEXT_INPUTS))
    order = sorted(range(len(rows)), key=lambda r: (zlib.crc32(names[r].encode()), names[r], text[r].tolist()))
    cells, y = (rows.column(c).to_numpy()[order] for c in ("cell", "y"))
    return co_train(text[order], cells.astype(np.int64), y.astype(float), Pool(views.filter("y is null")), settings)


def score_documents(docs: DataFrame, model: CoTrained, text_column: str = "text", score_column: str = "quality_score") -> DataFrame:
    """``docs`` with the probability that a document is good, for every row and whole text.

    Null and empty texts look like an empty text to the text view, null page columns like a value of their
    own. Row by row, without a shuffle; a column of the name ``score_column`` is replaced.
    """

    @F.arrow_udf("double")
    def score(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for body, source, lang, size in batches:
            batch = pa.RecordBatch.from_arrays([body, source, lang, size], ["body", "source", "lang", "n_chars"])
            out = [np.zeros(0)]
            for part in slices(batch, "body", _SLICE):
                meta = [part.column(c).to_pylist() for c in ("source", "lang", "n_chars")]
                out.append(model.score(text_view(part.column("body")), page_view(page_cells(*meta))))
            yield pa.array(np.concatenate(out), pa.float64())

    return docs.withColumn(score_column, score(C.whole(F.col(text_column)), *_page_columns(docs)))
