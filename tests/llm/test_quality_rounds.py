"""Co-training over a written table of views against a plain loop over all rows."""

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import quality as Q


class PlainPool:
    """The same questions answered from arrays, row by row."""

    def __init__(self, text, cells):
        self.text, self.where = text, cells

    def cells(self):
        out = np.zeros(Q.CELLS)
        for c in self.where:
            out[c] += 1
        return out

    def by_logit(self, view):
        out = np.zeros(len(Q.LOGITS))
        for z in view.logit(self.text):
            out[int(round(z * 100)) + 1200] += 1
        return out

    def by_cell(self, view, named):
        out = np.zeros((2, Q.CELLS))
        for z, c in zip(view.logit(self.text), self.where):
            name = named[int(round(z * 100)) + 1200]
            if name >= 0:
                out[name, c] += 1
        return out

    def slopes(self, view, by_cell):
        n = len(view.weights)
        curve, gradient, loss = np.zeros((n, n)), np.zeros(n), 0.0
        for x, c in zip(view.inputs(self.text), self.where):
            if by_cell[c] >= 0:
                x = np.append(1, x)
                p = 1 / (1 + np.exp(-np.clip(x @ view.weights, -35, 35)))
                curve += np.outer(x, x) * p * (1 - p)
                gradient += x * (by_cell[c] - p)
                loss -= np.log(p if by_cell[c] else 1 - p)
        return curve, gradient, loss


def test_rounds_equal_a_plain_loop(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    settings = Q.Settings(certainty=0.8)
    model = Q.train(docs, labels.filter("doc_id % 3 = 0"), settings=settings)
    rows = docs.join(labels.filter("doc_id % 3 = 0").select(F.col("doc_id").alias("l"), "quality"), F.col("doc_id") == F.col("l"), "left").collect()
    import zlib

    import pyarrow as pa

    rows.sort(key=lambda r: zlib.crc32(repr(r.doc_id).encode()))
    text = Q.text_view(pa.array([r.text or "" for r in rows])).astype(np.float32).astype(float)
    cells = Q.page_cells([r.source for r in rows], [r.lang for r in rows], [r.n_chars for r in rows])
    known = np.array([r.quality is not None for r in rows])
    y = np.array([r.quality or 0.0 for r in rows], float)
    plain = Q.co_train(text[known], cells[known], y[known], PlainPool(text[~known], cells[~known]), settings)
    alone = Q.co_train(text[known], cells[known], y[known], PlainPool(text[:0], cells[:0]), settings)
    assert np.allclose(model.text.weights, plain.text.weights, atol=1e-6) and np.allclose(model.page.weights, plain.page.weights, atol=1e-6)
    assert np.allclose(model.score(text, Q.page_view(cells)), plain.score(text, Q.page_view(cells)), atol=1e-6)
    assert not np.allclose(alone.page.weights, plain.page.weights, atol=1e-3)  # pseudo-labels matter


def test_every_kind_of_document_can_get_a_pseudo_label():
    """The surest values are named whole, on both sides, and unsure ones never."""
    counts = np.array([5.0, 1, 100, 1, 3])
    assert Q.surest(counts, np.array([-6.0, -4, 0, 4, 6]), Q.Settings(share=0.03)).tolist() == [0, -1, -1, 1, 1]
    assert Q.surest(counts * 0, np.array([-6.0, -4, 0, 4, 6]), Q.Settings()).tolist() == [-1] * 5


def test_saturated_views_are_calibrated():
    """Log odds far from zero with a few rows on the wrong side: the line must not turn round."""
    rng = np.random.default_rng(4)
    y = (rng.random(4000) < 0.86).astype(float)
    x = np.where(y == 1, 1.0, -1.0)[:, None] * rng.uniform(20, 90, (4000, 1))
    x[:5] = -x[:5]
    view = Q.calibrated(Q.View(np.zeros(1), np.ones(1) / 40, np.array([0.0, 1.0])), x, y)
    assert view.slope > 0 and ((view.logit(x) > 0) == (y == 1)).mean() > 0.99
