"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text is cut into bins. The model is one lookup table per
feature and one small table per chosen pair of features; a score is the sigmoid of
the sum of the looked-up values. The tables are learnt by cyclic boosting: in
each round a shallow tree is fitted to the residuals of one feature (then of one pair)
at a time, with a small step, so that no feature takes all of the signal.

The features are statistics of the text alone. Fitting uses at most ``max_rows``
labelled rows, chosen by a hash of doc_id, so that it fits the driver at every size;
features are extracted and scores computed in tasks over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import raw_texts

# labelled rows that the model is fitted on, at most
MAX_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 10
ROUNDS = 300
STEP = 0.1
LEAST_LEAF = 20
# words of a window in which distinct ones are counted; a longer text repeats words by nature
WINDOW = 500

FEATURES = (
    "log_bytes", "log_words", "mean_word", "upper", "symbols", "exclaims", "bars", "digits",
    "stops", "commas", "line_ends", "non_ascii", "distinct", "doubled", "top_word", "capitals",
    "short_words", "long_words", "worst_symbols", "worst_upper", "distinct_lines", "mean_line",
    "least_distinct",
)

_CLASS = np.zeros(256, np.uint8)
for _name, _chars in enumerate(
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", ".?", ",;:'\"-()",
     "!", "|", "#$%&*+/<=>@[\\]^_`{}~", " \t\r\f\v", "\n"), start=1,
):
    _CLASS[[ord(c) for c in _chars]] = _name
_CLASS[128:] = 11


def features(text: bytes) -> list[float]:
    """The values of FEATURES for one UTF-8 text."""
    if not text:
        return [0.0] * len(FEATURES)
    kinds = _CLASS[np.frombuffer(text, np.uint8)]
    n = np.bincount(kinds, minlength=12)
    size = len(text)
    letters = max(1, int(n[1] + n[2]))
    words = text.split()
    count = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    numbered: dict[bytes, int] = {}
    ids = np.fromiter(
        (numbered.setdefault(w, len(numbered)) for w in words), np.int64, len(words)
    )
    often = int(np.bincount(ids).max()) if len(ids) else 0
    shares = _distinct_shares(ids)
    capitals = sum(w[:1].isupper() for w in words)
    # the worst of the pieces between line ends, so that a bad part is not averaged away
    ends = np.concatenate([np.flatnonzero(kinds == 10), [size]])
    begins = np.concatenate([[0], ends[:-1] + 1])
    widths = np.maximum(ends - begins, 1)
    marks = np.concatenate([[0], np.cumsum((kinds >= 6) & (kinds <= 8))])
    uppers = np.concatenate([[0], np.cumsum(kinds == 1)])
    lowers = np.concatenate([[0], np.cumsum(kinds == 2)])
    long_ = widths >= 30
    worst_symbols = worst_upper = 0.0
    if long_.any():
        b, e = begins[long_], ends[long_]
        worst_symbols = float(((marks[e] - marks[b]) / widths[long_]).max())
        up, low = uppers[e] - uppers[b], lowers[e] - lowers[b]
        worst_upper = float((up / np.maximum(up + low, 1)).max())
    lines = text.split(b"\n")
    return [
        float(np.log1p(size)),
        float(np.log1p(len(words))),
        float(lengths.mean()) if len(words) else 0.0,
        n[1] / letters,
        n[8] / size,
        n[6] / size,
        n[7] / size,
        n[3] / size,
        n[4] / size,
        n[5] / size,
        n[10] / size,
        n[11] / size,
        float(shares.mean()) if len(ids) else 0.0,
        float((ids[1:] == ids[:-1]).mean()) if len(ids) > 1 else 0.0,
        often / count,
        capitals / count,
        float((lengths <= 3).mean()) if len(words) else 0.0,
        float((lengths >= 14).mean()) if len(words) else 0.0,
        worst_symbols,
        worst_upper,
        len(set(lines)) / len(lines),
        size / len(lines),
        float(shares.min()) if len(ids) else 0.0,
    ]


def _distinct_shares(ids: np.ndarray) -> np.ndarray:
    """The share of distinct words of consecutive windows that cover the whole text.

    The last window ends with the text and overlaps the one before.
    """
    if len(ids) <= WINDOW:
        return np.array([len(np.unique(ids)) / max(1, len(ids))])
    begins = np.append(np.arange(0, len(ids) - WINDOW, WINDOW), len(ids) - WINDOW)
    windows = np.sort(np.lib.stride_tricks.sliding_window_view(ids, WINDOW)[begins], axis=1)
    return (1 + (windows[:, 1:] != windows[:, :-1]).sum(axis=1)) / WINDOW


@dataclass(frozen=True)
class Model:
    """Bin edges and lookup tables. ``pairs`` holds (i, j, edges i, edges j, table)."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for i, (cuts, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(cuts, x[:, i], "right")]
        for i, j, cuts_i, cuts_j, values in self.pairs:
            a = np.searchsorted(cuts_i, x[:, i], "right")
            total += values[a, np.searchsorted(cuts_j, x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = 3) -> np.ndarray:
    """A tree over ordered bins: at most ``leaves`` ranges, each with its Newton step."""
    cg, ch, cn = (np.concatenate([[0], np.cumsum(v)]) for v in (g, h, n))
    bounds = [0, len(g)]
    while len(bounds) <= leaves:
        best = (1e-9, 0)
        for a, b in zip(bounds, bounds[1:]):
            at = np.arange(a + 1, b)
            at = at[(cn[at] - cn[a] >= LEAST_LEAF) & (cn[b] - cn[at] >= LEAST_LEAF)]
            if not len(at):
                continue
            split = _gain(cg[at] - cg[a], ch[at] - ch[a]) + _gain(cg[b] - cg[at], ch[b] - ch[at])
            split -= _gain(cg[b] - cg[a], ch[b] - ch[a])
            best = max(best, (float(split.max()), int(at[split.argmax()])))
        if not best[1]:
            break
        bounds = sorted([*bounds, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(bounds, bounds[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut into four quadrants of a two-feature grid: its gain and the steps."""
    cg = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    ch = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    parts = []
    for c in (cg, ch):
        a = c[1:-1, 1:-1]
        top, left, total = c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
        parts.append((a, top - a, left - a, total - top - left + a))
    if not parts[0][0].size:
        return 0.0, np.zeros_like(g)
    gain = sum(_gain(x, y) for x, y in zip(*parts)) - _gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    steps = [float(x[i, j] / (y[i, j] + 1.0)) for x, y in zip(*parts)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :] = steps[0], steps[1]
    out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = steps[2], steps[3]
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit on features ``x`` and labels ``y`` (0 or 1). No rows give the constant 0.5."""
    if not len(y):
        return Model(0.0, [], [], [])
    rate = (y.sum() + 0.5) / (len(y) + 1)
    intercept = float(np.log(rate / (1 - rate)))
    edges = [_cuts(x[:, i], BINS) for i in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, i], "right") for i, c in enumerate(edges)]
    tables = [np.zeros(len(c) + 1) for c in edges]
    sizes = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables)]
    total = np.full(len(y), intercept)
    # rows held back from the trees tell when to stop
    back = np.arange(len(y)) % 7 == 3
    train = ~back if len(y) >= 500 else np.ones(len(y), bool)
    weight = train.astype(float)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return (y - p) * weight, p * (1 - p) * weight

    def loss() -> float:
        p = np.clip(1 / (1 + np.exp(-total[back])), 1e-9, 1 - 1e-9)
        return float(-np.mean(np.where(y[back] == 1, np.log(p), np.log(1 - p))))

    def boost(cells: list[np.ndarray], steps, values: list[np.ndarray]) -> None:
        """Cycle over all tables; keep the state with the smallest loss on the held-back rows."""
        nonlocal total
        best = (loss() if back.any() else 0.0, [v.copy() for v in values], total.copy())
        waited = 0
        for _ in range(ROUNDS):
            for k, cell in enumerate(cells):
                g, h = residuals()
                step = STEP * steps(k, cell, g, h)
                values[k] += step
                total += step.ravel()[cell]
            if not back.any():
                continue
            now = loss()
            if now < best[0] - 1e-5:
                best, waited = (now, [v.copy() for v in values], total.copy()), 0
            else:
                waited += 1
                if waited >= 20:
                    break
        if back.any():
            for v, kept in zip(values, best[1]):
                v[...] = kept
            total = best[2]

    def single(k: int, cell: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        size = len(tables[k])
        return _tree(np.bincount(cell, g, size), np.bincount(cell, h, size), sizes[k])

    boost(bins, single, tables)

    # the pairs whose quadrants explain most of what the single features left
    coarse = [_cuts(x[:, i], PAIR_BINS) for i in range(x.shape[1])]
    small = [np.searchsorted(c, x[:, i], "right") for i, c in enumerate(coarse)]
    g, h = residuals()
    ranked = []
    for i in range(x.shape[1]):
        for j in range(i):
            shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
            cell = small[i] * shape[1] + small[j]
            grids = [np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)]
            ranked.append((_pair_tree(*grids)[0], i, j))
    chosen = [(i, j) for _, i, j in sorted(ranked, reverse=True)[:PAIRS]]
    grids = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in chosen]
    cells = [small[i] * t.shape[1] + small[j] for (i, j), t in zip(chosen, grids)]

    def double(k: int, cell: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        shape = grids[k].shape
        sums = [np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)]
        return _pair_tree(*sums)[1]

    boost(cells, double, grids)
    pairs = [(i, j, coarse[i], coarse[j], t) for (i, j), t in zip(chosen, grids)]
    return Model(intercept, edges, tables, pairs)


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    rows = [features(t) for t in raw_texts(column)]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled documents that are not held out.

    Rows without label or id are left out, and so are documents with opposite labels.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .filter("doc_id is not null and quality in (0, 1)")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("y"), F.max("quality").alias("high"))
        .filter("y = high")
        .select("doc_id", F.col("y").cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).join(F.broadcast(known), "doc_id")  # bounded by max_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(list(x))],
                names=["doc_id", "y", "x"],
            )

    # of rows that repeat a doc_id one is taken
    found = rows.mapInArrow(run, "doc_id long, y int, x array<double>")
    sample = found.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x"))
    got = sorted(sample.collect(), key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in got], float).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r["y"] for r in got], float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document.

    A null text counts as empty; its score comes from the model like any other. Rows
    without a doc_id are scored too and are not held out. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.score(_matrix(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p)],
                names=["doc_id", "held_out", "score"],
            )

    marked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    scored = marked.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a score of 0.5 or more, all columns as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = model.score(_matrix(batch.column("text").fill_null(""))) >= 0.5
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
