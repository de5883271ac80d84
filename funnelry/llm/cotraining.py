"""Quality scores by co-training of a text view and a page-metadata view.

Each view has a logistic classifier of its own. In every round each labels unlabelled
documents that it is sure of, and these are added to the other's training rows. Held-back
labels tell from which logit on a view is right so often that it may label; a view that is
not says nothing. Held-back labels then calibrate both, and the calibrated views are combined
to score all documents.

All unlabelled rows take part, and stay on the executors: a round's cut-offs come from counts
of logits, a fit from sums of gradients and Hessians. No row's pseudo-labels are stored; they
follow from the weights and cut-offs of the rounds so far.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelry.llm.jaccard_join import word_hashes
from funnelry.llm.texts import SYMBOLS
from funnelry.sources.tables import stored

#: The bounded sample of labelled documents: those of small hashes.
LABELLED = 4000
#: Rounds, and the share of the unlabelled documents that a view labels in each at most.
ROUNDS, SURE = 5, 0.05
#: How often a view must be right among held-back rows to label, and the weight of a
#: pseudo-label (less where they outnumber the labels: all of them weigh no more than these).
PRECISION, PSEUDO = 0.95, 0.5
WORD_CELLS, SOURCE_CELLS, HOST_CELLS = 128, 32, 32
TEXT_WIDTH = WORD_CELLS + 9
#: Steps of a fit at most, and the largest change of a weight in the last one.
STEPS, SMALL = 12, 1e-3
#: Logits are counted in equal cells from -REACH to REACH.
REACH, CELLS = 30, 4096
#: Partial sums of partitions are added up in so many tasks of each view.
DEAL = 16


def text_features(text: str | None) -> np.ndarray:
    """Style ratios and hashed word shares of a whole text; zeros without words."""
    out = np.zeros(TEXT_WIDTH, np.float32)
    raw = (text or "").encode()
    words = word_hashes(raw)
    if not len(words):
        return out
    n, lines = len(words), [x for x in text.split("\n") if x.strip()]
    codes = np.frombuffer(raw, np.uint8)
    upper = ((codes >= 65) & (codes <= 90)).sum()
    digits = ((codes >= 48) & (codes <= 57)).sum()
    symbols = sum(map(text.count, SYMBOLS))
    out[:9] = [
        np.log1p(n) / 8, len(raw) / n / 10, min(4, symbols / n), min(4, text.count("!") / n),
        upper / len(raw), digits / len(raw), len(np.unique(words)) / n,
        1 - len(set(lines)) / max(1, len(lines)), n < 20,
    ]
    cells = np.bincount((words % np.uint64(WORD_CELLS)).astype(np.int64), minlength=WORD_CELLS)
    out[9:] = cells / n * 4
    return out


def meta_features(rows: pd.DataFrame) -> np.ndarray:
    """Source, language, length, and what the URLs of a document's pages tell."""

    def cells(values: pd.Series, size: int) -> np.ndarray:
        hashed = pd.util.hash_array(values.fillna("").astype(str).to_numpy(object)) % size
        return np.eye(size)[hashed.astype(np.int64)]

    url = rows["url"].fillna("")
    host = url.str.extract(r"://(?:www\.|m\.|blog\.)?([^/?#]*)", expand=False)
    more = np.column_stack(
        [
            np.log1p(rows["n_chars"].fillna(0).clip(lower=0).astype(float)) / 10,
            np.log1p(rows["n_pages"].fillna(0).astype(float)),
            url.ne(""),
            url.str.startswith("https:"),
            url.str.contains("?", regex=False),
            url.str.contains("-", regex=False),
            url.str.len() / 100,
        ]
    ).astype(float)
    parts = [cells(rows["source"], SOURCE_CELLS), cells(rows["lang"], 8), cells(host, HOST_CELLS)]
    return np.hstack([more, *parts])


def _logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def _moments(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Loss, gradient and Hessian of a logistic fit, summed over rows, as one array."""
    z = _logit(x, w)
    p = 1 / (1 + np.exp(-np.clip(z, -REACH, REACH)))
    x = np.column_stack([x, np.ones(len(x))])
    hess = (x * (p * (1 - p))[:, None]).T @ x
    return np.concatenate([[(np.logaddexp(0, z) - y * z).sum()], x.T @ (y - p), hess.ravel()])


Sums = Callable[[list[np.ndarray]], list[np.ndarray]]


def _newton(sums: Sums, start: list[np.ndarray], ridge: float = 1.0) -> list[np.ndarray]:
    """Weights of several fits at once, the last one of each a constant.

    ``sums`` gives the moments of all at given weights. A step that raises the loss is halved.
    """
    best, trial, step = list(start), list(start), [np.zeros(1)] * len(start)
    loss, done = [np.inf] * len(start), [False] * len(start)
    for _ in range(STEPS):
        for v, moments in enumerate(sums(trial)):
            if done[v]:
                continue
            k, w = len(trial[v]), trial[v]
            now = moments[0] + ridge / 2 * (w @ w)
            if now > loss[v] + 1e-9 * abs(loss[v]):
                step[v] = step[v] / 2
            else:
                best[v], loss[v] = w, now
                hess = moments[1 + k :].reshape(k, k) + ridge * np.eye(k)
                step[v] = np.linalg.solve(hess, moments[1 : 1 + k] - ridge * w)
            trial[v] = best[v] + step[v]
            done[v] = np.abs(step[v]).max() < SMALL
        if all(done):
            return trial
    return best


@dataclass
class Views:
    """Weights of both views, and of their logits in the combination."""

    text: np.ndarray
    meta: np.ndarray
    joint: np.ndarray


@dataclass
class Round:
    """What a round's pseudo-labels follow from: weights, and each view's cut-offs.

    Rows below the low cell are labelled 0, rows above the high one 1, and of the rows of
    these cells a share that a hash chooses.
    """

    weights: list[np.ndarray]
    cuts: list[tuple[int, float, int, float]]


def _views(rows: pd.DataFrame) -> list[np.ndarray]:
    return [
        np.frombuffer(b"".join(rows[c]), np.float32).reshape(len(rows), -1).astype(float)
        for c in ("features", "meta")
    ]


def _cells(logits: np.ndarray) -> np.ndarray:
    cells = (logits + REACH) * (CELLS / (2 * REACH))
    return np.clip(np.floor(cells), 0, CELLS - 1).astype(np.int64)


def _given(views: list[np.ndarray], hashes: np.ndarray, rounds: list[Round]) -> list[np.ndarray]:
    """The labels that each view gives to the rows for the other: 0, 1, or -1 for none yet."""
    given = [np.full(len(hashes), -1.0) for _ in views]
    for turn, past in enumerate(rounds):
        for v, label in enumerate(given):
            cell = _cells(_logit(views[v], past.weights[v]))
            mixed = pd.util.hash_array(hashes ^ np.int64((2 * turn + v + 1) * 0x9E3779B97F4A7C1))
            draw = (mixed >> np.uint64(11)) / 2.0**53
            low, low_share, high, high_share = past.cuts[v]
            free = label < 0
            no = free & ((cell < low) | ((cell == low) & (draw < low_share)))
            yes = free & ~no & ((cell > high) | ((cell == high) & (draw >= 1 - high_share)))
            label[no], label[yes] = 0, 1
    return given


def _sure_cells(label: np.ndarray, logits: np.ndarray) -> tuple[int, int] | None:
    """Cells up to which label 0, and from which on label 1, is right often enough.

    Judged by held-back rows with Laplace's estimate. None unless both labels have one: a
    view that gives one label only would shift the classes.
    """
    cells, ends = _cells(logits), []
    for label_, order in ((0, np.argsort(cells)), (1, np.argsort(-cells))):
        right = np.cumsum(label[order] == label_)
        whole = np.append(np.diff(cells[order]) != 0, True)
        rate = (right + 1) / (np.arange(len(label)) + 3)
        good = np.flatnonzero(whole & (rate >= PRECISION))
        if not len(good):
            return None
        ends.append(int(cells[order[good[-1]]]))
    return ends[0], ends[1]


def _cut(
    counts: np.ndarray, low: int, high: int, sure: tuple[int, int] | None
) -> tuple[int, float, int, float]:
    """Where the ``low`` rows of the smallest logits and the ``high`` of the largest end.

    Fewer of both, in the same proportion, if the sure cells have not as many; none without.
    """
    part = 0.0
    if sure:
        room = (counts[: sure[0] + 1].sum(), counts[sure[1] :].sum())
        part = min(1.0, *(x / max(1, y) for x, y in zip(room, (low, high), strict=True)))
    low, high = int(low * part), int(high * part)

    def end(counts: np.ndarray, rows: int) -> tuple[int, float]:
        upto = np.cumsum(counts)
        cell = int(np.searchsorted(upto, rows))
        return cell, float((rows - upto[cell] + counts[cell]) / max(1, counts[cell]))

    total = int(counts.sum())
    low = min(low, total)
    cell, share = end(counts[::-1], min(high, total - low))
    return *end(counts, low), CELLS - 1 - cell, share


def _cuts(
    pool: DataFrame,
    rounds: list[Round],
    weights: list[np.ndarray],
    low: int,
    high: int,
    sure: list[tuple[int, int] | None],
) -> list[tuple[int, float, int, float]]:
    """Each view's cut-offs among the rows of the pool that it has not labelled yet."""
    shared = pool.sparkSession.sparkContext.broadcast((rounds, weights))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        past, now = shared.value
        counts = np.zeros((2, CELLS), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            views = _views(batch)
            for v, label in enumerate(_given(views, batch["hash"].to_numpy(), past)):
                cells = _cells(_logit(views[v][label < 0], now[v]))
                counts[v] += np.bincount(cells, minlength=CELLS)
        view, cell = np.nonzero(counts)
        yield pd.DataFrame({"view": view, "cell": cell, "rows": counts[view, cell]})

    found = pool.mapInPandas(count, "view int, cell int, rows long")
    counts = np.zeros((2, CELLS), np.int64)
    for r in found.groupBy("view", "cell").agg(F.sum("rows").alias("n")).collect():
        counts[r["view"], r["cell"]] = r["n"]
    return [_cut(c, low, high, x) for c, x in zip(counts, sure, strict=True)]


def _added(parts: pd.DataFrame) -> pd.DataFrame:
    """Adds partial sums, in the order of their partitions."""
    parts = parts.sort_values("part")
    total = sum(np.frombuffer(x) for x in parts["sums"])
    return parts[:1].assign(sums=[total.tobytes()])


def _pool_sums(
    pool: DataFrame, rounds: list[Round], weights: list[np.ndarray]
) -> list[np.ndarray | float]:
    """Moments of each view's fit over all rows of the pool that the other has labelled, and
    the number of these rows."""
    shared = pool.sparkSession.sparkContext.broadcast((rounds, weights))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        past, now = shared.value
        total = [np.zeros(2 + len(w) + len(w) ** 2) for w in now]
        for batch in batches:
            if not len(batch):
                continue
            views = _views(batch)
            labels = _given(views, batch["hash"].to_numpy(), past)[::-1]
            for v, label in enumerate(labels):
                some = label >= 0
                total[v][:-1] += _moments(views[v][some], label[some], now[v])
                total[v][-1] += some.sum()
        part = TaskContext.get().partitionId()
        yield pd.DataFrame({"part": part, "view": [0, 1], "sums": [x.tobytes() for x in total]})

    schema = "part int, view int, sums binary"
    parts = pool.mapInPandas(emit, schema)
    added = parts.groupBy("view", F.col("part") % DEAL).applyInPandas(
        lambda key, x: _added(x[["part", "view", "sums"]]), schema
    )
    total: list[np.ndarray | float] = [0.0, 0.0]
    for r in sorted(added.collect(), key=lambda r: r["part"]):
        total[r["view"]] = total[r["view"]] + np.frombuffer(r["sums"])
    return total


def cotrain(known: pd.DataFrame, pool: DataFrame) -> tuple[Views, list[Round]] | None:
    """Fits on labelled rows and on all rows of the pool; also what the rounds have given.

    Every fourth labelled row is held back: these rows tell when a view is sure, and
    calibrate. The rounds end early when no view is. None without both labels.
    """
    if not len(known):
        return None
    label, views = known["label"].to_numpy(float), _views(known)
    held = np.arange(len(label)) % 4 == 0
    if any(len(np.unique(label[x])) < 2 for x in (held, ~held)):
        return None

    def own(weights: list[np.ndarray]) -> list[np.ndarray]:
        return [_moments(x[~held], label[~held], w) for x, w in zip(views, weights, strict=True)]

    share, take = label[~held].mean(), int(pool.count() * SURE)
    weights = _newton(own, [np.zeros(x.shape[1] + 1) for x in views])
    rounds: list[Round] = []
    for _ in range(ROUNDS if take else 0):
        sure = [
            _sure_cells(label[held], _logit(x[held], w))
            for x, w in zip(views, weights, strict=True)
        ]
        if not any(sure):
            break
        low, high = int(take * (1 - share)), int(take * share)
        rounds.append(Round(weights, _cuts(pool, rounds, weights, low, high, sure)))

        def all_rows(now: list[np.ndarray]) -> list[np.ndarray]:
            given = _pool_sums(pool, rounds, now)
            weight = [min(PSEUDO, (~held).sum() / max(1.0, y[-1])) for y in given]
            return [x + y[:-1] * k for x, y, k in zip(own(now), given, weight, strict=True)]

        weights = _newton(all_rows, weights)
    logits = np.column_stack([_logit(x[held], w) for x, w in zip(views, weights, strict=True)])
    logits = np.clip(logits, -10, 10)
    joint = _newton(lambda w: [_moments(logits, label[held], w[0])], [np.zeros(3)])
    return Views(*weights, *joint), rounds


def _with_features(df: DataFrame, text: str) -> DataFrame:
    """The text as its features: packed 32-bit floats."""

    @F.pandas_udf(T.BinaryType())
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([text_features(t).tobytes() for t in batch], dtype=object)

    return df.withColumn("features", packed(F.col(text)))


def _with_meta(df: DataFrame) -> DataFrame:
    """The metadata columns as their features: packed 32-bit floats."""
    names = ["source", "lang", "n_chars", "n_pages", "url"]

    @F.pandas_udf(T.BinaryType())
    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = meta_features(batch).astype(np.float32) if len(batch) else []
            yield pd.Series([x.tobytes() for x in rows], dtype=object)

    return df.withColumn("meta", packed(F.struct(*names))).drop(*names)


def metadata(pages: DataFrame) -> DataFrame:
    """One row per document id that pages name in their path: smallest URL, and how many."""
    number = F.regexp_extract("url", r"://[^/?#]*[^?#]*/([0-9]{1,18})(?:[/.?#]|$)", 1)
    named = pages.filter("url is not null").select("url", number.alias("number"))
    named = named.filter("number != ''").withColumn("page_doc", F.col("number").cast("long"))
    return named.groupBy("page_doc").agg(
        F.min("url").alias("url"), F.count(F.lit(1)).alias("n_pages")
    )


def quality_scores(documents: DataFrame, pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``text_score``, ``meta_score``, ``kept`` of every row.

    A row is kept from a score of one half on. Texts without words, missing metadata and
    documents without pages are scored by what there is. Labels other than 0 and 1 count as
    none, of several labels of an id the largest counts. Without labels of both kinds all
    scores are one half.
    """
    spark = documents.sparkSession
    columns = ["doc_id", "source", "lang", "n_chars"]
    featured = _with_features(documents.select("text", *columns), "text").drop("text")
    rows = featured.join(
        metadata(pages), F.col("doc_id") == F.col("page_doc"), "left"
    ).drop("page_doc")
    clean = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("label"))
    marked = _with_meta(rows.join(clean, "doc_id", "left"))
    rows = stored(marked.withColumn("hash", F.xxhash64("doc_id", "features", "meta")), "features")
    known = rows.filter("label is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "hash")
    pool = rows.filter("label is null").select("features", "meta", "hash")
    found = cotrain(known.limit(LABELLED).toPandas(), pool)
    model = found[0] if found else None
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        views = shared.value
        for batch in batches:
            if not len(batch):
                continue
            out = batch[["doc_id"]].copy()
            out["score"] = out["text_score"] = out["meta_score"] = 0.5
            if views is not None:
                text, meta = _views(batch)
                logits = np.column_stack([_logit(text, views.text), _logit(meta, views.meta)])
                joint = _logit(np.clip(logits, -10, 10), views.joint)
                for name, value in zip(
                    ["text_score", "meta_score", "score"], [*logits.T, joint], strict=True
                ):
                    out[name] = 1 / (1 + np.exp(-np.clip(value, -30, 30)))
            yield out

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", "features", "meta").mapInPandas(
        score, f"doc_id {kind}, score double, text_score double, meta_score double"
    )
    return scored.withColumn("kept", F.col("score") >= 0.5)
