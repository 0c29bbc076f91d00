"""Quality classifier by co-training a text view and a metadata view.

Each view has a logistic model. In rounds, each labels the unlabelled documents it is surest
of for the other to learn from, as far down its ranking as labelled rows held out show it to
be right; those rows then calibrate both, and a model over the two calibrated scores combines
them. Models are fitted on bounded samples; all documents
are scored in one scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Words, chunks, ready

LABELLED = 6_000  # labelled documents that the fit may hold, about
UNLABELLED = 6_000  # others that it may label itself, about
ROUNDS = 3
PRECISION = 0.9  # share of right labels, on rows held out, down to which a view teaches
TAUGHT_WEIGHT = 0.05  # of a row labelled by the other view, against 1 of a labelled one
PER_ROUND = 600  # documents that one view labels for the other in a round
LEAST_OF_CLASS = 10
KEEP_FROM = 0.5

#: Kinds of bytes: lower case, capitals, digits, spaces, line ends, and marks by their use.
_KINDS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:", "!?", "%$#&*@^~", "|/\\_<>=+", "'\"()[]{}-"]
WORD_BUCKETS = 256
CHUNK_BYTES = 2 << 20
WINDOW_BYTES = 1 << 18
SHAPE = 4  # words said twice running, words, bytes a word, shortness
STEPS = 32  # half octaves of a size
META = 8 + 64 + 6 + 3 * STEPS

_SCORES = "doc_id long, text_score double, metadata_score double, score double, keep boolean"


def _kind_of() -> np.ndarray:
    out = np.full(256, len(_KINDS), dtype=np.int8)
    for i, chars in enumerate(_KINDS):
        out[[ord(c) for c in chars]] = i
    return out


def text_features(texts: list[bytes | None]) -> np.ndarray:
    """Shares of neighbouring byte kinds and of hashed words, as square roots, and the shape."""
    kinds = len(_KINDS) + 1
    parts = [t or b"" for t in texts]
    size = np.asarray([len(p) for p in parts])
    ends = np.cumsum(size)
    kind = _kind_of()[np.frombuffer(b"".join(parts), dtype=np.uint8)]
    pairs = np.zeros(len(parts) * kinds * kinds)
    for at in range(0, len(kind) - 1, WINDOW_BYTES):  # a window at a time, to hold little
        stop = min(at + WINDOW_BYTES + 1, len(kind))
        text = np.repeat(np.arange(len(parts), dtype=np.int32), np.clip(ends, at, stop) - np.clip(ends - size, at, stop))
        code = text[1:] * np.int32(kinds * kinds) + kind[at : stop - 1] * np.int32(kinds) + kind[at + 1 : stop]
        pairs += np.bincount(code[text[1:] == text[:-1]], minlength=len(pairs))
    words = Words(parts)
    n = np.diff(words.first)
    values, owner = words.hashes(), np.repeat(np.arange(len(parts)), n)
    at = owner * WORD_BUCKETS + (values % np.uint64(WORD_BUCKETS)).astype(np.int64)
    hashed = np.bincount(at, minlength=len(parts) * WORD_BUCKETS).reshape(len(parts), WORD_BUCKETS)
    pairs = pairs.reshape(len(parts), -1)
    again = np.bincount(owner[1:][(values[1:] == values[:-1]) & (owner[1:] == owner[:-1])], minlength=len(parts)) if words.n else np.zeros(len(parts))
    shape = np.stack([np.sqrt(again / np.maximum(n, 1)), np.log1p(n), np.log1p(size / np.maximum(n, 1)), 1 / (1 + n)], axis=1)
    # shares in a short text say less: they are drawn to nothing
    return np.concatenate([np.sqrt(pairs / (size + 40)[:, None]), np.sqrt(hashed / (n + 20)[:, None]), shape], axis=1).astype(np.float32)


def meta_features(lang: list, source: list, n_chars: list, texts: list[bytes | None]) -> np.ndarray:
    """What is known of a page without reading its words: language, source, size and layout.

    Sizes come as logarithms and by half octaves, so that a size in between can tell.
    """
    import zlib

    out = np.zeros((len(lang), META), dtype=np.float32)
    rows = np.arange(len(lang))
    out[rows, [zlib.crc32(str(x).encode()) % 8 for x in lang]] = 1
    out[rows, [8 + zlib.crc32(str(x).encode()) % 64 for x in source]] = 1
    size = np.asarray([len(t or b"") for t in texts], dtype=np.float64)
    lines = np.asarray([(t or b"").count(b"\n") + 1 for t in texts], dtype=np.float64)
    chars = np.asarray([0 if x is None else max(0, x) for x in n_chars], dtype=np.float64)
    logs = np.stack([np.log1p(chars), np.log1p(size), np.log1p(lines), np.log1p(size / lines)], axis=1)
    out[:, 72:78] = np.c_[logs, [x is None for x in n_chars], [t is None for t in texts]]
    for i, c in enumerate((0, 2, 3)):
        out[rows, 78 + i * STEPS + np.minimum(2 * logs[:, c] / np.log(2), STEPS - 1).astype(int)] = 1
    return out


class Logistic:
    """Ridge logistic regression by Newton steps, on standardised columns."""

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25, weight: np.ndarray | float = 1.0) -> Logistic:
        x = x.astype(np.float64)
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = np.c_[(x - self.mean) / self.scale, np.ones(len(x))]
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        self.w = np.zeros(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            step = np.linalg.solve((z.T * (weight * p * (1 - p) + 1e-9)) @ z + np.diag(penalty), z.T @ (weight * (y - p)) - penalty * self.w)
            self.w += step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-6:
                break
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1], -30, 30)


def _chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-logit))


def precise_from(score: np.ndarray, right: np.ndarray) -> float:
    """The lowest score from which upwards at least ``PRECISION`` of the rows are right.

    Infinite where no score leaves ``LEAST_OF_CLASS`` rows above it that are.
    """
    order = np.argsort(-score, kind="stable")
    n = np.arange(1, len(order) + 1)
    good = np.flatnonzero((np.cumsum(right[order]) >= PRECISION * n) & (n >= LEAST_OF_CLASS))
    return float(score[order[good[-1]]]) if len(good) else np.inf


class CoTrained:
    """Both views, their calibration and their combination."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray, rounds: int = ROUNDS):
        classes = np.bincount(y, minlength=2)
        self.base = (classes[1] + 1) / (len(y) + 2)
        self.fitted = bool(classes.min() >= LEAST_OF_CLASS)
        if not self.fitted:
            return
        held = np.zeros(len(y), dtype=bool)
        for c in (0, 1):  # a third of each class is held out for calibration
            held[np.flatnonzero(y == c)[::3]] = True
        views, pools = (text, meta), (pool_text, pool_meta)
        self.taught: list[tuple[list[int], list[int]]] = [([], []), ([], [])]  # by view and class, a number a round
        said = [np.full(len(pool_text), -1) for _ in views]  # what each view's model learns of the pool
        self.models = [self._fit(v[~held], y[~held], p, s) for v, p, s in zip(views, pools, said)]
        self.calibrations = [Logistic().fit(m.logit(v[held])[:, None], y[held]) for m, v in zip(self.models, views)]
        for _ in range(rounds):
            for i, (m, v) in enumerate(zip(self.models, views)):
                known, free = m.logit(v[held]), m.logit(pools[i])
                other = said[1 - i]
                for label, sign in ((1, 1), (0, -1)):
                    share = self.base if label else 1 - self.base
                    sure = np.flatnonzero((other < 0) & (sign * free >= precise_from(sign * known, y[held] == label)))
                    best = sure[np.argsort(-sign * free[sure], kind="stable")]
                    other[best[: max(1, int(PER_ROUND * share))]] = label
                    self.taught[i][label].append(min(len(best), max(1, int(PER_ROUND * share))))
            self.models = [self._fit(v[~held], y[~held], p, s) for v, p, s in zip(views, pools, said)]
            self.calibrations = [Logistic().fit(m.logit(v[held])[:, None], y[held]) for m, v in zip(self.models, views)]
        self.learned = [int((s >= 0).sum()) for s in said]
        self.combination = Logistic().fit(self._views(text[held], meta[held]), y[held])

    @staticmethod
    def _fit(x: np.ndarray, y: np.ndarray, pool: np.ndarray, said: np.ndarray) -> Logistic:
        weight = np.r_[np.ones(len(y)), np.full((said >= 0).sum(), TAUGHT_WEIGHT)]
        return Logistic().fit(np.concatenate([x, pool[said >= 0]]), np.concatenate([y, said[said >= 0]]), ridge=10.0, weight=weight)

    def _views(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return np.stack([c.logit(m.logit(v)[:, None]) for c, m, v in zip(self.calibrations, self.models, (text, meta))], axis=1)

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chances of good quality: by text, by metadata, and combined."""
        if not self.fitted:
            same = np.full(len(text), max(self.base, KEEP_FROM))
            return same, same, same
        views = self._views(text, meta)
        return _chance(views[:, 0]), _chance(views[:, 1]), _chance(self.combination.logit(views))


def _features(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Features from the columns after the first: text, lang, source, n_chars."""
    texts, lang, source, n_chars = (c.to_pylist() for c in chunk.columns[1:5])
    return text_features(texts), meta_features(lang, source, n_chars, texts)


def _viewed(documents: DataFrame, first) -> DataFrame:
    """The column ``first``, then the four that the views read; a missing one is null."""
    there = set(documents.columns)
    wanted = (("text", "binary"), ("lang", "string"), ("source", "string"), ("n_chars", "long"))
    return documents.select(first, *[(F.col(c) if c in there else F.lit(None)).cast("string" if t == "binary" else t).cast(t).alias(f"_{c}") for c, t in wanted])


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, 1, CHUNK_BYTES):
        text, meta = _features(chunk)
        yield pa.RecordBatch.from_arrays(
            [chunk.column("doc_id"), pa.array([np.concatenate(r).tobytes() for r in zip(text, meta)], pa.binary())], ["doc_id", "x"]
        )


def _some(ids: DataFrame, bound: int) -> DataFrame:
    """About ``bound`` of the rows at most, told by a hash of doc_id: the same on every run."""
    share = min(1.0, bound / max(1, ids.count()))
    return ids.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED, unlabelled: int = UNLABELLED, rounds: int = ROUNDS) -> CoTrained:
    """Fits on about ``labelled`` labelled and ``unlabelled`` other documents at most.

    Labels other than 0 and 1, without doc_id, or that differ for one doc_id are left out.
    """
    ready(documents.sparkSession)
    y = labels.where(f"doc_id is not null and {label} in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).cast("int").alias("y"), F.max(label).alias("z"))
    y = _some(y.where("y = z").select("doc_id", "y"), labelled)
    pool = _some(documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")), unlabelled)
    # at most about labelled + unlabelled ids
    chosen = y.unionByName(pool.select("doc_id", F.lit(None).cast("int").alias("y"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = _viewed(documents, F.col("doc_id").cast("long").alias("doc_id")).join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    seen = rows.mapInArrow(_sample_rows, "doc_id long, x binary").groupBy("doc_id").agg(F.min("x").alias("x"))
    got = seen.join(F.broadcast(chosen), "doc_id").orderBy("doc_id").toArrow()
    width = (len(_KINDS) + 1) ** 2 + WORD_BUCKETS + SHAPE
    x = np.frombuffer(b"".join(got["x"].to_pylist()), dtype=np.float32).reshape(got.num_rows, width + META)
    target = np.asarray(got["y"].fill_null(-1).to_pylist(), dtype=np.int64)
    text, meta, known = x[:, :width], x[:, width:], target >= 0
    return CoTrained(text[known], meta[known], target[known], text[~known], meta[~known], rounds)


def _score(batches: Iterator[pa.RecordBatch], model: CoTrained, keep_from: float) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, 1, CHUNK_BYTES):
        by_text, by_meta, both = model.scores(*_features(chunk))
        yield pa.RecordBatch.from_arrays(
            [chunk.column("doc_id"), pa.array(by_text), pa.array(by_meta), pa.array(both), pa.array(both >= keep_from)],
            ["doc_id", "text_score", "metadata_score", "score", "keep"],
        )


def score_quality(documents: DataFrame, model: CoTrained, keep_from: float = KEEP_FROM) -> DataFrame:
    """Scores of each row of ``documents``: doc_id, text_score, metadata_score, score, keep.

    ``documents`` has doc_id, text, lang, source and n_chars; any of the last three may be
    missing, and other columns are ignored. Whole texts are read.

    - Nulls are values of their own to the metadata view; a null text is empty to the text view.
    - Rows are scored one by one: repeated rows and null doc_ids are returned as they come.
    - An empty table gives an empty result. With fewer than ten labelled documents of a class
      nothing can be learned: every document gets the base rate, or 0.5 if that is more, and stays.
    """
    ready(documents.sparkSession)
    return _viewed(documents, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(lambda it: _score(it, model, keep_from), _SCORES)


def _filter(batches: Iterator[pa.RecordBatch], model: CoTrained, keep_from: float) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, 1, CHUNK_BYTES):
        keep = model.scores(*_features(chunk))[2] >= keep_from
        yield pa.RecordBatch.from_struct_array(chunk.column(0).filter(pa.array(keep)))


def keep_good(documents: DataFrame, model: CoTrained, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``documents``, all columns, whose score is ``keep_from`` or more."""
    ready(documents.sparkSession)
    # the caller's columns travel in one, so that none of their names matters here
    return _viewed(documents, F.struct(*documents.columns).alias("doc")).mapInArrow(lambda it: _filter(it, model, keep_from), documents.schema)
