"""Toxicity (operator 8): compression distance between zstd dictionaries.

One dictionary is trained on ordinary text and ``FOLDS`` on toxic text, each
without another part of the sample.  A text (lower case, punctuation as blanks)
is cut into windows of about ``WINDOW`` bytes, each window is compressed with
all of them, and the saving of a toxic dictionary over the ordinary one is its
distance.  The highest two savings, the excess over noise and the number of
windows give log-odds through a logistic calibration; the score is that of
their mean over the toxic dictionaries.

Toxic dictionaries are trained on the stretches of toxic texts that tell the
classes apart: runs of six-character strings of a word that are ``ODDS`` times
as frequent in toxic texts, beyond chance.  zstd trains on samples of eight
stretches in mixed order, frequent ones more often, to a size that follows the
stretches' own; few samples are repeated until there are enough to train on.
The same path is taken at every size.  The toxic compressors have the ordinary
dictionary as content too, so an ordinary window is compressed alike by all and
the difference shows toxic stretches alone.  A fixed lead before every window,
known to all, keeps short windows above the size that zstd stores raw.

Cross-fitting wastes no label: each part of the sample is measured with the
dictionary that has not seen it, and the calibration is fitted on all of these
measurements.  0.5 lies at the cut with the best F-measure there (recall
counts ``RECALL`` times as much as precision).

Learning uses a bounded sample of labelled rows: at most ``SAMPLE`` of each
class, taken in hash order.
Each sampled row counts for as many labels of its class as it
stands for, so the calibration, its cut and the choice of strings follow the
labels' own mix however large the input is.  Only the sample's ids, its strings
and words that tell the classes apart, its ordinary windows and its
measurements reach the driver.  Scoring is map-only, over whole texts.

Defined results: null and empty texts have no windows and get the score that
the calibration gives to none; without labels of both classes every score is
the share of label 1 (0 without any labels); repeated rows stay repeated; ids
that repeat in the labels count once, toxic if any row says so; of an id that
repeats in the documents one text is learnt from; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import session, slices, text_of
from barsmith.session import materialize

SAMPLE = 6000  # labelled rows of each class
WINDOW = 96
GRAM = 6
FOLDS = 4
# a string tells the classes apart if it is so many times as frequent in toxic
# texts and that is no chance
ODDS, SURPLUS = 2.5, 8.0
RECALL = 1.5
# a toxic dictionary has SPARE bytes and GROWTH times its stretches; what zstd's trainer is given at least
GROWTH, SPARE, SEGMENT, TRAIN_BYTES, TRAIN_SAMPLES = 4, 256, 64, 4096, 16
BASE_SIZE = 16_384
LEAD = b"<~window~of~text~begins~here~:~> "
BLANK = r"""[.,;:!?…"'()\[\]|*#$%&\s]+"""  # what parts words
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: tuple[bytes, ...]  # one for each part of the sample left out
    weights: tuple[float, ...]  # empty: the score is `share`
    share: float

    def compressors(self):
        import zstandard as zstd

        made = []
        for content in (self.ordinary, *(t + self.ordinary for t in self.toxic)):
            p = zstd.ZstdCompressionParameters(min_match=5, strategy=zstd.STRATEGY_GREEDY, window_log=16, hash_log=14, chain_log=14, search_log=4,
                                               write_content_size=False, write_checksum=False, write_dict_id=False)
            d = zstd.ZstdCompressionDict(content + LEAD, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            made.append(zstd.ZstdCompressor(dict_data=d, compression_params=p))
        return made

    def score(self, feats: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(feats), self.share)
        log_odds = sum(_design(feats[:, [0, k, k + 1, k + 2]]) @ np.array(self.weights) for k in range(1, feats.shape[1], 3))
        return 1 / (1 + np.exp(-np.clip(log_odds / len(self.toxic), -30, 30)))


def windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, owner) of the windows of the texts data[starts:ends]:
    ``width`` bytes each, ended at the next white space if one is near."""
    counts = np.maximum(ends - starts - 1, 0) // width + (ends > starts)
    owner = np.repeat(np.arange(len(starts)), counts)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    spaces = np.flatnonzero((data == 32) | ((data >= 9) & (data <= 13)))
    want = starts[owner] + k * width  # where a window begins before it is moved
    at = np.append(spaces, len(data))[np.searchsorted(spaces, want)] + 1
    begin = np.where(k == 0, starts[owner], np.minimum(np.minimum(at, want + width // 2), ends[owner]))
    end = np.append(begin[1:], 0)
    last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.empty(0, dtype=bool)
    end[last] = ends[owner[last]]
    some = end > begin
    return begin[some], end[some], owner[some]


def savings(data: np.ndarray, begin: np.ndarray, end: np.ndarray, compressors) -> np.ndarray:
    """Bytes that each toxic dictionary saves on each window."""
    import zstandard as zstd

    if not len(begin):
        return np.empty((len(compressors) - 1, 0), dtype=np.int64)
    sizes, lead = end - begin, np.frombuffer(LEAD, dtype=np.uint8)
    offsets = np.append(0, np.cumsum(sizes + len(lead)))
    out = np.empty(offsets[-1], dtype=np.uint8)
    out[(offsets[:-1, None] + np.arange(len(lead))).ravel()] = np.tile(lead, len(begin))
    ramp = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(offsets[:-1] + len(lead), sizes) + ramp] = data[np.repeat(begin, sizes) + ramp]
    segments = np.stack([offsets[:-1], np.diff(offsets)], axis=1).astype(np.uint64).tobytes()
    buffer = zstd.BufferWithSegments(out.tobytes(), segments)
    sizes = np.array([[len(x) for x in c.multi_compress_to_buffer(buffer, threads=1)] for c in compressors], dtype=np.int64)
    return sizes[0] - sizes[1:]


def features(texts, compressors) -> np.ndarray:
    """Per text of an Arrow string array: the number of windows; for each
    toxic dictionary highest and second highest saving, excess over noise."""
    import pyarrow as pa
    import pyarrow.compute as pc

    edged = pc.binary_join_element_wise(" ", pc.utf8_lower(texts), " ", "")
    edged = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", edged)
    low = pc.replace_substring_regex(edged, BLANK, " ").cast(pa.large_string())
    ends = np.frombuffer(low.buffers()[1], dtype=np.int64)[low.offset:low.offset + len(low) + 1]
    raw = low.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8)
    begin, end, owner = windows(data, ends[:-1], ends[1:])
    n = len(texts)
    columns = [np.bincount(owner, minlength=n)]
    for saved in savings(data, begin, end, compressors):
        top = np.zeros((2, n))
        order = np.lexsort((-saved, owner))
        o = owner[order]
        if len(o):
            first = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
            top[0, o[first]] = saved[order][first]
            second = first + 1
            second = second[(second < len(o)) & (o[np.minimum(second, len(o) - 1)] == o[second - 1])]
            top[1, o[second]] = saved[order][second]
        columns += [*top, np.bincount(owner, weights=np.maximum(saved - 2, 0), minlength=n)]
    return np.stack(columns, axis=1).astype(float)


def _design(f: np.ndarray) -> np.ndarray:
    n, top, second, excess = np.log1p(f[:, 0]), np.clip(f[:, 1], 0, 12), np.clip(f[:, 2], 0, 12), np.log1p(f[:, 3])
    return np.stack([np.ones(len(f)), n, top, second, excess, np.maximum(top - 2, 0), np.maximum(top - 4, 0), excess * n], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * w)
        w = w + step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _best_cut(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The log-odds at which calling everything above toxic has the best F-measure."""
    order = np.argsort(-score, kind="stable")
    s, hit, miss = score[order], np.cumsum((y * weight)[order]), np.cumsum(((1 - y) * weight)[order])
    border = np.append(s[1:] != s[:-1], True)
    f = hit / (hit + miss + RECALL**2 * (y * weight).sum())
    best = int(np.argmax(np.where(border, f, -1)))
    low = s[best + 1] if best + 1 < len(s) else s[best] - 1
    return float((s[best] + low) / 2)


def _train(samples: list[bytes], size: int, segment: int = SEGMENT) -> bytes:
    """The dictionary that zstd trains on the samples."""
    import zstandard as zstd

    times = max(-(-TRAIN_BYTES // sum(map(len, samples))), -(-TRAIN_SAMPLES // len(samples)))  # the trainer refuses very little input
    return zstd.train_dictionary(size, samples * times, k=segment, d=6, level=3).as_bytes()


def _stretches(words: list[tuple[str, int]], kept: set[str]) -> dict[str, int]:
    """Runs of kept strings in the words, with the words' counts."""
    runs: dict[str, int] = {}
    for word, count in words:
        w = f" {word} "
        on = [w[i:i + GRAM] in kept for i in range(max(1, len(w) - GRAM + 1))]
        i = 0
        while i < len(on):
            j = i
            while j < len(on) and on[j]:
                j += 1
            if j > i:
                run = w[i:j - 1 + GRAM]
                runs[run] = runs.get(run, 0) + count
            i = j + 1
    return runs


def _toxic_dictionary(runs: dict[str, int]) -> bytes:
    """Trained on samples of eight runs in mixed order, frequent ones more
    often; empty without runs."""
    each = [r for r, n in sorted(runs.items(), key=lambda x: (-x[1], x[0])) for _ in range(min(n, 40))]
    order = np.random.default_rng(0).permutation(len(each))
    samples = ["".join(each[i] for i in order[k:k + 8]).encode() for k in range(0, len(each), 8)]
    return _train(samples, GROWTH * sum(len(r.encode()) for r in runs) + SPARE) if samples else b""


def _surplus(seen: Column, expected: Column) -> Column:
    """How far a count lies above its expectation: the exponent of the chance
    to see so many (0 if it lies below)."""
    return F.when(seen > expected, seen * F.log(seen / expected) - (seen - expected)).otherwise(0.0)


def _expected(k0: Column, k1: Column, odds: float, rate: float) -> Column:
    """How many of the sampled toxic texts would hold a string that is as
    frequent in both classes; ``odds`` is toxic : ordinary by the labels, an
    ordinary text stands for ``rate`` times as many labels as a toxic one."""
    return (k0 * rate + k1) * (odds / (1 + odds))


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str) -> tuple[DataFrame, dict[int, float]]:
    """(y, fold, text) of at most SAMPLE labelled rows of each class, and how
    many labels of a class a sampled one stands for; ``learn`` says over
    column ``doc_id`` which labels may be used."""
    rows = (labels.select(F.col(id_col).alias("doc_id"), F.col("toxic").cast("int").alias("y")).filter("y in (0, 1) and doc_id is not null")
            .filter(learn).groupBy("doc_id").agg(F.max("y").alias("y")))
    totals = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    order = F.xxhash64("doc_id", F.lit(11))
    ids = [rows.filter(F.col("y") == c).orderBy(order, "doc_id").limit(SAMPLE) for c in (0, 1)]
    ids = materialize(ids[0].unionByName(ids[1]).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(FOLDS)).cast("int")), "label-sample")
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text")
    texts = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y", "fold").agg(one)
    sample = materialize(texts.select("y", "fold", "text"), "sample-texts")  # at most 2 * SAMPLE rows
    return sample, {y: n / min(n, SAMPLE) for y, n in totals.items()}


def _counted(words: DataFrame) -> DataFrame:
    """The six-character strings of the words, edges marked, with the words' counts."""
    edged = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    at = F.sequence(F.lit(1), F.greatest(F.length(edged) - (GRAM - 1), F.lit(1)))
    return words.withColumn("gram", F.explode(F.array_distinct(F.transform(at, lambda i: F.substring(edged, i, F.lit(GRAM))))))


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> Model:
    session(docs.sparkSession)
    sample, stands_for = labelled_sample(docs, labels, F.lit(True) if learn is None else learn, id_col, text_col)
    found = {(r["y"], r["fold"]): r["n"] for r in sample.groupBy("y", "fold").agg(F.count("*").alias("n")).collect()}  # 2 * FOLDS rows
    sizes = np.array([[found.get((y, f), 0) for f in range(FOLDS)] for y in (0, 1)])
    n0, n1 = sizes.sum(axis=1) * [stands_for.get(0, 0.0), stands_for.get(1, 0.0)]
    share = n1 / (n0 + n1) if n0 + n1 else 0.0
    if (sizes.sum(axis=1)[:, None] == sizes).any():  # a class lacks, or has one fold only
        return Model(b"", (), (), float(share))

    # counts of words and strings by class and fold; `parts` are the folds that a model learns from
    cells = [(y, f, f"k{y}_{f}") for y in (0, 1) for f in range(FOLDS)]
    word = F.explode(F.array_distinct(F.filter(F.split(F.lower("text"), BLANK), lambda w: w != ""))).alias("word")
    words = sample.select("y", "fold", word).groupBy("word").agg(*[F.count_if((F.col("y") == y) & (F.col("fold") == f)).alias(c) for y, f, c in cells])
    words = materialize(words, "sample-words")
    grams = _counted(words).groupBy("gram").agg(*[F.sum(c).alias(c) for *_, c in cells])
    parts = [[f for f in range(FOLDS) if f != out] for out in range(FOLDS)]
    rate = stands_for[0] / stands_for[1]
    for p, folds in enumerate(parts):
        k0, k1 = (sum((F.col(f"k{y}_{f}") for f in folds), F.lit(0)) for y in (0, 1))
        m0, m1 = (int(sizes[y, folds].sum()) for y in (0, 1))
        odds = (k1 + 0.5) * m0 / ((k0 + 0.5) * m1)
        strong = (k1 >= 3) & (odds >= ODDS) & (_surplus(k1, _expected(k0, k1, m1 / (m0 * rate), rate)) >= SURPLUS)
        grams = grams.withColumn(f"odds{p}", F.when(strong, odds))
    grams = materialize(grams.filter(F.coalesce(*[f"odds{p}" for p in range(len(parts))]).isNotNull()), "sample-strings")
    telling = _counted(words).join(grams.select("gram"), "gram", "left_semi").drop("gram").distinct().orderBy("word").toPandas()
    grams = grams.orderBy("gram").toPandas()

    def cut(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            for t in pc.replace_substring_regex(pc.utf8_lower(b.column("text")), BLANK, " ").to_pylist():
                data = np.frombuffer(t.encode(), dtype=np.uint8)
                begin, end, _ = windows(data, np.array([0]), np.array([len(data)]))
                yield pa.RecordBatch.from_arrays([pa.array([data[i:j].tobytes() for i, j in zip(begin, end, strict=True)], pa.binary())], names=["w"])

    base = sample.filter("y = 0").select("text").mapInArrow(cut, "w binary").orderBy(F.xxhash64("w"), "w").toPandas()["w"].tolist()
    ordinary = _train([bytes(w) for w in base], BASE_SIZE) if base else b""

    def toxic(p: int) -> bytes:
        kept = set(grams["gram"][grams[f"odds{p}"].notna()])
        counts = telling[[f"k1_{f}" for f in parts[p]]].sum(axis=1)
        return _toxic_dictionary(_stretches([(w, int(k)) for w, k in zip(telling["word"], counts, strict=True) if k >= 2], kept))

    dictionaries = tuple(toxic(p) for p in range(FOLDS))
    rows = _features(sample, [Model(ordinary, (t,), (), 0.0) for t in dictionaries]).toPandas()  # at most 2 * SAMPLE rows
    f, y = rows.drop(columns="y").to_numpy(dtype=float), rows["y"].to_numpy(dtype=float)
    weight = np.where(y == 1, stands_for[1], stands_for[0])
    w = _logistic(_design(f), y, weight)
    log_odds = _design(f) @ w
    w[0] -= _best_cut(log_odds, y, weight)
    return Model(ordinary, dictionaries, tuple(w.tolist()), float(share))


def _features(sample: DataFrame, models: list[Model]) -> DataFrame:
    """y and the features of each sampled text, by the model that has not seen it."""
    names = [f"f{i}" for i in range(4)]

    def measure(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        made = [m.compressors() for m in models]
        for b in slices(batches, "text", SLICE_BYTES):
            for k, c in enumerate(made):
                part = b.filter(pc.equal(b.column("fold"), k))
                f = features(part.column("text"), c)
                yield pa.RecordBatch.from_arrays([part.column("y"), *(pa.array(f[:, i]) for i in range(f.shape[1]))], names=["y", *names])

    return sample.mapInArrow(measure, "y int, " + ", ".join(f"{n} double" for n in names))


def scores(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` (all its columns) with ``__toxic_score``."""
    session(docs.sparkSession)
    names = docs.columns
    rows = docs.withColumn("__toxicity_text", text_of(text_col))

    def measure(batches: Iterable) -> Iterator:
        import pyarrow as pa

        c = model.compressors() if model.weights else None
        for b in slices(batches, "__toxicity_text", SLICE_BYTES):
            f = features(b.column("__toxicity_text"), c) if c else np.zeros((b.num_rows, 1))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), pa.array(model.score(f))], names=[*names, "__toxic_score"])

    from pyspark.sql.types import DoubleType, StructType

    return rows.mapInArrow(measure, StructType([*docs.schema.fields]).add("__toxic_score", DoubleType()))


def held_out(c: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % 5 == 0


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = fit(docs, labels, ~held_out(F.col("doc_id")), id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = scores(rows, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__toxic_score").alias("score"),
                      (F.col("__toxic_score") >= 0.5).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not called toxic."""
    model = fit(docs, labels, ~held_out(F.col("doc_id")), id_col=id_col, text_col=text_col)
    return scores(docs, model, text_col=text_col).filter("__toxic_score < 0.5").select(*docs.columns)
