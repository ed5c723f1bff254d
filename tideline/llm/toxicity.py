"""Toxicity: a linear classifier of character n-grams scaled by their naive Bayes log-count ratios."""

from __future__ import annotations

import io

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm._shared import Scratch, map_batches

#: Lengths of the n-grams in bytes of the UTF-8 text, A-Z lower-cased.
GRAMS = (4, 5, 6)
BUCKET_BITS = 20
#: At most so many labelled rows of each class train the model: those whose id hashes lowest.
ROWS_PER_CLASS = 4000
#: N-grams in fewer training texts than this aren't features; of the rest so many stay whose classes differ most surely.
#: More make the model worse: see the README for figures.
MIN_TEXTS = 3
FEATURES = 1 << 12
#: Tasks among which the sampled texts are shared out.
TASKS = 12
SMOOTHING = 1.0
PENALTY = 0.3
STEPS = 80


def _buckets(data, offsets):
    """(text, bucket) of each distinct n-gram of each text; texts lie one after another in data, cut at offsets."""
    import numpy as np

    from tideline.llm._shingles import _LOWER, U, mix

    data = _LOWER[data].astype(U)
    of = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    packed, out_of, out = data.copy(), [], []
    for n in range(2, max(GRAMS) + 1):
        packed = (packed[:-1] << U(8)) | data[n - 1 :] if len(packed) > 1 else packed[:0]
        if n in GRAMS and len(packed):
            whole = of[: len(packed)] == of[n - 1 :]
            out_of.append(of[: len(packed)][whole])
            out.append((mix(packed[whole] + (U(n) << U(56))) >> U(64 - BUCKET_BITS)).astype(np.int32))
    if not out:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    return np.concatenate(out_of), np.concatenate(out)


def _distinct(of, bucket):
    import numpy as np

    key = np.unique((of.astype(np.int64) << BUCKET_BITS) | bucket)
    return (key >> BUCKET_BITS).astype(np.int32), (key & ((1 << BUCKET_BITS) - 1)).astype(np.int32)


#: Buckets go through the shuffle in so many slices.
SLICES = 64


def _texts(column):
    """(text, bucket) of the distinct n-grams of a column's texts, some texts at a time; texts are numbered through."""
    import numpy as np

    from tideline.llm._shingles import _chunks

    base = 0
    for data, ends in _chunks(column):
        of, bucket = _distinct(*_buckets(data, np.concatenate([[0], ends])))
        yield base, len(ends), of, bucket
        base += len(ends)


def _count(batches):
    """A task's batches of (text, label) to a row for each slice: its buckets that occur, and in how many toxic texts, and in how many at all, their n-grams are."""
    import numpy as np
    import pyarrow as pa

    n = 1 << BUCKET_BITS
    pos, every = np.zeros(n, "<i4"), np.zeros(n, "<i4")
    for batch in batches:
        y = np.asarray(batch.column(1), dtype=np.int64)
        for base, _, of, bucket in _texts(batch.column(0)):
            every += np.bincount(bucket, minlength=n).astype("<i4")
            pos += np.bincount(bucket[y[base + of] > 0], minlength=n).astype("<i4")
    there = np.flatnonzero(every)
    parts = np.split(there, np.searchsorted(there, np.arange(1, SLICES) * (n // SLICES)))
    rows = [(i, x.astype("<i4").tobytes(), pos[x].tobytes(), every[x].tobytes()) for i, x in enumerate(parts) if len(x)]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3))], ["slice", "bucket", "pos", "every"])


def _add(batches):
    """Rows of _count(), those of a slice together, to (bucket, pos, every) of all tasks."""
    import numpy as np
    import pyarrow as pa

    size, now, pos, every = (1 << BUCKET_BITS) // SLICES, None, None, None

    def done():
        there = np.flatnonzero(every)
        return pa.RecordBatch.from_arrays([pa.array(there + now * size, pa.int32()), pa.array(pos[there], pa.int64()), pa.array(every[there], pa.int64())], ["bucket", "pos", "every"])

    for batch in batches:
        for i, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if i != now:
                if now is not None:
                    yield done()
                now, pos, every = i, np.zeros(size, np.int64), np.zeros(size, np.int64)
            bucket, p, q = (np.frombuffer(x, "<i4") for x in row)
            pos[bucket - i * size] += p
            every[bucket - i * size] += q
    if now is not None:
        yield done()


def _features(chosen):
    """Batches of (h, tie, label, text) to (h, tie, label, features): the places in chosen, a sorted array, of a text's n-grams."""

    def features(batches):
        import numpy as np
        import pyarrow as pa

        index = np.full(1 << BUCKET_BITS, -1, dtype=np.int32)
        index[chosen] = np.arange(len(chosen))
        for batch in batches:
            lists = []
            for _, n, of, bucket in _texts(batch.column(3)):
                keep = index[bucket] >= 0
                ends = np.searchsorted(of[keep], np.arange(1, n))
                lists += [np.sort(x).tolist() for x in np.split(index[bucket[keep]], ends)] if n else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(lists, pa.list_(pa.int32()))], ["h", "tie", "label", "features"])

    return features


def solve(feature_lists, labels, ratio, per_class=(1.0, 1.0)):
    """(weight of each feature, bias): the penalised log loss by Adam, features scaled by their log-count ratios.

    per_class has for how many labels a text of class 0 and of class 1 stands, where the classes are sampled at
    different rates: the prior and the loss weigh texts by it.
    """
    import numpy as np

    y = np.asarray(labels, dtype=np.float64)
    stands = np.where(y > 0, per_class[1], per_class[0])
    prior = ((stands * y).sum() + 1) / (stands.sum() + 2)
    bias = float(np.log(prior / (1 - prior)))
    if not len(y) or y.min() == y.max() or not len(ratio):
        return np.zeros(len(ratio)), bias
    of = np.repeat(np.arange(len(y)), [len(f) for f in feature_lists])
    feature = np.concatenate([np.asarray(f, dtype=np.int64) for f in feature_lists])
    w, b, m, v = np.zeros(len(ratio)), bias, np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    x = ratio[feature]
    norm = np.sqrt(max(1.0, np.average(np.bincount(of, weights=x * x, minlength=len(y)), weights=stands)))
    x = x / norm
    share = stands / stands.sum()
    for step in range(1, STEPS + 1):
        z = np.bincount(of, weights=x * w[feature], minlength=len(y)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        g = np.append(np.bincount(feature, weights=x * error[of], minlength=len(w)) + PENALTY / len(y) * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        d = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - d[:-1], b - d[-1]
    return w * ratio / norm, float(b)


def predict(column, model):
    """The score of each text of a column."""
    import numpy as np

    from tideline.llm._shingles import _chunks

    chosen, weights, bias = model
    table = np.zeros(1 << BUCKET_BITS, dtype=np.float32)
    table[chosen] = weights
    out = []
    for data, ends in _chunks(column):
        of, bucket = _buckets(data, np.concatenate([[0], ends]))
        used = table[bucket] != 0
        of, bucket = _distinct(of[used], bucket[used])
        z = np.bincount(of, weights=table[bucket], minlength=len(ends)) + bias
        out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
    return np.concatenate(out) if out else np.empty(0)


def _solver(ratio, per_class):
    """All rows of (h, tie, label, features), in order, to one row: the weights and the bias."""

    def solver(batches):
        import numpy as np
        import pyarrow as pa

        lists, labels = [], []
        for batch in batches:
            labels += batch.column(2).to_pylist()
            lists += [np.asarray(x.values) for x in batch.column(3)]
        weights, bias = solve(lists, labels, np.asarray(ratio), per_class)
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype("<f4").tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])

    return solver


def _stored(chosen, weights, bias) -> bytes:
    import numpy as np

    to = io.BytesIO()
    np.savez(to, chosen=np.asarray(chosen, np.int32), weights=np.asarray(weights, np.float32), bias=bias)
    return to.getvalue()


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id", rows_per_class: int = ROWS_PER_CLASS) -> bytes:
    """The model of the documents that have a label, as bytes.

    Of each class at most rows_per_class labels are used, those whose id hashes lowest, so that the sample of ids is
    bounded: it is broadcast to find its texts. All labels are counted, and where a class has more, its texts weigh as
    much more, so that the model learns the classes' true shares at every size.

    The sampled texts are written to the shared folder. Tasks count their n-grams, counts are added up by slices of
    buckets, and the FEATURES n-grams whose classes differ most surely are chosen; which they are, and their log-count
    ratios, is found against the sample's own shares, so that neither moves with the sampling rates. Tasks then reduce
    each text to its features, and these short lists alone, in the order of the ids' hashes, meet in the one task that
    fits the weights.

    Null labels are left out, and labels without a document; an id that has several labels, or several texts, is a
    training text for each. A null text is an empty one; a very long text counts whole, once for each of its n-grams.
    Without rows of both classes the model gives every text the prior. The model holds at most FEATURES weights,
    whatever the input. Other columns take no part, whatever their names.
    """
    import numpy as np

    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("__id"), (F.col(label_col) > 0).cast("int").alias("label"), F.xxhash64(F.lit("sample"), id_col).alias("h"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    per_class = tuple(max(1.0, counts.get(c, 0) / max(rows_per_class, 1)) for c in (0, 1))
    some = [known.where(F.col("label") == c).orderBy("h", "__id").limit(rows_per_class) for c in (0, 1)]
    sample = F.broadcast(some[0].union(some[1]))
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(sample, "__id")
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.write(texts.select("h", F.xxhash64("text").alias("tie"), "label", "text").repartition(TASKS))
        both = rows.groupBy("label").agg(F.count("*").alias("n")).collect()
        n = sum(r.n for r in both)
        chosen, ratio = np.empty(0, np.int32), np.empty(0)
        if len(both) == 2:
            share = next(r.n for r in both if r.label) / n
            slices = map_batches(rows.select("text", "label"), _count, "slice int, bucket binary, pos binary, every binary")
            grams = scratch.write(map_batches(slices.repartition(TASKS, "slice").sortWithinPartitions("slice"), _add, "bucket int, pos long, every long"))
            total = grams.agg(F.sum("pos").alias("p"), F.sum(F.col("every") - F.col("pos")).alias("q")).first()
            expected = F.col("every") * F.lit(share)
            surety = F.abs(F.col("pos") - expected) / F.sqrt(expected * F.lit(1 - share))
            best = grams.where(F.col("every") >= MIN_TEXTS).withColumn("surety", surety).where("surety > 0").orderBy(F.col("surety").desc(), "bucket").limit(FEATURES).collect()
            best = sorted(best, key=lambda r: r.bucket)
            chosen = np.array([r.bucket for r in best], dtype=np.int32)
            p, q = (np.array(x, dtype=np.float64) + SMOOTHING for x in ([r.pos for r in best], [r.every - r.pos for r in best]))
            space = SMOOTHING * (1 << BUCKET_BITS)
            ratio = np.log((p / ((total.p or 0) + space)) / (q / ((total.q or 0) + space)))
        lists = map_batches(rows, _features(chosen), "h long, tie long, label int, features array<int>")
        one = map_batches(lists.repartition(1).sortWithinPartitions("h", "tie"), _solver(ratio, per_class), "weights binary, bias double").first()
        weights, bias = (np.frombuffer(one.weights, "<f4"), one.bias) if one else solve([], [], ratio, per_class)
        return _stored(chosen, weights, bias)


def score_toxicity(docs: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """Returns the documents with score, from 0 to 1, and predicted, 1 where it is 0.5 or more.

    The score is of the whole text alone, however long; null and empty texts get the one that the model gives to no
    n-grams. Equal texts get equal scores. Empty tables stay empty. Input columns named as the results are replaced.
    """
    from pyspark.sql import types as T

    keep = [f for f in docs.schema.fields if f.name.lower() not in ("score", "predicted")]
    names = [f.name for f in keep]

    def apply(batches):
        import numpy as np
        import pyarrow as pa

        with np.load(io.BytesIO(model)) as stored:
            ready = stored["chosen"], stored["weights"], float(stored["bias"])
        for batch in batches:
            score = predict(batch.column(batch.num_columns - 1), ready)
            columns = [*batch.columns[:-1], pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "score", "predicted"])

    schema = T.StructType([*keep, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return map_batches(docs.select(*[f"`{x}`" for x in names], F.col(text_col).alias("__text")), apply, schema)
