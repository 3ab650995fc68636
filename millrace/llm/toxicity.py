"""Toxicity by class-conditional Kneser-Ney models over words.

Two models, of toxic and of ordinary texts, are counted in Spark over all labelled rows of the
training part. Words are lower-cased runs of letters and digits; counts are of distinct
neighbours, which copies of a text do not raise:

    P_c(w)   = max(N_c(.w) - D, 0) / N_c(..) + g_c P(w)           N: distinct words before w
    P(w)     = (N(.w) + 1) / (N(..) + words + 1)                  both classes: the shared backoff
    P_c(w|v) = (1 - g(v)) max(C_c(vw) - D, 0) / C_c(v.) + g(v) P_c(w)     for expressions vw that
                                                                  texts of either class hold often

g_c and g(v) hand on what the discounts take; g(v) is of both classes together, so for all
other pairs the two models differ by P_c(w) alone. Words of few neighbours have no entry of
their own and are left to the shared backoff, where both classes agree; an expression has its
entry however few neighbours its words have.

A text's log-likelihoods are compared per word, over the whole text and over its best windows
of WINDOWS words: insults are few words of a long text. A logistic model of these
length-normalised differences makes the score. It is cross-fitted: the labelled rows are dealt
into FOLDS parts, counted side by side in one pass, and each part's differences are by a model
without its own counts. The weights are fitted on the driver from at most `sample` labelled
rows of each label, of all parts. All documents are then scored by the model of all labelled
rows. If a part is needed for one label to be known at all, its rows say nothing about the
weights; if too few are left, the score follows the mean difference alone.

The model is one table of (hash, log ratio), written and read in shards of SHARD_ROWS rows.
Each shard is sent to all tasks, one shard per step, so no broadcast is larger than that; their
number grows with the corpus.

Null texts are empty; texts without words are scored as such. Null ids are in no label table.
Without labels of both kinds the score is 0 for every document. Repeated rows are scored
each. Empty tables give no rows. Other columns are carried along; helper names start with
`_toxic` and `_label`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.labelled import PREDICTED, known, labelled, logistic, remainder, sampled, sigmoid
from millrace.llm.words import MARKS, hashed, mix, utf8
from millrace.session import written

DISCOUNT = 2.0
#: Pairs of words that so many places of the texts of one class hold have an entry of their own.
EXPRESSION = 4
#: Words with fewer distinct neighbours in both classes are left to the backoff, unless they are in an expression.
RARE = 3
WINDOWS = (1, 2, 4, 8, 32)
SAMPLE_ROWS = 20_000
#: What the weights of the score are held back by, in rows: a few labels prove little.
RIDGE = 20.0
#: What a mean log ratio of 1 adds to the log odds where no weights can be fitted.
ALONE = 10.0
#: Parts that the labelled rows are dealt into; models are of all rows, and of those without a part.
FOLDS = 3
KINDS = ("all", *map(str, range(FOLDS)))
CELLS = [f"{c}{k}" for c in "to" for k in range(FOLDS)]
#: Words whose pairs a task counts together before it sends them.
COMBINED_WORDS = 1 << 21
SHARD_ROWS = 1 << 22
#: Rows of an Arrow batch that a task works on at once.
SLICE_ROWS = 512
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _texts(column) -> list[bytes]:
    return [t.decode().lower().encode() for t in utf8(column)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _pairs(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each word and the one before it; 0 is before the first of a text."""
    now = np.concatenate(words)
    before = np.roll(now, 1)
    if len(now):
        first = np.cumsum([0, *map(len, words[:-1])])
        before[first[first < len(now)]] = 0
    return before, now


def _pair_key(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return mix(mix(before + _PAIR) ^ now)


def counts(rows: DataFrame) -> DataFrame:
    """(before, word, t0, t1, ..., o0, o1, ...): how often each pair of words is in toxic and ordinary texts of each fold.

    Rows have `_label`, `_fold` and `_toxic_text`.
    """

    def combined(parts: list) -> pa.RecordBatch:
        before, now, cell = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort((_pair_key(before, now) & ~np.uint64(7)) | cell.astype(np.uint64))
        before, now, cell = before[order], now[order], cell[order]
        new = np.flatnonzero(np.r_[True, (now[1:] != now[:-1]) | (before[1:] != before[:-1]) | (cell[1:] != cell[:-1])])
        n = np.diff(np.r_[new, len(now)]).astype(np.int32)
        found = [before[new].view(np.int64), now[new].view(np.int64), cell[new], n]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["before", "word", "cell", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in _slices(batches):
            cells = batch.column(1).to_numpy() + FOLDS * (1 - batch.column(0).to_numpy())
            for at, words in hashed(_texts(batch.column(2)), MARKS):
                before, now = _pairs(words)
                if not len(now):
                    continue
                parts.append((before, now, np.repeat(cells[at : at + len(words)], list(map(len, words))).astype(np.int32)))
                held += len(now)
                if held > COMBINED_WORDS:
                    yield combined(parts)
                    parts, held = [], 0
        if held:
            yield combined(parts)

    found = rows.select("_label", F.col("_fold").cast("int"), "_toxic_text").mapInArrow(count, "before bigint, word bigint, cell int, n int")
    # A task has combined its texts already, and most pairs are rare: they are dealt out as they are.
    sums = [F.sum(F.when(F.col("cell") == k, F.col("n")).otherwise(0)).alias(c) for k, c in enumerate(CELLS)]
    return found.repartition("before", "word").groupBy("before", "word").agg(*sums)


def _of(label: str, kind: str):
    """The count of a label in the rows of a kind of model."""
    return sum((F.col(f"{label}{k}") for k in range(FOLDS) if str(k) != kind), F.lit(0))


def neighbours(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sums by word, and by the word before, for every kind of model."""
    words, contexts = [], []
    for kind in KINDS:
        t, o = _of("t", kind), _of("o", kind)
        words += [F.sum((c > 0).cast("int")).alias(f"{name}_{kind}") for name, c in (("n", t + o), ("t", t), ("o", o))]
        contexts += [F.sum(c).alias(f"{name}_{kind}") for name, c in (("ct", t), ("co", o), ("taken", F.least(t + o, F.lit(DISCOUNT))))]
    return written(pairs.groupBy("word").agg(*words), "toxic_words"), written(pairs.groupBy("before").agg(*contexts), "toxic_contexts")


def _discounted(count, total: float, rest: float, base):
    return F.greatest(count - DISCOUNT, F.lit(0.0)) / F.lit(total) + F.lit(rest) * base


def model(rows: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """(before, word, value_<kind>...): log ratios of words, and of expressions by (before, word), and those of other words by kind.

    Kinds of model without rows of both labels are left out, and their values are null.
    """
    pairs = written(counts(rows), "toxic_pairs")
    words, contexts = neighbours(pairs)
    sums = []
    for k in KINDS:
        taken = [F.sum(F.least(F.col(f"{c}_{k}"), F.lit(DISCOUNT))).alias(f"d{c}_{k}") for c in "to"]
        sums += [F.count_if(F.col(f"n_{k}") > 0).alias(f"words_{k}"), *[F.sum(f"{c}_{k}").alias(f"{c}_{k}") for c in "nto"], *taken]
    total = words.agg(*sums).first()
    kinds = [k for k in KINDS if total[f"t_{k}"] and total[f"o_{k}"]]
    often = lambda k: (_of("t", k) >= EXPRESSION) | (_of("o", k) >= EXPRESSION)
    each, singles, expressions, others = [], [], [], {}
    for k in KINDS:
        if k not in kinds:
            singles.append(F.lit(None).cast("float").alias(f"value_{k}"))
            expressions.append(singles[-1])
            continue
        n, t, o = (float(total[f"{c}_{k}"]) for c in "nto")
        rest_t, rest_o = total[f"dt_{k}"] / t, total[f"do_{k}"] / o
        base = (F.col(f"n_{k}") + 1) / F.lit(n + total[f"words_{k}"] + 1)
        each += [_discounted(F.col(f"t_{k}"), t, rest_t, base).alias(f"pt_{k}"), _discounted(F.col(f"o_{k}"), o, rest_o, base).alias(f"po_{k}")]
        others[k] = float(np.log(rest_t / rest_o))
        known_word = (F.col(f"t_{k}") >= RARE) | (F.col(f"o_{k}") >= RARE)
        singles.append(F.when(known_word, F.log(F.col(f"pt_{k}") / F.col(f"po_{k}"))).cast("float").alias(f"value_{k}"))
        g = F.col(f"taken_{k}") / (F.col(f"ct_{k}") + F.col(f"co_{k}"))
        pair = lambda c, p, k=k, g=g: (1 - g) * F.greatest(_of(c, k) - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"c{c}_{k}"), F.lit(1)) + g * F.col(f"{p}_{k}")
        expressions.append(F.when(often(k), F.log(pair("t", "pt") / pair("o", "po"))).cast("float").alias(f"value_{k}"))
    each = words.select("*", *each)
    frequent = written(pairs.where(often("all") & (F.col("before") != 0)), "toxic_expressions")
    found = frequent.join(contexts, "before").join(each.drop(*[f"{c}_{k}" for c in "nto" for k in KINDS]), "word").select("before", "word", *expressions)
    table = each.select(F.lit(None).cast("bigint").alias("before"), "word", *singles).union(found)
    return written(table.where(F.coalesce(*[F.col(f"value_{k}") for k in KINDS]).isNotNull()), "toxic_model"), others


def shards(table: DataFrame, kinds: list[str]) -> list:
    """The model as broadcasts of sorted (keys, values of each kind) of words and of pairs, SHARD_ROWS rows each."""
    table = table.select("before", "word", *[F.col(f"value_{k}") for k in kinds]).where(F.coalesce(*[F.col(f"value_{k}") for k in kinds]).isNotNull())
    parts = max(1, -(-table.count() // SHARD_ROWS))
    out = []
    for part in range(parts):
        rows = table.where(F.pmod(F.xxhash64("word"), F.lit(parts)) == part).toArrow()
        before, word = rows.column("before"), rows.column("word").to_numpy().view(np.uint64)
        value = np.stack([rows.column(f"value_{k}").fill_null(float("nan")).to_numpy().astype(np.float32) for k in kinds])
        single = np.asarray(before.is_null())
        pair = _pair_key(before.fill_null(0).to_numpy().view(np.uint64)[~single], word[~single])
        tables = []
        for keys, values in ((word[single], value[:, single]), (pair, value[:, ~single])):
            order = np.argsort(keys)
            tables.append((keys[order], values[:, order]))
        out.append(table.sparkSession.sparkContext.broadcast(tables))
    return out


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, kind: np.ndarray | int, into: np.ndarray) -> None:
    if len(keys):
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = values[kind, at]
        hit = (keys[at] == wanted) & ~np.isnan(found)
        into[hit] = found[hit]


def _summary(ratio: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Per text: the mean ratio, the best mean of every window, how many words it has (as shares and logs)."""
    out = np.zeros((len(lengths), len(WINDOWS) + 3))
    sums = np.r_[0.0, np.cumsum(ratio, dtype=np.float64)]
    at = 0
    for row, n in enumerate(lengths):
        if n:
            own = sums[at : at + n + 1]
            out[row, 0] = (own[-1] - own[0]) / n
            for k, width in enumerate(WINDOWS, 1):
                w = min(width, n)
                out[row, k] = ((own[w:] - own[:-w]) / width).max()
            high = ratio[at : at + n] > 3
            out[row, -2] = np.log1p(np.count_nonzero(high))
            out[row, -1] = np.count_nonzero(high) / n
        at += n
    return out


def with_summaries(rows: DataFrame, kept: list[str], parts: list, others: list[float], scores=None, text: str = "_toxic_text", kind: str | None = None) -> DataFrame:
    """`kept` columns and `_toxic_summary`, the numbers that the score is made of (as doubles, in binary).

    With `scores`, a function of these numbers, `score` and `predicted` instead. A row is looked
    up in the kind of model that its column `kind` numbers, or in the first. One step per shard
    of the model; between steps a text's ratios so far travel with it.
    """
    other = np.array(others, dtype=np.float32)
    for number, shard in enumerate(parts):
        first, last = number == 0, number == len(parts) - 1
        names = [*kept, *([] if last else [text, kind])]
        fields = [f for f in rows.schema.fields if f.name in names]
        schema = StructType(list(fields))
        if not last:
            schema = schema.add("_toxic_ratio", "binary")
        elif scores is None:
            schema = schema.add("_toxic_summary", "binary")
        else:
            schema = schema.add("score", "double").add("predicted", "integer")

        def step(batches: Iterator[pa.RecordBatch], shard=shard, first=first, last=last, fields=fields, schema=schema) -> Iterator[pa.RecordBatch]:
            singles, pairs = shard.value
            for batch in _slices(batches):
                out = []
                kinds = None if kind is None else batch.column(kind).to_numpy()
                so_far = None if first else batch.column("_toxic_ratio").to_pylist()
                for at, words in hashed(_texts(batch.column(text)), MARKS):
                    before, now = _pairs(words)
                    lengths = list(map(len, words))
                    own = np.zeros(len(now), np.int64) if kinds is None else np.repeat(kinds[at : at + len(words)], lengths)
                    if first:
                        ratio = other[own]
                    else:
                        ratio = np.concatenate([np.frombuffer(x, np.float32) for x in so_far[at : at + len(words)]]).copy()
                    _look_up(*singles, now, own, ratio)
                    _look_up(*pairs, _pair_key(before, now), own, ratio)
                    out.extend(_summary(ratio, lengths) if last else (x.tobytes() for x in np.split(ratio, np.cumsum(lengths)[:-1])))
                if last and scores is not None:
                    score = scores(np.stack(out))
                    made = [pa.array(score), pa.array((score >= PREDICTED).astype(np.int32))]
                else:
                    made = [pa.array([x.tobytes() for x in out] if last else out, pa.binary())]
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], *made], names=schema.names)

        rows = rows.mapInArrow(step, schema)
    return rows


def _fitted(rows: DataFrame, known_: DataFrame, table: DataFrame, others: dict[str, float], sample: int):
    """The score as a function of the numbers that it is made of."""
    kinds = [k for k in KINDS[1:] if k in others]
    x = np.zeros((0, len(WINDOWS) + 3))
    if kinds:
        parts = shards(table, kinds)
        place = F.array_position(F.lit(kinds), F.col("_fold").cast("string")).cast("int") - 1
        picked = sampled(known_.where(F.col("_fold").cast("string").isin(kinds)), sample)
        picked = labelled(rows, picked).select("_label", place.alias("_toxic_kind"), "_toxic_text")
        found = with_summaries(picked, ["_label"], parts, [others[k] for k in kinds], kind="_toxic_kind").toArrow()
        for part in parts:
            part.destroy()
        y = found.column("_label").to_numpy().astype(np.float64)
        x = np.array([np.frombuffer(b) for b in found.column("_toxic_summary").to_pylist()]).reshape(len(y), -1)
    if not len(x) or len(np.unique(y)) < 2:
        even = np.log(PREDICTED / (1 - PREDICTED))
        return lambda x: sigmoid(even + ALONE * x[:, 0])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = logistic(np.c_[(x - mean) / scale, np.ones(len(x))], y, ridge=RIDGE, constant=True)
    return lambda x: sigmoid(((x - mean) / scale) @ weights[:-1] + weights[-1])


def toxicity_scores(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", divisor: int = 4, held: int = 2, sample: int = SAMPLE_ROWS, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or only its columns `keep`) with `held_out`, `score` and `predicted`.

    Labels are learned from ids whose crc32 modulo `divisor` is not `held`. All are counted; at
    most `sample` of each label are for the weights.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("held_out", "score", "predicted")]
    body = F.col(f"`{text}`").alias("_toxic_text")
    known_ = known(labels, id, label).where(remainder(F.col("_label_id"), divisor) != held)
    fold = F.pmod(F.xxhash64(F.lit("fold"), "_label_id"), F.lit(FOLDS)).cast("int")
    known_ = written(known_.withColumn("_fold", fold), "toxic_counted")
    rows = docs.select(F.col(f"`{id}`").alias("_label_id"), body)
    table, others = model(labelled(rows, known_))
    chosen = docs.select(*[F.col(f"`{c}`") for c in kept], (remainder(F.col(f"`{id}`"), divisor) == held).alias("held_out"), *([] if text in kept else [body]))
    names = [*kept, "held_out"]
    if "all" not in others:
        return chosen.drop("_toxic_text").withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    scores = _fitted(rows, known_, table, others, sample)
    own = text if text in kept else "_toxic_text"
    return with_summaries(chosen, names, shards(table, ["all"]), [others["all"]], scores, own)
