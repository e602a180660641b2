"""Language of whole texts by error-correcting output codes.

Every language has a codeword of bits. One linear classifier over hashed letter n-grams predicts each bit;
decoding sums, for each codeword, the logistic losses of its bits, each weighted by how well that bit's classifier did on
its training rows, and takes the codeword of least loss. A text whose two best codewords are about as near is
flagged as ambiguous.

Training takes at most `SAMPLE` different texts in all, in about equal parts for the languages, chosen by a hash of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import SPREAD, U64, arrow_schema, as_binary, buffers, byte_table, mix, pieces, reach

#: Different texts that training takes in all, at most.
SAMPLE = 4000
#: Hashed n-grams of 1 to 3 bytes of letters.
FEATURES, ORDERS = 2048, (1, 2, 3)
UNKNOWN = "und"
#: A lead of the best codeword over the next, as a share of the probability, below which a text is ambiguous.
MARGIN = 0.05
STEPS, RATE, RIDGE = 300, 8.0, 1e-4

_FOLD = np.full(256, 32, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of unit length for each text: roots of the counts of its hashed n-grams, marks and digits as blanks."""
    texts = len(offsets) - 1
    out = np.zeros((texts, FEATURES))
    if len(data) == 0:
        return out
    folded = _FOLD[data]
    capital = np.zeros(len(data), bool)  # of Latin-1, as two bytes
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    folded[capital] += 0x20
    text = np.repeat(np.arange(texts), np.diff(offsets))
    drop = np.zeros(len(data), bool)
    drop[1:] = (folded[1:] == 32) & (folded[:-1] == 32) & (text[1:] == text[:-1])
    folded, text = folded[~drop], text[~drop]
    value, total = byte_table(31)[folded], None
    for order in ORDERS:
        n = len(folded) - order + 1
        if n <= 0:
            break
        total = value[:n].copy() if total is None else total[:n] * SPREAD + value[order - 1 :]
        same = text[:n] == text[order - 1 :]
        slot = (mix(total + U64(order)) % U64(FEATURES)).astype(np.int64)[same]
        out += np.bincount(text[:n][same] * FEATURES + slot, minlength=texts * FEATURES).reshape(texts, FEATURES)
    out = np.sqrt(out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def codewords(classes: int) -> np.ndarray:
    """Bits (+1, -1) for each class: all splits of up to 6 classes, else the best spread of random codes."""
    if classes <= 1:
        return np.ones((classes, 1))
    if classes <= 6:
        splits = np.arange(1, 1 << (classes - 1))
        return np.where(splits[None, :] >> np.arange(classes)[:, None] & 1, 1.0, -1.0)
    random, best, found = np.random.default_rng(7), -1, None
    for _ in range(50):
        code = random.choice([-1.0, 1.0], size=(classes, 12 * int(np.ceil(np.log2(classes)))))
        code = code[:, np.abs(code.sum(axis=0)) < classes]
        near = (code @ code.T - 2 * code.shape[1] * np.eye(classes)).max()
        if found is None or -near > best:
            best, found = -near, code
    return found


@dataclass
class Model:
    """Languages with their codewords, and for each bit a linear classifier with its weight in decoding."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its probability, and whether the next is about as near."""
        margins = rows @ self.weights + self.bias
        loss = np.stack([(self.trust * np.logaddexp(0, -margins * word)).sum(axis=1) for word in self.code], axis=1)
        odds = np.exp(loss.min(axis=1, keepdims=True) - loss)
        odds /= odds.sum(axis=1, keepdims=True)
        best = odds.argmax(axis=1)
        score = odds[np.arange(len(odds)), best]
        second = np.partition(odds, -2, axis=1)[:, -2] if len(self.languages) > 1 else np.zeros(len(odds))
        return best, score, score - second < MARGIN


def train(rows: np.ndarray, languages: list[str]) -> Model:
    """Fit one ridge-penalised logistic classifier for each bit, by gradient descent with momentum."""
    names = sorted(set(languages))
    code = codewords(len(names))
    target = code[[names.index(x) for x in languages]]
    weights, bias = np.zeros((rows.shape[1], code.shape[1])), np.zeros(code.shape[1])
    speed, lift = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(STEPS):
        slope = -target / (1 + np.exp(target * (rows @ weights + bias))) / len(rows)
        speed = 0.9 * speed - RATE * (rows.T @ slope + RIDGE * weights)
        lift = 0.9 * lift - RATE * slope.sum(axis=0)
        weights, bias = weights + speed, bias + lift
    right = np.clip(((rows @ weights + bias) * target > 0).mean(axis=0), 0.5, 0.999)
    trust = np.log(right / (1 - right))
    return Model(names, code, weights, bias, trust / max(trust.max(), 1e-9))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = buffers(as_binary(batch.column(1)))
        for lo, hi in pieces(at):
            rows = features(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[lo:hi], pa.array([r.tobytes() for r in rows], pa.binary()), batch.column(2)[lo:hi]], names=["lang", "row", "place"]
            )


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from rows (lang, text), copies of a row counting once; rows without a lang or a text are no examples. None if nothing
    is left."""
    reach(labelled.sparkSession)
    known = labelled.select("lang", "text", F.xxhash64("text").alias("print")).where("lang is not null and text is not null and text != ''")
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.countDistinct("print").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, sample / len(counts) / n)])
    # of a uniform hash, so places below 1 are the wanted number of each language
    place = F.pmod("print", F.lit(1 << 30)) / F.lit(float(1 << 30)) / share[F.col("lang")]
    chosen = known.select("lang", "text", place.alias("place"))
    if sum(counts.values()) > sample:
        chosen = chosen.where("place < 1")
    rows = chosen.distinct().mapInArrow(_sampled, "lang string, row binary, place double")
    got = rows.orderBy("place", "lang", "row").limit(sample).collect()
    if not got:
        return None
    return train(np.stack([np.frombuffer(r.row, np.float16) for r in got]).astype(float), [r.lang for r in got])


def _has_letter(texts: list[str | None]) -> np.ndarray:
    return np.array([any(map(str.isalpha, t or "")) for t in texts], bool)


def _predictor(model: Model | None, schema: str):
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            data, at = buffers(as_binary(column))
            for lo, hi in pieces(at):
                languages, scores, unsure = [UNKNOWN] * (hi - lo), np.zeros(hi - lo), np.ones(hi - lo, bool)
                if model:
                    best, scores, unsure = model.decode(features(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]))
                    letters = _has_letter(column[lo:hi].to_pylist())
                    scores, unsure = np.where(letters, scores, 0.0), unsure | ~letters
                    languages = [model.languages[b] if x else UNKNOWN for b, x in zip(best, letters, strict=True)]
                found = [pa.array(languages), pa.array(scores), pa.array(unsure)]
                columns = [*(batch.column(i)[lo:hi] for i in range(2, batch.num_columns)), *found]
                yield pa.RecordBatch.from_arrays(columns, names=target.names).cast(target)

    return run


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """A row for each document: doc_id, lang_pred, score (0 to 1), ambiguous.

    A text that is missing or has no letter is `und` with score 0 and ambiguous, as are all if there is no model. doc_id is only
    passed on, so missing and repeated ones are kept. Other columns are ignored.
    """
    reach(documents.sparkSession)
    kind = dict(documents.dtypes)["doc_id"]
    rows = documents.select(F.lit(0), "text", "doc_id")
    schema = f"doc_id {kind}, lang_pred string, score double, ambiguous boolean"
    return rows.mapInArrow(_predictor(model, schema), schema)


def recognised(documents: DataFrame, model: Model | None) -> DataFrame:
    """The documents, with all their columns, whose text has letters and is not ambiguous."""
    reach(documents.sparkSession)
    names = documents.columns
    rows = documents.select(F.lit(0).alias("_0"), documents["text"].alias("_1"), *(documents[c].alias(f"_c{i}") for i, c in enumerate(names)))
    schema = ", ".join(f"_c{i} {documents.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    schema += ", lang_pred string, score double, ambiguous boolean"
    judged = rows.mapInArrow(_predictor(model, schema), schema)
    kept = judged.where("not ambiguous")
    return kept.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)))
