"""Language identification as inference of a mixture (operator 4).

Learning: counts of hashed byte trigrams per language, summed per task before the shuffle, over every
labelled text of the training fold. The model is FEATURES floats for each language (labels are a
closed set; ``MAX_LANGUAGES`` of them at most are accepted), so its broadcast has a fixed bound.

Prediction: a text is a sample of words; each word's likelihood in each language is the product of
its trigrams'. Expectation-maximisation estimates the proportions of the languages in the text.
Which languages take part is chosen by penalised likelihood: from the best single language on, the
language with the next largest proportion joins as long as the likelihood gained exceeds
``PENALTY`` * log(words) (BIC with a weight). The prediction is the language of largest proportion,
the score that proportion.

Trigrams: A-Z lower-cased; white space, digits and ASCII punctuation count as word bounds, bytes of
other characters as letters. Defined cases: null text or one without a letter: ``und``, score 0; the
same for all texts if nothing was learned; a null doc_id is in neither fold (held_out false, not
learned from); ties of proportions go to the first label in order; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnup.llm.base import row_schema
from burnup.llm.columns import BYTE_CODE, GOLD, LOWER, chunks, mix, per_row, ragged

FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
MAX_LANGUAGES = 400
ALPHA, ROUNDS, PENALTY = 0.5, 8, 2.0
UNKNOWN = "und"

#: Letters as they are counted: lower case, and one space for all that isn't part of a word.
FOLD = LOWER.copy()
FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32
_PART = [(mix(BYTE_CODE + np.full(256, i, np.uint64) * GOLD) & np.uint64(FEATURES - 1)).astype(np.uint16) for i in range(3)]


def features(buf: np.ndarray) -> np.ndarray:
    """Hashed trigram that starts before each byte of folded text; none goes on after a word's end."""
    long = np.concatenate([np.full(1, 32, np.uint8), buf, np.full(1, 32, np.uint8)])
    return _PART[0][long[:-2]] + _PART[1][long[1:-1]] + _PART[2][np.where(long[1:-1] == 32, np.uint8(32), long[2:])]


def folded(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks of folded text; each text ends with a space."""
    for a, b, buf, bounds in chunks(column):
        yield a, b, FOLD[buf], bounds


def fold(doc_id: str = "doc_id", mod: int = 3) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % mod


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and log P(trigram | language), learned from all rows with text and lang."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            lang = np.asarray(batch["lang"].to_pylist(), object)
            for a, b, buf, bounds in folded(batch["text"]):
                f = features(buf)
                inside = (buf != 32) | np.concatenate([[False], buf[:-1] != 32])
                names, code = np.unique(lang[a:b].astype(str), return_inverse=True)
                code = np.repeat(code, np.diff(bounds))
                for i, name in enumerate(names.tolist()):
                    sums[name] = sums.get(name, 0) + np.bincount(f[inside & (code == i)], minlength=FEATURES)
        for name, n in sums.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(n[some].astype(np.int64))], names=["lang", "f", "n"])

    rows = docs.where("text is not null and lang is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    counts = rows.mapInArrow(run, "lang string, f int, n long").groupBy("lang", "f").agg(F.sum("n").alias("n"))
    # one row of at most FEATURES counts for each language
    learned = counts.groupBy("lang").agg(F.collect_list("f").alias("f"), F.collect_list("n").alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(learned) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.zeros((len(learned), FEATURES))
    for i, x in enumerate(learned):
        table[i, x.f] = x.n
    table += ALPHA
    return [x.lang for x in learned], np.log(table / table.sum(1, keepdims=True)).astype(np.float32) if learned else table.astype(np.float32)


def _mixture(like: np.ndarray, doc: np.ndarray, words: np.ndarray, first: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after ROUNDS of expectation-maximisation from ``share`` (zeros stay), and the log-likelihood over the scale of ``like``."""
    for _ in range(ROUNDS):
        part = like * share[doc]
        part /= part.sum(1, keepdims=True)
        share = np.add.reduceat(part, first, axis=0) / words[:, None]
    total = (like * share[doc]).sum(1)
    return share, np.add.reduceat(np.log(total), first)


def infer(buf: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language number, or -1; its proportion) of each text of a chunk of folded text."""
    n_rows, n_lang = len(bounds) - 1, len(table)
    out, score = np.full(n_rows, -1), np.zeros(n_rows)
    inside = np.concatenate([[False], buf != 32])
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    words = per_row(starts, bounds)
    some = np.flatnonzero(words)
    if not n_lang or not len(some):
        return out, score
    f = np.where(inside[1:] | inside[:-1], features(buf).astype(np.int32), FEATURES)  # between words: no trigram
    like = np.stack([np.add.reduceat(np.append(log, np.float32(0))[f], starts, dtype=np.float64) for log in table], axis=1)
    like -= like.max(1, keepdims=True)
    words = words[some]
    first = np.cumsum(words) - words
    doc = np.repeat(np.arange(len(some)), words)
    single = np.add.reduceat(like, first, axis=0)
    like = np.exp(np.maximum(like, -60.0))
    best = single.argmax(1)
    share = np.zeros((len(some), n_lang))
    share[np.arange(len(some)), best] = 1.0
    if n_lang > 1:
        full, _ = _mixture(like, doc, words, first, np.full((len(some), n_lang), 1.0 / n_lang))
        full[np.arange(len(some)), best] = 2.0  # the best single language comes first
        order = np.argsort(-full, axis=1, kind="stable")
        level, active = single.max(1), np.arange(len(some))
        for size in range(2, n_lang + 1):  # texts that gained by the last language try the next
            word, _ = ragged(words[active])
            rows = first[active][word] + np.arange(len(word)) - np.repeat(np.cumsum(words[active]) - words[active], words[active])
            start = np.zeros((len(active), n_lang))
            np.put_along_axis(start, order[active, :size], 1.0 / size, axis=1)
            got, value = _mixture(like[rows], word, words[active], np.cumsum(words[active]) - words[active], start)
            better = value - level[active] > PENALTY * np.log(words[active] + 1.0)
            share[active[better]] = got[better]
            level[active[better]] = value[better]
            active = active[better]
            if not len(active):
                break
    out[some] = share.argmax(1)
    score[some] = np.minimum(share.max(1), 1.0)
    return out, score


def predict(docs: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """The rows of ``docs`` as a struct ``row`` with lang_pred and score."""
    model = docs.sparkSession.sparkContext.broadcast((languages, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs = model.value
        for batch in batches:
            pred, score = np.full(len(batch), -1), np.zeros(len(batch))
            for a, b, buf, bounds in folded(batch["text"]):
                pred[a:b], score[a:b] = infer(buf, bounds, logs)
            found = (pred >= 0) & batch["lettered"].to_numpy(zero_copy_only=False)
            label = [names[p] if ok else UNKNOWN for p, ok in zip(pred.tolist(), found.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(label, pa.string()), pa.array(np.where(found, score, 0.0))], names=["row", "lang_pred", "score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return rows.mapInArrow(run, row_schema(rows, "lang_pred string, score double"))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    languages, table = train(docs.where(fold() != 1))
    out = predict(docs.select("doc_id", "text"), languages, table)
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce(fold("row.doc_id") == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text has a main language (a proportion of ``least`` or more); all columns.

    Where no language could be learned, all rows with a letter stay.
    """
    languages, table = train(docs.where(fold() != 1))
    if not languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    out = predict(docs, languages, table).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
