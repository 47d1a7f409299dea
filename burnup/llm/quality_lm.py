"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text (operator 7).

The model is one of symbols: each byte of a text is one of 64 (letters of both cases, digits, white
space, common marks, classes of other bytes), and the order is ``ORDER``. So every n-gram is a number
below 64^ORDER, counts are exact, and every table has a fixed bound, however large the corpus; a word
model's joins would shuffle several times the input.

Counting and estimating are sharded by n-gram: tasks pre-sum their n-grams; counts of the highest
order are summed by n-gram, continuation counts of the lower ones follow by grouping; each order's
counts are joined with their contexts' totals and numbers of followers to give discounted
probabilities and back-off weights, with three discounts an order from the counts of counts. The
joined tables (at most 64^ORDER rows by the alphabet) are what tasks score whole texts with.

A document's perplexity is held against a quantile of its own language's trusted documents (of all
trusted ones where a language has none): a higher perplexity is poor quality.

Defined cases: null and empty texts have no perplexity and aren't kept; a null language is a language
of its own; a document with several labels is trusted if one row of them is; with no trusted text the
model is uniform and every text with symbols is kept; repeated rows are judged each; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnup.llm.base import row_schema, stored
from burnup.llm.columns import chunks

ORDER, SYMBOL_BITS = 4, 6
SYMBOLS = 1 << SYMBOL_BITS
#: A document above this quantile of its language's trusted perplexities is not kept.
QUANTILE = 0.99
#: Something is left for what wasn't seen, also where the counts of counts give no discount.
LEAST_DISCOUNT = 0.01
#: Counts a task holds before it sends them on.
HELD = 1 << 22


def _alphabet() -> np.ndarray:
    """0 is the start of a text; then letters, and classes of other bytes."""
    out = np.zeros(256, np.uint8)
    out[97:123], out[65:91] = np.arange(1, 27), np.arange(27, 53)
    for b in range(256):
        c = chr(b)
        if out[b]:
            continue
        if b >= 128:
            out[b] = 61 + (b >= 192) + (b >= 224)
        elif c.isdigit():
            out[b] = 53
        elif c in " \t\r\n\x0b\x0c":
            out[b] = 55 if c == "\n" else 54
        else:
            out[b] = {".": 56, ",": 57, "'": 58, "-": 58, "!": 59, "?": 59}.get(c, 60)
    return out


ALPHABET = _alphabet()


def codes(buf: np.ndarray, bounds: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Number of the n-gram that ends at each byte; texts end with a byte that isn't part of them (its code is void)."""
    s = ALPHABET[buf].astype(np.int32)
    out = s.copy()
    place = np.arange(len(buf)) - np.repeat(bounds[:-1], np.diff(bounds))
    for i in range(1, order):
        before = np.zeros_like(s)
        before[i:] = s[:-i]
        before[place < i] = 0
        out |= before << (SYMBOL_BITS * i)
    return out


def symbol_counts(rows: DataFrame) -> DataFrame:
    """(g, n): n-grams of highest order of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            g, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(g.astype(np.int32)), pa.array(n.astype(np.int64))], names=["g", "n"])

        for batch in batches:
            for _, _, buf, bounds in chunks(batch["text"]):
                own = np.ones(len(buf), bool)
                own[bounds[1:] - 1] = False
                held.append(codes(buf, bounds)[own])
                size += len(held[-1])
                if size >= HELD:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return rows.select("text").mapInArrow(run, "g int, n long").groupBy("g").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> list[float]:
    """The three discounts of an order, from how many n-grams occur once to four times."""
    n = [0, 0, 0, 0, 0]
    for x in counts.where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect():
        n[x.n] = x.c
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    out = [(i - (i + 1) * y * n[i + 1] / n[i]) if n[i] else 0.0 for i in (1, 2, 3)]
    return [min(max(d, LEAST_DISCOUNT), float(i + 1)) for i, d in enumerate(out)]


def estimate(top: DataFrame, order: int = ORDER) -> list[tuple[DataFrame, DataFrame]]:
    """Per order from the highest: (g, p) discounted probabilities, (h, back) back-off weights of contexts."""
    out, counts = [], top
    for k in range(order, 0, -1):
        d = discounts(counts)
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        by_context = counts.select("g", "n", F.shiftright("g", SYMBOL_BITS).alias("h"), cut.alias("d"))
        context = by_context.groupBy("h").agg(F.sum("n").alias("total"), F.sum("d").alias("left"))
        p = by_context.join(context, "h").select("g", ((F.col("n") - F.col("d")) / F.col("total")).alias("p"))
        out.append((p, context.select("h", (F.col("left") / F.col("total")).alias("back"))))
        if k > 1:
            counts = stored(counts.groupBy(F.col("g").bitwiseAND(F.lit((1 << SYMBOL_BITS * (k - 1)) - 1)).alias("g")).agg(F.count(F.lit(1)).alias("n")), "kn_counts")
    return out


Tables = list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def collected(model: list[tuple[DataFrame, DataFrame]]) -> Tables:
    """The joined tables; at most SYMBOLS ** order rows each."""
    out = []
    for p, back in model:
        a, b = p.toArrow(), back.toArrow()
        out.append((a["g"].to_numpy(), a["p"].to_numpy().astype(np.float32), b["h"].to_numpy(), b["back"].to_numpy().astype(np.float32)))
    return out


def dense(tables: Tables) -> np.ndarray:
    """log2 P of every n-gram of highest order, by its number."""
    below = np.full(1, 1.0 / SYMBOLS, np.float32)
    for k, (g, p, h, back) in enumerate(reversed(tables), 1):
        weight = np.ones(SYMBOLS ** (k - 1), np.float32)
        weight[h] = back
        # the shorter n-gram drops the first symbol of the context
        shorter = below if k == 1 else below.reshape(-1, SYMBOLS)[np.arange(SYMBOLS ** (k - 1)) % SYMBOLS ** max(k - 2, 0)]
        now = (weight[:, None] * shorter).ravel() if k > 1 else np.full(SYMBOLS, weight[0] / SYMBOLS, np.float32)
        now[g] += p
        below = now
    return np.log2(below)


def perplexities(docs: DataFrame, tables: Tables, keep: Column) -> DataFrame:
    """(row, n_symbols, perplexity) per row; ``keep``: the struct that is handed on."""
    model = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = dense(model.value)
        for batch in batches:
            n, bits = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            for a, b, buf, bounds in chunks(batch["text"]):
                value = table[codes(buf, bounds)]
                value[bounds[1:] - 1] = 0
                n[a:b] = np.diff(bounds) - 1
                bits[a:b] = np.add.reduceat(value, bounds[:-1], dtype=np.float64)
            ppl = np.exp2(-bits / np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(n), pa.array(ppl, mask=n == 0)], names=["row", "n_symbols", "perplexity"])

    rows = docs.select(keep.alias("row"), "text")
    return rows.mapInArrow(run, row_schema(rows, "n_symbols long, perplexity double"))


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold, kept per row."""
    trusted = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").cast("long").alias("id")).distinct()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    # a sort-merge join at every size: labels grow with the documents, and the plan should not turn over with them
    learned = docs.where("text is not null").select("doc_id", "text").join(trusted.hint("merge"), F.col("doc_id") == F.col("id"), "left_semi")
    counts = stored(symbol_counts(learned), "kn_counts")
    scored = stored(perplexities(docs, collected(estimate(counts)), F.struct("doc_id", "lang")).select("row.*", "n_symbols", "perplexity"), "kn_scores")
    marks = scored.join(trusted, F.col("doc_id") == F.col("id"), "left_semi").where("perplexity is not null")
    at = F.percentile_approx("perplexity", quantile, 10_000)
    own = marks.groupBy(F.col("lang").alias("own_lang")).agg(at.alias("own"))
    everyone = F.lit(marks.agg(at).first()[0]).cast("double")
    out = scored.join(own, F.col("lang").eqNullSafe(F.col("own_lang")), "left")
    out = out.select("doc_id", "lang", "n_symbols", "perplexity", F.coalesce("own", everyone).alias("threshold"))
    return out.withColumn("kept", F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold"))))
