"""Quality by perplexity under an interpolated modified Kneser-Ney model of words (operator 7).

The model is one of bigrams over all words of any script: A-Z are lower-cased, a word is a run without white
space, a text ends with an end token and starts with a start token that is only a context. No vocabulary is cut.

Texts are turned once into stored batches (distinct word hashes, words as ranks by their number in the batch), a part of the
documents at a time: only a part's texts are in the shuffle that tells which are trusted. Each batch sends its distinct bigrams, in ``PASSES`` parts, to the bucket of their hash with their numbers in the texts learned from. A bucket
sums them and returns to each batch the counts of its own bigrams; one of the batches that hold a bigram owns it. Batches sum
what they own by word: a context's tokens and followers seen once, twice and more often, and the words a word
follows (its continuation count). These sums go to the words' buckets and back to the batches in the same way. So the counts
stay sharded, each batch is joined with those of its own n-grams alone, and only the counts of counts reach the driver.

Probabilities: the three discounts of an order come from its counts of counts; bigrams back off to continuation
counts, these to 1 / (V + 1), V the words seen and one for all others. They sum to one after any context.

Threshold: of the trusted documents those with crc32(doc_id as text) mod 5 = 1 are held out. A document's perplexity
is held against a quantile of its own language's held-out ones, so it isn't taken on texts the model has learned from (of all
held-out ones where a language has none, of the learned ones where nothing is held out).

Defined cases: texts without a word have no perplexity (0 symbols) and aren't kept; a null language is a language of its
own; a document with several labels is trusted if one row of them is; with no trusted text the model is uniform and
every text with words is kept; a perplexity equal to the threshold is kept; repeated rows are judged each; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnup.llm.base import discard, stored
from burnup.llm.bloom_lm import BUCKET_BYTES, END, FOLDS, HELD_OUT, START, _back, _by_bucket, _contexts, bigrams
from burnup.llm.columns import CHUNK_BYTES, LOWER, chunks, groups, per_row, token_bounds, word_hashes
from burnup.llm.quality_lm import LEAST_DISCOUNT, QUANTILE

#: Words of a batch; the more, the fewer bigrams are sent twice.
BATCH_TOKENS = 1 << 20
#: Parts in which the bigrams are sent, one after another, and in which batches meet their answers; they bound the disk taken at once.
PASSES, SLICES = 4, 4
#: Parts in which the documents are joined with the labels and made into batches; each reads all documents and sends its own.
TEXT_PARTS = 2
LEARNED, CALIBRATES, OTHER = 0, 1, 2
#: Sums of a word: tokens after it, followers seen once, twice, more often, words that it follows.
SUMS = 5

BATCH = "batch long, doc_id array<bigint>, lang array<string>, part array<int>, n_tokens array<int>, tokens binary, hashes binary, often binary"
ANSWERS = "bucket int, batch long, values binary, c array<bigint>"
RESULT = "doc_id long, lang string, part int, n_symbols long, perplexity double"


def pack(x: np.ndarray) -> bytes:
    """An array's bytes by place, compressed: small numbers take little in a shuffle."""
    planes = np.ascontiguousarray(x).ravel().view(np.uint8).reshape(-1, x.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).ravel().view(kind)


def pack_ascending(x: np.ndarray) -> bytes:
    """Ascending numbers by their steps: hashes themselves can't be compressed, their order can."""
    return pack(np.diff(x, prepend=np.uint64(0)))


def unpack_ascending(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def _as(column: pa.ChunkedArray | pa.Array, kind: str) -> list[np.ndarray]:
    return [unpack(x.as_py(), kind) for x in column]


def _ascending(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    return [unpack_ascending(x.as_py()) for x in column]


def _joined(back: pa.Array) -> np.ndarray:
    """A batch's values from its buckets, in their order."""
    return np.concatenate([unpack(x["values"], "<i8") for x in sorted(back[0].as_py(), key=lambda x: x["bucket"])])


def _joined_sums(back: pa.Array) -> np.ndarray:
    return np.concatenate([_by_row(unpack(x["values"], "<i8")) for x in sorted(back[0].as_py(), key=lambda x: x["bucket"])])


def _by_row(sums: np.ndarray) -> np.ndarray:
    """Words' sums, sent column by column."""
    return sums.reshape(SUMS, -1).T


def _cut(keys: np.ndarray, values: np.ndarray, buckets: int, passes: int = 1, at: int = 0) -> list[tuple[int, bytes, bytes]]:
    """Entries in order of their bucket and key, cut into the buckets of one pass. A key is sent as its quotient by
    the number of buckets, which tells it from the others of its bucket."""
    quotient, bucket = np.divmod(keys, np.uint64(buckets))
    bucket = bucket.astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    return [(b, pack_ascending(quotient[cuts[b]: cuts[b + 1]]), pack(values[cuts[b]: cuts[b + 1]].T)) for b in np.unique(bucket).tolist() if b % passes == at]


SENT = "bucket int, batch long, keys binary, counts binary"


def _sent(batch: int, rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([batch] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                                      names=["bucket", "batch", "keys", "counts"])


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, as they go through the shuffle that tells which are trusted."""
    for batch in batches:
        data = [x.as_buffer() for x in batch["text"].cast(pa.large_binary())]
        packed = [x.size.to_bytes(8, "little") + pa.compress(x, codec="zstd", asbytes=True) for x in data]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["lang"], pa.array(packed, pa.binary())], names=["doc_id", "lang", "packed"])


def _texts(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """The texts again, some megabytes at a time, with the place of the first."""
    held, size, first = [], 0, 0
    for i, x in enumerate(column):
        data = x.as_py()
        n = int.from_bytes(data[:8], "little")
        held.append(pa.decompress(data[8:], n, codec="zstd", asbytes=True))
        size += n
        if size >= CHUNK_BYTES or i == len(column) - 1:
            yield first, pa.array(held, pa.large_binary())
            held, size, first = [], 0, i + 1


def _batches(most: int, parts: int = 1, at: int = 0):
    """Rows of texts to batches: the distinct hashes in ascending order, how often each occurs, and the texts' words as ranks by that number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, number = 0, 0

        def out() -> pa.RecordBatch:
            ids, langs = (pa.concat_arrays([x[i] for x in held]) for i in (0, 1))
            part, n, h = (np.concatenate([x[i] for x in held]) for i in (2, 3, 4))
            distinct, places, often = np.unique(h, return_inverse=True, return_counts=True)
            rank = np.empty(len(distinct), "<u4")
            rank[_by_number(often)] = np.arange(len(distinct))
            one = [pa.ListArray.from_arrays([0, len(ids)], pa.array(x)) for x in (ids, langs, part.astype(np.int32), n.astype(np.int32))]
            return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() * parts + at << 32 | number]), *one, *(pa.array([x], pa.binary()) for x in (pack(rank[places]), pack_ascending(distinct), pack(often.astype("<u4"))))],
                                              names=["batch", "doc_id", "lang", "part", "n_tokens", "tokens", "hashes", "often"])

        for batch in batches:
            part = batch["part"].to_numpy()
            for first, text in _texts(batch["packed"]):
                for a, b, buf, bounds in chunks(text):
                    low = LOWER[buf]
                    starts, ends = token_bounds(low)
                    n = per_row(starts, bounds)
                    h = np.insert(word_hashes(low, starts, ends), np.cumsum(n), END)
                    held.append((batch["doc_id"].slice(first + a, b - a), batch["lang"].slice(first + a, b - a), part[first + a: first + b], n + 1, h))
                    size += len(h)
                    if size >= most:
                        yield out()
                        held, size, number = [], 0, number + 1
        if held:
            yield out()

    return run


def _by_number(often: np.ndarray) -> np.ndarray:
    """Places in order of falling numbers."""
    return np.argsort(-often.astype(np.int64), kind="stable")


def _coded(one: pa.RecordBatch, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A batch's words as places among its distinct hashes, these in order of their bucket, and the texts' numbers of words."""
    keys = unpack_ascending(one["hashes"][0].as_py())
    order = np.argsort(keys % np.uint64(buckets), kind="stable")
    place = np.empty(len(keys), "<u4")
    place[order] = np.arange(len(keys))
    tokens = place[_by_number(unpack(one["often"][0].as_py(), "<u4"))][unpack(one["tokens"][0].as_py(), "<u4")]
    return tokens, keys[order], one["n_tokens"].flatten().to_numpy()


def _learned(one: pa.RecordBatch, n: np.ndarray) -> np.ndarray:
    """The batch's tokens that are learned from; a text without words isn't."""
    return np.repeat((one["part"].flatten().to_numpy() == LEARNED) & (n > 1), n)


def _send_pairs(buckets: int, passes: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                one = batch.slice(row, 1)
                tokens, keys, n = _coded(one, buckets)
                pairs, places = _by_bucket(bigrams(keys[tokens], n), buckets)
                counts = np.bincount(places[_learned(one, n)], minlength=len(pairs))
                yield _sent(one["batch"][0].as_py(), _cut(pairs, counts.astype("<u4"), buckets, passes, at))

    return run


def _counts_of_counts(x: np.ndarray) -> list[int]:
    """How many are 1 to 4, how many are above 0, and the sum of all."""
    return [*(int((x == i).sum()) for i in (1, 2, 3, 4)), int((x > 0).sum()), int(x.sum())]


def _answers(bucket: int, names: list[int], values: list[bytes], c: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket] * (1 + len(names)), pa.int32()), pa.array([None, *names], pa.int64()), pa.array([None, *values], pa.binary()),
                                       pa.array([c, *[None] * len(names)], pa.list_(pa.int64()))], names=["bucket", "batch", "values", "c"])


def _sum_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: its counts of counts, and for each batch's own bigrams twice the sum over all batches, and one if the batch owns it."""
    for bucket, rows in groups(batches, "bucket"):
        each, number = _ascending(rows["keys"]), _as(rows["counts"], "<u4")
        distinct, first, place = np.unique(np.concatenate(each), return_index=True, return_inverse=True)
        total = np.bincount(place, np.concatenate(number), len(distinct)).astype("<i8")
        value = 2 * total[place]
        value[first[total > 0]] += 1
        ends = np.cumsum([0, *map(len, each)])
        yield _answers(bucket, rows["batch"].to_pylist(), [pack(value[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)], _counts_of_counts(total))


def _send_words(buckets: int):
    """What a batch owns, summed by word, to the words' buckets; the start of a text has a bucket of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                one = batch.slice(row, 1)
                tokens, keys, n = _coded(one, buckets)
                pairs, places = _by_bucket(bigrams(keys[tokens], n), buckets)
                value = _joined(one["bi"])
                context, word = np.empty(len(pairs), np.int64), np.empty(len(pairs), np.int64)
                context[places], word[places] = _contexts(tokens, n, len(keys)), tokens
                own = (value & 1) > 0
                context, word, count = context[own], word[own], value[own] >> 1
                size = len(keys) + 1
                sums = np.stack([np.bincount(context, count, size), *(np.bincount(context[c], minlength=size) for c in (count == 1, count == 2, count > 2)),
                                 np.bincount(word, minlength=size)], axis=1).astype("<i8")
                yield _sent(one["batch"][0].as_py(), [*_cut(keys, sums[:-1], buckets), (buckets, pack_ascending(np.array([START], np.uint64)), pack(sums[-1:].T))])

    return run


def _sum_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: the counts of continuation counts, and for each batch's own words the sums over all batches."""
    for bucket, rows in groups(batches, "bucket"):
        each, number = _ascending(rows["keys"]), np.concatenate([_by_row(x) for x in _as(rows["counts"], "<i8")])
        distinct, place = np.unique(np.concatenate(each), return_inverse=True)
        total = np.stack([np.bincount(place, x, len(distinct)) for x in number.T], axis=1).astype("<i8")
        ends = np.cumsum([0, *map(len, each)])
        yield _answers(bucket, rows["batch"].to_pylist(), [pack(total[place[i:j]].T) for i, j in zip(ends[:-1], ends[1:], strict=True)], _counts_of_counts(total[:, -1]))


def _totals(answers: DataFrame) -> list[int]:
    rows = answers.where("batch is null").select(*[F.sum(F.get("c", F.lit(i))) for i in range(6)]).first()
    return [x or 0 for x in rows]


def discounts(n: list[int]) -> np.ndarray:
    """The three discounts of an order by count (none, one, two, more), from how many n-grams occur once to four times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    out = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else 0.0 for i in (1, 2, 3)]
    return np.array([0.0, *(min(max(d, LEAST_DISCOUNT), float(i)) for i, d in enumerate(out, 1))])


def probabilities(pair: np.ndarray, context: np.ndarray, follows: np.ndarray, two: list[int], one: list[int]) -> np.ndarray:
    """P of each token: the count of it after its context, the context's sums, its own continuation count, both orders' counts of counts."""
    d2, d1 = discounts(two), discounts(one)
    types, words = one[4], one[5]
    many = types - one[0] - one[1]
    below = (follows - d1[np.minimum(follows, 3)] + (d1[1] * one[0] + d1[2] * one[1] + d1[3] * many) / (types + 1)) / words if words else np.full(len(pair), 1.0)
    total, left = context[:, 0], context[:, 1:4] @ d2[1:]
    return np.where(total > 0, (pair - d2[np.minimum(pair, 3)] + left * below) / np.maximum(total, 1), below)


def _score(buckets: int, two: list[int], words: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                one = batch.slice(row, 1)
                tokens, keys, n = _coded(one, buckets)
                _, places = _by_bucket(bigrams(keys[tokens], n), buckets)
                pair = (_joined(one["bi"]) >> 1)[places]
                sums = _joined_sums(one["words"])
                p = probabilities(pair, sums[_contexts(tokens, n, len(keys))], sums[tokens, -1], two, words)
                bits = np.add.reduceat(np.log2(p), np.cumsum(n) - n)
                none = n == 1
                yield pa.RecordBatch.from_arrays([one["doc_id"].flatten(), one["lang"].flatten(), one["part"].flatten(), pa.array(np.where(none, 0, n).astype(np.int64)), pa.array(np.exp2(-bits / n), mask=none)],
                                                 names=["doc_id", "lang", "part", "n_symbols", "perplexity"])

    return run


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    return out


def _by_bucket_sums(sent: DataFrame, run) -> DataFrame:
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, ANSWERS)


def scores(rows: list[DataFrame], size: int, batch_tokens: int = BATCH_TOKENS, bucket_bytes: int = BUCKET_BYTES, passes: int = PASSES, slices: int = SLICES) -> DataFrame:
    """doc_id, lang, part, n_symbols, perplexity of each row (doc_id, lang, part, packed) of the tables; ``size``: bytes of all texts."""
    buckets = max(1, -(-size // bucket_bytes))
    batch_parts = [stored(x.select("doc_id", "lang", "part", "packed").mapInArrow(_batches(batch_tokens, len(rows), at), BATCH), "kn_batches") for at, x in enumerate(rows)]
    batched = _union(batch_parts)
    coded = batched.select("batch", "part", "n_tokens", "tokens", "hashes", "often")
    pair_parts = [stored(_by_bucket_sums(coded.mapInArrow(_send_pairs(buckets, passes, at), SENT), _sum_pairs), "kn_pairs") for at in range(passes)]
    pairs = _union(pair_parts)
    own = lambda df, at: df.where(F.pmod(F.xxhash64("batch"), F.lit(slices)) == at)
    bi = lambda at: _back(own(pairs, at), "bi", "values").hint("merge")
    sent = [stored(own(coded, at).join(bi(at), "batch").mapInArrow(_send_words(buckets), SENT), "kn_sent") for at in range(slices)]
    word_parts = [stored(_by_bucket_sums(_union(sent).where(F.col("bucket") % slices == at), _sum_words), "kn_words") for at in range(slices)]
    words = _union(word_parts)
    for x in sent:
        discard(x)
    two, one = _totals(pairs), _totals(words)
    each = lambda at: own(batched, at).join(bi(at), "batch").join(_back(own(words, at), "words", "values").hint("merge"), "batch")
    scored = _union([stored(each(at).mapInArrow(_score(buckets, two, one), RESULT), "kn_scores") for at in range(slices)])
    for x in (*batch_parts, *pair_parts, *word_parts):
        discard(x)
    return scored


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, **sizes: int) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold, kept per row."""
    trusted = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").cast("long").alias("id")).distinct()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    part = F.when(F.col("id").isNull(), OTHER).when(fold == HELD_OUT, CALIBRATES).otherwise(LEARNED)
    # a sort-merge join at every size: labels grow with the documents, and the plan should not turn over with them
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packed = [docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(TEXT_PARTS)) == at).mapInArrow(_packed_texts, "doc_id long, lang string, packed binary") for at in range(TEXT_PARTS)]
    scored = scores([x.join(trusted.hint("merge"), F.col("doc_id") == F.col("id"), "left").withColumn("part", part.cast("int")) for x in packed], size, **sizes)
    at = F.percentile_approx("perplexity", quantile, 10_000)
    marks = scored.where((F.col("part") != OTHER) & F.col("perplexity").isNotNull())
    own = marks.where(F.col("part") == CALIBRATES).groupBy(F.col("lang").alias("own_lang")).agg(at.alias("own"))
    by_part = {x.part: x.at for x in marks.groupBy("part").agg(at.alias("at")).collect()}
    everyone = F.lit(by_part.get(CALIBRATES, by_part.get(LEARNED))).cast("double")
    out = scored.join(own, F.col("lang").eqNullSafe(F.col("own_lang")), "left")
    out = out.select("doc_id", "lang", "n_symbols", "perplexity", F.coalesce("own", everyone).alias("threshold"))
    return out.withColumn("kept", F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold"))))
