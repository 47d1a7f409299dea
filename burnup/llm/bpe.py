"""BPE encoding and decoding through a minimal acyclic transducer (operator 1).

``Lexicon``: the corpus's most frequent words and their token ids, compiled into a minimal acyclic
automaton (suffixes are shared; each arc carries the number of words passed over, so the sum along
an accepted word is its place in the list of id sequences). It is one block of bytes of bounded
size (``lexicon_words``), broadcast, put into an unnamed file and memory-mapped by each Python
worker. A word it does not accept is merged exactly, lowest rank first, leftmost among equals. So
the lexicon decides the time only, never the ids.

Which words are compiled follows from counts over all texts, summed per task before the shuffle.

Text rules are those of the tokenizer file (word BPE: NFC, white space, lower case, split pattern,
byte alphabet, end-of-word suffix); files with other rules are refused. Where the library's Unicode
tables differ from Python's (letters of other versions), the driver takes the difference from the
library itself (``differences``) and ships it with the rules. Defined cases: null text is empty;
special tokens' strings in a text become their ids; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers

from burnup.llm.base import discard, row_schema, stored, texts
from burnup.llm.columns import byte_lengths, slices

LEXICON_WORDS = 1 << 17
#: Frequency levels to a doubling.
LEVELS = 16
#: Distinct words a task keeps at hand, and a longest word worth it.
MEMO_WORDS, MEMO_LENGTH = 1 << 18, 64
#: Bytes of a word that is merged without a queue.
SHORT_WORD = 64
#: A character of each class that both tables know.
STAND_IN = {"letter": "ä", "number": "5", "space": " ", "other": "§"}


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def differences() -> dict:
    """Where the library's Unicode tables aren't Python's.

    ``lower``: its lower case; ``kind``: the class it puts a character in; ``order``: characters that
    take part in NFC in one of the two only (by combining class, or as the second of a pair).
    """
    lower, kind, order = {}, {}, set()
    nfc, small = normalizers.NFC().normalize_str, normalizers.Lowercase().normalize_str
    classes = {"letter": r"\p{L}", "number": r"\p{N}", "space": r"\s"}
    for block in range(0, 0x110000, 1 << 12):
        chars = [chr(c) for c in range(block, block + (1 << 12)) if not 0xD800 <= c < 0xE000 and c != 10]
        lines, text = "\n".join(chars), "".join(chars)
        if (theirs := small(lines)) != lines.lower():
            lower |= {c: x for c, x in zip(chars, theirs.split("\n"), strict=True) if c.lower() != x}
        of = [(name, set(regex.findall(p, text)), set(text).difference(normalizers.Replace(Regex(p), "").normalize_str(text))) for name, p in classes.items()]
        kind |= {c: "other" for _, ours, theirs in of for c in ours - theirs}
        kind |= {c: name for name, ours, theirs in of for c in theirs - ours}
        # beside a mark of class 240 and one of class 1, any character that reorders in one of the two shows
        for before, after in (("", ""), ("a\u0345", ""), ("a", "\u0334")):
            probes = before + f"{after}\n{before}".join(chars) + after
            if (theirs := nfc(probes)) != (ours := unicodedata.normalize("NFC", probes)):
                order |= {c for c, x, y in zip(chars, ours.split("\n"), theirs.split("\n"), strict=True) if x != y}
        for c in filter(unicodedata.decomposition, chars):
            parts = unicodedata.decomposition(c).split()
            if len(parts) == 2 and parts[0][0] != "<":
                pair = "".join(chr(int(x, 16)) for x in parts)
                if nfc(pair) != unicodedata.normalize("NFC", pair):
                    order.add(pair[1])
    return {"lower": lower, "kind": kind, "order": "".join(sorted(order))}


class Rules:
    """Vocabulary, merges and text rules of one tokenizer file."""

    def __init__(self, source: str):
        source = json.loads(source)
        spec, apart = source["file"], source["unicode"]
        model, parts = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]], [x["type"] for x in parts]
        if model["type"] != "BPE" or spec["decoder"] or spec["post_processor"] or kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
            raise ValueError("not a word-level BPE file of the supported rules")
        self.suffix: str = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.rank = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(model["merges"])}
        self.made = [vocab[a + b] for a, b in model["merges"]]
        shown = byte_alphabet()
        self.inner = [vocab[shown[b]] for b in range(256)]
        self.last = [vocab[shown[b] + self.suffix] for b in range(256)]
        self.tokens = [""] * (1 + max([*vocab.values(), *special.values()]))
        for t, i in [*vocab.items(), *special.items()]:
            self.tokens[i] = t
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        pattern = parts[0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        # the same over ASCII, where both classes are known, by the faster library
        self.ascii_pattern = re.compile(pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9"), re.ASCII)

        self.lower = str.maketrans(apart["lower"])
        self.kind = str.maketrans({c: STAND_IN[x] for c, x in apart["kind"].items()})
        self.reordered = frozenset(apart["order"])
        self.odd = frozenset([*apart["lower"], *apart["kind"], *apart["order"]])
        # a table for the first plane and one range beyond it: a quick look before the set
        self.maybe_odd = re.compile("[" + "".join(re.escape(c) for c in sorted(self.odd) if c <= "\uffff") + "\U00010000-\U0010ffff]")
        self.nfc = normalizers.NFC()

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_pattern.findall(text.lower())
        if self.maybe_odd.search(text) and not self.odd.isdisjoint(text):
            return self._words_apart(text)
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case by single characters
        return self.pattern.findall(text.lower())

    def _words_apart(self, text: str) -> list[str]:
        """The same for a text with characters that the library's tables hold otherwise."""
        text = unicodedata.normalize("NFC", text) if self.reordered.isdisjoint(text) else self.nfc.normalize_str(text)
        text = text.translate(self.lower).replace("Σ", "σ").lower()
        return [text[m.start(): m.end()] for m in self.pattern.finditer(text.translate(self.kind))]

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens in order."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return self.words(text)
        out: list[str] = []
        for i, part in enumerate(self.special_pattern.split(text)):
            out += [part] if i % 2 else self.words(part)
        return out

    def merge(self, word: str) -> bytes:
        """Exact ids of a word as little-endian 32-bit integers."""
        data = word.encode()
        ids = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        if len(ids) > SHORT_WORD:
            return self._merge_long(ids)
        get, none = self.rank.get, len(self.made)
        ranks = [get(x << 32 | y, none) for x, y in zip(ids[:-1], ids[1:], strict=True)]
        while ranks and (rank := min(ranks)) < none:
            i = ranks.index(rank)
            ids[i: i + 2] = [self.made[rank]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(ids[i] << 32 | ids[i + 1], none)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | ids[i], none)
        return np.array(ids, "<u4").tobytes()

    def _merge_long(self, ids: list[int]) -> bytes:
        """The same by a queue of pairs: time grows as n log n."""
        n = len(ids)
        left, right = [i - 1 for i in range(n)], [i + 1 for i in range(n)]
        rank_of = self.rank.get
        heap = [(r, i) for i in range(n - 1) if (r := rank_of(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = right[i]
            if ids[i] < 0 or j >= n or rank_of(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = self.made[rank], -1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
                if (r := rank_of(ids[i] << 32 | ids[right[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if left[i] >= 0 and (r := rank_of(ids[left[i]] << 32 | ids[i])) is not None:
                heapq.heappush(heap, (r, left[i]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def decode(self, ids: Iterable[int]) -> str:
        """Without a decoder in the file, tokens are joined by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids))


def compile_lexicon(words: Iterable[str], rules: Rules) -> bytes:
    """Minimal acyclic automaton of the words (built from their sorted bytes) with their id sequences."""
    ordered = sorted({w.encode() for w in words if w})
    register: dict[tuple, int] = {}
    arcs_of: list[tuple[tuple[int, int], ...]] = []
    final_of: list[bool] = []
    open_nodes: list[tuple[bool, list[tuple[int, int]]]] = [(False, [])]  # along the last word

    def close(node: tuple[bool, list[tuple[int, int]]]) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(arcs_of)
            arcs_of.append(key[1])
            final_of.append(node[0])
        return register[key]

    path = b""
    for word in [*ordered, None]:
        common = 0
        if word is not None:
            while common < min(len(word), len(path)) and word[common] == path[common]:
                common += 1
        for depth in range(len(path), common, -1):
            state = close(open_nodes.pop())
            open_nodes[-1][1].append((path[depth - 1], state))
        if word is None:
            break
        open_nodes += [(False, []) for _ in word[common:]]
        open_nodes[-1] = (True, open_nodes[-1][1])
        path = word
    root = close(open_nodes[0])
    below = [0] * len(arcs_of)  # accepted words from each state; targets close before their sources
    key, target, passed = [], [], []
    for state, arcs in enumerate(arcs_of):
        n = int(final_of[state])
        for label, to in arcs:
            key.append(state << 8 | label)
            target.append(to)
            passed.append(n)
            n += below[to]
        below[state] = n
    sequences = [rules.merge(w.decode()) for w in ordered]
    ends = np.cumsum([0, *(len(s) // 4 for s in sequences)])
    parts = [np.array(key, "<u4"), np.array(target, "<u4"), np.array(passed, "<u4"), np.array(final_of, "<u4"), ends.astype("<u4"), np.frombuffer(b"".join(sequences), "<u4")]
    head = np.array([root, *map(len, parts)], "<u4")
    return b"".join(x.tobytes() for x in [head, *parts])


class Lexicon:
    """A compiled lexicon, memory-mapped from an unnamed file of this process."""

    def __init__(self, blob: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(blob)
            f.flush()
            self.map = mmap.mmap(f.fileno(), len(blob), access=mmap.ACCESS_READ)
        head = np.frombuffer(self.map, "<u4", 7)
        self.root, at, parts = int(head[0]), 28, []
        for n in head[1:]:
            parts.append(np.frombuffer(self.map, "<u4", int(n), at))
            at += 4 * int(n)
        self.key, self.target, self.passed, self.final, self.ends, self.ids = parts

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """Place of each word, -1 for those it does not accept; all words step through the automaton together."""
        place = np.full(len(words), -1, np.int64)
        if not len(self.key) or not words:
            return place
        length = np.array([len(w) for w in words])
        data, first = np.frombuffer(b"".join(words), np.uint8), np.cumsum(length) - length
        alive, state, total = np.flatnonzero(length > 0), np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(alive):
            key = state[alive] << 8 | data[first[alive] + step]
            arc = np.minimum(np.searchsorted(self.key, key.astype(np.uint32)), len(self.key) - 1)
            ok = self.key[arc] == key
            alive, arc = alive[ok], arc[ok]
            total[alive] += self.passed[arc]
            state[alive] = self.target[arc]
            step += 1
            done = length[alive] == step
            ends = alive[done]
            ends = ends[self.final[state[ends]] == 1]
            place[ends] = total[ends]
            alive = alive[~done]
        return place

    def sequence(self, place: int) -> bytes:
        return self.ids[self.ends[place]: self.ends[place + 1]].tobytes()


class Encoder:
    """Ids of texts: words from the lexicon, others merged; a task keeps words it has met at hand."""

    def __init__(self, rules: Rules, lexicon: Lexicon):
        self.rules, self.lexicon = rules, lexicon
        self.memo: dict[str, bytes] = dict(rules.special)

    def learn(self, words: set[str]) -> list[str]:
        """Put all ``words`` into the memo; the ones too long to stay there are returned."""
        missing = [w for w in words if w not in self.memo]
        if len(self.memo) + len(missing) > MEMO_WORDS:
            self.memo = dict(self.rules.special)
            missing = [w for w in words if w not in self.memo]
        places = self.lexicon.lookup([w.encode() for w in missing]).tolist()
        for w, place in zip(missing, places, strict=True):
            self.memo[w] = self.lexicon.sequence(place) if place >= 0 else self.rules.merge(w)
        return [w for w in missing if len(w) > MEMO_LENGTH]

    def encode(self, column: list[str]) -> list[bytes]:
        split = [self.rules.pieces(t) for t in column]
        rare = self.learn(set().union(*split))
        get = self.memo.__getitem__
        out = [b"".join(map(get, s)) for s in split]
        for w in rare:
            del self.memo[w]
        return out


_RULES: dict[str, Rules] = {}


def rules_of(source: str) -> Rules:
    """Parsed once per process."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _RULES:
        _RULES.clear()
        _RULES[key] = Rules(source)
    return _RULES[key]


def read_rules(path: str) -> str:
    """The tokenizer file and ``differences``, as one text for the workers."""
    with open(path, encoding="utf-8") as f:
        return json.dumps({"file": json.load(f), "unicode": differences()})


def frequent_words(docs: DataFrame, source: str, most: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of all texts, as many whole frequency levels as ``most`` words hold.

    Only the levels' sizes and then the chosen words come to the driver, ``most`` of them at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, counts = rules_of(shared.value), Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch["text"]:
                counts.update(rules.words(text.as_py()))
                if len(counts) > MEMO_WORDS:
                    yield out()
                    counts.clear()
        yield out()

    words = texts(docs).select("text").mapInArrow(run, "word string, n long").where(F.length("word") <= MEMO_LENGTH)
    level = F.floor(F.log2("n") * LEVELS).cast("int").alias("level")
    counted = stored(words.groupBy("word").agg(F.sum("n").alias("n")).select("word", level), "bpe_words")
    sizes = counted.groupBy("level").count().collect()  # at most 64 * LEVELS
    least, held = None, 0
    for x in sorted(sizes, key=lambda x: -x.level):
        held += x["count"]
        if held > most:
            break
        least = x.level
    out = [] if least is None else [x.word for x in counted.where(F.col("level") >= least).select("word").collect()]
    discard(counted)
    return out


def encode(docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS, keep: tuple[str, ...] = ("doc_id",), digests: bool = False) -> DataFrame:
    """Columns ``keep`` with n_tokens and ids (digests: the SHA-256 of ids and of the decoded text instead of ids)."""
    source = read_rules(path)
    spark = docs.sparkSession
    blob = spark.sparkContext.broadcast(compile_lexicon(frequent_words(docs, source, lexicon_words), rules_of(source)))
    shared = spark.sparkContext.broadcast(source)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = rules_of(shared.value)
        encoder = Encoder(rules, Lexicon(blob.value))
        for batch in batches:
            for a, b in slices(byte_lengths(batch["text"])):
                part = batch.slice(a, b - a)
                ids = encoder.encode(part["text"].to_pylist())
                n = np.array([len(x) // 4 for x in ids], np.int64)
                if digests:
                    decoded = [rules.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
                    more = [pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded])]
                else:
                    flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                    more = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))]
                yield pa.RecordBatch.from_arrays([part["row"], pa.array(n), *more], names=names)

    names = ["row", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids"])]
    kinds = ["long", *(["string", "string"] if digests else ["array<int>"])]
    out = rows.mapInArrow(run, row_schema(rows, ", ".join(f"{x} {y}" for x, y in zip(names[1:], kinds, strict=True))))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], *names[1:])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encoded`` with a column ``decoded``: the text of ``ids`` (null ids: null)."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_rules(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = rules_of(shared.value)
        for batch in batches:
            text = [None if x is None else rules.decode(x) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(text, pa.string())], names=["row", "decoded"])

    names = [c for c in encoded.columns if c != "decoded"]
    rows = encoded.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "ids")
    out = rows.mapInArrow(run, row_schema(rows, "decoded string"))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "decoded")
