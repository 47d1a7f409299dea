import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from burnup.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", None, "Hello, World's 42nd it'll don't I'M we've", "<|startoftext|>Hi<|endoftext|><|endoftext|>x", "ΣΑΣ Σ ὈΔΥΣΣΕΎΣ İstanbul",
       "é é Å ﬁ ½ ²", "日本語 テスト 한국어 🙂🙂👍🏽", "a b c\u0085d\x1ce\x1ff​g　h", "x" * 700, "ab" * 3000 + "!?" * 400, "\t\r\n\x0b", "_snake_case__", "<|startoftext",
       "1234567 ١٢٣ Ⅷ ५", "'s't're 'S 'LL", "Ǆ ǅ ß ẞ Ω", "﻿bom", "ạ̀́", "\U0001d400 𐐀"]


def corpus():
    r = random.Random(0)
    pool = "abcdeé ñÑ'.,!?0123\n\tßΣσ<|>日🙂́ "
    return ODD + ["".join(r.choice(pool) for _ in range(r.randint(0, 80))) for _ in range(400)]


@pytest.mark.parametrize("words", [0, 50, 1 << 12])
def test_as_the_library(spark, words):
    rows = corpus()
    lib = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, n_tokens string").repartition(4)
    got = {x.doc_id: x for x in bpe.encode(df, PATH, words, digests=True).collect()}
    for i, t in enumerate(rows):
        want = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(want), t
        assert got[i].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest(), t
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(want, skip_special_tokens=False).encode()).hexdigest(), t


def test_every_code_point_as_the_library():
    """Each within a word and before a number; marks also between others, which NFC puts in order."""
    lib, rules = Tokenizer.from_file(PATH), bpe.rules_of(bpe.read_rules(PATH))
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    marks = [c for c in chars if unicodedata.category(c)[0] == "M"]
    parts = [f"x{c}1" for c in chars] + [f"a\u0345{c}\u0334 e{c}\u0301" for c in marks]
    rows = [" ".join(parts[i: i + 256]) for i in range(0, len(parts), 256)]
    for i in range(0, len(rows), 64):
        for row, x in zip(rows[i: i + 64], lib.encode_batch(rows[i: i + 64], add_special_tokens=False), strict=True):
            assert b"".join(map(rules.merge, rules.words(row))) == np.array(x.ids, "<u4").tobytes(), ascii(row[:20])


def test_letters_of_other_versions_between_texts():
    """Random texts of the characters on which the two tables differ, with plain ones between."""
    lib, rules, r = Tokenizer.from_file(PATH), bpe.rules_of(bpe.read_rules(PATH)), random.Random(3)
    apart = bpe.differences()
    pool = [*apart["lower"], *r.sample(sorted(apart["kind"]), 300), *apart["order"], "\U00011935", "\U00011930", *"aÉ1 ' s\u0301\u0316\u0334Σ"]
    rows = ["".join(r.choices(pool, k=30)) for _ in range(3000)]
    for row, x in zip(rows, lib.encode_batch(rows, add_special_tokens=False), strict=True):
        assert b"".join(map(rules.merge, rules.words(row))) == np.array(x.ids, "<u4").tobytes(), ascii(row)


def test_ids_and_decode(spark):
    lib = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(1, "A cat sat"), (1, "A cat sat"), (None, None)], "doc_id long, text string")
    out = bpe.encode(df, PATH)
    ids = lib.encode("a cat sat", add_special_tokens=False).ids
    assert sorted((x.doc_id or 0, x.ids) for x in out.collect()) == [(0, []), (1, ids), (1, ids)]
    assert sorted((x.doc_id or 0, x.decoded) for x in bpe.decode(out, PATH).collect()) == [(0, ""), (1, lib.decode(ids)), (1, lib.decode(ids))]
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_automaton_is_minimal_and_exact():
    rules = bpe.rules_of(bpe.read_rules(PATH))
    words = ["running", "jumping", "sing", "ring", "run", "é", "a", "abc", "xbc"]
    lex = bpe.Lexicon(bpe.compile_lexicon(words, rules))
    place = lex.lookup([w.encode() for w in words])
    assert sorted(place.tolist()) == list(range(len(words)))
    assert all(lex.sequence(p) == rules.merge(w) for w, p in zip(words, place.tolist()))
    assert (lex.lookup([b"runn", b"", b"zz", b"runnings", b"ab"]) == -1).all()
    # states of equal right languages are one: compare with the classes of all prefixes
    prefixes = {w.encode()[:i] for w in words for i in range(len(w.encode()) + 1)}
    classes = {frozenset(w.encode()[len(p):] for w in words if w.encode().startswith(p)) for p in prefixes}
    assert len(lex.final) == len(classes)
