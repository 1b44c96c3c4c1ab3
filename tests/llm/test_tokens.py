"""Token counts and byte-level BPE, against the tokenizers library."""

import hashlib
import random

import pytest

from recordlens.llm import bpe
from recordlens.llm.queries import tokenizer_file
from recordlens.llm.token_counts import balanced, token_counts
from tests.llm.texts import corpus, frame

tokenizers = pytest.importorskip("tokenizers")
ODD = [
    "don't we'll I'D 'S ", "a b   c\x1c\x1d\x85d", "<|endoftext|>", " <|startoftext|>x<|endoftext|> y",
    "é ́alone ﬁ İstanbul ẞ", "\r\n\r\n  \t x  ", "中文字符 かな 한글 😀👍🏽", "\x00\x01", "½ ² ٣ 12345678",
    "a" * 3000, " " * 700, "!?" * 400,
]


def rows():
    return corpus(40) + [(1000 + i, t) for i, t in enumerate(ODD)]


def test_counts(spark):
    library = tokenizers.Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    df = frame(spark, rows())
    found = token_counts(df, tokenizer_file("word_bpe_49k.json"), limit=60).collect()
    expected = []
    for doc_id, text in rows():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 60))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert token_counts(df.limit(0), tokenizer_file("word_bpe_49k.json")).count() == 0


def test_balanced_batches():
    batches = list(balanced([b"x" * n for n in (5, 3, 9, 1, 1, 1)], 8))
    assert [sum(map(len, b)) for b in batches] == [8, 9, 3]


@pytest.fixture(scope="module")
def vocabulary():
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))


def test_encoding_and_decoding(spark, library):
    df = frame(spark, rows())
    found = bpe.encode_and_decode(df, tokenizer_file("byte_bpe_50k.json")).collect()
    expected = []
    for doc_id, text in rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
        expected.append((doc_id, len(ids), *digest, decoded == (text or "")))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert bpe.encode_and_decode(df.limit(0), tokenizer_file("byte_bpe_50k.json")).count() == 0


def test_random_texts(vocabulary, library):
    rng = random.Random(4)
    parts = [*"abcdeTHsrv   \n\t\x1c\x85 .,!#é中😀0½́﻿", " the", "ing", "'s", "<|endoftext|>"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(50)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text, vocabulary) == ids
        assert bpe.decode(ids, vocabulary) == library.decode(ids, skip_special_tokens=False)


def test_incomplete_characters(vocabulary, library):
    rng = random.Random(6)
    for _ in range(200):
        ids = [rng.randrange(300) for _ in range(rng.randrange(12))]
        assert bpe.decode(ids, vocabulary) == library.decode(ids, skip_special_tokens=False)


def test_long_texts_in_blocks(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 40)
    text = " ".join(random.Random(2).choice(["one", "two,", "  three", "\n\nfour", "fünf"]) for _ in range(900))
    found = bpe.encode_and_decode(frame(spark, [(1, text)]), tokenizer_file("byte_bpe_50k.json")).first()
    ids = library.encode(text, add_special_tokens=False).ids
    assert found.n_tokens == len(ids)
    assert found.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


class Small:
    """A vocabulary over a and b whose merges reach far to the left."""

    def __init__(self, seed):
        rng = random.Random(seed)
        tokens, self.merges = [b"a", b"b"], []
        while len(self.merges) < 14:
            u, v = rng.choice(tokens), rng.choice(tokens)
            if len(u + v) <= 8 and u + v not in tokens:
                self.merges.append((u, v))
                tokens.append(u + v)
        ids = {t: i for i, t in enumerate(tokens)}
        self.byte_ids = [ids.get(bytes([b]), 0) for b in range(256)]
        self.bytes_of = {i: t for t, i in ids.items()}
        self.ranks = {bpe.pair_key(ids[u], ids[v]): r for r, (u, v) in enumerate(self.merges)}
        self.made = [ids[u + v] for u, v in self.merges]


@pytest.mark.parametrize("seed", range(12))
def test_bounded_lookahead_is_enough(seed):
    """Emitting early with the computed lookahead never changes a token."""
    small, rng = Small(seed), random.Random(seed)
    lookahead = bpe.sufficient_lookahead(small.merges)
    for _ in range(40):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(5 * lookahead)))
        blocks = [text[i : i + 3] for i in range(0, len(text), 3)]
        expected = bpe.merge_all(text, small)
        assert list(bpe.transduce(blocks, small, lookahead)) == expected
        assert bpe.merge_long(text, small) == expected


def test_long_piece_is_streamed(vocabulary, library):
    text = "".join(random.Random(1).choice(["a", "th", "in", "ing", "re", "x"]) for _ in range(50_000))
    assert len(text) > 2 * bpe.sufficient_lookahead(vocabulary.merges)
    assert bpe.encode(text, vocabulary) == library.encode(text, add_special_tokens=False).ids


def test_recent_entries_come_in_two_generations(monkeypatch):
    from recordlens.llm import bpe

    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 10 * bpe.ENTRY_BYTES)
    known, made = bpe.Recent(), 0
    frequent = {"the", "of"}
    for i in range(200):
        new = known.missing(frequent | {f"w{i}", f"v{i}", "x" * (bpe.LONG_UNIT + 1)})
        made += len(new & frequent)
        for text in new:
            known.add(text, len(text))
        assert all(known.young[t] == len(t) for t in frequent | {f"w{i}", f"v{i}"})
        assert len(known.young) + len(known.old) < 40 and sum(len(t) > bpe.LONG_UNIT for t in known.young) == 1
    # What is asked for all the time is made once.
    assert made == len(frequent)


def test_pieces_of_known_units_are_not_merged_again(vocabulary, monkeypatch):
    merged = []
    real = bpe.merge_many

    def spy(pieces, *rest):
        merged.extend(pieces)
        return real(pieces, *rest)

    monkeypatch.setattr(bpe, "merge_many", spy)
    encoder = bpe.Encoder(vocabulary)
    encoder.learn([" apple", "<|endoftext|>"])
    encoder.learn([" apple,", " apple"])
    assert merged == [b" apple", b","]
    for unit in (" apple", " apple,"):
        text, count, body = encoder.known.young[unit]
        ids = bpe.encode(unit, vocabulary)
        assert (text, count, body) == ("".join(f",{i}" for i in ids).encode(), len(ids), unit.encode())
    # What a unit is made of is kept once, as the unit's.
    assert set(encoder.known.young) == {" apple", " apple,", "<|endoftext|>"}


def test_nothing_is_remembered_behind_a_task():
    import gc

    known = bpe.Recent()
    with bpe.remembering(known):
        known.add("word", 1)
        known.missing({"word"})
        assert known.young == {"word": 1} and not gc.isenabled()
    assert gc.isenabled()
    assert (known.young, known.old, known.n_bytes, known.long) == ({}, {}, 0, [])


def test_slices_do_not_change_results(spark):
    df = frame(spark, rows())
    file = tokenizer_file("byte_bpe_50k.json")
    whole, single = (bpe.encode_and_decode(df, file, slice_bytes=n).collect() for n in (4 << 20, 1))
    assert sorted(map(tuple, whole), key=repr) == sorted(map(tuple, single), key=repr)
