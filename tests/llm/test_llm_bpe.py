"""Byte-level BPE against tiktoken."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from reviewlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def coder():
    return bpe.Codec(bpe.read_ranks(PATH), PATTERN)


@pytest.fixture(scope="module")
def peer(coder):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


HARD = [
    "", " ", "  a", "a  b", "a \n b", "\n\n x y 　z", "don't we'll 'S", "x\x1c \x1dy", "a" * 255, "a" * 256,
    "ab" * 700 + " é" * 10, "日本語 テスト🙂🙂", "<|endoftext|> hi ", "\t\ta b\t c", " lead", "trail ", "a  b  c",
    "1234567 89 ²½", "\x00\x00", "\xa0 \xa0x", "é" * 200, "qz" * 128, "\r\n" * 300,
]


def test_hard_texts(coder, peer):
    rnd = random.Random(1)
    texts = HARD + ["".join(rnd.choice("ab é\n\t 1!'s \x1c🙂 ") for _ in range(rnd.randint(0, 40))) for _ in range(500)]
    ids = list(bpe.encode_all(coder, texts))
    assert [x.tolist() for x in ids] == [peer.encode_ordinary(t) for t in texts]
    assert [x.decode() for x in bpe.decode_all(coder, ids)] == texts


def test_words_by_query_and_by_heap_agree(coder, peer):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 120))).encode() for _ in range(300)]
    words = [w for w in words if w not in coder.ranks]
    assert coder.encode_words(words) == [coder.contract(w) for w in words]
    assert [np.frombuffer(x, np.int32).tolist() for x in map(coder.contract, words)] == [
        peer.encode_ordinary(w.decode()) for w in words
    ]


def test_many_long_words_in_bounded_memory(coder, peer):
    rnd = random.Random(4)
    for n, length in ((20_000, 200), (3_000, 60), (400, 64)):
        text = " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=length)) for _ in range(n))
        assert coder.encode([text])[0].tolist() == peer.encode_ordinary(text)


def test_pieces_join_to_the_text_and_its_ids(coder, peer):
    text = " ".join(HARD) * 2
    pieces = list(bpe.pieces_of(text, 40))
    assert len(pieces) > 5 and "".join(pieces) == text
    assert [i for p in pieces for i in coder.encode([p])[0]] == peer.encode_ordinary(text)


def test_cache_is_emptied_when_full(coder, peer, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    for i in range(20):
        text = " ".join(f"wörd{i}x{j}" for j in range(30))
        assert coder.encode([text])[0].tolist() == peer.encode_ordinary(text)
        assert len(coder.chunks.new) <= 50 or len(coder.chunks.old) <= 50


def test_chunks_are_cut_in_one_go(coder, peer, monkeypatch):
    """Not one call for each chunk; ends and beginnings of texts, and odd spaces, stay what they are."""
    calls = []

    class Words:
        def findall(self, text, words=coder.words):
            calls.append(text)
            return words.findall(text)

    texts = [f"a{i} {' '.join(f'w{i}x{j}' for j in range(10))} b{i}c\n\nd \te {i}{end}" for i in range(300) for end in ("", "\n\n", " ", "\x1c")] + HARD
    monkeypatch.setattr(coder, "words", Words())
    ids = coder.encode(texts)
    assert [x.tolist() for x in ids] == [peer.encode_ordinary(t) for t in texts]
    assert [x.decode() for x in coder.decode(ids)] == texts
    assert len(calls) < 2.5 * len(texts)


def test_frames(spark, peer):
    rows = [(1, "a b", 1), (2, None, 2), (None, "", 3), (3, "repeated é", 4), (3, "repeated é", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS int")
    both = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN).collect()
    assert [(r.doc_id, r.ids, bytes(r.decoded).decode()) for r in both] == [
        (i, peer.encode_ordinary(t or ""), t or "") for i, t, _ in rows
    ]
    found = bpe.digests(df, PATH, PATTERN, ids_too=True).collect()
    for r, (i, t, _) in zip(found, rows):
        ids = peer.encode_ordinary(t or "")
        assert (r.doc_id, r.n_tokens, r.ids) == (i, len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.digests(df.where("false"), PATH, PATTERN).count() == 0


def test_unknown_ids_raise(coder):
    for bad in ([coder.max_id + 1], [-1]):
        with pytest.raises(ValueError):
            list(bpe.decode_all(coder, [np.array(bad, np.int32)]))


def test_null_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, [64])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(df, PATH, PATTERN).collect()] == [b"", b"a"]


def test_texts_are_taken_in_small_slices(coder, monkeypatch):
    taken, encode = [], coder.encode
    monkeypatch.setattr(coder, "encode", lambda texts: taken.append(sum(map(len, texts))) or encode(texts))
    texts = ["ab cd " * 10_000] * 40
    assert len(list(bpe.encode_all(coder, texts))) == 40
    assert max(taken) <= 700_000 and sum(taken) == 2_400_000


def test_known_chunks_are_not_cut_again(peer, monkeypatch):
    coder = bpe.Codec(bpe.read_ranks(PATH), PATTERN)
    texts = [" ".join(f"w{j}x{i % 7}," for j in range(i, i + 30)) for i in range(60)]
    first = [x.tolist() for x in coder.encode(texts)]
    assert first == [peer.encode_ordinary(t) for t in texts]
    cut, asked = [], []

    class Words:
        def findall(self, text, words=coder.words):
            cut.append(text)
            return words.findall(text)

    monkeypatch.setattr(coder, "words", Words())
    monkeypatch.setattr(coder, "encode_words", lambda words, of=coder.encode_words: asked.extend(words) or of(words))
    assert [x.tolist() for x in coder.encode(texts[::-1])] == first[::-1]
    assert not any(cut) and not asked
    # Of new chunks, the known words are not asked for.
    assert coder.encode(["w1x1, w5x1! w5x1,"])[0].tolist() == peer.encode_ordinary("w1x1, w5x1! w5x1,")
    assert cut == [" w5x1!"] and asked == [b"!"]


def test_what_is_kept_is_bounded(peer, monkeypatch):
    """Old chunks get new again, long ones are not kept, and ids of all agree with those of a new codec."""
    monkeypatch.setattr(bpe, "CACHE", 60)
    coder = bpe.Codec(bpe.read_ranks(PATH), PATTERN)
    rnd = random.Random(5)
    words = [f"wörd{i}," for i in range(150)] + ["z" * 127, "y" * 128, "é" * 65, "\u3042" * 300, "=" * 5_000] + HARD
    for _ in range(80):
        texts = [" ".join(rnd.choices(words[:150], k=8)), " ".join(rnd.choices(words, k=6)), rnd.choice(words)] * 2
        assert [x.tolist() for x in coder.encode(texts)] == [peer.encode_ordinary(t) for t in texts]
        for name, runs in (("new_texts", coder.chunks.new), ("old_texts", coder.chunks.old)):
            kept, distinct, longest = coder.db.execute(
                f"select count(*), count(distinct text), coalesce(max(strlen(text)), 0) from {name}"
            ).fetchall()[0]
            assert kept == distinct <= len(runs) and longest <= bpe.KEY
        assert len(coder.chunks.new) <= 60 and coder.chunks.new.flat.size <= 16 * 60
    long = "".join(rnd.choices("abcdefgh", k=20_000))
    assert coder.encode([long])[0].tolist() == peer.encode_ordinary(long)
    assert not len(coder.chunks.new) and not len(coder.chunks.old)
