"""BPE transducer, token records and their index against the tokenizers library, with odd texts."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from curdle.llm import bpe, records

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "  \n\t x", "it's we'll 'll 's don't'", "a" * 9000, " " * 9000, " " * 5000 + "x" + "\n" * 5000, "!" * 7000 + "'s", "9" * 6000 + "abc",
    "éà" * 4000, "漢字かな" * 2000, "👩‍👩‍👧" * 50, "x<|endoftext|>y", "<|endoftext|>" * 3, "<|endoftext", "a\x1c\x1d\x85\xa0 　b", "\x00\x01",
    " the" * 20000, "ab " * 30000 + "<|endoftext|>" + "tail", "e" * 70000, "́" * 5000, "²³½Ⅷ٣",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Transducer(bpe.read_spec(PATH))


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_encode_and_decode_as_the_library(own, library, i):
    ids = library.encode(TEXTS[i], add_special_tokens=False).ids
    assert own.encode(TEXTS[i]) == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_assigned_character(own, library):
    for lo in range(0, 0x30000, 0x800):
        text = "".join(f"{chr(c)}a {chr(c)}1" for c in range(lo, lo + 0x800) if not 0xD800 <= c < 0xE000)
        if text:
            assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(lo)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab c'stre\n\t.!1é漢 ", max_size=200), st.integers(1, 9))
def test_pieces_make_no_difference(text, size):
    own, library = _pair()
    ids = library.encode(text, add_special_tokens=False).ids
    pieces = [text[i : i + size] for i in range(0, len(text), size)]
    assert [i for block in own.encode_stream(pieces) for i in block] == ids
    assert "".join(own.decode_stream([[i] for i in ids])) == library.decode(ids, skip_special_tokens=False)


_kept = []


def _pair():
    if not _kept:
        _kept.append((bpe.Transducer(bpe.read_spec(PATH)), Tokenizer.from_file(PATH)))
    return _kept[0]


@pytest.mark.parametrize("text", ["a" * 3000, " " * 3000 + "b", "the cat " * 500, "!?" * 2000 + "'ll", "éa" * 900])
def test_memory_is_bounded_by_small_windows(own, library, monkeypatch, text):
    """With tiny buffers every long run goes through the open state."""
    monkeypatch.setattr(bpe, "OPEN_AT", 8)
    monkeypatch.setattr(bpe, "WINDOW", 16)
    got = [i for block in own.encode_stream(text[i : i + 5] for i in range(0, len(text), 5)) for i in block]
    assert got == library.encode(text, add_special_tokens=False).ids


def test_lookahead_is_finite_and_sufficient(own):
    assert 0 < own.lookahead < bpe.WINDOW
    rng = np.random.default_rng(3)
    for _ in range(200):  # a token with the lookahead behind it does not depend on what follows
        s = bytes(rng.choice(list(b"aeinrsth"), own.lookahead + 40))
        full = own.merge([own.byte_ids[b] for b in s + bytes(rng.choice(list(b"aeinrsth"), 60))])
        short = own.merge([own.byte_ids[b] for b in s])
        used = 0
        for a, b in zip(full, short):
            used += len(own.bytes_of[b])
            if used + own.lookahead > len(s):
                break
            assert a == b


def test_malformed_bytes_decode_like_the_library(own, library):
    rng = np.random.default_rng(4)
    for _ in range(100):
        ids = rng.integers(0, 50257, 30).tolist()
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (None, "no id"), (200, "again"), (200, "again")]


def _docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, n_tokens string")


def test_encode_table(spark, library):
    got = sorted(map(tuple, bpe.encode_table(_docs(spark), bpe.read_spec(PATH)).collect()), key=str)
    want = []
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=str)
    assert bpe.encode_table(_docs(spark, []), bpe.read_spec(PATH)).collect() == []


def test_records_round_trip(spark, scratch, library):
    records.write_records(_docs(spark), bpe.read_spec(PATH), f"{scratch}/shards")
    index = records.build_index(spark, f"{scratch}/shards", f"{scratch}/index")
    got = sorted(records.with_starts(index).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i))
    start, by_id = 0, {}
    for i, t in ROWS:
        by_id.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    for r in got:
        ids = by_id[r.doc_id][0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += r.n_tokens
    shuffled = records.read_shuffled(spark, f"{scratch}/shards", index, seed=1).collect()
    assert sorted((str(r.doc_id), r.ids) for r in shuffled) == sorted((str(i), x) for i, many in by_id.items() for x in many)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab ' s\n\t.1é\x85\u3000漢\x1c", max_size=60), max_size=4))
def test_units_make_no_difference(texts):
    if not _encoder:
        _encoder.append(records.Encoder(bpe.read_spec(PATH)))
    _, library = _pair()
    texts = [*texts, *("<|endoftext|>".join(texts[:2]) for _ in range(1))]
    assert [np.frombuffer(b, "<u2").tolist() for b in _encoder[0].encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


_encoder = []


def test_a_unit_of_a_shard_is_looked_up_once():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

        def __contains__(self, key):
            Counted.asked += 1
            return super().__contains__(key)

    encoder = records.Encoder(bpe.read_spec(PATH))
    encoder.table = Counted()
    encoder.encode(["one two three", "two three\nfour", "three two"])
    assert Counted.asked == len({"one", " two", " three", "two", "\n", "four", "three"})
    assert records.GROUP_CHARS >= records.SHARD_BYTES


def test_white_space_is_that_of_python():
    import pyarrow as pa
    import pyarrow.compute as pc

    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    found = pc.match_substring_regex(pa.array(characters), records._SPACE).to_pylist()
    assert [c for c, f in zip(characters, found) if f] == [c for c in characters if c.isspace()]


def test_records_of_an_empty_table(spark, scratch):
    records.write_records(_docs(spark, []), bpe.read_spec(PATH), f"{scratch}/shards")
    assert records.with_starts(records.build_index(spark, f"{scratch}/shards", f"{scratch}/index")).collect() == []


def test_damaged_frames_are_noticed():
    whole = records.frame(7, np.arange(5, dtype="<u2").tobytes(), 2) + b"\n"
    assert [(d, ids.tolist()) for _, _, d, ids in records.frames(whole * 2)] == [(7, [0, 1, 2, 3, 4])] * 2
    for at in range(len(whole)):
        broken = whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1 :]
        with pytest.raises(ValueError):
            list(records.frames(broken))
    with pytest.raises(ValueError):
        list(records.frames(whole[:-1]))
