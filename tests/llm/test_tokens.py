import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harvestry.llm import packing, token_files
from harvestry.llm.elias_fano import EliasFano
from harvestry.llm.tokens import encoder
from harvestry.scratch import new_folder


def library(vocabulary, text):
    return encoder(vocabulary).tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from(list("aAeEZß Σςσ İıÅ\u01fb\u030a.,!'#$|<>\n\t\x0b\xa0\x1c\x85st12²½中한가ǅ—_\u0958\u0959\u095d\u092a\u093c\ufb2a\u212b\u2126\u0344\u0530\u1e9e")), max_size=60))
def test_encoding_equals_the_library(vocabulary_path, text):
    assert encoder(vocabulary_path).wide(text.encode()).tolist() == library(vocabulary_path, text)


@settings(max_examples=400, deadline=None)
@given(text=st.text(max_size=40))
def test_encoding_equals_the_library_on_all_of_unicode(vocabulary_path, text):
    assert encoder(vocabulary_path).wide(text.encode()).tolist() == library(vocabulary_path, text)


def test_letters_that_compose_or_fall_apart(vocabulary):
    for text in ("\u0959#", "\u0958!", "\u092a\u095d.", "a\u095d?", "\ufb2a,", "e\u0301.", "\u212bx", "ΑΣ. ΑΣ"):
        assert encoder(vocabulary).wide(text.encode()).tolist() == library(vocabulary, text)
    for c in map(chr, range(0x21, 0x600)):
        for text in (c, "a" + c, c + "a", "é" + c + ".", "Ab" + c + "Z!?", f"1{c}_{c}{c}'s {c}'T"):
            assert encoder(vocabulary).wide(text.encode()).tolist() == library(vocabulary, text), text


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers

    other = encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word
    for text in ("two  words\n\nand more", "", "don't"):
        assert other.wide(text.encode(), 7).tolist() == [*other.tokenizer.encode(text, add_special_tokens=False).ids, 7]


def test_the_table_of_words_is_bounded(vocabulary, monkeypatch):
    from harvestry.llm import tokens

    monkeypatch.setattr(tokens, "MAX_PIECES", 50)
    mine = tokens.PieceEncoder(vocabulary)
    text = " ".join("w" + "abcdefghij"[i % 10] * (i % 17) + "." for i in range(900))
    assert mine.wide(text.encode()).tolist() == library(vocabulary, text)
    assert len(mine) <= 50


@pytest.fixture(scope="session")
def vocabulary_path(vocabulary):
    return vocabulary


def test_special_strings(vocabulary):
    for text in ("<|endoftext|>", "a <|startoftext|>b<|endoftext|>. c", "don't 'tis they're", "İ. Σ, ΟΔΟΣ."):
        assert encoder(vocabulary).wide(text.encode()).tolist() == library(vocabulary, text)


@settings(max_examples=200, deadline=None)
@given(steps=st.lists(st.integers(0, 5000), max_size=700))
def test_elias_fano(steps):
    values = np.cumsum([0, *steps])
    coded = EliasFano.build(values)
    assert coded.run(0, len(values)).tolist() == values.tolist()
    again = EliasFano.of(coded.n, coded.low_bits, coded.parts())
    for i in range(0, len(values), 37):
        assert again.get(i) == values[i]
        assert again.run(i, min(i + 300, len(values))).tolist() == values[i : i + 300].tolist()
    bits = 8 * (coded.low.nbytes + coded.high.nbytes)
    assert bits <= len(values) * (3 + np.log2(values[-1] / len(values) + 1)) + 64


def test_elias_fano_refuses():
    for bad in ([3, 2], [-1, 2]):
        with pytest.raises(ValueError):
            EliasFano.build(np.array(bad))
    assert EliasFano.build(np.array([], int)).run(0, 0).tolist() == []
    with pytest.raises(IndexError):
        EliasFano.build(np.array([1])).get(1)


def test_corpus_round_trip(spark, table, odd, vocabulary):
    manifest = token_files.write_corpus(table(odd), vocabulary, new_folder(spark, "t"))
    got = token_files.read_corpus(spark, manifest).orderBy("start").collect()
    want = sorted((zlib.crc32(np.array([*library(vocabulary, t), 1], "<u4").tobytes()), i or -1) for i, t in odd)
    assert sorted((zlib.crc32(bytes(r.ids)), r.doc_id or -1) for r in got) == want
    ids = [r.doc_id for r in got]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    assert [r.start for r in got] == np.cumsum([0, *(len(r.ids) // 4 for r in got[:-1])]).tolist()
    shard = token_files.Shard(manifest[-1][1])
    last = shard.about["docs"] - 1
    assert shard.document(last).astype("<u4").tobytes() == bytes(got[-1].ids)
    assert shard.ids.itemsize == 2
    assert token_files.write_corpus(table([]), vocabulary, new_folder(spark, "t")) == []
    assert token_files.read_corpus(spark, []).count() == 0


def test_files_are_sized_by_the_data(spark, table, vocabulary):
    docs = table([(i, f"text {i} " * (i % 9)) for i in range(200)])
    assert token_files.file_count(docs) == 1
    assert token_files.file_count(docs, file_docs=30) == 7
    size = sum(len(f"text {i} " * (i % 9)) for i in range(200))
    assert token_files.file_count(docs, file_bytes=size // 5) in (5, 6)
    assert token_files.file_count(docs, unit_bytes=1) == int(size**0.5)


def test_reading_unpacks_a_block_of_boundaries_at_a_time(tmp_path, monkeypatch):
    lengths = [random.Random(3).randrange(6) for _ in range(20_000)] + [5000, 0, 0]
    docs = [(i if i % 7 else None, np.arange(n, dtype="<u4")) for i, n in enumerate(lengths)]
    uri = str(tmp_path / "shard")
    token_files.write_shard(uri, iter(docs), 2)
    shard, seen, run = token_files.Shard(uri), [], EliasFano.run
    monkeypatch.setattr(EliasFano, "run", lambda self, i, j: seen.append(j - i) or run(self, i, j))
    monkeypatch.setattr(token_files, "SLICE", 3000)
    blocks = list(shard.blocks())
    assert max(seen) <= token_files.BLOCK + 1
    assert all(b[-1] - b[0] <= 3000 or len(b) == 2 for _, b in blocks)
    assert [int(x) for _, b in blocks for x in np.diff(b)] == lengths
    assert [bool(x) for i, b in blocks for x in shard.null(i, i + len(b) - 1)] == [d[0] is None for d in docs]


def test_pieces(table, odd, vocabulary):
    rows = packing.tokenised_pieces(table(odd), vocabulary, capacity=100, with_ids=True).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in odd:
        whole = np.array([*library(vocabulary, t), 1], "<u4").tobytes()
        if i not in (None, 6):
            mine = sorted(by[i], key=lambda r: r.piece)
            assert b"".join(bytes(r.ids) for r in mine) == whole
            assert [r.start for r in mine] == list(range(0, len(whole) // 4, 100))
            assert all(r.length == 100 for r in mine[:-1]) and all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in mine)


def check_packed(pieces, got, capacity):
    assert sorted((r[0], r[1], r[3]) for r in pieces) == sorted((r.doc_id, r.piece, r.length) for r in got)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        assert [p for p, _ in places] == np.cumsum([0, *(n for _, n in places[:-1])]).tolist()
        assert sum(n for _, n in places) <= capacity
    return len(bins)


def test_packing_in_rounds(spark):
    r = random.Random(2)
    pieces = [(i, 0, 0, min(100, int(r.expovariate(1 / 30)) + 1), 7) for i in range(3000)]
    df = spark.createDataFrame(pieces, packing.PIECES).repartition(6)
    got = packing.pack(df, capacity=100, most_items=150).collect()
    n = check_packed(pieces, got, 100)
    whole = len(packing.best_fit([p[3] for p in pieces], 100))
    least = -(-sum(p[3] for p in pieces) // 100)
    assert least <= n <= whole * 1.03


def test_packing_stays_bounded_where_nothing_fits(spark, monkeypatch):
    # every piece is just over half of the capacity, so no two ever share a bin
    pieces = [(i, 0, 0, 51 + i % 3, 7) for i in range(2000)]
    df = spark.createDataFrame(pieces, packing.PIECES).repartition(3)
    fit = packing.best_fit
    got = packing.pack(df, capacity=100, most_items=100).collect()
    assert check_packed(pieces, got, 100) == 2000
    # in one process: never more than the bound at a time, whatever the partition holds
    seen = []
    monkeypatch.setattr(packing, "best_fit", lambda lengths, c: seen.append(len(lengths)) or fit(lengths, c))
    monkeypatch.setattr("pyspark.TaskContext.get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})()))
    import pyarrow as pa

    columns = [pa.array(c, k) for c, k in zip(zip(*pieces, strict=True), packing._KINDS, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, packing._NAMES)
    bins = list(packing._round(0, 100, 99.5, 100, 10**6)(packing._items([batch])))
    assert sum(b.num_rows for b in bins) == 2000 and max(seen) <= 100


def test_packing_documents_equals_packing_their_pieces(table, odd, vocabulary):
    keys = lambda rows: sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    docs = table(odd)
    whole = packing.pack_documents(docs, vocabulary, capacity=500).collect()
    assert keys(whole) == keys(packing.pack(packing.tokenised_pieces(docs, vocabulary, capacity=500), capacity=500).collect())


def test_packing_edges(spark):
    for pieces in ([], [(1, 0, 0, 5, 0)], [(None, 0, 0, 10, 0)] * 7, [(1, 0, 0, 6, 0)] * 3):
        df = spark.createDataFrame(pieces, packing.PIECES)
        assert len({r.sequence_id for r in packing.pack(df, capacity=10).collect()}) == len(pieces)


@settings(max_examples=200, deadline=None)
@given(sizes=st.lists(st.integers(1, 50), max_size=80))
def test_best_fit(sizes):
    bins = packing.best_fit(sizes, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 50 for b in bins)
    assert sum(sum(sizes[i] for i in b) <= 25 for b in bins) <= 1  # two half-empty ones would have been one
