import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from botiquin.llm import encoding, packing, queries, token_store
from botiquin.llm.packing import Example, Limits, pack
from botiquin.session import work_dir
from tests.llm import frames

PATH = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 1], dtype="<u4")


def rows_of(folder):
    import duckdb

    return duckdb.connect().execute(
        f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id"
    ).fetchall()


def test_piecewise_encoding_equals_whole_texts(tokenizer):
    texts = [
        "don't you'll 'sx it's X'S", "İstanbul Σας ΟΔΟΣ", "á éx  \t\x1c\x85y z", "ﬁ½²³ KK ÅÅ", "x'",
        "日本語 テスト", "<|endoftext|> hi<|startoftext|>", "ª º µ÷×", "😀😀 🏳️‍🌈 a😀b", "", " \n",
        "a.b,c!!d 12 3,4", *[text for _, text in rows_of(FOLDER)[:200]],
    ]
    coder = encoding.WordwiseEncoder(PATH)
    for text, data in zip(texts, coder.encode(texts)):
        assert np.frombuffer(data, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_any_text(text):
    got = np.frombuffer(encoding.encoder(PATH).encode([text])[0], "<u4").tolist()
    assert got == encoding.encoder(PATH).tokenizer.encode(text, add_special_tokens=False).ids


def test_long_text_in_parts(tokenizer, monkeypatch):
    monkeypatch.setattr(encoding, "PART", 1000)
    monkeypatch.setattr(encoding, "KEPT_WORDS", 500)
    coder = encoding.WordwiseEncoder(PATH)
    for text in (frames.LONG[:20_000], "x" * 5000, "x" * 1500 + " y " + "z" * 1500):
        got = np.frombuffer(coder.encode([text])[0], "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_store_query_against_brute_force(spark, tokenizer):
    start, want = 0, []
    for doc_id, text in rows_of(FOLDER):
        ids = ids_of(tokenizer, text)
        want.append((doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    got = queries.token_binary(spark, FOLDER).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("kind", ["delta", "dictionary"])
def test_store_files(spark, kind):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    path = work_dir(spark, "store-test")
    token_store.write_tokens(
        docs, path, PATH, encoding=kind, row_group_bytes=64 * 1024, page_rows=50
    )
    files = glob.glob(f"{path.removeprefix('file:')}/tokens/*.parquet")
    groups, last = 0, -1
    for name in sorted(files):
        meta = pq.ParquetFile(name).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c)
                       for c in range(meta.num_columns)}
            ids = next(c for p, c in columns.items() if p.startswith("ids"))
            wanted = "DELTA_BINARY_PACKED" if kind == "delta" else "RLE_DICTIONARY"
            assert wanted in ids.encodings or "PLAIN_DICTIONARY" in ids.encodings
            assert ids.has_offset_index and columns["doc_id"].has_column_index
            # Ranges of ids follow each other, so a read of some documents skips the other groups.
            assert columns["doc_id"].statistics.min > last
            last = columns["doc_id"].statistics.max
    assert groups > 1
    part = token_store.read_tokens(spark, path, 100, 120)
    assert sorted(r.doc_id for r in part.collect()) == list(range(100, 121))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,100)" in plan
    bare = token_store.read_metadata(spark, path)
    assert "ids" not in bare._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert bare.agg(F.sum("n_tokens")).first()[0] == token_store.read_tokens(spark, path).agg(
        F.sum(F.size("ids"))).first()[0]


def test_store_edges(spark, tokenizer):
    for frame in (frames.docs(spark), frames.clashing(spark)):
        path = work_dir(spark, "store-test")
        token_store.write_tokens(frame, path, PATH)
        got = token_store.read_tokens(spark, path).orderBy("start").collect()
        assert [r.doc_id for r in got] == sorted(
            (r[0] for r in frames.ROWS), key=lambda x: (x is not None, x))
        assert sorted(r.ids for r in got) == sorted(ids_of(tokenizer, r[1]).tolist() for r in frames.ROWS)
        assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))
    path = work_dir(spark, "store-test")
    token_store.write_tokens(frames.docs(spark, []), path, PATH)
    assert token_store.checksums(token_store.read_tokens(spark, path)).count() == 0


def check_pieces(pieces, ids, limits=Limits()):
    covered, sequences = {}, {}
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert zlib.crc32(part) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id])
        covered.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for key, parts in covered.items():
        place = 0
        for start, length in sorted(parts):
            assert start == place and length > 0
            place += length
        assert place == len(ids[key])
    assert set(covered) == set(ids)
    held = padded = 0
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= limits.tokens and len(parts) <= limits.segments
        held += place
        padded += place if place & (place - 1) == 0 else limits.tokens
    return held / padded


def test_packing_query(spark, tokenizer):
    ids = {i: ids_of(tokenizer, text) for i, text in rows_of(FOLDER)}
    assert check_pieces(queries.vector_packing(spark, FOLDER).collect(), ids) > 0.999


def test_packing_edges(spark, tokenizer):
    rows = [(i, text) for i, (_, text, *_) in enumerate(frames.ROWS)]
    frame = frames.clashing(spark, [(i, text, "x", "x", 1) for i, text in rows])
    got = packing.pack_texts(frame, PATH, Limits(tokens=256, segments=4, loss=200))
    check_pieces(got.collect(), {i: ids_of(tokenizer, text) for i, text in rows}, Limits(256, 4, 200))
    assert packing.pack_texts(frames.docs(spark), PATH).where("doc_id is null").count() >= 2
    assert packing.pack_texts(frames.docs(spark, []), PATH).count() == 0


@given(
    st.lists(st.tuples(st.integers(1, 90), st.integers(0, 90)), max_size=60),
    st.integers(1, 64), st.integers(1, 8), st.integers(1, 64),
)
@settings(max_examples=120, deadline=None)
def test_limits_hold_together(sizes, tokens, segments, loss):
    """Every token once, no limit exceeded, for masks whose last tokens bear loss."""
    limits, examples, want = Limits(tokens, segments, loss), [], {}
    for key, (n, bears) in enumerate(sizes):
        mask = np.zeros(n, dtype=np.int64)
        mask[max(0, n - bears):] = 1
        want[key] = mask
        examples.append(Example(key, np.arange(n, dtype="<u4"), np.concatenate([[0], np.cumsum(mask)])))
    seen = {key: np.zeros(len(mask), dtype=int) for key, mask in want.items()}
    for sequence in pack(iter(examples), limits):
        total = sum(length for _, _, length in sequence)
        borne = sum(int(want[e.key][s : s + n].sum()) for e, s, n in sequence)
        assert 0 < total <= tokens and len(sequence) <= segments and borne <= loss
        for e, s, n in sequence:
            seen[e.key][s : s + n] += 1
    assert all((count == 1).all() for count in seen.values())


def test_buffers_carry_the_last_sequence_on(monkeypatch):
    monkeypatch.setattr(packing, "BUFFER_TOKENS", 500)
    examples = [Example(k, np.arange(37, dtype="<u4"), None) for k in range(300)]
    lengths = [sum(n for _, _, n in s) for s in pack(iter(examples), Limits(100, 50, 100))]
    assert sum(lengths) == 300 * 37
    assert sum(1 for n in lengths if n < 100) <= 7


def test_instruction_data(spark):
    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    got = packing.pack_conversations(turns, PATH, Limits(512, 8, 300))
    per_sequence = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("s"))
    assert per_sequence.where("n > 512 or s > 8").count() == 0
    assert got.select("conv_id").distinct().count() == turns.select("conv_id").distinct().count()
