import glob
import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from holdfast.llm import bpe, packing, token_files, words

PARTS = [*" \n\tab'sé1２.,<>|漢😀\r\x1c\x85\xa0​՘", "<|endoftext|>", "  ", "'ll"]
ODD = st.lists(st.sampled_from(PARTS), max_size=40).map("".join)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def split(found, ends):
    return [found[a:b].tolist() for a, b in zip([0, *ends], ends)]


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, max_size=8))
def test_encoders_equal_the_library(tokenizer, library, texts):
    expected = [ids_of(library, t) for t in texts]
    for table in (words.encoder(tokenizer), bpe.byte_pairs(tokenizer)):
        assert split(*table.encode(pa.array(texts, pa.string()))) == expected
    pairs = bpe.byte_pairs(tokenizer)
    found, ends = pairs.encode(pa.array(texts, pa.string()))
    assert pairs.decode(found.astype(np.int64), ends) == texts


def test_words_are_forgotten_without_harm(tokenizer, library, monkeypatch):
    monkeypatch.setattr(words, "REMEMBERED", 5)
    table = words.WordEncoder(tokenizer)
    for text in ("a few words here", "a few others, here", "words of a third kind", "a few words here", "more than five new words in a text"):
        assert split(*table.encode(pa.array([text]))) == [ids_of(library, text)]


def test_memory_holds_many_words(tokenizer, library):
    table = words.WordEncoder(tokenizer)
    for part in range(4):
        texts = [" ".join(f"w{i * 7 + j + part}x" for j in range(50)) for i in range(1500)]
        assert split(*table.encode(pa.array(texts))) == [ids_of(library, text) for text in texts]
    assert table.memory.count > 10_000 and len(table.memory.slots) > 1 << 14


def test_long_words_merge_in_the_same_order(tokenizer, library):
    pairs = bpe.byte_pairs(tokenizer)
    for text in ("ab" * 700 + "the" * 300, "x" * 3000, "thequickbrown" * 100):
        assert pairs.merge(text.encode()) == ids_of(library, text)


def test_decode_replaces_what_is_no_text(tokenizer, library):
    pairs = bpe.byte_pairs(tokenizer)
    ids = pairs.merge("é".encode()[:1]) + pairs.merge(b"a")
    assert pairs.decode(np.array(ids), np.array([2])) == ["�a"]
    assert pairs.decode(np.array([10**6, 64]), np.array([2])) == [library.decode([64])]


def test_token_ids_are_dictionary_encoded(spark, plain_docs, tokenizer, tmp_path):
    docs = spark.createDataFrame(list(plain_docs.items()), "doc_id long, text string").coalesce(1)
    token_files.encode_documents(docs, tokenizer, 2).write.options(**token_files.LAYOUT).parquet(str(tmp_path / "t"))
    (path,) = glob.glob(str(tmp_path / "t" / "*.parquet"))
    column = pq.ParquetFile(path).metadata.row_group(0).column(2)
    assert column.path_in_schema == "tokens.list.element" and "RLE_DICTIONARY" in column.encodings


def test_op1_against_brute_force(query, plain_docs, library):
    start, expected = 0, []
    for doc_id in sorted(plain_docs):
        ids = ids_of(library, plain_docs[doc_id]) + [2]
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(tuple(r) for r in query("op1_token_files")) == expected


def test_token_files_layout(spark, odd_docs, no_docs, tokenizer, library, tmp_path):
    token_files.write_token_files(odd_docs, str(tmp_path / "t"), tokenizer, 2)
    found = token_files.token_index(spark, str(tmp_path / "t")).collect()
    expected = Counter((r.doc_id, crc(ids_of(library, r.text) + [2])) for r in odd_docs.collect())
    assert Counter((r.doc_id, r.ids_crc32) for r in found) == expected
    places = sorted((r.start, r.n_tokens) for r in found)
    assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
    last = None
    for path in sorted(glob.glob(str(tmp_path / "t" / "*.parquet"))):
        file = pq.ParquetFile(path)
        for doc_id in file.read(["doc_id"]).column(0).to_pylist():
            assert last is None or doc_id >= last
            last = doc_id
        for g in range(file.metadata.num_row_groups):
            columns = {file.metadata.row_group(g).column(i).path_in_schema: file.metadata.row_group(g).column(i) for i in range(3)}
            assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
            # A dictionary is given up where it would not make a small page smaller.
            assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(columns["tokens.list.element"].encodings)
            assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    plan = token_files.read_token_files(spark, str(tmp_path / "t")).select("doc_id", "n_tokens")
    assert "struct<doc_id:bigint,n_tokens:bigint>" in plan._jdf.queryExecution().executedPlan().toString()
    token_files.write_token_files(no_docs, str(tmp_path / "none"), tokenizer, 2)
    assert token_files.token_index(spark, str(tmp_path / "none")).collect() == []


def test_op2_against_brute_force(query, plain_docs, library):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    for row in query("op2_bpe"):
        ids = ids_of(library, plain_docs[row.doc_id])
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (
            len(ids), digest(",".join(map(str, ids))), digest(decoded),
        )
    assert len(query("op2_bpe")) == len(plain_docs)


def test_bpe_keeps_other_columns(odd_docs, no_docs, tokenizer, library):
    encoded = bpe.encode(odd_docs, tokenizer)
    assert sorted(encoded.columns) == sorted(odd_docs.columns)  # `ids` gives way
    rows = bpe.decode(encoded, tokenizer).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert row.ids == ids_of(library, row.text) and row.decoded == (row.text or "") and row.hash == "h"
    assert sorted(map(str, bpe.round_trip(odd_docs, tokenizer).collect())) == sorted(map(str, rows))
    assert bpe.decode(bpe.encode(no_docs, tokenizer), tokenizer).collect() == []


def test_hilbert_neighbours_touch():
    for dimensions, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
        keys = packing.hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check_pieces(rows, texts, library, length=2048):
    """`texts`: list of (doc_id, text)."""
    by_sequence, total = {}, 0
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for sequence, pieces in by_sequence.items():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at and size > 0
            at += size
        assert at == length or (at < length and at & (at - 1) == 0)
        total += at
    expected = Counter()
    for doc_id, text in texts:
        expected[doc_id] += len(ids_of(library, text)) + 1
    assert total == sum(expected.values())
    found = Counter()
    for row in rows:
        found[row.doc_id] += row.length
    assert found == expected


def test_op10_against_brute_force(query, plain_docs, library):
    rows = query("op10_packing")
    check_pieces(rows, list(plain_docs.items()), library)
    for row in rows:
        ids = ids_of(library, plain_docs[row.doc_id]) + [1]
        assert row.doc_tokens == len(ids)
        assert row.ids_crc32 == crc(ids[row.start : row.start + row.length])


def test_packing_of_odd_documents(odd_docs, no_docs, tokenizer, library):
    rows = packing.pack(odd_docs, tokenizer, 1, 64).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], library, 64)
    assert packing.pack(no_docs, tokenizer, 1).collect() == []


def test_packing_puts_like_documents_together(spark, tokenizer):
    topics = ["red green blue colour paint", "seven eight nine count sum", "river lake sea water rain"]
    rows = [(i, " ".join(topics[i % 3].split()[(i + j) % 5] for j in range(30))) for i in range(90)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer, 1, 512).collect()
    order = [r.doc_id % 3 for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)) if r.start == 0]
    assert sum(a != b for a, b in zip(order, order[1:])) < 12


def test_documents_without_ids_fill_several_files(spark, tokenizer, tmp_path):
    docs = spark.range(8000).select(F.when(F.col("id") < 10, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    source, path = str(tmp_path / "docs"), str(tmp_path / "tokens")
    docs.write.parquet(source)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    token_files.write_token_files(spark.read.parquet(source), path, tokenizer, end_id=2)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = token_files.read_token_files(spark, path).groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 6 and max(row["count"] for row in files) < 3000
    rows = token_files.token_index(spark, path).orderBy("start").collect()
    assert len(rows) == 8000 and sum(row.n_tokens for row in rows[:-1]) == rows[-1].start
    assert [row.doc_id for row in rows[-10:]] == list(range(10))
