"""BPE by trie, token counts and token files against the tokenizers library."""

import hashlib
import random
import struct
import unicodedata
import zlib

import pytest

from clusterkit.llm import bpe_trie, pretoken, token_counts, token_files
from clusterkit.llm.queries import vocabulary_path
from tests.llm import cases

PATH = vocabulary_path()
SCRAPS = ["a", "e", " ", "the", "in", "\n", "  ", "é", "#", "$$", "1", "<|endoftext|>", "ing", "ß", "\x1c",
          "½", "語", "'s", "'", "--", "aaaa", "\U00016d40", "_", "\u0301", "\xa0"]


def library_ids(texts):
    return [e.ids for e in pretoken.library(PATH).encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    out = ["".join(r.choice(SCRAPS) for _ in range(r.randrange(50))) for _ in range(1500)]
    out += ["".join(r.choice("abcdeinrst") for _ in range(r.randrange(150))) for _ in range(300)]
    out += ["a" * 1001, "-" * 500, " " * 333, "ab" * 300, ""]
    out += [chr(p) + "a" + chr(p) + "1" + chr(p) for p in range(0x20, 0x3000, 3) if not 0xD800 <= p < 0xE000]
    return out


def test_trie_encodes_as_the_library(texts):
    got = [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in bpe_trie.encode_texts(texts, PATH)]
    assert got == library_ids(texts)


def test_decoding_is_the_librarys(texts):
    for text, ids in zip(texts, library_ids(texts)):
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert bpe_trie.decode_ids(packed, PATH) == text
        assert bpe_trie.decode_ids(packed[:4], PATH) == pretoken.library(PATH).decode(ids[:1], skip_special_tokens=False)


def test_merged_counts_are_the_librarys(texts):
    table = token_counts.count_table(PATH)
    got = [sum(map(table.__getitem__, split)) for run in pretoken.blocks(texts) for split in table.learn(run)]
    assert got == [len(x) for x in library_ids(texts)]


def test_a_full_table_starts_anew():
    table = pretoken.PieceTable(pretoken.vocabulary(PATH), lambda new: [len(p) for p in new], lambda i: 1, most=3)
    for text in ("one two", "three four five", "one"):
        assert sum(map(table.__getitem__, table.learn([text])[0])) == len(text)


def test_pieces_of_new_letters_and_controls():
    odd = [c for c in ("\x1d", "½", "Ⅷ", "\U0001c000", "\u0378") if unicodedata.category(c) in ("Cn", "No", "Nl", "Cc", "Lo")]
    for c in odd:
        text = f"a{c}b 1{c}2 {c}"
        cuts = pretoken.library(PATH).pre_tokenizer.pre_tokenize_str(text)
        assert pretoken.pieces(text, PATH) == [text[a:b] for _, (a, b) in cuts]


def expected(row):
    text = row[1] or ""
    return library_ids([text])[0], text


def test_digest_of_hard_rows(spark):
    got = cases.by_id(bpe_trie.bpe_digest(cases.frame(spark), PATH).collect())
    want = []
    for row in cases.TEXTS:
        ids, text = expected(row)
        want.append((row[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == cases.by_id(want)
    assert bpe_trie.bpe_digest(cases.empty(spark), PATH).count() == 0


def test_encode_then_decode(spark):
    encoded = bpe_trie.bpe_encode(cases.frame(spark), PATH)
    assert cases.by_id(bpe_trie.bpe_decode(encoded, PATH).collect()) == cases.by_id(
        [(i, t or "") for i, t in cases.TEXTS])


def test_counts_of_hard_rows(spark):
    got = cases.by_id(token_counts.token_counts(cases.frame(spark), PATH).collect())
    want = []
    for row in cases.TEXTS:
        ids, text = expected(row)
        want.append((row[0], len(text.encode()), len(ids), len(ids) > 1024))
    assert got == cases.by_id(want)
    assert token_counts.token_counts(cases.empty(spark), PATH).count() == 0


def test_files_of_hard_rows(spark, tmp_path):
    out = str(tmp_path / "tokens")
    token_files.write_tokens(cases.frame(spark), PATH, out)
    got = token_files.token_digest(spark, out).collect()
    want = {}
    for row in cases.TEXTS:
        ids = [*expected(row)[0], 0]
        want.setdefault(row[0], []).append((len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    assert {k: sorted(v) for k, v in want.items()} == {
        k: sorted((r.n_tokens, r.ids_crc32) for r in got if r.doc_id == k) for k in want}
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids_in_order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids_in_order == sorted(ids_in_order, key=lambda i: (i is not None, i or 0))
    assert {r.start for r in token_files.read_offsets(spark, out).collect()} == {r.start for r in got}


def test_selective_reads(spark, tmp_path):
    out = str(tmp_path / "tokens")
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text number ', id) AS text")
    token_files.write_tokens(docs, PATH, out, row_group_bytes=1 << 16, page_rows=50)
    some = token_files.read_tokens(spark, out, 100, 102)
    assert sorted(r.doc_id for r in some.collect()) == [100, 101, 102]
    plan = some._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(doc_id,100)" in plan
    offsets = token_files.read_offsets(spark, out)._jdf.queryExecution().toString()
    assert "ids" not in [line for line in offsets.splitlines() if "ReadSchema" in line][-1].split("ReadSchema")[1]
    ids = some.filter("doc_id = 101").first().ids
    assert ids == [*library_ids(["text number 101"])[0], 0]


def test_encodings_and_page_index_of_the_files(spark, tmp_path):
    import pyarrow.parquet as pq

    out = tmp_path / "tokens"
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat(concat('text number ', id, ' '), 20) AS text")
    token_files.write_tokens(docs.coalesce(1), PATH, str(out))
    group = pq.ParquetFile(next(out.glob("part-*.parquet"))).metadata.row_group(0)
    columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    ids = next(c for name, c in columns.items() if name.startswith("ids"))
    assert ids.has_dictionary_page and ids.has_offset_index and columns["doc_id"].has_column_index


def test_files_of_an_empty_table(spark, tmp_path):
    out = str(tmp_path / "tokens")
    token_files.write_tokens(cases.empty(spark), PATH, out)
    assert token_files.token_digest(spark, out).count() == 0


def test_ranks_give_the_librarys_ids():
    """Each code point between and beside letters, digits, spaces and itself."""
    encode = pretoken.rank_encoding(PATH).encode
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for begin in range(0, len(points), 50_000):
        texts = [f"a{c}b {c} {c}{c}1{c}!" for c in map(chr, points[begin:begin + 50_000])]
        assert library_ids(texts) == [encode(t, allowed_special="all") for t in texts]
    for text in ("<|endoftext|>a <|endoftext|><|endoftext|>", " " * 5000, "\n \n" * 3000 + "x", "ab" * 50_000, "", "\x00"):
        assert library_ids([text]) == [encode(text, allowed_special="all")]
