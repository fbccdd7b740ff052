import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from martloom.llm import token_counts, token_files, tokens
from tests.llm.common import no_documents, odd_documents, rows_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [".", ",", ".\n", "\x01", "ö", "word", "я.", "Σ", "'", " ", "  ", "\n", "\t", "a", "Bc", "é", "!", "12", "'s", "\u3000", "\x1c", "\x85", "<|endoftext|>", "中", "\r\n", "-"]


def ids_of(text, plain=False):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = plain
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("by_spaces", [False, True])
def test_pieces_are_the_whole_encoding(by_spaces, plain):
    random.seed(5)
    texts = ["".join(random.choice(PARTS) for _ in range(random.randint(0, 25))) for _ in range(2000)] + [None, ""]
    known = tokens.Pieces(tokens.load(PATH, plain), most=50)  # starts anew now and then
    reference = tokens.load(PATH, plain)
    for at in range(0, len(texts), 300):
        part = texts[at : at + 300]
        got = tokens.encode(known, pa.array(part, pa.string()), by_spaces)
        assert [list(x) for x in got] == [reference.encode(t or "", add_special_tokens=False).ids for t in part]


def test_token_files_round_trip(spark):
    docs = odd_documents(spark).repartition(3)
    parts = token_files.write_token_files(docs, PATH)
    got = sorted(rows_of(token_files.read_token_files(parts)), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is not None, i or 0))
    start, expected = 0, []
    for row in docs.collect():
        ids = np.array(ids_of(row.text) + [0], "<u4")
        expected.append((row.doc_id, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(map(str, [(i, n, c) for i, _, n, c in got])) == sorted(map(str, expected))
    for _, begin, n, _ in got:
        assert begin == start
        start += n
    part = parts.first()
    assert np.memmap(part["offsets"], "<i8", "r").tolist()[0] == part["base"] and part["type"] == "<u2"


def test_token_files_of_nothing(spark):
    assert rows_of(token_files.read_token_files(token_files.write_token_files(no_documents(spark), PATH))) == []


@pytest.mark.parametrize("block_ids", [3, 1000, 1 << 20])
def test_separator_scan_is_brute_force(spark, block_ids):
    docs = odd_documents(spark).filter("doc_id <> 5 or doc_id is null" if block_ids == 3 else "true").repartition(3)
    files = token_counts.write_flat_files(docs, PATH)
    got = sorted(rows_of(token_counts.count_tokens(files, block_ids=block_ids)))
    assert sorted(r[3] for r in got) == sorted(len(ids_of(r.text, plain=True)) for r in docs.collect())
    assert [r[0] for r in got] == list(range(len(got))) and all(r[4] for r in got)
    named = sorted(rows_of(token_counts.with_doc_ids(token_counts.count_tokens(files, block_ids=block_ids), files)), key=str)
    assert sorted(((r[0], r[4]) for r in named), key=str) == sorted(
        ((r.doc_id, len(ids_of(r.text, plain=True))) for r in docs.collect()), key=str)
    again = token_counts.write_flat_files(docs, PATH)
    assert named == sorted(rows_of(token_counts.with_doc_ids(token_counts.count_tokens(again), again)), key=str)
    nothing = token_counts.write_flat_files(no_documents(spark), PATH)
    assert token_counts.with_doc_ids(token_counts.count_tokens(nothing), nothing).count() == 0


def test_documents_span_blocks_and_files(spark, tmp_path):
    stream = [5, 9, 5, 5, 9, 9, 5, 5, 5, 5, 5, 9, 5]
    cuts, paths = [0, 1, 3, 3, 8, 13], []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        paths.append(str(tmp_path / f"{9 - k}.bin"))  # the order of the list counts, not the names
        np.array(stream[a:b], "<u4").tofile(paths[-1])
    for block in (1, 2, 100):
        got = sorted(rows_of(token_counts.count_tokens(token_counts.files_at(spark, paths, "<u4"), 9, block)))
        assert [(n, s, t, c) for n, _, s, t, c in got] == [
            (0, 0, 1, True), (1, 2, 2, True), (2, 5, 0, True), (3, 6, 5, True), (4, 12, 1, False)]
