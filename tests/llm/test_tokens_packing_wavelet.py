import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakelayer.llm.packing import fillings, pack_documents, plan_packing, sequences, solve_nnls
from lakelayer.llm.tokens import ColumnEncoder, public_path
from lakelayer.llm.wavelet import WaveletMatrix, occurrences, read_documents, read_entry, write_entry, write_token_shards
from lakelayer.session import work_dir

WORD, BYTE = public_path("word_bpe_49k.json"), public_path("byte_bpe_50k.json")
ODD = ["", "  a", "a  b ", " \n", "\n\nfoo bar", "x\ty", "naïve İstanbul", "don't we'll 'S", "日本語", "<|endoftext|> x", "plain words <|endoftext|>", "a<|startoftext|>b",
       "1²3 ½ ª", "a\nb c\n", " lead", "trail ", "A" * 3000, "é combining", None]


def plain_ids(path, text, end, special_as_text=False):
    t = Tokenizer.from_file(path)
    if special_as_text:
        t.encode_special_tokens = True
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


@pytest.mark.parametrize("path,keeps", [(WORD, False), (BYTE, True)])
def test_encoder_is_the_tokenizer(spark, sf_small, path, keeps):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").limit(60).collect()]
    got = list(ColumnEncoder(path, keeps).encode(pa.array(texts)))
    assert got == [plain_ids(path, t, 0)[:-1].tobytes() for t in texts]
    as_text = list(ColumnEncoder(path, keeps, special_as_text=True).encode(pa.array(ODD)))
    assert as_text == [plain_ids(path, t, 0, True)[:-1].tobytes() for t in ODD] != got[:len(ODD)]


def test_wavelet_matrix_rank_select():
    rng = np.random.default_rng(3)
    for ids in (rng.integers(0, 50_000, 3000), np.zeros(1, int), np.arange(700), rng.integers(0, 3, 1500)):
        m = WaveletMatrix.build(ids.astype("<u4"))
        assert (m.ids() == ids).all()
        at = rng.integers(0, len(ids), 50)
        assert (m.access(at) == ids[at]).all()
        for symbol in [*np.unique(ids)[:20].tolist(), 60_001]:
            assert m.occurrences(symbol).tolist() == np.flatnonzero(ids == symbol).tolist()
            assert m.count(symbol, 5, 500) == int((ids[5:500] == symbol).sum())
    keys, lengths, back = read_entry(write_entry([None, 7], [1, 3], np.array([0, 5, 70_000, 0])))
    assert keys == [None, 7] and lengths.tolist() == [1, 3] and back.ids().tolist() == [0, 5, 70_000, 0]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, block int, entry string")


def test_token_shards_round_trip(spark):
    rows = [*((i + 3, t) for i, t in enumerate(ODD)), (1, "tie"), (1, "tie"), (None, "no id"), (2, "word " * 4000)]
    folder = work_dir(spark, "test-shards")
    write_token_shards(documents(spark, rows), BYTE, folder, shard_tokens=500)
    entries = spark.read.parquet(folder)
    got = sorted(read_documents(entries).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)]).tolist()[:-1]
    wanted = sorted((i or -1, zlib.crc32(plain_ids(BYTE, t, 0))) for i, t in rows)
    assert sorted((r.doc_id or -1, r.ids_crc32) for r in got) == wanted
    assert occurrences(entries, 0).count() >= len(rows)
    empty = work_dir(spark, "test-shards")
    write_token_shards(documents(spark, rows).limit(0), BYTE, empty)
    assert read_documents(spark.read.parquet(empty)).count() == 0


def test_nnls_and_plan():
    a = np.array([[1.0, 0, 1], [0, 1, 1]])
    assert np.allclose(a @ solve_nnls(a, np.array([3.0, 2.0])), [3, 2], atol=1e-5)
    assert all(sum(w) == 16 and len(w) <= 3 for w in fillings(16)) and len(set(fillings(16))) == len(fillings(16))
    rng = np.random.default_rng(0)
    sizes, n = np.unique(rng.integers(1, 33, 5000), return_counts=True)
    plan = plan_packing(dict(zip(sizes.tolist(), n.tolist())), classes=32)
    used = np.zeros(33, int)
    for way, times in plan:
        assert sum(way) <= 32 and times > 0
        np.add.at(used, list(way), times)
    assert used[sizes].tolist() == n.tolist()
    assert sum(t for _, t in plan) * 32 < 1.03 * (sizes * n).sum()


def check_packing(spark, rows, placed, window):
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(plain_ids(WORD, t, 1))
    by_doc, by_seq = {}, {}
    for r in placed:
        own = ids[r.doc_id][0]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length])
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, own in ids.items():
        pieces = sorted(by_doc[i])[::len(own)]
        assert [a for a, _ in pieces] == [0, *np.cumsum([n for _, n in pieces])[:-1]]
        assert sum(n for _, n in pieces) == len(own[0])
    for pieces in by_seq.values():
        pieces.sort()
        assert [a for a, _ in pieces] == [0, *np.cumsum([n for _, n in pieces])[:-1]]
        assert sum(n for _, n in pieces) <= window
    return by_seq


def test_packing_edges_and_arrays(spark):
    rows = [*enumerate(ODD), (50, "tie"), (50, "tie"), (None, "no id"), (60, "word " * 500)]
    placed = pack_documents(documents(spark, rows), WORD, window=256)
    by_seq = check_packing(spark, rows, placed.collect(), 256)
    packed = sequences(placed, 256, pad_id=9).collect()
    assert {r.sequence_id for r in packed} == set(by_seq) and all(len(r.ids) == 1024 for r in packed)
    assert pack_documents(documents(spark, rows).limit(0), WORD).count() == 0


def test_packing_of_tables_has_little_padding(spark):
    from lakelayer.llm.queries import op1_pack_sequences

    sf = "/root/testdata/sf0.01"
    placed = op1_pack_sequences(spark, sf).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    by_seq = check_packing(spark, rows, placed, 2048)
    assert sum(n for own in by_seq.values() for _, n in own) > 0.97 * 2048 * len(by_seq)
