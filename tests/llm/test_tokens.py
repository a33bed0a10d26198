import random
import zlib

import numpy as np
import pytest

from barforge.llm import binpack, bytebpe, idfile, pieces, rank_merge, scratch
from barforge.llm.queries import BYTE_MODEL, PIECE_MODEL, tokenizer_path
from tests.conftest import SMALL

ODD = ["a", "b", " ", "  ", "\n", "é", "▁", "<s>", "漢", "🙂", "\t", "aaaa", "==", "the", "\x00", "<0x0A>", "-", "ing", "<|endoftext|>", "'s", "\u0085", " ", "12", "_", "́"]


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(1)
    fixed = ["", " ", "  ", "\n", "a ", " a", "a" * 2000, "=" * 1001, " " * 300 + "x", "x\ny z", "x \ny"]
    return fixed + ["".join(rng.choices(ODD, k=rng.randint(1, 30))) for _ in range(1500)]


def test_pieces_and_counts_equal_the_library(odd_texts):
    import sentencepiece

    path = tokenizer_path(PIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    want = library.encode(odd_texts, num_threads=1)
    assert [x.tolist() for x in pieces.chunk_table(path).encode(odd_texts)] == want
    assert rank_merge.merger(path).count(odd_texts) == [len(x) for x in want]


def test_bytes_equal_the_library(odd_texts):
    own = bytebpe.encoder(tokenizer_path(BYTE_MODEL))
    assert [x.tolist() for x in own.encode(odd_texts)] == [own.library.encode(t, add_special_tokens=False).ids for t in odd_texts]


def test_long_chunks(odd_texts):
    """A chunk without white space takes time in proportion, and counts as the library's."""
    import time

    import sentencepiece

    path, rng = tokenizer_path(PIECE_MODEL), random.Random(2)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)), "".join(rng.choices("the漢é🙂an", k=30_000)), "a" * 50_001, "=" * 20_000]
    began = time.perf_counter()
    want = [len(library.encode(t)) for t in texts]
    took, began = time.perf_counter() - began, time.perf_counter()
    assert rank_merge.merger(path).count(texts) == want
    assert time.perf_counter() - began < 50 * took + 5


def test_tables_forget_and_stay_right(odd_texts, monkeypatch):
    from barforge.llm.chunks import Known

    piece, byte = pieces.ChunkTable(tokenizer_path(PIECE_MODEL)), bytebpe.ByteChunks(tokenizer_path(BYTE_MODEL))
    piece.known, byte.known = Known(piece.segment, 60, np.int32), Known(byte._learn, 60, np.uint32)
    for at in range(0, 600, 50):
        part = odd_texts[at : at + 50]
        assert [x.tolist() for x in piece.encode(part)] == piece.model.encode(part)
        assert [x.tolist() for x in byte.encode(part)] == [byte.library.encode(t, add_special_tokens=False).ids for t in part]


def test_documents_equal_the_libraries(spark):
    """The three tokenizers on all documents, and the corpus table is used."""
    import sentencepiece

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    piece, byte = tokenizer_path(PIECE_MODEL), bytebpe.encoder(tokenizer_path(BYTE_MODEL))
    library = sentencepiece.SentencePieceProcessor(model_file=piece)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    want = {i: library.encode(t) for i, t in texts.items()}
    table = pieces.corpus_table(docs.select("text").na.fill(""), piece, 500)
    assert table.num_rows == 500 and table.column("n").to_pylist() == sorted(table.column("n").to_pylist(), reverse=True)
    got = pieces.encode(docs, piece, decoded=True, frequent=500).collect()
    assert {r.doc_id: r.ids for r in got} == want and all(r.decoded == library.decode(want[r.doc_id]) for r in got)
    assert {r.doc_id: r.n_tokens for r in rank_merge.count(docs, piece, 100).collect()} == {i: len(x) for i, x in want.items()}
    ids = sorted(texts)
    assert [x.tolist() for x in byte.encode([texts[i] for i in ids])] == [byte.library.encode(texts[i], add_special_tokens=False).ids for i in ids]


def test_round_trip_and_edges(spark, edge):
    path = tokenizer_path(PIECE_MODEL)
    rows = pieces.decode(pieces.encode(edge, path), path).collect()
    assert len(rows) == edge.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].ids == [] and by[1].decoded == "" and by[7].decoded.startswith("É è 漢字")
    counts = {r.doc_id: r for r in rank_merge.count(edge, path, 100).collect()}
    assert counts[1].n_tokens == 0 == counts[1].n_bytes and all(counts[i].n_tokens == len(by[i].ids) for i in by)
    assert counts[8].over_limit and not counts[5].over_limit
    assert pieces.encode(edge.limit(0), path).count() == 0 == rank_merge.count(edge.limit(0), path, 1).count()


@pytest.mark.parametrize("width", [1, 5, 11, 16, 17, 32])
def test_bit_packing(width):
    ids = np.random.default_rng(width).integers(0, 2**width, 777, dtype=np.uint64).astype(np.uint32)
    packed = idfile.pack(ids, width)
    assert len(packed) == -(-777 * width // 8)
    assert (idfile.unpack(packed, width, 0, 777) == ids).all() and (idfile.unpack(packed, width, 13, 50) == ids[13:63]).all()
    if width < 32:
        with pytest.raises(ValueError):
            idfile.pack(np.array([2**width], np.uint32), width)


def test_files(spark, edge, tmp_path):
    own = bytebpe.encoder(tokenizer_path(BYTE_MODEL))
    path = f"file://{tmp_path}/ids"
    idfile.write(edge, tokenizer_path(BYTE_MODEL), path)
    got = idfile.documents(spark, path).orderBy("start").collect()
    rows = sorted(((r.doc_id, r.text or "") for r in edge.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start = 0
    for r, (i, text) in zip(got, rows, strict=True):
        ids = np.append(own.encode([text])[0], 0).astype("<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert [x.tolist() for x in idfile.lookup(spark, path, 4)] == [[*own.encode(["one"])[0].tolist(), 0]]
    idfile.write(edge.limit(0), tokenizer_path(BYTE_MODEL), f"{path}0")
    assert idfile.documents(spark, f"{path}0").count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_is_tight_and_whole(rule):
    rng = np.random.default_rng(4)
    lengths = np.where(rng.random(20_000) < 0.5, rng.integers(1, 1025, 20_000), np.minimum(1024, rng.lognormal(5, 1, 20_000).astype(int) + 1))
    values, counts = np.unique(lengths, return_counts=True)
    runs = binpack.plan(dict(zip(values.tolist(), counts.tolist(), strict=True)), binpack.Capacity(rule=rule))
    assert max(s + n for _, _, n, s, _ in runs) <= -(-lengths.sum() // 1024) * 1.002 + 1


def _one_by_one(lengths, capacity):
    """Best fit of items, the longest first, each into the open sequence with the least weighted rest."""
    full, weights, rooms = capacity.vector(), np.array(capacity.weights), []
    for length in sorted(lengths, reverse=True):
        need = binpack.demand(length)
        fits = [(float((weights * ((r - need) / full) ** 2).sum()), k) for k, r in enumerate(rooms) if (r >= need).all()]
        if fits:
            rooms[min(fits)[1]] = rooms[min(fits)[1]] - need
        else:
            rooms.append(full - need)
    return len(rooms)


@pytest.mark.parametrize("capacity", [binpack.Capacity(tokens=100), binpack.Capacity(tokens=100, documents=4, cost=5000)])
def test_plan_against_one_by_one(capacity):
    for seed in range(12):
        rng = np.random.default_rng(seed)
        lengths = rng.integers(1, 71, rng.integers(1, 300)).tolist()
        values, counts = np.unique(lengths, return_counts=True)
        runs = binpack.plan(dict(zip(values.tolist(), counts.tolist(), strict=True)), capacity)
        plain = _one_by_one(lengths, capacity)
        assert max(s + n for _, _, n, s, _ in runs) <= plain * 1.02 + 1


def test_every_capacity_holds():
    full = binpack.Capacity(tokens=100, documents=3, cost=4000)
    runs = binpack.plan({60: 5, 30: 20, 5: 40, 0: 3}, full)
    held = {}
    for length, _, n, first, _ in runs:
        for k in range(n):
            held.setdefault(first + k, []).append(length)
    assert all(sum(x) <= 100 and len(x) <= 3 and sum(v * v for v in x) <= 4000 for x in held.values())
    with pytest.raises(ValueError):
        binpack.plan({70: 1}, full)


def test_packing(spark, edge, words):
    docs = edge.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + k, words(40 * (k % 90) + 1, k)) for k in range(200)], "doc_id long, text string"))
    own = bytebpe.encoder(tokenizer_path(BYTE_MODEL))
    items = binpack.token_pieces(docs, tokenizer_path(BYTE_MODEL), 2, 1024)
    rows = binpack.pack(items).toPandas()
    texts = {r.doc_id: np.append(own.encode([r.text or ""])[0], 2) for r in docs.collect()}
    for i, part in rows[rows["doc_id"].notna() & (rows["doc_id"] != 6)].groupby("doc_id"):
        part, ids = part.sort_values("piece"), texts[i]
        assert part["length"].sum() == len(ids) and (part["length"].iloc[1:] == 1024).all()
        for r in part.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].astype("<u4").tobytes())
    for _, part in rows.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["offset"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]] and part["length"].sum() <= 1024
    assert rows["sequence_id"].nunique() <= -(-rows["length"].sum() // 1024) + 2
    assert binpack.pack(items.limit(0)).count() == 0


def test_packing_has_one_python_worker_a_task(spark, words, monkeypatch):
    """A worker that makes items and one that numbers them would hold two tokenizers' tables in a task."""
    docs = spark.createDataFrame([(i, words(30 + i, i)) for i in range(40)], "doc_id long, text string")
    plans, write = [], scratch.write

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(scratch, "write", seen)
    packed = binpack.pack(binpack.token_pieces(docs, tokenizer_path(BYTE_MODEL), 2, 1024))
    plans.append(packed._jdf.queryExecution().executedPlan().toString())
    assert max(p.count("MapInArrow") for p in plans) == 1
    assert packed.count() == 40


def test_small_tables_give_the_same_pieces(spark, edge, words):
    docs = edge.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, words(900, i)) for i in range(12)], "doc_id long, text string"))
    rows = lambda **more: sorted(map(str, binpack.token_pieces(docs, tokenizer_path(BYTE_MODEL), 2, 256, **more).collect()))
    assert rows(at_once=1, chunks=16) == rows()
