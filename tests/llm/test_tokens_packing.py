"""Operators 1 and 3 against the tokenizers library itself."""

import zlib

import numpy as np
import pytest

from fathom.llm import packing, token_index, tokens
from fathom.llm import queries as Q

from conftest_llm import SF, edge_rows


def plain_ids(text):
    return tokens.encoder().tok.encode(text or "", add_special_tokens=False).ids


def brute(rows):
    """(doc_id, start, n_tokens, crc) in ascending doc_id order, nulls first."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*plain_ids(text), 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("text", ["", None, " \n ", "a.. b., c. D, ²., x_. 5. !. ½, \xa0.", "<|endoftext|>. a<|startoftext|>, <|ENDOFTEXT|>", "Σας ΣΑΣ ﬁ",
                                  "é́ ́a", "a~b ~ ~~ c~.", "ß. SS, µ. ", "I'll 's don't. it's,", "\x85a\xa0b\x1cc　d"])
def test_chunks_give_the_tokenizers_ids(text):
    assert tokens.encoder().encode_all([text])[0].tolist() == plain_ids(text)


def test_a_full_table_changes_no_ids(monkeypatch, docs):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    monkeypatch.setattr(tokens, "GROUP_WORDS", 100)
    texts = [r.text for r in docs.limit(30).collect()]
    enc = tokens.WordEncoder(tokens.DEFAULT_TOKENIZER)
    assert [x.tolist() for x in enc.encode_all(texts)] == [plain_ids(t) for t in texts]


def test_index_query(spark, docs):
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in Q.op1_token_index(spark, SF).orderBy("doc_id").collect()]
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_index_edges(edge):
    rows = token_index.encode_and_read(edge).collect()
    got = sorted((r.n_tokens, r.ids_crc32) for r in rows)
    assert got == sorted((n, c) for _, _, n, c in brute([r[:2] for r in edge_rows()]))
    spans = sorted((r.start, r.n_tokens) for r in rows)
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert {k: sum(r.doc_id == k for r in rows) for k in (1, 8, None)} == {1: 2, 8: 2, None: 2}


def test_fetch_reads_the_ids_of_keys(spark, docs, tmp_path, monkeypatch):
    """Keyed access: index, block, place. A key's documents are all fetched, over several blocks; other keys give nothing."""
    monkeypatch.setattr(token_index, "BLOCK_DOCS", 3)
    rows = [(r.doc_id, r.text) for r in docs.limit(40).collect()] + [(7_000, f"copy {k}") for k in range(10)] + [(None, "no key")]
    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    token_index.write_tokens(df, path, bucket_keys=8)
    blocks = token_index.directory(spark, path).where("doc_id = 7000").select("part", "block").distinct().count()
    assert blocks >= 4
    some = [rows[3][0], rows[11][0], 7_000, None, 123_456]
    asked = spark.createDataFrame([(k,) for k in some], "doc_id long")
    got = sorted(((r.doc_id is not None, r.doc_id or 0), list(r.ids)) for r in token_index.fetch(spark, path, asked, bucket_keys=8).collect())
    want = sorted(((k is not None, k or 0), plain_ids(t) + [2]) for k, t in rows if k in some)
    assert got == want


def test_rows_come_through_the_index(spark, docs, tmp_path):
    """A wrong slot loses its row: nothing else leads to the payload."""
    path = f"file://{tmp_path}/t"
    token_index.write_tokens(docs, path)
    index = spark.read.schema(token_index.INDEX).parquet(f"{path}/index").collect()
    broken = [{**r.asDict(), "place": bytes(len(r["place"]) - 8) + bytes([255] * 7 + [0])} for r in index]
    spark.createDataFrame(broken, token_index.INDEX).write.parquet(f"{path}-broken/index")
    for name in ("payload", "parts"):
        spark.read.parquet(f"{path}/{name}").write.parquet(f"{path}-broken/{name}")
    keys = docs.select("doc_id")
    assert token_index.fetch(spark, path, keys, with_ids=False).count() == docs.count()
    assert token_index.fetch(spark, f"{path}-broken", keys, with_ids=False).count() < docs.count()


def test_lookup_finds_all_and_refuses_others(spark, docs, tmp_path):
    path = f"file://{tmp_path}/t"
    token_index.write_tokens(docs, path, bucket_keys=16)
    asked = docs.select("doc_id").union(spark.range(10_000, 12_000).toDF("doc_id"))
    got = {r.doc_id: r for r in token_index.lookup(spark, path, asked, bucket_keys=16).collect()}
    want = {d: (s, n) for d, s, n, _ in brute([(r.doc_id, r.text) for r in docs.collect()])}
    assert {d: (r.start, r.n_tokens) for d, r in got.items() if r.found} == want
    assert len(got) == len(want) + 2000


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    slots = token_index.slots_of(keys, *token_index.build_mph(keys))
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_empty_tables(empty):
    assert token_index.encode_and_read(empty).count() == 0
    assert packing.pack(empty).count() == 0


def check_packing(rows, want, window):
    seqs, pieces = {}, {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    for spans in seqs.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        assert sum(n for _, n in spans) <= window
    assert sum(r.length for r in rows) == want
    return seqs


def test_packing_query(spark, docs):
    rows = Q.op3_best_fit_packing(spark, SF).collect()
    ids = {r.doc_id: np.array([*plain_ids(r.text), 2], "<u4") for r in docs.collect()}
    seqs = check_packing(rows, sum(map(len, ids.values())), 4096)
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
    assert sum(map(len, ids.values())) / (4096 * len(seqs)) > 0.97


def test_packing_edges_in_many_groups(edge):
    rows = packing.pack(edge, window=64, group_rows=40).collect()
    check_packing(rows, sum(n for _, _, n, _ in brute([r[:2] for r in edge_rows()])), 64)


def test_best_fit_is_the_tightest():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 100, 300)
    where, offset = packing.best_fit_decreasing(lengths, 100)
    used = {}
    for i in np.argsort(-lengths, kind="stable"):
        fits = [100 - u for u in used.values() if 100 - u >= lengths[i]]
        room = 100 - used.get(where[i], 0)
        assert room == (min(fits) if fits else 100) and offset[i] == used.get(where[i], 0)
        used[where[i]] = used.get(where[i], 0) + lengths[i]
