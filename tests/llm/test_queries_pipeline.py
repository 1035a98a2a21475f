import math
import re

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from tracknet.llm import queries as Q

SF = E.SMOKE_DIR
TABLES = ("documents", "pages", "labels")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_against_its_sql(spark, duck, name):
    got = Q.queries()[name](spark, SF)
    cols = sorted(got.columns)
    res = duck.execute(Q.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    place = [names.index(c) for c in cols]
    want = sorted((tuple(plain(r[k]) for k in place) for r in res.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in cols) for r in got.collect()), key=repr) == want and want


def test_every_operator_has_one_query_and_all_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in Q.queries())
    assert numbers == list(range(1, 14))
    assert set(Q.queries()) | {"pipeline"} <= set(E.queries())


def test_pipeline_stages(spark):
    docs = Q.table(spark, SF, "documents")
    first = docs
    seen = []
    for name, stage in C.STAGES:
        before = docs
        docs = C.cut(stage(spark, before, SF))
        seen.append((name, before, docs))
        if name != "encode":
            assert docs.dtypes == first.dtypes
    by = {n: (a, b) for n, a, b in seen}
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    a, b = by["quality_rules"]
    assert ids(b) == sorted(r.doc_id for r in Q.quality.judge_quality(a).filter("kept").collect())
    a, b = by["near_duplicates"]
    assert ids(b) == sorted(r.id for r in Q.hyperminhash.near_duplicates(a).filter("kept").collect())
    a, b = by["substring_dedup"]
    texts = {r.doc_id: r.text for r in b.collect()}
    seen_windows = {}
    for r in a.orderBy("doc_id").collect():
        words = WORD.findall(r.text or "")
        gone = set()
        for k in range(len(words) - 19):
            if seen_windows.setdefault(tuple(words[k:k + 20]), (r.doc_id, k)) != (r.doc_id, k):
                gone.update(range(k, k + 20))
        assert WORD.findall(texts[r.doc_id]) == [w for k, w in enumerate(words) if k not in gone]
    a, b = by["mix_sources"]
    want = {r.id: r.copies for r in Q.mixing.mix_sources(a).collect()}
    got = {}
    for i in ids(b):
        got[i] = got.get(i, 0) + 1
    assert got == {i: n for i, n in want.items() if n}
    a, b = by["encode"]
    assert ids(a) == ids(b)
    spelled = {r.doc_id: r for r in b.collect()}
    coder = Q.bpe.load(*Q.vocabulary())
    for r in a.collect():
        assert coder.decode_bytes(Q.bpe.np.frombuffer(bytes(spelled[r.doc_id].ids), "<u4")).decode() == (r.text or "")


def test_run_applies_all_stages(spark):
    out = E.queries()["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and out.count() > 50


def test_stages_take_null_ids_repeated_rows_and_any_column_names(spark):
    found = Q.quality.keep_good(Q.table(spark, SF, "documents")).orderBy("doc_id").limit(30).collect()
    rows = [(*r, "x", 2) for r in found]
    rows += [(None, found[0].text, "en", None, 1, None, 3), (None, None, None, None, None, None, None), (9, "", "en", "s1", 0, "", 4), rows[1], rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, `we``ird kept` int")
    empty = docs.limit(0)
    for name, stage in C.STAGES:
        docs, empty = (C.cut(stage(spark, x, SF)) for x in (docs, empty))
        assert empty.collect() == []
        if name != "encode":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "a.b", "we`ird kept"]
        if name == "near_duplicates":
            held = [(r.doc_id, r.text) for r in docs.collect()]
            assert len(held) == len(set(held)) > 10 and (None, found[0].text) not in held
    assert docs.count() > 10
