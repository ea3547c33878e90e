"""The registered queries of the corpus operators and the pipeline on the smallest scale."""

import random
import zlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from rivulet.llm.queries import ORACLES, QUERIES, word_bpe
from tests.llm.corpora import awkward, frame, sentence
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        found, n = df.collect(), con.execute("SELECT count(*) FROM documents").fetchone()[0]
        assert found if name in ("op7_packing", "op9_license_scan") else len(found) == n


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_pipeline_against_a_plain_version(spark, con):
    """Stage by stage: what each keeps is checked by hand on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    quality = con.execute("SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality = 1").fetchall()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        before = docs.collect()
        if name == "packing":
            encode = word_bpe()
            want = []
            for r in before:
                raw = next(encode([(r.text or "").encode()])) + (1).to_bytes(4, "little")
                n = len(raw) // 4
                want += [(r.doc_id, a, min(2048, n - a), zlib.crc32(raw[4 * a : 4 * min(n, a + 2048)]), n) for a in range(0, n, 2048)]
            got = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out.collect()]
            assert sorted(got) == sorted(want)
            return
        assert out.columns == columns
        after = out.collect()
        ids = [r.doc_id for r in after]
        if name == "quality":
            assert len({i for (i,) in quality} - set(ids)) <= 0.02 * len(quality) and len(ids) < len(before)
        elif name == "exact":
            last = {}
            for r in before:
                last[r.text] = max(last.get(r.text, -1), r.doc_id)
            assert sorted(ids) == sorted(last.values())
        elif name == "near":
            from tests.llm.test_near_dedup import brute

            lead = brute({r.doc_id: r.text for r in before})
            assert sorted(ids) == sorted({c for _, c in lead.values()})
        elif name == "mixture":
            words = lambda rows: sum(len(r.text.split()) for r in rows)
            assert words(after) == pytest.approx(1.5 * words(before), abs=25)
            assert max(ids.count(i) for i in set(ids)) <= 2
        docs = spark.createDataFrame(after, out.schema)


def test_pipeline_on_awkward_and_empty_tables(spark, tmp_path):
    """Nulls, blanks, very long texts, repeated ids, and columns named like those that the stages use inside."""
    rng = random.Random(5)
    rows = [*awkward(), *[(k, " ".join(sentence(rng, rng.randrange(20, 300)))) for k in range(100, 140)]]
    frame(spark, rows, clash=True).write.parquet(f"{tmp_path}/some/documents.parquet")
    frame(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    for name, labels in (("some", [(k, k % 4 > 0, k % 9 == 0) for k in range(100, 140)]), ("none", [])):
        df = spark.createDataFrame([(i, int(q), int(t)) for i, q, t in labels], "doc_id bigint, quality int, toxic int")
        df.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    pieces = corpus_pipeline.run(spark, f"{tmp_path}/some")
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    known = {r[0] for r in rows}
    found = pieces.collect()
    assert found and {r.doc_id for r in found} <= known
    for r in found:
        assert 0 <= r.offset and r.offset + r.length <= 2048 and 0 <= r.start < r.doc_tokens
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
