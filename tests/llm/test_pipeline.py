import __spark_entry__ as E
import corpus_pipeline
from tests.llm.conftest import SF
from tillpoint.llm.queries import ORACLE_SQL, QUERIES
from tillpoint.operators.persist import materialize
from tests.llm.test_exact_dedup import brute as brute_exact
from tests.llm.test_mixing import check as check_mix, rows_of
from tests.llm.test_packing import check as check_packing
from tests.llm.test_simhash import brute as brute_simhash
from tillpoint.llm.mixing import mix
from tillpoint.llm.packing import pack


def test_registered():
    names = [k for k in E.queries() if k.startswith("op")]
    assert sorted(names) == sorted(QUERIES) and len(names) == 13 and "pipeline" in E.queries()
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_stages_one_by_one(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    before = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = materialize(stage(spark, before, SF), "t")
        rows = [(r.doc_id, r.text) for r in before.collect()]
        ids = sorted(r.doc_id for r in after.select("doc_id").collect())
        if k < 4:
            assert after.columns == columns
            assert not after.select(columns).distinct().exceptAll(before.distinct()).count()
        if k == 0:
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            good = {i for i, _ in rows if labels.get(i) == 1}
            assert len(good & set(ids)) >= 0.97 * len(good) and len(ids) < len(rows)
        if k == 1:
            assert ids == sorted(r[0] for r in brute_exact(rows) if r[3])
        if k == 2:
            assert ids == sorted(r[0] for r in brute_simhash(rows) if r[0] == r[2])
        if k == 3:
            made = mix(before).collect()
            check_mix(rows_of(before), made)
            assert ids == sorted(i for r in made for i in [r.doc_id] * r.copies)
        if k == 4:
            assert set(ids) == {i for i, _ in rows}
            check_packing(rows, pack(before, with_ids=True).collect(), 4096)
        before = after


def test_run(spark):
    import os

    from tillpoint.session import checkpoint_dir

    before = set(os.listdir(checkpoint_dir(spark)))
    out = corpus_pipeline.run(spark, SF)
    left = set(os.listdir(checkpoint_dir(spark))) - before
    assert len(left) == 5 and all(name.startswith("pipeline-") for name in left)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0
