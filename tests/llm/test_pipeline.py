import os

import pytest

import corpus_pipeline as cp
from ledgerstar.llm import decontam, langid, quality, simhash
from ledgerstar.llm.common import table, written

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_stages_on_the_smallest_table(spark):
    docs = table(spark, SF, "documents")
    seen = [docs]
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF), name)
        seen.append(docs)
    ids = [{r[0] for r in d.select("doc_id").collect()} for d in seen]
    assert all(d.columns == seen[0].columns for d in seen[:-1])
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] >= ids[4] == ids[5]
    judged = {r.doc_id: r for r in langid.identify(seen[0]).collect()}
    assert ids[1] == {i for i in ids[0] if judged[i].lang_pred != "und" and judged[i].score >= cp.LANGUAGE_SCORE}
    assert ids[2] == {r.doc_id for r in quality.score(seen[1]).where("kept").collect()}
    assert ids[3] == {r.component_id for r in simhash.near_duplicates(seen[2]).collect()}
    assert ids[4] == {r.doc_id for r in decontam.decontaminate(seen[3], table(spark, SF, "benchmark")).where("not contaminated").collect()}


def test_odd_rows(spark, frame, odd_texts, tmp_path):
    spark.createDataFrame([(1, "some words of a benchmark item that no document here has at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    good = ("The river rose after a night of steady rain.\nFarmers near its banks moved their cattle to higher ground before dawn.\n"
            "By noon water had covered two fields and part of the old road.\nNobody was hurt, though several cellars will need weeks to dry.")
    rows = [(*r, "en") for r in odd_texts] + [(500, good, "en"), (500, good, "en"), (501, good, None), (None, good, "en")]
    docs = frame(rows)
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)), name)
    got = docs.select("doc_id").distinct().collect()
    assert (500,) in got and (501,) not in got and (None,) not in got
    empty = frame([])
    for name, stage in cp.STAGES:
        empty = written(stage(spark, empty, str(tmp_path)), name)
    assert empty.count() == 0
