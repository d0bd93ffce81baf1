import pytest

import corpus_pipeline
from folioforge.llm.decontaminate import contaminated
from folioforge.llm.near_dedup import near_duplicates
from folioforge.llm.quality import judge
from folioforge.llm.substring_dedup import repeated_passages

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's result over the smallest tables, written and read again."""
    docs, out = spark.read.parquet(f"{D}/documents.parquet"), {}
    out["documents"] = docs
    for name, f in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        f(spark, docs, D).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "substring_dedup", "decontamination", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_quality_decisions(spark, stages):
    want = judge(spark, stages["documents"], spark.read.parquet(f"{D}/labels.parquet")).where("accepted")
    assert ids(stages["quality"]) == ids(want)


def test_near_dedup_decisions(spark, stages):
    found = near_duplicates(spark, stages["quality"]).collect()
    assert ids(stages["near_dedup"]) == sorted(r.doc_id for r in found if r.kept) == sorted({r.component_id for r in found})
    assert all(r.kept and r.component_id == r.doc_id for r in near_duplicates(spark, stages["near_dedup"]).collect())


def test_substring_decisions(spark, stages):
    spans = {}
    for r in repeated_passages(spark, stages["near_dedup"]).collect():
        spans.setdefault(r.doc_id, []).append(r)
    before = {r.doc_id: r.text for r in stages["near_dedup"].collect()}
    after = {r.doc_id: r for r in stages["substring_dedup"].collect()}
    for d, t in before.items():
        left = t
        for s in sorted(spans.get(d, []), key=lambda s: -s.start):
            left = left[: s.start] + left[s.start + s.length :]
        assert (after[d].text.split() if d in after else []) == left.split()
        assert d not in after or after[d].n_chars == len(after[d].text)


def test_decontamination_decisions(spark, stages):
    gone = {r.doc_id for r in contaminated(spark, stages["substring_dedup"], spark.read.parquet(f"{D}/benchmark.parquet")).collect()}
    assert ids(stages["decontamination"]) == [i for i in ids(stages["substring_dedup"]) if i not in gone]


def test_packing_takes_every_document(stages):
    got = {}
    for r in stages["packing"].collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert sorted(got) == ids(stages["decontamination"])
    assert all(sum(n for _, n, _ in ps) == ps[0][2] for ps in got.values())


def test_run_equals_the_stages(spark, stages):
    run = corpus_pipeline.run(spark, D)
    assert ids(run.dropDuplicates(["doc_id"])) == ids(stages["decontamination"])


def test_without_documents_or_with_odd_rows(spark, tmp_path):
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a few plain words", "en", "s", 17), (3, "a few plain words", "en", "s", 17)], stages_schema(spark))
    for case, docs in enumerate((odd, odd.limit(0))):
        for k, (_, f) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{case}-{k}")
            f(spark, docs, D).write.parquet(path)
            docs = spark.read.parquet(path)


def stages_schema(spark):
    return spark.read.parquet(f"{D}/documents.parquet").schema
