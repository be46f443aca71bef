import importlib.util

import pytest
from pyspark.sql import functions as F

from tripstream.llm import decontaminate, line_dedup, quality
from tripstream.llm.common import table, written

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no corpus_pipeline.py")


def test_stages_one_by_one(spark):
    import corpus_pipeline as cp

    docs = table(spark, SF, "documents")
    columns = docs.columns
    stages = dict(cp.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "jaccard_join", "decontaminate", "packing"]

    kept = written(stages["quality_rules"](spark, docs, SF), "t1")
    model = quality.train_quality(docs, table(spark, SF, "labels"))
    verdict = {r.doc_id for r in quality.judge_quality(docs, model).where("kept").collect()}
    assert kept.columns == columns and {r.doc_id for r in kept.select("doc_id").collect()} == verdict

    lined = written(stages["line_dedup"](spark, kept, SF), "t2")
    report = {r.doc_id: r for r in line_dedup.dedup_lines(kept, report=True).collect()}
    got = {r.doc_id: r for r in lined.collect()}
    assert lined.columns == columns
    assert {i: r.text for i, r in got.items()} == {i: r.text for i, r in report.items() if r.text.strip()}
    assert all(r.n_chars == len(r.text) for r in got.values())

    single = written(stages["jaccard_join"](spark, lined, SF), "t3")
    assert single.columns == columns

    def grams(t):
        w = t.encode().lower().split()
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))

    rows = sorted((r.doc_id, grams(r.text)) for r in lined.select("doc_id", "text").collect())
    near = {i for n, (i, a) in enumerate(rows) for _, b in rows[:n] if 5 * len(a & b) >= 4 * len(a | b)}
    assert {r.doc_id for r in single.select("doc_id").collect()} == {i for i, _ in rows} - near

    clean = written(stages["decontaminate"](spark, single, SF), "t4")
    items = table(spark, SF, "benchmark")
    leaked = {r.doc_id for r in decontaminate.contained_items(single, items).collect()}
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - leaked

    packed = stages["packing"](spark, clean, SF)
    fills = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("top"))
    assert fills.where("n > 2048 OR n != top").count() == 0
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in clean.collect()}


def test_run_equals_its_stages(spark):
    """``run`` end to end: the rows of the stages one after another, and no scratch left."""
    import corpus_pipeline as cp

    from tripstream.config import ensure_checkpoint_dir

    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = fs.Path(f"{ensure_checkpoint_dir(spark)}/tripstream")
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def folders():
        return {str(x.getPath().getName()) for x in store.listStatus(root)} if store.exists(root) else set()

    before = folders()
    out = cp.run(spark, SF)
    left = folders() - before
    assert {x.rsplit("-", 1)[0] for x in left} == {f"pipeline-{name}" for name, _ in cp.STAGES}
    docs = table(spark, SF, "documents")
    for _, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF), "by-hand")
    # which documents share a sequence may differ from run to run, the pieces do not
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, docs.select(*cols).collect())) != []
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_odd_documents_pass_every_stage(spark, docs_of, odd, clashing):
    """Each stage's defined result on null, empty, repeated and long rows; clashing names
    come through with their values."""
    import corpus_pipeline as cp

    same, long = "a b c d e f g", odd[-1][1]
    want = {
        # fewer than 50 words go; the long text's verdict is the classifier's
        "quality_rules": lambda got: {i for i, _ in got} <= {7},
        # later copies of short single lines stay; blank and null texts go
        "line_dedup": lambda got: sorted(got, key=repr) == sorted(
            [(4, "one"), (5, same), (5, same), (6, same), (None, same), (7, long)], key=repr),
        # one of the equal rows stays (the smallest doc_id), rows without words stay
        "jaccard_join": lambda got: sorted(got, key=repr) == sorted(
            [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, same), (None, None), (7, long)], key=repr),
        "decontaminate": lambda got: sorted(got, key=repr) == sorted(odd, key=repr),
    }
    for name, stage in cp.STAGES:
        for rows in (odd, []):
            df = clashing(docs_of(rows)).withColumns({c: F.lit(f"x-{c}") for c in ("__row", "row", "key", "first", "gone")})
            out = stage(spark, df, SF)
            if name == "packing":
                assert out.where("piece = 0").count() == len(rows)
                continue
            assert out.columns == df.columns, name
            got = out.collect()
            assert all(r["__row"] == "x-__row" and r["row"] == "x-row" and r["key"] == "x-key" for r in got), name
            pairs = [(r.doc_id, r.text) for r in got]
            assert want[name](pairs) if rows else not pairs, (name, pairs)
