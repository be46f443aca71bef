import pytest

from tripstream.llm import common, line_dedup
from tripstream.llm.components import connected


@pytest.fixture
def many_parts(spark):
    """Shuffles of 24 partitions that Spark does not put together."""
    names = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def files(scope):
    return {path.rstrip("/").rsplit("/", 1)[-1]: len(df.inputFiles()) for path, df in scope.paths.items()}


def test_parts_grow_with_the_rows(spark, many_parts):
    df = spark.range(1000).repartition(24, "id")
    assert common.few_parts(df, 1000).rdd.getNumPartitions() == common.LEAST_FILES
    assert common.few_parts(df, 20 * common.FILE_ROWS).rdd.getNumPartitions() == 20
    assert common.few_parts(df, 24 * common.FILE_ROWS) is df
    assert sorted(r.id for r in common.few_parts(df, 10).collect()) == list(range(1000))


def test_small_tables_are_few_files(spark, docs_of, many_parts):
    docs = docs_of([(i, "\n".join(f"line {(i * k) % 37} of some text" for k in range(12))) for i in range(80)])
    with common.scratch_scope(spark) as scope:
        line_dedup.dedup_lines(docs).count()
        made = files(scope)
    # the lines alone are sorted into all partitions
    assert sum(n > common.LEAST_FILES for n in made.values()) <= 1, made
    with common.scratch_scope(spark) as scope:
        connected(spark.createDataFrame([(i, i // 2) for i in range(1, 60)], "a long, b long"))
        made = files(scope)
    assert sum(n > common.LEAST_FILES for n in made.values()) <= 1, made


def test_ranks_follow_the_pairs_and_results_stay(spark, docs_of, many_parts, monkeypatch):
    texts = [(i, "\n".join(f"line {(i * k) % 37} of some text" for k in range(12))) for i in range(60)]
    texts = docs_of(texts)

    def results():
        lines = line_dedup.ordered_lines(texts)
        depths = [sorted((r.r, r.seq, r.n) for r in d.collect()) for d in line_dedup.suffix_ranks(lines)]
        ranks = line_dedup._ranked(lines, "h1", "h2", "line-ranks", lines.count()).orderBy("h1", "h2").collect()
        assert [r.rank for r in ranks] == sorted({r.rank for r in ranks})
        left = sorted(map(tuple, line_dedup.dedup_lines(texts).select("doc_id", "text").collect()))
        return len(depths), depths, left

    monkeypatch.setattr(common, "FILE_ROWS", 1)             # as many parts as before
    monkeypatch.setattr(common, "LEAST_FILES", 24)
    want = results()
    monkeypatch.setattr(common, "FILE_ROWS", 16)
    monkeypatch.setattr(common, "LEAST_FILES", 3)
    assert results() == want
