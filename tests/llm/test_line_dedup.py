import random

from pyspark.sql import functions as F

from tripstream.llm import line_dedup as ld


def brute(docs, min_lines, min_chars):
    """Texts after deletion; docs in (doc_id, row) order."""
    seqs = []
    for i, text in docs:
        lines = (text or "").split("\n")
        seqs.append([(k, x) for k, x in enumerate(lines) if x.strip(" \t\n\v\f\r")])
    gone = [set() for _ in docs]
    for k in range(1, min_lines + 1):
        seen = set()
        for n, seq in enumerate(seqs):
            for s in range(len(seq) - k + 1):
                run = tuple(x for _, x in seq[s:s + k])
                if run in seen:
                    if k == min_lines or sum(map(len, run)) >= min_chars:
                        gone[n].update(line for line, _ in seq[s:s + k])
                seen.add(run)
    return [(i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[n]))
            for n, (i, t) in enumerate(docs)]


def test_against_brute_force(spark, docs_of, clashing):
    rng = random.Random(4)
    pool = [f"line {k} " + "x" * rng.randint(0, 60) for k in range(25)] + ["", "  ", "a"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(120)]
    docs += [(200, "a\na\na\na\na\na"), (201, None), (202, ""), (203, "\n\n")]
    df = clashing(docs_of(docs))
    for lines, chars in ((3, 100), (4, 10_000), (1, 1), (5, 40)):
        out = ld.dedup_lines(df, lines, chars)
        assert out.columns == df.columns
        assert sorted(map(tuple, out.select("doc_id", "text").collect())) == sorted(brute(docs, lines, chars)), (lines, chars)


def test_repeated_rows_and_edges(spark, docs_of, odd):
    out = [tuple(r) for r in ld.dedup_lines(docs_of(odd, parts=1), 1, 1).select("doc_id", "text").collect()]
    assert len(out) == len(odd)
    same = "a b c d e f g"
    # null doc_id comes first and stays whole, later rows lose the line
    assert (None, same) in out and sorted(r for r in out if r[0] in (5, 6)) == [(5, ""), (5, ""), (6, "")]
    assert ld.dedup_lines(docs_of([])).count() == 0


def test_suffix_ranks_follow_the_order_of_runs(spark, docs_of):
    docs = [(i, "\n".join("abcab"[k % 5] * 3 for k in range(i, i + 9))) for i in range(6)]
    lines = ld.ordered_lines(docs_of(docs))
    where = {r["at"]: r.d for r in lines.collect()}
    assert [(r.d, r.seq) for r in lines.orderBy("at").collect()] == sorted((r.d, r.seq) for r in lines.collect())
    depths = ld.suffix_ranks(lines)
    assert len(depths) == 4                                  # runs of 8 lines repeat, of 16 none
    for p, rows in enumerate(depths):
        k, runs = 1 << p, {}
        for r in rows.collect():
            run = tuple(docs[where[r["at"]]][1].split("\n")[r.seq:r.seq + k])
            assert len(run) == k
            runs.setdefault(r["rank"], []).append(run)
        assert all(len(set(x)) == 1 and len(x) > 1 for x in runs.values())
        assert len(runs) == len({x[0] for x in runs.values()})
        if p:       # a rank's order is that of the ranks it is made of
            half = {(r.r, r.seq): r["rank"] for r in depths[p - 1].collect()}
            parts = sorted({(r["rank"], half[r.r, r.seq], half[r.r, r.seq + k // 2]) for r in rows.collect()})
            assert [x[1:] for x in parts] == sorted(x[1:] for x in parts)


def maximal(docs, min_lines, min_chars):
    """Longest runs that occur before, at each place, less those inside the run before."""
    seqs = [[(k, x) for k, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\v\f\r")] for _, t in docs]
    out = []
    for n, seq in enumerate(seqs):
        text = [x for _, x in seq]
        last = 0
        for s in range(len(seq)):
            best, where = 0, None
            for m, other in enumerate(seqs[:n + 1]):
                for z in range(len(other) if m < n else s):
                    k = 0
                    while s + k < len(seq) and z + k < len(other) and other[z + k][1] == text[s + k]:
                        k += 1
                    if k > best:
                        best, where = k, (docs[m][0], other[z][0])
            if best and best != last - 1:
                run = text[s:s + best]
                copies = sum([x for _, x in q[z:z + best]] == run for q in seqs for z in range(len(q) - best + 1))
                if best >= min_lines or sum(map(len, run)) >= min_chars:
                    out.append((docs[n][0], seq[s][0], best, copies, *where))
            last = best
    return sorted(out)


def test_maximal_runs_against_brute_force(spark, docs_of, clashing):
    rng = random.Random(14)
    pool = [f"line {k} " + "x" * rng.randint(0, 40) for k in range(12)] + ["", "a"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 16)))) for i in range(50)]
    whole = "\n".join(f"long {k}" for k in range(70))
    docs += [(100, whole), (101, "head\n" + whole), (102, whole.replace("long 37", "other")), (103, "a\na\na\na\na")]
    df = clashing(docs_of(docs, parts=1))
    for lines, chars in ((3, 100), (1, 1), (5, 30)):
        got = sorted(map(tuple, ld.repeated_runs(df, lines, chars).collect()))
        assert got == maximal(docs, lines, chars), (lines, chars)
    by = {(r.doc_id, r.line): r for r in ld.repeated_runs(df).collect()}
    assert by[101, 1].n_lines == 70 and by[102, 38].n_lines == 32 and by[102, 38].copies == 3


def test_native_plan(spark, docs_of):
    plan = ld.dedup_lines(docs_of([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert F is not None
