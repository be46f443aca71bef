"""Line dedup: repeated runs of lines, later copies deleted (DataFrame functions only).

Each document is a sequence of line ids (lines without a word are left out of
the sequence and always stay). The *suffix ranks* over all sequences are built
by distributed *prefix doubling*: the rank of a position at depth 2h is the
rank of the pair (its rank at depth h, the rank h lines on at depth h).
Ranking a depth means: count the distinct pairs, range-partition and sort
the distinct ones, and number them in that order; so no task holds a whole
rank table, and a pair that occurs millions of times is one row of it. Positions
whose pair occurs once leave the deeper rounds; doubling goes on until no pair
repeats, however long a run is.

Positions with one rank at depth h are an interval of the suffix array whose
*longest common prefix* is at least h. How far a position shares its lines with an
earlier one lies between its last depth as a later copy and the double; it
is found by halving steps, all depths at once: a run of m lines between h and 2h
is the pair of the rank at its start and the rank h lines before its end, so each
step splits the intervals by one more rank. These are the intervals' lengths: the
longest run at each position that occurs before it, its copies, and the first of
them. *Maximal* runs are those not inside the run of the line before.

A run counts when it has ``min_lines`` lines, or fewer but ``min_chars``
characters. Of each interval the copy first in (doc_id, row, line) order
stays, and the lines of all later copies are deleted.

Lines are equal when two 64-bit hashes of them are. Every table between
rounds is written to the shared folder.

Edge cases: null text -> null text, no lines; empty text stays; a line
without a word stays; runs that overlap themselves (``a a a``) count as
copies of the first; repeated rows are documents of their own, the first one
in scan order stays whole; null doc_id comes first; empty table -> no rows;
extra columns are carried through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tripstream.llm.common import few_parts, row_key, written

MIN_LINES = 3
MIN_CHARS = 100

_BLANKS = " \t\n\x0b\x0c\r"
_DOC = ["d", "r"]        # doc_id and row: the order in which copies are kept
_COLUMNS = ["r", "seq", "at", "rank", "n", "first"]


def line_table(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``d, r, line, seq, h1, h2, chars``: lines with a word; ``seq`` counts them."""
    lines = F.filter(F.transform(F.split(F.col(text), "\n"),
                                 lambda x, i: F.struct(i.alias("line"), x.alias("x"))),
                     lambda s: F.btrim(s["x"], F.lit(_BLANKS)) != "")
    rows = documents.select(F.col(doc_id).cast("long").alias("d"), row_key(documents).alias("r"),
                            F.posexplode(lines).alias("seq", "s"))
    return rows.select("d", "r", F.col("s.line").alias("line"), "seq", F.xxhash64("s.x").alias("h1"),
                       F.xxhash64(F.lit(1), F.col("s.x")).alias("h2"), F.length("s.x").alias("chars"))


def ordered_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``line_table`` with ``at``: a number that rises with (doc_id, row, line) over all
    documents, so that the first of some places is a plain minimum."""
    rows = written(line_table(documents, doc_id, text), "lines")
    # sorted by range: the running id of a row rises from partition to partition
    rows = rows.repartitionByRange(*_DOC, "seq").sortWithinPartitions(*_DOC, "seq")
    return written(rows.withColumn("at", F.monotonically_increasing_id()), "lines")


def _ranked(keys: DataFrame, a: str, b: str, label: str, size: int) -> DataFrame:
    """Rank of each pair (a, b) that occurs twice or more: ``a, b, rank, n, first``.

    Ranks follow the order of the pairs. A row of ``first`` is the copy that stays.
    ``size``: rows of ``keys``; a pair that repeats takes two.
    """
    pairs = (keys.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
             .where("n > 1"))
    # sorted by range: the running id of a row rises from partition to partition
    ordered = few_parts(pairs, size // 2).repartitionByRange(a, b).sortWithinPartitions(a, b)
    return written(ordered.select(a, b, "n", "first", F.monotonically_increasing_id().alias("rank")), label, size // 2)


def suffix_ranks(lines: DataFrame) -> list[DataFrame]:
    """For depth 1, 2, 4, ..: ``r, seq, at, rank, n, first`` of the positions whose run of
    so many lines occurs twice or more; until no run does. ``lines`` as ``ordered_lines``."""
    size = lines.count()
    ranks = _ranked(lines, "h1", "h2", "line-ranks", size)
    rows = written(lines.join(ranks, ["h1", "h2"]).select(*_COLUMNS), "line-rows", size)
    out = []
    while size := rows.count():
        out.append(rows)
        depth = 1 << (len(out) - 1)
        w = Window.partitionBy("r").orderBy("seq").rangeBetween(depth, depth)
        pairs = rows.select("r", "seq", "at", F.col("rank").alias("here"), F.first("rank").over(w).alias("ahead"))
        pairs = written(pairs.where("ahead IS NOT NULL"), "line-pairs", size)
        ranks = _ranked(pairs, "here", "ahead", "line-ranks", size)
        rows = written(pairs.join(ranks, ["here", "ahead"]).select(*_COLUMNS), "line-rows", size)
    return out


def longest_runs(lines: DataFrame) -> DataFrame:
    """``r, seq, at, m, n, first``: the positions that repeat an earlier one, the most lines
    they share with one, how often that run occurs, and where first."""
    depths = suffix_ranks(lines)
    if not depths:
        return lines.select("r", "seq", F.lit(0).alias("m"), F.lit(0).cast("long").alias("n"), "at", F.col("at").alias("first")).limit(0)
    size = depths[0].count()                 # the places of each depth are among those of the first
    levels = None
    for p, rows in enumerate(depths):
        rows = rows.withColumn("p", F.lit(p))
        levels = rows if levels is None else levels.unionByName(rows)
    # the deepest level as a later copy
    later = levels.where("at != first")
    deepest = later.groupBy("at").agg(F.max("p").alias("p"))
    runs = written(later.join(deepest, ["at", "p"]).withColumn("m", F.expr("shiftleft(1, p)")), "line-runs", size)
    ranks = levels.select("p", "rank", "r", "seq", "at")
    done = runs.where("p = 0")               # a run of depth 2^p takes p steps
    for step in range(1, len(depths)):
        runs = runs.where(F.col("p") >= step)
        # longer by half the last step: the rank at the start, and that of the last 2^p lines
        more = F.col("m") + F.expr(f"shiftleft(1, p - {step})")
        probes = runs.select("p", "rank", more.alias("m2")).distinct()
        starts = ranks.join(probes, ["p", "rank"]).withColumn("last", F.col("seq") + F.col("m2") - F.expr("shiftleft(1, p)"))
        ends = ranks.select("p", "r", F.col("seq").alias("last"), F.col("rank").alias("end"))
        met = written(starts.join(ends, ["p", "r", "last"]).select("p", "rank", "m2", "end", "at"), "line-probes", size)
        key = ["p", "rank", "m2", "end"]
        groups = met.groupBy(*key).agg(F.count(F.lit(1)).alias("n2"), F.min("at").alias("first2")).where("n2 > 1")
        found = met.join(groups, key).where("at != first2").select("at", "m2", "n2", "first2")
        longer = runs.withColumn("m2", more).join(found, ["at", "m2"], "left")
        runs = written(longer.select("r", "seq", "at", "p", "rank", *[
            F.when(F.col("n2").isNotNull(), F.col(f"{c}2")).otherwise(F.col(c)).alias(c) for c in ("n", "first", "m")]), "line-runs", size)
        done = done.unionByName(runs.where(F.col("p") == step))
    return done.select("r", "seq", "at", "m", "n", "first")


def _counts(runs: DataFrame, lines: DataFrame, min_lines: int, min_chars: int) -> DataFrame:
    """The runs with ``line, chars, counts``: first line's number, characters (of runs
    below ``min_lines`` lines, else null), and whether the run counts."""
    own = lines.select("at", "d", "line", F.col("chars").alias("own"))
    rows = runs.join(own, "at")
    w = Window.partitionBy("r").orderBy("seq")
    # a run's lines all repeat earlier ones, so the next rows are its lines
    chars = F.lit(None).cast("long")
    for k in range(1, min_lines):
        chars = F.when(F.col("m") == k, F.sum("own").over(w.rowsBetween(0, k - 1))).otherwise(chars)
    rows = rows.withColumn("chars", chars)
    return rows.withColumn("counts", (F.col("m") >= min_lines) | F.coalesce(F.col("chars") >= min_chars, F.lit(False)))


def repeated_runs(documents: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, line, n_lines, copies, source_id, source_line``: the maximal runs of lines
    that occur before, each at its later copies, how often the run occurs in all, and where
    first; of the runs that count. ``n_lines`` counts lines with a word."""
    lines = ordered_lines(documents, doc_id, text)
    runs = _counts(longest_runs(lines), lines, min_lines, min_chars)
    w = Window.partitionBy("r").orderBy("seq")
    inside = (F.lag("seq").over(w) == F.col("seq") - 1) & (F.lag("m").over(w) == F.col("m") + 1)
    runs = runs.withColumn("inside", F.coalesce(inside, F.lit(False))).where("counts AND NOT inside")
    source = lines.select(F.col("at").alias("first"), F.col("d").alias("source_id"), F.col("line").alias("source_line"))
    return runs.join(source, "first").select(
        F.col("d").alias("doc_id"), "line", F.col("m").alias("n_lines"), F.col("n").alias("copies"), "source_id", "source_line")


def deleted_lines(lines: DataFrame, min_lines: int, min_chars: int) -> DataFrame:
    """``d, r, line``: lines inside a later copy of a run that counts."""
    rows = _counts(longest_runs(lines), lines, min_lines, min_chars)
    w = Window.partitionBy("r").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("counts"), F.col("seq") + F.col("m"))).over(w)
    return rows.withColumn("reach", reach).where("reach > seq").select(*_DOC, "line")


def dedup_lines(documents: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS,
                doc_id: str = "doc_id", text: str = "text", report: bool = False) -> DataFrame:
    """The documents (all columns) with later copies deleted from the text.

    ``report=True`` instead returns ``doc_id, n_lines, n_deleted, deleted, text``.
    """
    lines = ordered_lines(documents, doc_id, text)
    gone = (deleted_lines(lines, min_lines, min_chars)
            .groupBy(*_DOC).agg(F.collect_list("line").alias("gone")))
    # the row's own columns as one struct: extra names never clash
    docs = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col(doc_id).cast("long").alias("d"), row_key(documents).alias("r"))
    joined = docs.join(gone, (docs["d"].eqNullSafe(gone["d"])) & (docs["r"] == gone["r"]), "left").select(
        "row", F.coalesce("gone", F.array().cast("array<int>")).alias("gone"),
        F.explode(F.array(F.split(F.col(f"row.{text}"), "\n"))).alias("lines"))    # split once
    keep = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    left = F.array_join(F.transform(keep, lambda i: F.get("lines", i)), "\n")
    out = F.when(F.size("gone") == 0, F.col(f"row.{text}")).otherwise(left)
    if report:
        return joined.select(
            F.col(f"row.{doc_id}").alias("doc_id"),
            F.greatest(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
            F.size("gone").cast("long").alias("n_deleted"),
            F.array_join(F.array_sort("gone"), ",").alias("deleted"), out.alias("text"))
    return joined.select(*[out.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
