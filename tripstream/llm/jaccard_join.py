"""N-gram Jaccard join by a token-group matrix; exact.

A document's set are its distinct n-word shingles (64-bit hashes; A-Z
lower-cased). Two documents link when their sets' Jaccard similarity is at
least ``num / den``; the result is each document's component.

*Groups.* Documents of equal sets are one *class* (one copy goes on); classes
that link to a common leader form a *group*. The matrix has a row per (token,
group): the union of the tokens of the group's members. A query's overlap
with that union bounds its overlap with every member, and only groups whose
bound qualifies are opened, that is, have their members verified on whole sets.

*Which tokens.* All tokens have one order: those in at most ``c`` groups
first, then the others, by hash within both. Linked documents x, y share at
least k of the first p + k - 1 tokens of each, where p = n - ceil(t n) + 1 for a
set of n: the prefix filter. So only the rare tokens need counting: a
document with at least p rare tokens is *open* for k = rare - p + 1, a pair of
open ones needs min(k) common rare tokens, and a pair with one open document
needs one. At first only tokens with a hash below a bound that depends on the
set's size are emitted (about a quarter), chosen so that every token that
decides a pair is emitted by both sides.

*The rest.* Documents with fewer than p rare tokens (mostly boilerplate, or
members of a large family of near copies) go to the next level: whole sets, four
times the bound c, and groups: each document joins the nearest of the leaders that
share a minimum with it, if it is near (``NEAR``), linked or not. Leaders are
the documents with the fewest rare tokens: the originals of their near copies.
So a family's tokens lie in few groups, however many documents hold them.

A document that opens a group of several members is held against its leader first:
near it, it becomes a member; else only members as far from the leader as the
triangle inequality demands are verified. Of two groups the smaller one asks.

*Within a group* members are compared by what they differ in from the leader L:
D(x), the tokens of x or L but not both. Two members x, y differ in D(x) xor D(y), and
linked ones differ in ``(|x| + |y|) (1 - t) / (1 + t)`` tokens at most, so they
share all but so many of the tokens of D(x), and one at least unless both link to L.
Tokens of the family's common text are in no D, so the prefix filter runs on
edits, which are rare; the number of rare tokens shared, and of others that
could be, tells which pairs can link. Members that link to L need no pair among them.

Levels go on until no document is left, so nothing is capped or lost; with c
above the number of groups, and of a group's members, every token is rare.

Hot tokens and hot groups are aggregated before any shuffle; token lists
are only joined by token on rare tokens, so each row meets c others at most.
Equal copies are never compared.

Edge cases: null or empty text -> empty set, n_shingles 0, its own component;
fewer words than n -> the whole sequence is one shingle; repeated rows are
equal copies; null doc_id: the smallest non-null doc_id of the component
counts; empty table -> no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tripstream.llm.common import (
    few_parts,
    hashed_texts,
    long_lists,
    mix64,
    row_key,
    shared,
    shingle_hashes,
    small,
    wanted_texts,
    written,
)
from tripstream.llm.components import connected

N = 5
NUM, DEN = 80, 100
RARE = 16               # groups that hold a rare token at most, on the first level
GROWTH = 4
MINHASHES = 4           # tries to find a leader
NEAR = 3                # a member differs from its leader by so many times what linked ones may

_SEEDS = mix64(np.arange(1, MINHASHES + 1, dtype=np.uint64)) | np.uint64(1)


def _needed(n, num: int, den: int):
    """p: so many tokens of a set of n hold one of any linked set's."""
    return n - (n * num + den - 1) // den + 1


def _bound(n: float, num: int, den: int) -> float:
    """Share of the hash range that decides for a set of n; falls with n."""
    return min(1.0, 1.25 * (1 - num / den) + max(n, 1.0) ** -0.5)


def set_table(documents: DataFrame, n: int, num: int, den: int, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """``r, doc, n, s1, s2, m0.., nd, e``: row, size and checksums of the set,
    minima, how many of the emitted tokens decide, and those tokens."""
    minima = [f"m{j}" for j in range(MINHASHES)]
    schema = "r long, doc long, n int, s1 long, s2 long, " + ", ".join(f"{m} long" for m in minima) \
        + ", nd int, e array<long>"
    rows = documents.select(F.col(text).cast("binary").alias("t"), row_key(documents).alias("r"),
                            F.col(doc_id).cast("long").alias("doc"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = float(1 << 63)
        for part, words, at in hashed_texts(batches):
            sets = [np.unique(shingle_hashes(words[a:b], n) >> np.uint64(1)) for a, b in zip(at[:-1], at[1:])]
            numbers, emitted = [], []
            for s in sets:
                size = len(s)
                decide = min(size, int(np.searchsorted(s, np.uint64(min(top * _bound(size, num, den), top - 1)))))
                emit = min(size, int(np.searchsorted(s, np.uint64(min(
                    top * _bound(size * num // den, num, den), top - 1)))))
                if _bound(size, num, den) >= 1:
                    decide = size
                if _bound(size * num // den, num, den) >= 1:
                    emit = size
                with np.errstate(over="ignore"):
                    s1, s2 = s.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(s)) if size else np.uint64(0)
                    low = (s[:, None] * _SEEDS).min(axis=0) if size else np.zeros(MINHASHES, np.uint64)
                numbers.append([size, s1, s2, *low, decide])
                emitted.append(s[:emit])
            cols = list(zip(*numbers))
            as_long = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in cols[1:-1]]
            yield pa.RecordBatch.from_arrays(
                [part.column(1), part.column(2), pa.array(cols[0], pa.int32()), *as_long,
                 pa.array(cols[-1], pa.int32()), long_lists(emitted)],
                names=["r", "doc", "n", "s1", "s2", *minima, "nd", "e"])

    return rows.mapInArrow(make, schema)


def whole_sets(documents: DataFrame, wanted: DataFrame, n: int, text: str = "text") -> DataFrame:
    """``cid, s``: the whole sets of the wanted classes (columns cid, r)."""
    def tokens(words: np.ndarray) -> np.ndarray:
        return np.unique(shingle_hashes(words, n) >> np.uint64(1))

    rows = wanted_texts(documents, wanted, tokens, text)
    return written(rows.join(small(wanted)(wanted.select("cid", "r")), "r").select("cid", "s"), "jaccard-sets")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, na, nb, d`` of the pairs (a, b): sizes, and how many tokens they differ in."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                rows.append((len(x), len(y), len(x) + len(y) - 2 * shared(x, y)))
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(c, pa.int64()) for c in cols)],
                                             names=["a", "b", "na", "nb", "d"])

    both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("s").alias("sb")), "b")
            .select("a", "b", "sa", "sb"))
    return both.mapInArrow(check, "a long, b long, na long, nb long, d long")


def _differ(d: Column, na: Column, nb: Column, num: int, den: int, times: int = 1) -> Column:
    """Whether sets that differ in d tokens link (``times`` 1), or are so much further apart."""
    return d * (den + num) <= times * (den - num) * (na + nb)


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that link, on whole sets."""
    linked = _differ(F.col("d"), F.col("na"), F.col("nb"), num, den)
    return written(compared(pairs, sets).where(linked).select("a", "b"), "jaccard-links")


def _fits(a: Column, b: Column, num: int, den: int) -> Column:
    """Sizes that allow a link."""
    return F.least(a, b) * den >= F.greatest(a, b) * num


def match(tokens: DataFrame, docs: DataFrame, rare: int, num: int, den: int,
          size: int, thin: bool = False) -> tuple[DataFrame, DataFrame]:
    """One level: which document opens which group (``cid, og, n``), and the documents with ``k``.

    ``size``: rows of ``tokens``: t, cid, g, decides; ``docs``: cid, g, n, nd, size (members of g). Of two
    groups that of fewer members asks. ``thin``: drop tokens of one document before
    their groups are counted (most tokens, at first); each is its own group then, and
    ``tokens`` have no g.
    """
    if thin:
        # a set holds a token once; `d` keeps both readers of `tokens` alike, so Spark reuses them
        spread = (tokens.groupBy("t").agg(F.count("cid").alias("times"), F.max("decides").alias("d"))
                  .where("times > 1 AND d IS NOT NULL").select("t"))
        tokens = tokens.join(spread, "t").select("t", "cid", F.col("cid").alias("g"), "decides")
    tokens = written(tokens, "jaccard-tokens", rows=size)
    size, n_docs = tokens.count(), docs.count()
    width = (few_parts(tokens.select("t", "g").distinct(), size).groupBy("t").agg(F.count(F.lit(1)).alias("width"))
             .where("width > 1"))
    tokens = written(tokens.join(width, "t").select("t", "cid", "g", "decides", (F.col("width") <= rare).alias("rare")),
                     "jaccard-widths", rows=size)
    frequent = tokens.where("decides AND NOT rare").groupBy("cid").agg(F.count(F.lit(1)).alias("frequent"))
    p = F.expr(f"n - (n * {num} + {den - 1}) div {den} + 1")
    docs = docs.join(frequent, "cid", "left").select(
        *docs.columns, (F.col("nd") - F.coalesce("frequent", F.lit(0))).alias("rare"),
        (F.col("nd") - F.coalesce("frequent", F.lit(0)) - p + 1).alias("k"))
    docs = written(docs, "jaccard-docs", rows=n_docs)
    few = small(docs)
    rows = tokens.where("rare").select("t", "cid", "g").join(few(docs.select("cid", "k", "size")), "cid")
    union = rows.groupBy("t", F.col("g").alias("og"), F.col("size").alias("osize")).agg(F.max(F.col("k") >= 1).alias("opened"))
    # one of a pair is open, and then rare tokens decide
    counts = (rows.join(few_parts(union, size), "t").where("(size < osize OR (size = osize AND g < og)) AND (k >= 1 OR opened)")
              .groupBy("cid", "og").agg(F.count(F.lit(1)).alias("n_shared")))
    # two open documents share as many as the least k of them
    least = docs.groupBy(F.col("g").alias("og")).agg(F.min("k").alias("ok"))
    bound = F.greatest(F.lit(1), F.least("k", "ok"))
    opens = (counts.join(few(docs.select("cid", "n", "k")), "cid").join(few(least), "og")
             .where(F.col("n_shared") >= bound).select("cid", "og", "n"))
    return written(opens, "jaccard-opens", rows=size), docs


def grouped(docs: DataFrame, sets: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Groups around leaders: ``cid, leader, linked`` of the documents near one, and
    the links to leaders.

    ``docs``: cid, n, rare, m0..; the leader of a bucket of equal minima is the
    document with the fewest rare tokens.
    """
    tries = docs.select("cid", "n", "rare", F.posexplode(F.array(*[f"m{j}" for j in range(MINHASHES)])).alias("j", "m"))
    lead = (tries.groupBy("j", "m").agg(F.min(F.struct("rare", "cid", "n")).alias("lead"), F.count(F.lit(1)).alias("size"))
            .where("size > 1"))
    pairs = (tries.join(lead, ["j", "m"]).where(F.col("cid") != F.col("lead.cid"))
             .select(F.col("cid").alias("a"), F.col("lead.cid").alias("b")))
    found = written(compared(written(pairs.distinct(), "jaccard-leaders"), sets), "jaccard-compared")
    sizes = F.col("d"), F.col("na"), F.col("nb"), num, den
    linked = _differ(*sizes)
    near = (found.where(_differ(*sizes, NEAR)).groupBy(F.col("a").alias("cid"))
            .agg(F.min(F.struct("d", "b", (~linked).alias("apart"))).alias("x"))
            .select("cid", F.col("x.b").alias("leader"), (~F.col("x.apart")).alias("linked"), F.col("x.d").alias("d")))
    return near, found.where(linked).select("a", "b")


def differences(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``cid, g, s``: the tokens of a member or of its leader g, but not of both."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.setxor1d(x.values.to_numpy(), y.values.to_numpy(), assume_unique=True)
                     for x, y in zip(batch.column(2), batch.column(3))]
            if found:
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], long_lists([x.view(np.uint64) for x in found])],
                                                 names=["cid", "g", "s"])

    both = (members.select("cid", "g").join(sets, "cid")
            .join(sets.select(F.col("cid").alias("g"), F.col("s").alias("sl")), "g").select("cid", "g", "s", "sl"))
    return both.mapInArrow(make, "cid long, g long, s array<long>")


def within_groups(docs: DataFrame, sets: DataFrame, rare: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs ``a, b`` of one group, and the members (cid) that have too few rare tokens.

    ``docs``: cid, g, n, linked; a document may be in several groups. Only groups with a member that is not linked to
    the leader hold pairs that count: of two such members, or of one and a linked one. For
    either kind a member asks with the rarest of its tokens, as many as can be needed.
    """
    members = docs.where("cid != g")
    mixed = (members.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.max(~F.col("linked")).alias("any"))
             .where("size > 1 AND any").select("g"))
    members = written(members.join(mixed, "g", "left_semi"), "jaccard-members", rows=docs.count())
    size = members.count()
    tokens = written(differences(members, sets).select("cid", "g", F.explode("s").alias("t")), "jaccard-differences")
    n_tokens = tokens.count()
    width = tokens.groupBy("g", "t").agg(F.count(F.lit(1)).alias("width"))
    order = Window.partitionBy("g", "cid").orderBy("width", "t")
    tokens = written(tokens.join(width, ["g", "t"]).select("g", "t", "cid", "width", F.row_number().over(order).alias("place")),
                     "jaccard-edits", rows=n_tokens)
    sums = tokens.groupBy("g", "cid").agg(F.count(F.lit(1)).alias("d"), F.count_if(F.col("width") <= rare).alias("rare"))
    members = written(members.join(sums, ["g", "cid"]), "jaccard-members", rows=size)
    # the fewest tokens and the largest set that a partner of either kind can have
    kinds = members.groupBy("g").agg(*[f(F.when(F.col("linked") == k, F.col(c))).alias(f"{c}{int(k)}")
                                       for k in (False, True) for f, c in ((F.min, "d"), (F.max, "n"))])
    both = den + num

    def prefix(kind: str):
        """So many of a member's tokens hold one of those shared with any linked partner of a kind:
        they differ in (D(x) - D(y) + what linked sets may) / 2 of D(x) at most."""
        top = F.least(F.col(f"n{kind}"), F.expr(f"n * {den} div {num}"))
        apart = (den - num) * (F.col("n") + top)
        least = F.floor(((F.col("d") - F.col(f"d{kind}")) * both + apart) / (2 * both))
        return F.least(F.col("d"), F.floor(apart / both) + 1, least + 1)

    members = members.join(small(members)(kinds), "g").select(
        "cid", "g", "n", "linked", "d", "rare", prefix("0").alias("p0"),
        F.when(~F.col("linked"), F.coalesce(prefix("1"), F.lit(0))).alias("p1"))
    members = written(members.withColumn("open", F.col("rare") >= F.greatest("p0", F.coalesce("p1", F.lit(0)))), "jaccard-members", rows=size)
    few = small(members)
    rows = tokens.where((F.col("width") > 1) & (F.col("width") <= rare)).join(few(members), ["g", "cid"])

    def side(name: str, kind: str, linked: bool) -> DataFrame:
        """Tokens that members ask with for partners of a kind; ``others``: those left out."""
        return rows.where((F.col("linked") == linked) & (F.col("place") <= F.col(kind))).select(
            "g", "t", F.col("cid").alias(f"{name}_cid"), F.col("open").alias(f"{name}_open"), F.col("d").alias(f"{name}_d"),
            F.col("n").alias(f"{name}_n"), (F.col("d") - F.least("rare", kind)).alias(f"{name}_others"))

    apart = side("x", "p0", False).join(side("y", "p0", False), ["g", "t"]).where(
        "x_open AND (x_cid < y_cid OR (x_cid > y_cid AND NOT y_open))")
    one = side("x", "p1", False).join(side("y", "p0", True), ["g", "t"]).where("x_open OR y_open")
    met = apart.unionByName(one).groupBy(*[f"{p}_{c}" for p in "xy" for c in ("cid", "d", "n", "others")]).agg(
        F.count(F.lit(1)).alias("n_shared"))
    # what they differ in: all of both less what they share, twice; in the tokens' common
    # order, all that they share beyond what both asked with is left out by the one that asked less far
    fewest = F.col("x_d") + F.col("y_d") - 2 * (F.col("n_shared") + F.greatest("x_others", "y_others"))
    pairs = met.where(_differ(fewest, F.col("x_n"), F.col("y_n"), num, den)).select(
        F.greatest("x_cid", "y_cid").alias("a"), F.least("x_cid", "y_cid").alias("b")).distinct()
    return written(pairs, "jaccard-pairs", rows=n_tokens), members.where("NOT open").select("cid").distinct()


def opened(opens: DataFrame, docs: DataFrame, sets: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the documents that open groups (``cid, og, n``) meet there: candidate pairs
    ``a, b``, further members ``cid, g, n, linked``, and links to leaders.

    A group's only member is met itself. A larger group is first held against its leader:
    a document near it becomes a member; another can only link to members that
    are as far from the leader as the triangle inequality demands.
    """
    members = docs.select(F.col("g").alias("og"), F.col("cid").alias("m"), F.col("n").alias("mn"), F.col("d").alias("md"), "size")
    few = small(docs)
    one = opens.join(few(members.where("size = 1")), "og").where(_fits(F.col("n"), F.col("mn"), num, den)).select("cid", "m")
    large = docs.where("size > 1").select(F.col("g").alias("og")).distinct()
    found = written(compared(opens.join(large, "og", "left_semi").select(F.col("cid").alias("a"), F.col("og").alias("b")), sets),
                    "jaccard-compared")
    sizes = F.col("d"), F.col("na"), F.col("nb"), num, den
    linked, near = _differ(*sizes), _differ(*sizes, NEAR)
    more = found.where(near).select(F.col("a").alias("cid"), F.col("b").alias("g"), F.col("na").cast("int").alias("n"), linked.alias("linked"))
    far = (found.where(~near).select("a", F.col("b").alias("og"), "d", "na").join(few(members), "og")
           .where(_differ(F.col("d") - F.col("md"), F.col("na"), F.col("mn"), num, den) & _fits(F.col("na"), F.col("mn"), num, den))
           .select(F.col("a").alias("cid"), "m"))
    pairs = one.unionByName(far).where("cid != m").select(F.greatest("cid", "m").alias("a"), F.least("cid", "m").alias("b"))
    return written(pairs.distinct(), "jaccard-pairs", rows=opens.count()), more, found.where(linked & (F.col("a") != F.col("b"))).select("a", "b")


def jaccard_links(documents: DataFrame, table: DataFrame, classes: DataFrame, n: int, num: int,
                  den: int, rare: int = RARE, text: str = "text") -> DataFrame:
    """Links ``a, b`` between classes that connect all linked classes."""
    docs = classes.select("cid", F.col("cid").alias("g"), "n", "nd", F.lit(1).alias("size"))
    tokens = (table.select("r", "e").join(classes.select("r", "cid", "nd"), "r")
              .select("cid", "nd", F.posexplode("e").alias("at", "t"))
              .select("t", "cid", (F.col("at") < F.col("nd")).alias("decides")))
    size = classes.count()
    # about a quarter of all tokens
    opens, docs = match(tokens, docs, rare, num, den, classes.agg(F.sum("n")).first()[0] or 0, thin=True)
    others = docs.select(F.col("cid").alias("og"), F.col("n").alias("mn"))
    pairs = (opens.join(small(docs)(others), "og").where(_fits(F.col("n"), F.col("mn"), num, den))
             .select(F.greatest("cid", "og").alias("a"), F.least("cid", "og").alias("b")).distinct())
    pairs = written(pairs, "jaccard-pairs", rows=opens.count())
    rows = classes.select("cid", "r")
    wanted = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).unionByName(
        docs.where("k < 1").select("cid")).distinct().join(rows, "cid")
    sets = whole_sets(documents, written(wanted, "jaccard-wanted", rows=size), n, text)
    links = verify(pairs, sets, num, den)
    minima = classes.select("cid", *[f"m{j}" for j in range(MINHASHES)])
    left = written(docs.where("k < 1"), "jaccard-left")
    while size := left.count():
        rare *= GROWTH
        # a level compares what is left only: the other sets are not shuffled again
        sets = written(sets.join(small(left)(left.select("cid")), "cid", "left_semi"), "jaccard-sets")
        leaders, found = grouped(left.select("cid", "n", "rare").join(minima, "cid"), sets, num, den)
        links = links.unionByName(found)
        docs = left.select("cid", "n").join(leaders, "cid", "left").select(
            "cid", F.coalesce("leader", "cid").alias("g"), "n", F.col("n").alias("nd"),
            F.coalesce("linked", F.lit(False)).alias("linked"), F.coalesce("d", F.lit(0)).alias("d"))
        docs = written(docs, "jaccard-groups", rows=size)
        docs = written(docs.join(docs.groupBy("g").agg(F.count(F.lit(1)).alias("size")), "g").select(*docs.columns, "size"),
                       "jaccard-groups", rows=size)
        tokens = (docs.join(sets, "cid")
                  .select("cid", "g", F.explode("s").alias("t"))
                  .select("t", "cid", "g", F.lit(True).alias("decides")))
        opens, matched = match(tokens, docs.drop("linked", "d"), rare, num, den, left.agg(F.sum("n")).first()[0])
        pairs, more, found = opened(opens, docs, sets, num, den)
        links = links.unionByName(found)
        inner, again = within_groups(docs.select("cid", "g", "n", "linked").unionByName(more), sets, rare, num, den)
        links = links.unionByName(verify(pairs.unionByName(inner).distinct(), sets, num, den))
        left = matched.join(again.withColumn("again", F.lit(True)), "cid", "left").where("k < 1 OR again").drop("again")
        left = written(left, "jaccard-left", rows=size)
    return links


def near_components(documents: DataFrame, n: int = N, num: int = NUM, den: int = DEN, rare: int = RARE,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``r`` (its row_key), ``doc_id, n_shingles, component_id`` (the smallest
    doc_id reachable by links) and ``first`` (the row that stands for the component)."""
    table = written(set_table(documents, n, num, den, doc_id, text), "jaccard-table")
    minima = [f"m{j}" for j in range(MINHASHES)]
    # equal sets: the copy first in (doc_id, row) order
    key = ["s1", "s2", "n"]
    classes = (table.where("n > 0").groupBy(*key)
               .agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "r")).alias("one"),
                    F.first("nd").alias("nd"), *[F.first(m).alias(m) for m in minima])
               .select(F.monotonically_increasing_id().alias("cid"), *key, F.col("one.r").alias("r"), "one", "nd", *minima))
    classes = written(classes, "jaccard-classes", rows=table.count())
    roots = connected(jaccard_links(documents, table, classes, n, num, den, rare, text))
    labels = classes.join(roots.withColumnRenamed("a", "cid"), "cid", "left").select(
        *key, F.coalesce("b", "cid").alias("root"), "one")
    best = labels.groupBy("root").agg(F.min("one").alias("top"))
    labels = written(labels.join(best, "root").select(
        *key, F.col("top.doc").alias("component_id"), F.col("top.r").alias("first")), "jaccard-labels", rows=classes.count())
    rows = table.select("r", "doc", *key).join(labels, key, "left")
    return rows.select("r", F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                       F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"),
                       F.coalesce("first", "r").alias("first"))
