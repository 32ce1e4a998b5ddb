"""N-gram Jaccard join by vertical partitioning.

A document is the set of hashes of its distinct shingles.  Documents with one set form a class; classes are joined, and
a document has its class's result.  Shingles have a global order, cut into fragments; each fragment counts alone and the
counts are summed.

1. Fragment by fragment against the lone shingle.  Two sets A and B link only if at most (1-t) of A's shingles lack a
   partner.  The first fragment (``first`` of the hash space) counts, for each class, shingles that no other class has;
   that alone settles nearly all documents without a near copy, and only for the rest is the second fragment looked at.
2. Candidates.  What is left is ordered rarest first.  A linked pair shares a shingle of both prefixes; with the first
   shared one at places i and j, at most min(|A|-i, |B|-j) shingles are shared, which sets a bound on the pair.
   Of two linked sets one has its place in the first ninth (at t = 0.8), so only such "clean" ones are set against all.
3. Verification.  Candidate pairs meet their sets fragment by fragment; partial overlaps are counted and summed per pair.

Groups of near copies aren't expanded: per shingle the cleanest set, the hub, is compared with all others first.  Pairs
that this puts in one component need no further test; all other pairs that pass the bounds are tested, so no link between
components is lost.  Those meet by shingle and size: sizes of linked sets differ by a factor of 1/t at most, so a set looks into its own
grade of sizes and the next ones.  A shingle and grade with many sets is split by salts.  ``links`` gives every linked pair instead.

Cases.  Null and empty texts have no shingles and are alone, even if they are many.  A very long text is one set of all its shingles, in one row.  Of shingles equally
frequent the one with the smaller hash comes first; of documents with the least id of a component one is ``first``.  Texts of fewer words than a shingle
have one, the whole sequence.  Repeated rows get a result each; a null id is the largest.  An empty table gives an empty
result.  Further columns are ignored.  Hashes have 64 bits, see ``wordhash``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeweave.llm import wordhash
from citeweave.llm.common import attach_groups, bit_set, bounded, documents, forget, is_small, keep_rows, row_hash, saved, with_asked, with_uid
from citeweave.llm.components import components

_U64 = np.uint64


def _shingle_sets(size: int, low: int, only_sets: bool):
    """Per row: number of distinct shingles, signature of the set, and the shingles below ``low`` (all, with ``only_sets``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, raw, offsets in wordhash.text_slices(batch):
                made, to = wordhash.shingles(*wordhash.word_hashes(raw, offsets), size)
                sets = [np.unique(made[to[i] : to[i + 1]]) for i in range(end - begin)]
                sig = [int(wordhash.mix(s + _U64(1)).sum(dtype=_U64).view(np.int64)) for s in sets]
                if not only_sets:
                    sets_out = [s[: np.searchsorted(s, _U64(low))] for s in sets]
                else:
                    sets_out = sets
                ends = np.zeros(len(sets) + 1, np.int32)
                np.cumsum([len(s) for s in sets_out], out=ends[1:])
                flat = np.concatenate(sets_out) if sets_out else np.zeros(0, _U64)
                tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))
                own = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([own.column("uid"), own.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sig, pa.int64()), tokens], ["uid", "doc_id", "n", "sig", "tokens"])

    return run


_SETS = "uid long, doc_id long, n long, sig long, tokens array<long>"


def _lone(tokens: DataFrame) -> DataFrame:
    """(sig, lone): how many of the class's tokens in (sig, token) no other class has."""
    owners = tokens.groupBy("token").agg(F.min("sig").alias("a"), F.max("sig").alias("b"))
    return owners.filter("a = b").groupBy(F.col("a").alias("sig")).agg(F.count(F.lit(1)).alias("lone"))


def jaccard_join(docs: DataFrame, size: int = 5, threshold: Fraction = Fraction(4, 5), first: float = 0.28, fragments: int = 4, links: bool = False, uid: Column | None = None) -> DataFrame:
    """Per row of ``docs``: uid, doc_id, n_shingles, class_id, component_id (smallest doc_id of the component), first (whether it has it).

    With ``links``: (a, b) of every two classes that link, by class_id, instead.
    """
    num, den = threshold.numerator, threshold.denominator
    low = int(first * 2**64)
    base = with_uid(bounded(docs).select("doc_id", "text"), uid)
    first_fragment = saved(base.mapInArrow(_shingle_sets(size, low, False), _SETS), "jaccard-first")
    rows = saved(first_fragment.select("uid", "doc_id", "n", "sig"), "jaccard-rows")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    classes = saved(rows.filter("n > 0").groupBy("sig").agg(F.min(order).alias("least"), F.max("n").alias("n"), F.count(F.lit(1)).alias("n_rows")), "jaccard-classes")

    # 1. Classes that may still link: lone shingles are at most (1 - t) of all.
    few_lone = F.coalesce("lone", F.lit(0)) * den <= F.col("n") * (den - num)
    lone = _lone(first_fragment.select("sig", F.explode("tokens").alias("token")))
    alive = saved(classes.join(lone, "sig", "left").filter(few_lone).select("sig", "least"), "jaccard-alive")
    forget(first_fragment)  # the largest of all tables here
    ids = alive.select(F.col("least.doc_id").alias("rep_id")).distinct()
    if is_small(ids):
        again = base.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("rep_id")), "left_semi")
    else:  # by a set of bits of a bounded size: texts stay where they are, and sets that aren't alive leave below
        again = with_asked(base, bit_set(ids, F.xxhash64("rep_id")), F.xxhash64("doc_id"), "asked").filter("asked").drop("asked")
    sets = again.mapInArrow(_shingle_sets(size, low, True), _SETS).select("sig", "n", "tokens").join(alive.select("sig"), "sig", "left_semi")
    sets = saved(sets.groupBy("sig").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")), "jaccard-sets")

    # 2. The rest, rarest first; uid names the class for attach_groups.
    tokens = sets.select(F.col("sig").alias("uid"), "n", F.explode("tokens").alias("token"))
    df = saved(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "jaccard-df")
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared = attach_groups(tokens, df, "token", "df", total, how="inner")
    by_class = Window.partitionBy("uid")
    u = F.col("n") - F.count(F.lit(1)).over(by_class)
    place = u + F.row_number().over(by_class.orderBy("df", "token")) - 1
    reach = F.col("n") - F.ceil(F.col("n") * num / F.lit(float(den)) - 1e-9) + 1
    prefix = shared.select(F.col("uid").alias("sig"), "n", "token", u.alias("lone"), place.alias("at")).filter(few_lone & (F.col("at") < reach))
    prefix = saved(prefix.select("sig", "n", "token", "lone", "at"), "jaccard-prefix")
    forget(df)

    # overlap o links iff o / (n + n' - o) >= t, so o * (num + den) >= num * (n + n').
    def may_link(x: str, y: str) -> Column:
        most = F.least(F.col(f"{x}.n") - F.col(f"{x}.at"), F.col(f"{y}.n") - F.col(f"{y}.at"))
        return most * (num + den) >= (F.col(f"{x}.n") + F.col(f"{y}.n")) * num

    clean = F.col("at") * (num + den) <= F.col("n") * (den - num)
    if links:
        hubs, label = None, F.lit(0)
    else:
        hub = F.min(F.struct((F.col("lone") / F.col("n")).alias("part"), "sig", "n", "at")).alias("hub")
        by_token = saved(prefix.groupBy("token").agg(hub, F.count(F.lit(1)).alias("m")), "jaccard-hubs")
        x = attach_groups(prefix.withColumn("uid", F.col("sig")), by_token, "token", "m", prefix.count(), how="inner")
        pairs = x.select(F.struct("sig", "n", "at").alias("x"), F.col("hub").alias("y")).filter(F.col("x.sig") != F.col("y.sig")).filter(may_link("x", "y"))
        hubs = _linked(pairs.select(F.col("y.sig").alias("a"), F.col("x.sig").alias("b")).distinct(), sets, num, den, fragments)
    # All that is still open: clean sets against all that share a prefix token and are in another component.
    side = prefix if hubs is None else prefix.join(components(hubs).withColumnRenamed("v", "sig"), "sig", "left").withColumn("c", F.coalesce("c", "sig"))
    if hubs is not None:
        side = saved(side, "jaccard-open")
        open_tokens = side.groupBy("token").agg((F.min("c") != F.max("c")).alias("open")).filter("open").select("token")
        side = saved(side.join(open_tokens, "token", "left_semi"), "jaccard-open")
    apart = F.col("x.sig") != F.col("y.sig") if hubs is None else F.col("x.c") != F.col("y.c")
    rest = _meeting(side.filter(clean), side, num, den).filter(apart & may_link("x", "y"))
    rest = _linked(rest.select(F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b")).distinct(), sets, num, den, fragments)
    if links:
        return rest
    forget(sets, prefix)
    found = components(hubs.unionByName(rest))

    # Classes to components, components to their least id, and that to rows.
    member = classes.join(found.withColumnRenamed("v", "sig"), "sig", "left").withColumn("c", F.coalesce("c", "sig"))
    member = saved(member.select("sig", "c", "least", "n_rows"), "jaccard-members")
    least = member.groupBy("c").agg(F.min("least").alias("head"), F.count(F.lit(1)).alias("n_classes"))
    member = attach_groups(member.withColumn("uid", F.col("sig")), saved(least, "jaccard-least"), "c", "n_classes", member.count(), how="inner")
    member = saved(member.select("sig", "head", "n_rows"), "jaccard-members")
    out = attach_groups(rows, member, "sig", "n_rows", rows.count())
    alone = F.col("n") == 0
    first = alone | ((F.col("head.uid") == F.col("uid")) & F.col("head.doc_id").eqNullSafe(F.col("doc_id")))
    return out.select("uid", "doc_id", F.col("n").alias("n_shingles"), F.when(~alone, F.col("sig")).alias("class_id"), F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"), first.alias("first"))


def _meeting(some: DataFrame, side: DataFrame, num: int, den: int, parts: int = 400) -> DataFrame:
    """(x, y) of ``some`` and ``side`` that share a token and whose sizes n may belong to linked sets.

    A token and grade of sizes with more than 1/parts of ``some`` is hot; there are ``parts`` of those at most, and that
    list is broadcast.  Its rows of ``some`` go to several salts, and those of ``side`` are repeated once per salt.
    """
    grade = F.floor(F.log(F.col("n").cast("double")) / (math.log(den / num) * (1 + 1e-9))).cast("int")
    x, y = some.withColumn("grade", grade), side.withColumn("grade", F.explode(F.array(grade - 1, grade, grade + 1)))
    sizes = x.groupBy("token", "grade").agg(F.count(F.lit(1)).alias("m"))
    piece = max(1000, math.ceil(some.count() / parts))
    hot = F.broadcast(sizes.filter(F.col("m") > piece).select("token", "grade", F.ceil(F.col("m") / piece).cast("int").alias("salts")))
    x = x.join(hot, ["token", "grade"], "left").withColumn("salt", F.pmod(F.xxhash64("sig"), F.coalesce("salts", F.lit(1))).cast("int"))
    y = y.join(hot, ["token", "grade"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    x, y = (z.select("token", "grade", "salt", F.struct(*side.columns).alias(name)) for z, name in ((x, "x"), (y, "y")))
    return x.join(y, ["token", "grade", "salt"]).select("x", "y")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` of which one of each component stays, all columns as they are; texts without words stay."""
    found = jaccard_join(docs, uid=row_hash())
    return keep_rows(docs, found.select("doc_id", "uid", F.col("first").alias("kept"), (F.col("n_shingles") > 0).alias("once")))


def _linked(pairs: DataFrame, sets: DataFrame, num: int, den: int, fragments: int) -> DataFrame:
    """The pairs (a, b) that link: overlaps are counted in each fragment of the hash space and summed per pair."""
    pairs = saved(pairs, "jaccard-pairs")
    part = lambda t: F.pmod(F.shiftright(t, 60), F.lit(fragments))
    segments = F.transform(F.sequence(F.lit(0), F.lit(fragments - 1)), lambda f: F.struct(f.alias("f"), F.filter("tokens", lambda t: part(t) == f).alias("t")))
    # How many pairs ask for a set: a hub's segments go to several salts.
    asks = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("sig"), F.lit(1).alias("as_a")), F.struct(F.col("b").alias("sig"), F.lit(0).alias("as_a")))).alias("x")).groupBy(F.col("x.sig").alias("sig"))
    asks = asks.agg(F.sum("x.as_a").alias("m_a"), F.sum(1 - F.col("x.as_a")).alias("m_b"))
    cut = saved(sets.join(asks, "sig").select("sig", "n", "m_a", "m_b", F.inline(segments)), "jaccard-segments")
    side = lambda k: cut.filter(f"m_{k} > 0").select(F.struct(F.col("sig"), "f").alias(f"{k}_f"), F.col("n").alias(f"n{k}"), F.col("t").alias(f"t{k}"), f"m_{k}")
    asked = pairs.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))).alias("f"))
    asked = asked.select("a", "b", F.struct(F.col("a").alias("sig"), "f").alias("a_f"), F.struct(F.col("b").alias("sig"), "f").alias("b_f"), F.xxhash64("a", "b").alias("uid"))
    total = pairs.count() * fragments
    met = attach_groups(attach_groups(asked, side("b"), "b_f", "m_b", total, how="inner"), side("a"), "a_f", "m_a", total, how="inner")
    partial = met.select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("o"))
    summed = partial.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("o").alias("o"))
    found = saved(summed.filter(F.col("o") * (num + den) >= (F.col("na") + F.col("nb")) * num).select("a", "b"), "jaccard-links")
    forget(cut)
    return found


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")
