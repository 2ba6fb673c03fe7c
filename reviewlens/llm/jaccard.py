"""N-gram Jaccard join by set relations: equal sets are one, similar sets share their answers.

1. A text becomes the set of its hashed word n-grams. Texts with equal sets (128-bit digests) are one set.
2. Two sets that link share an n-gram among the first ``n - ceil(t n) + 1`` of each, in any one order of
   all n-grams. The order puts those found once first, then rarer before more frequent, so only n-grams
   that occur twice need an inverted list. Counting is confined to the ``ZONE`` part of the hash range; n-grams
   outside it come last, in hash order, and are used by sets that have too few inside.
3. Entries of a list carry the set's size and the n-gram's position. Sizes fall into blocks, and only the
   same and the next block can hold partners; inside, a pair is skipped when size and position leave
   too few n-grams to reach the threshold.
4. Lists are answered through pivots. In each list the set with fewest n-grams of its own is the pivot; every
   set is checked against the pivot it shares most lists with, and linked sets form components.
5. Sets checked against one pivot b share its answers: with r(x) n-grams of b missing in x and a(x) added, two
   of them link only if their differences from b have ``needed(x, y) - |b| + r(x) + r(y)`` n-grams in
   common. For a set that missed the threshold with b this is 1 or more with any other, so these pairs meet through
   lists of differences, which are short and again skipped by position; nothing is compared that
   agrees with b only.
6. Sets of one list that have different pivots and components are checked pair by pair.
   Every check is exact, on whole sets or whole differences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import (
    Powers, byte_values, flat, fresh_name, gram_hash, is_space, join_hot, lower_ascii, mix, prefix_hash, ship, slices, span_hash, stored, table, word_spans,
)
from .components import components, joined_components
from .registry import QUERIES

ship(__name__)

N = 5
PERCENT = 80
ZONE = 0.25
CUT = -(1 << 63) + int(ZONE * (1 << 64))
SLICE = 1 << 18
SCHEMA = "doc_id long, t1 long, t2 long, n long, d1 long, d2 long, z int, grams array<long>"


def text_digests(text: str) -> list[Column]:
    """128 bits that tell texts apart, NULL from ''."""
    given = F.coalesce(F.concat(F.lit("t"), text), F.lit(""))
    return [F.xxhash64(given).alias("t1"), F.xxhash64(F.lit(2), given).alias("t2")]


def prefix_length(n: Column, percent: int) -> Column:
    """How many n-grams of a set of ``n`` must be looked up."""
    return n - F.ceil(n * percent / F.lit(100)) + 1


def shingle_sets(docs: DataFrame, doc_id: str, text: str, n: int, percent: int, whole: bool) -> DataFrame:
    """Per row: id, digests of the text (t1, t2), size, digests of the set, how many n-grams lie in the zone, and the n-grams to look up (or all, ``whole``).

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer than ``n`` words, but not
    none, has its whole sequence as the one n-gram.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, outside, powers = lower_ascii(), is_space(), Powers()
        values = byte_values()[lower]
        salts = np.array([0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                data, offsets = flat(part.column("text"))
                starts, ends = word_spans(~outside[data], offsets)
                words = span_hash(prefix_hash(values[data], powers), starts, ends, powers)
                grams = gram_hash(words, n)
                borders = np.searchsorted(starts, offsets).tolist()
                out: list[tuple] = []
                for a, b in zip(borders[:-1], borders[1:], strict=True):
                    own = grams[a : b - n + 1] if b - a >= n else gram_hash(words[a:b], b - a) if b > a else grams[:0]
                    own = np.unique(own.view(np.int64))
                    bits = own.view(np.uint64)
                    digests = [int(mix(bits ^ s).sum(dtype=np.uint64).view(np.int64)) for s in salts]
                    zone = int(np.searchsorted(own, CUT))
                    need = len(own) - -(-len(own) * percent // 100) + 1 if len(own) else 0
                    out.append((len(own), *digests, zone, own if whole else own[: max(zone, need)]))
                lists = [o[4] for o in out]
                flat_lists = np.concatenate(lists) if lists else np.zeros(0, np.int64)
                list_starts = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
                columns = [part.column(c) for c in ("doc_id", "t1", "t2")] + [pa.array([o[k] for o in out], pa.int64()) for k in range(3)]
                columns.append(pa.array([o[3] for o in out], pa.int32()))
                columns.append(pa.ListArray.from_arrays(pa.array(list_starts), pa.array(flat_lists)))
                made = pa.RecordBatch.from_arrays(columns, names=["doc_id", "t1", "t2", "n", "d1", "d2", "z", "grams"])
                # nothing but the result waits while the rows are read
                del data, offsets, starts, ends, words, grams, out, lists, flat_lists, list_starts, columns
                yield made
                del made

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *text_digests(text), F.col(text).alias("text"))
    return picked.mapInArrow(run, SCHEMA)


def _needed(size_a: Column, size_b: Column, percent: int) -> Column:
    """Smallest overlap with which two sets link."""
    return F.ceil((size_a + size_b) * percent / F.lit(100 + percent))


def _can_link(percent: int) -> Column:
    """Whether sizes and positions leave enough n-grams; right for the first n-gram that a pair shares."""
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    rest = F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b"))
    return (small * 100 >= large * percent) & (rest >= _needed(F.col("n_a"), F.col("n_b"), percent))


def _lists(sets: DataFrame, percent: int) -> DataFrame:
    """Inverted lists (gram, set, n, p, own: n-grams that no other set has) of the n-grams within reach; stored."""
    exploded = sets.select("d1", "n", "z", F.posexplode("grams").alias("i", "gram"))
    # z tells the position of an n-gram in the zone once its count is known; outside, i is the position
    rows = exploded.select("gram", "d1", "n", F.when(F.col("gram") < CUT, F.col("z")).otherwise(F.col("i")).alias("zi"))
    repeated = stored(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("found")).where("found > 1"), "grams")
    shared = join_hot(rows, repeated, ["gram"], "found", "d1")
    # copies of one set meet here: pre-aggregated in every task
    entries = shared.groupBy("gram", "d1").agg(F.first("n").alias("n"), F.first("zi").alias("zi"), F.first("found").alias("found"))
    inside = F.col("gram") < CUT
    per_set = entries.groupBy("d1", "n").agg(
        F.sort_array(F.collect_list(F.when(inside, F.struct("found", "gram")))).alias("zone"),
        F.max(F.when(inside, F.col("zi"))).alias("z"),
        F.collect_list(F.when(~inside, F.struct("gram", "zi"))).alias("rest"),
    )
    placed = F.concat(
        F.transform("zone", lambda x, i: F.struct(x["gram"].alias("gram"), (F.col("z") - F.size("zone") + i).alias("p"))),
        F.transform("rest", lambda x: F.struct(x["gram"].alias("gram"), x["zi"].alias("p"))),
    )
    own = F.col("z") - F.size("zone")
    near = F.filter(placed, lambda x: x["p"] < prefix_length(F.col("n"), percent))
    return stored(per_set.select("d1", "n", F.coalesce(own, F.lit(0)).alias("own"), F.inline(near)), "lists")


def _block(n: Column, percent: int) -> Column:
    """Sizes that can link lie in the same or in neighbouring blocks."""
    return F.floor(F.log(n.cast("double")) / float(-np.log(percent / 100)) + 1e-9).cast("int")


def _verified(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with sizes, overlap, whether they link and, where b comes close, how a differs from it; stored."""
    left = whole.select(F.col("d1").alias("a"), F.col("grams").alias("grams_a"))
    right = whole.select(F.col("d1").alias("b"), F.col("grams").alias("grams_b"))
    sized = pairs.join(left, "a").join(right, "b").select(
        "a", "b", "grams_a", "grams_b", F.size("grams_a").alias("n_a"), F.size("grams_b").alias("n_b"),
        F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap"),
    )
    needed = _needed(F.col("n_a"), F.col("n_b"), percent)
    differs = F.concat(F.array_except("grams_a", "grams_b"), F.array_except("grams_b", "grams_a"))
    close = 2 * F.col("overlap") >= needed
    return stored(
        sized.select("a", "b", "n_a", "n_b", "overlap", (F.col("overlap") >= needed).alias("linked"),
                     close.alias("close"), F.when(close, differs).alias("differs")),
        "checked",
    )


def _by_differences(checked: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of sets checked against one pivot that link, at least one of them not with the pivot itself."""
    close = checked.where("close").withColumnRenamed("b", "pivot")
    missed = stored(
        close.groupBy("pivot").agg(F.count(F.lit(1)).alias("found"), F.bool_and("linked").alias("all")).where("not all"), "missed"
    )
    members = stored(
        join_hot(close, missed, ["pivot"], "found", "a").select(
            "pivot", F.col("a").alias("x"), F.col("n_a").alias("n"), "n_b", (F.col("n_b") - F.col("overlap")).alias("r"),
            (F.col("n_a") - F.col("overlap")).alias("more"), "linked", "differs",
        ),
        "members",
    )
    entries = members.select("pivot", "x", F.explode("differs").alias("gram"))
    repeated = stored(entries.groupBy("pivot", "gram").agg(F.count(F.lit(1)).alias("found")).where("found > 1"), "differences")
    met = join_hot(entries, repeated, ["pivot", "gram"], "found", "x").groupBy("pivot", "x").agg(
        F.sort_array(F.collect_list(F.struct("found", "gram"))).alias("listed")
    )
    # n-grams of one set only come first, then rarer ones; rest: how many of the set's differences are left from here
    listed = met.join(members.drop("differs"), ["pivot", "x"]).select(
        "pivot", "x", "n", "n_b", "r", "more", "linked", F.posexplode("listed").alias("place", "entry"), F.size("listed").alias("many")
    )
    placed = stored(
        listed.select("pivot", "x", "n", "n_b", "r", "more", "linked", F.col("entry.gram").alias("gram"),
                      (F.col("many") - F.col("place")).alias("rest")),
        "placed",
    )
    # against any other member at least so many differences must agree, see the module's step 5
    least_asker = _needed(F.col("n"), F.col("n_b"), percent) - F.col("n_b") + F.col("r")
    askers = placed.where(~F.col("linked") & (F.col("rest") >= least_asker)).select(
        "pivot", "gram", F.col("x").alias("a"), F.col("n").alias("n_a"), F.col("r").alias("r_a"), F.col("rest").alias("rest_a"), "n_b"
    )
    # a partner adds (100 r + percent (more)) / (100 + percent) to what its asker needs at least, which is 1
    least_target = 1 + F.floor((100 * F.col("r") + percent * F.col("more")) / F.lit(100 + percent))
    targets = placed.where(F.col("rest") >= least_target).select(
        "pivot", "gram", F.col("x").alias("b"), F.col("n").alias("m_b"), F.col("r").alias("r_b"), F.col("rest").alias("rest_b")
    )
    needed = _needed(F.col("n_a"), F.col("m_b"), percent) - F.col("n_b") + F.col("r_a") + F.col("r_b")
    met = askers.join(targets, ["pivot", "gram"]).where((F.col("a") != F.col("b")) & (F.least("rest_a", "rest_b") >= needed))
    pairs = met.groupBy("pivot", "a", "b").agg(F.first(needed).alias("needed"))
    sets = members.select("pivot", F.col("x").alias("a"), F.col("differs").alias("differs_a"))
    others = members.select("pivot", F.col("x").alias("b"), F.col("differs").alias("differs_b"))
    joined = pairs.join(sets, ["pivot", "a"]).join(others, ["pivot", "b"])
    agree = F.size(F.array_intersect("differs_a", "differs_b"))
    return stored(joined.where(agree >= F.col("needed")).select("a", "b"), "differing")


def _untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    """Pairs (a, b) that are not in ``tested``, in either order."""
    seen = tested.select(F.greatest("a", "b").alias("seen_a"), F.least("a", "b").alias("seen_b"))
    return pairs.join(
        seen, (F.greatest("a", "b") == F.col("seen_a")) & (F.least("a", "b") == F.col("seen_b")), "left_anti"
    )


def link_sets(docs: DataFrame, sets: DataFrame, doc_id: str, text: str, n: int, percent: int) -> DataFrame:
    """(node, root): the component of every set (by d1) that links with a different set."""
    small = shingle_sets(docs, doc_id, text, n, percent, False)
    lists = _lists(small, percent)
    several = stored(
        lists.groupBy("gram").agg(F.count(F.lit(1)).alias("length")).where("length > 1"), "several"
    )
    open_lists = join_hot(lists, several, ["gram"], "length", "d1").drop("length")
    listed = stored(open_lists.withColumn("block", _block(F.col("n"), percent)), "open")
    named = sets.groupBy("d1").agg(F.min(F.struct("doc_id", "t1", "t2")).alias("named"))
    asked = stored(listed.select("d1").distinct().join(named, "d1"), "asked")
    # one text of each set that has candidates is read again for all of its n-grams
    first = asked.select("d1", F.col("named.doc_id").alias("doc_id"), F.col("named.t1").alias("t1"), F.col("named.t2").alias("t2"))
    same_row = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_t1") == F.col("t1")) & (F.col("own_t2") == F.col("t2"))
    t1, t2 = text_digests(text)
    texts = docs.select(F.col(doc_id).cast("long").alias("own_id"), t1.alias("own_t1"), t2.alias("own_t2"), F.col(text).alias("own_text"))
    read = texts.join(first.hint("shuffle_hash"), same_row, "left_semi").select(F.col("own_id").alias("id"), F.col("own_text").alias("text"))
    whole = shingle_sets(read, "id", "text", n, percent, True)
    whole = stored(whole.select("d1", "grams"), "sets")

    blocks = F.array(F.col("block"), F.col("block") - 1)
    # pivots: in each block of a list (and the next one) the set with fewest n-grams of its own
    reach = listed.select("gram", "d1", "n", "p", "own", F.explode(blocks).alias("block"))
    pivots = stored(
        reach.groupBy("gram", "block").agg(
            F.min(F.struct("own", "d1", "n", "p")).alias("pivot"), F.count(F.lit(1)).alias("length")
        ).where("length > 1"),
        "pivots",
    )
    met = join_hot(reach, pivots, ["gram", "block"], "length", "d1").select(
        F.col("d1").alias("a"), F.col("pivot.d1").alias("b"), F.col("pivot.own").alias("own_b")
    ).where(F.col("a") != F.col("b"))
    # a set that cannot link with its pivot is checked too: what it shares decides about the pivot's other sets
    counted = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"), F.first("own_b").alias("own_b"))
    chosen = counted.groupBy("a").agg(F.max_by("b", F.struct("common", -F.col("own_b"), "b")).alias("b"))
    checked = _verified(chosen, whole, percent)
    links = checked.where("linked").select("a", "b").unionByName(_by_differences(checked, percent))
    labels = components(links)

    # what is open: pairs of different pivots and components in one list that size and position allow
    none = F.lit(None).cast("long")
    heads = checked.where("close").select(F.col("b").alias("d1"), F.col("b").alias("head"), none.alias("pivot"), none.alias("root"))
    groups = checked.where("close").select(F.col("a").alias("d1"), none.alias("head"), F.col("b").alias("pivot"), none.alias("root"))
    rooted = labels.select(F.col("node").alias("d1"), none.alias("head"), none.alias("pivot"), "root")
    # one value of each kind at most for a set, so that one join brings all three
    known = heads.unionByName(groups).unionByName(rooted).groupBy("d1").agg(*(F.max(c).alias(c) for c in ("head", "pivot", "root")))
    named = stored(
        listed.join(known, "d1", "left").select(
            "gram", "block", "d1", "n", "p", F.coalesce("head", "pivot", "d1").alias("pivot"), F.coalesce("root", "d1").alias("label")
        ),
        "labelled",
    )
    mixed = stored(
        named.groupBy("gram").agg(
            F.min("pivot").alias("p1"), F.max("pivot").alias("p2"), F.min("label").alias("l1"), F.max("label").alias("l2"),
            F.count(F.lit(1)).alias("length"),
        ).where("p1 <> p2 and l1 <> l2").select("gram", "length"),
        "mixed",
    )
    named = stored(join_hot(named, mixed, ["gram"], "length", "d1").drop("length"), "named")
    # sets of one pivot in one block of a list stand together; what their best could reach decides whether two such meet
    sides = named.groupBy("gram", "pivot", "block").agg(
        F.max(F.col("n") - F.col("p")).alias("rest"), F.min("n").alias("n"), F.min("label").alias("l1"), F.max("label").alias("l2")
    )
    other = sides.select(
        "gram", F.col("pivot").alias("pivot_b"), F.explode(blocks).alias("block"), F.col("block").alias("block_b"),
        F.col("rest").alias("rest_b"), F.col("n").alias("m_b"), F.col("l1").alias("l1_b"), F.col("l2").alias("l2_b"),
    )
    several = (F.col("l1") != F.col("l2")) | (F.col("l1_b") != F.col("l2_b")) | (F.col("l1") != F.col("l1_b"))
    reachable = F.least("rest", "rest_b") >= _needed(F.col("n"), F.col("m_b"), percent)
    once = (F.col("block_b") > F.col("block")) | (F.col("pivot") > F.col("pivot_b"))
    meet = sides.join(other, ["gram", "block"]).where((F.col("pivot") != F.col("pivot_b")) & once & several & reachable)
    best = ["rest_b", "m_b", "l1_b", "l2_b"]
    meet = meet.select("gram", "pivot", "block", "pivot_b", "block_b", *best)
    left = named.select("gram", "pivot", "block", F.col("d1").alias("a"), F.col("n").alias("n_a"), F.col("p").alias("p_a"), F.col("label").alias("label_a"))
    right = named.select(
        "gram", F.col("pivot").alias("pivot_b"), F.col("block").alias("block_b"), F.col("d1").alias("b"), F.col("n").alias("n_b"),
        F.col("p").alias("p_b"), F.col("label").alias("label_b"),
    )
    # a set joins in only if it could link with the best of the other side and is not of one component with all of it
    could = F.least(F.col("n_a") - F.col("p_a"), F.col("rest_b")) >= _needed(F.col("n_a"), F.col("m_b"), percent)
    differs = (F.col("label_a") != F.col("l1_b")) | (F.col("label_a") != F.col("l2_b"))
    asking = meet.join(left, ["gram", "pivot", "block"]).where(could & differs).drop(*best)
    open_ = asking.join(right, ["gram", "pivot_b", "block_b"])
    open_ = open_.where((F.col("label_a") != F.col("label_b")) & _can_link(percent)).select("a", "b").distinct()
    last = _verified(_untested(open_, checked), whole, percent).where("linked").select("a", "b")
    return joined_components(labels, last)


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, root, t1, t2), one row per row of ``docs``.

    Two rows link when their n-gram sets have ``100 * intersection >= percent * union``; equal sets link
    always. ``component_id`` is the smallest id of the rows that links reach (NULL if none of them has an
    id). NULL, '' and texts without words have empty sets, which link with nothing: their component is
    their own id. Rows with the same id are rows of their own. ``root`` names the component even where no id does, NULL for
    empty sets; ``t1`` and ``t2`` are 128 bits of the text. Other columns are not returned. An empty table gives no rows.
    """
    sets = stored(shingle_sets(docs, doc_id, text, n, percent, False).drop("grams", "z"), "documents")
    labels = link_sets(docs, sets.where("n > 0"), doc_id, text, n, percent)
    nodes = sets.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    labelled = nodes.join(labels.withColumnRenamed("node", "d1"), "d1", "left").withColumn("root", F.coalesce("root", "d1"))
    labelled = stored(labelled, "nodes")
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(labelled.join(least, "root").select("d1", "d2", "component_id", "root", "rows"), "classes")
    full = join_hot(sets.where("n > 0"), classes, ["d1", "d2"], "rows", "doc_id")
    out = full.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "root", "t1", "t2")
    none = F.lit(None).cast("long").alias("root")
    empty = sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), none, "t1", "t2")
    return out.unionByName(empty)


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, all of its columns.

    The row with the smallest id stays, rows without id last, rows of one id by their texts' digests. Rows that repeat an
    id and its text are one. Texts with empty sets link with nothing and stay.
    """
    own = [fresh_name(x) for x in ("id", "t1", "t2", "rows")]
    classes = jaccard_classes(docs, doc_id, text, n, percent)
    alone = F.when(F.col("root").isNull(), F.struct("doc_id", "t1", "t2"))
    rows = classes.groupBy("root", alone.alias("alone"), "doc_id", "t1", "t2").agg(F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy("root", "alone").orderBy(F.asc_nulls_last("doc_id"), "t1", "t2")
    first = rows.withColumn("place", F.row_number().over(order)).where("place = 1")
    kept = first.select(*(F.col(a).alias(b) for a, b in zip(("doc_id", "t1", "t2", "rows"), own, strict=True)))
    t1, t2 = text_digests(text)
    same_row = F.col(doc_id).cast("long").eqNullSafe(F.col(own[0])) & (t1 == F.col(own[1])) & (t2 == F.col(own[2]))
    left = docs.join(kept.hint("shuffle_hash"), same_row)
    single = left.where(F.col(own[3]) == 1)
    several = left.where(F.col(own[3]) > 1).dropDuplicates(own[:3])
    return single.unionByName(several).select(*docs.columns)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of linked ones stays, see ``first_of_each``."""
    return first_of_each(docs)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


QUERIES["op9_jaccard_join"] = op9_jaccard_join
