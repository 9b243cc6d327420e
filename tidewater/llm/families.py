"""Connected components of classes that share lists, without all pairs of a list.

The lists are those of a similarity join: classes that are alike enough are together in at
least one. First each class meets one pivot, chosen from those of its lists, which joins
families of copies at one pair a class; and once more, by the lists that still hold several
components. Then the members of a short open list (at most ``SHORT``) meet completely, so at
most ``SHORT / 2`` pairs a member. A long one gets pivots, more of them in each round, that meet all
its members of other components, until every list lies in one component or all its
members have been pivots. No link between two components is lost, and none inside one is needed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import written, written_small

SHORT = 32
PIVOTS = 8  # times as many pivots of a long list in each round

Bound = Callable[[Column, Column], Column]


def shared_lists(entries: DataFrame, name: str) -> DataFrame:
    """``entries`` (token, me) of lists of two members or more, each with the list's pivot and size.

    ``me`` is a struct that orders the members of a list and holds at least ``uid``.
    """
    pivots = entries.groupBy("token").agg(F.min("me").alias("pivot"), F.count("*").alias("size")).where("size > 1")
    return written(entries.join(pivots, "token"), f"{name}-lists")


def _pairs(joined: DataFrame, a: str, b: str) -> DataFrame:
    """Both ends in order, so that a pair met in two lists is one row."""
    first = F.col(f"{a}.uid") < F.col(f"{b}.uid")
    end = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    return joined.select(
        end(f"{b}.uid", f"{a}.uid").alias("x"), end(f"{a}.uid", f"{b}.uid").alias("y"),
        end(f"{b}_label", f"{a}_label").alias("x_label"), end(f"{a}_label", f"{b}_label").alias("y_label"),
    )


def _joined(labels: DataFrame | None, links: DataFrame, name: str) -> DataFrame:
    """Labels (uid, label) after new links between labels."""
    found = components(links.select(F.col("x_label").alias("x"), F.col("y_label").alias("y")))
    if labels is None:
        return written_small(found.select(F.col("node").alias("uid"), F.col("component").alias("label")), f"{name}-labels")
    found = written_small(found, f"{name}-merged")
    every = labels.unionByName(found.select(F.col("node").alias("uid"), F.col("node").alias("label"))).groupBy("uid").agg(F.min("label").alias("label"))
    moved = every.join(found.withColumnRenamed("node", "label"), "label", "left")
    return written_small(moved.select("uid", F.coalesce("component", "label").alias("label")), f"{name}-labels")


def _open(rows: DataFrame, name: str) -> DataFrame:
    """The rows (token, me, label) of lists that hold several labels, with the lists' sizes."""
    lists = rows.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count("*").alias("size")).where("a < b")
    return written(rows.join(lists.select("token", "size"), "token"), name)


def labelled(
    lists: DataFrame, bound: Bound, choose: Callable[[Column], Column], check: Callable[[DataFrame], DataFrame], name: str,
    refine: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame | None:
    """(uid, label): the least uid of the component of every member that has a link; None if there is no link.

    ``lists``: see ``shared_lists``. ``bound`` says of two members' structs whether they can be linked at all,
    ``choose`` picks the uid of one pivot for a member of several lists, ``check`` keeps the
    rows of (x, y, x_label, y_label) whose two ends are linked. ``refine`` may put other rows (token, me,
    label) in place of those that are still open, in which all their links can still be found.
    """
    at_pivot = lists.where((F.col("me.uid") != F.col("pivot.uid")) & bound(F.col("me"), F.col("pivot")))
    best = at_pivot.groupBy(F.col("me.uid").alias("u")).agg(choose(F.col("pivot")).alias("p"))
    first = best.select(F.greatest("u", "p").alias("x"), F.least("u", "p").alias("y")).withColumns({"x_label": F.col("x"), "y_label": F.col("y")})
    links = written_small(check(first), f"{name}-links")
    labels = None if links.isEmpty() else _joined(None, links, name)
    rows, turn = lists.select("token", "me"), 1
    other = lambda a, b: (F.col(f"{a}_label") != F.col(f"{b}_label")) & bound(F.col(a), F.col(b))
    while True:
        if labels is not None:
            rows = rows.withColumn("uid", F.col("me.uid")).join(labels, "uid", "left").select("token", "me", F.coalesce("label", "uid").alias("label"))
        else:
            rows = rows.withColumn("label", F.col("me.uid"))
        rows = _open(written(rows, f"{name}-rows"), f"{name}-open")
        if refine is not None:
            rows = _open(written(refine(rows.select("token", "me", "label")), f"{name}-refined"), f"{name}-open")
        left = rows.select("token", F.col("me").alias("a"), F.col("label").alias("a_label"), "size")
        if turn == 1:
            pivots = rows.groupBy("token").agg(F.min(F.struct("me", "label")).alias("p"))
        else:
            salt = F.pmod(F.xxhash64("me.uid", F.lit(turn)), F.lit(PIVOTS ** (turn - 1)))
            pivots = rows.where(F.col("size") > SHORT).groupBy("token", salt.alias("salt")).agg(F.min(F.struct("me", "label")).alias("p"))
        pivots = written_small(pivots.select("token", F.col("p.me").alias("b"), F.col("p.label").alias("b_label")), f"{name}-pivots")
        met = left.join(pivots, "token").where(other("a", "b"))
        if turn == 1:
            met = met.groupBy("a.uid").agg(F.min_by(F.struct("a", "a_label", "b", "b_label"), "b").alias("m")).select("m.*")
            pairs = _pairs(met, "a", "b")
        else:
            short = left.where(F.col("size") <= SHORT)
            twin = short.select("token", F.col("a").alias("b"), F.col("a_label").alias("b_label"))
            pairs = _pairs(met, "a", "b").unionByName(_pairs(short.join(twin, "token").where(F.col("a.uid") > F.col("b.uid")).where(other("a", "b")), "a", "b"))
        links = written_small(check(pairs.distinct()), f"{name}-links")
        if not links.isEmpty():
            labels = _joined(labels, links, name)
        if turn > 1:
            spent = pivots.select("token", F.col("b.uid").alias("uid"))
            rows = rows.where(F.col("size") > SHORT).withColumn("uid", F.col("me.uid")).join(spent, ["token", "uid"], "left_anti")
            rows = written_small(rows, f"{name}-left")
        if rows.isEmpty():
            return labels
        rows, turn = rows.select("token", "me"), turn + 1


def named(classes: DataFrame, labels: DataFrame | None, key: list[str], name: str) -> DataFrame:
    """(key, component_id): the least id of each class's component, written. ``classes``: (rep, key, id)."""
    if labels is None:
        return written(classes.select(*key, F.col("id").alias("component_id")), f"{name}-named")
    members = classes.select("rep", *key, "id").join(labels.withColumnRenamed("uid", "rep"), "rep", "left")
    members = written(members.withColumn("label", F.coalesce("label", "rep")), f"{name}-members")
    least = members.groupBy("label").agg(F.min("id").alias("component_id"))
    return written(members.select("label", *key).join(least, "label").select(*key, "component_id"), f"{name}-named")


def component_ids(rows: DataFrame, names: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``component_id``: that of their class, and their own id where they have none (empty sets)."""
    found = rows.join(names.withColumn("known", F.lit(True)), key, "left")
    return found.withColumn("component_id", F.when(F.col("known"), F.col("component_id")).otherwise(F.col("id"))).drop("known")
